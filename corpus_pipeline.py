"""From raw documents to token ids, a stage at a time; each stage's rows are written and read back for the next.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given. All but the last return the columns of
``documents``. A null text is junk to the classifier like an empty one; repeated rows are equal sets to the near-duplicate
stage, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, decontaminate, line_templates, ngram_join, quality_cnn
from ebbtide.llm.workers import reachable
from ebbtide.sources.storage import scratch_path, through_table

# Near duplicates: five words, a similarity of 0.8 or more. Signatures find every such pair.
WORDS, PERCENT, SURE = 5, 80, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    network = quality_cnn.fit(docs, reachable(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.kept(docs, network)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines; a document that held nothing else goes."""
    found = line_templates.drop_recurring_lines(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        found = found.withColumn("n_chars", F.when(F.col("n_dropped") > 0, size).otherwise(F.col("n_chars")))
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.regexp_replace("text", "\\s+", " ")) == "")
    return found.filter(~F.coalesce(emptied, F.lit(False))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return ngram_join.one_of_each(docs, WORDS, PERCENT, SURE)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    passages = reachable(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, passages)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", encode),
]
# Trained weights, hashed signatures and merges are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = through_table(stage(spark, docs, sf_dir), scratch_path(spark, "stage"))
    return docs
