"""The operators as queries over the test tables: name -> (spark, sf_dir) -> DataFrame, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import (
    bpe, decontaminate, line_templates, merkle, mixing, ngram_join, phrases, quality_cnn, secret_scan, sql, token_counts,
    token_store, toxicity, vector_dedup,
)
from ebbtide.llm.workers import reachable
from ebbtide.sources.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {
    "op8_vector_dedup": sql.VECTORS,
    "op11_merkle_manifest": sql.MERKLE, "op12_phrase_collocations": sql.PHRASES, "op13_source_mix": sql.MIXING,
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op2_line_templates(spark, sf_dir):
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


@query
def op3_byte_pair_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op5_quality_cnn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_vector_dedup(spark, sf_dir):
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op10_token_store(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_store.write_store(table(spark, sf_dir, "documents"), path)
    return token_store.read_store(spark, path, with_ids=False)


@query
def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered_leaf(), proofs=False)


@query
def op12_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_source_mix(spark, sf_dir):
    mixed = mixing.plan(mixing.described(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
