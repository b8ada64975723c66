"""Collocations by SETM: occurrence relations that grow by merge joins, one word at a time.

The occurrences of all words lie in a table (piece, pos, word), dealt and sorted by piece and position. Joined to itself at
adjacent positions it gives the occurrences of pairs; those are counted in groups, and only occurrences of frequent pairs
are kept as the next table, which joined to itself in the same way gives the triples. The tables are bucketed by piece, so
no join shuffles occurrences; what is shuffled is pieces once, and counts combined before. A small set of frequent groups
is broadcast as it is; a larger one as a sieve of fixed size, which may let others pass as well. Those cost time and
change nothing, as every count that matters is taken from the occurrences that passed.

Words are 64-bit hashes of language and word, checked to be different for different words, else another seed is taken.
Pairs are first counted by a hash of theirs, which can only keep too many; the counts that matter are of the words.

A text without words, empty or null, has no occurrences; a null language is ``und``. Repeated rows count again. Other
columns are not looked at. An empty table gives no phrases. Long texts are split to pieces in one row of a task each;
their occurrences are rows like others.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm import sieve
from ebbtide.sources.storage import remove, scratch_path, through_table

LEAST = 10  # occurrences of a phrase
COVERED = 50  # percent of its occurrences inside a longer one, from which a phrase is dropped
SCALE = 1_000_000
TOP = 2_000  # phrases of a language
BUCKET_ROWS = 3_000_000
EXACT_ROWS = 500_000  # frequent groups that are broadcast one by one
_BREAK = "[.,;:!?\\n-\\r]"
_WIDE = "decimal(16,0)"  # products of two, times SCALE, stay within 38 digits


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, text) of every piece of a text between breaks, A to Z lower-cased."""
    text = F.coalesce("text", F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # then the quick way does the same
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(lowered, _BREAK)).alias("text"))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.replace(text, F.lit("\t"), F.lit(" ")), " "), "")


def word_id(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "lang", "word")


def vocabulary(cut: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, f) of all words, and a seed for which their hashes are all different."""
    spark = cut.sparkSession
    counted = cut.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word")
    known = through_table(counted.agg(F.count("*").alias("f")), scratch_path(spark, "words"))
    seed = 0
    while known.groupBy(word_id(seed)).count().filter("count > 1").limit(1).count():
        seed += 1
    return known, seed


# A join by piece and position may use tables dealt by piece alone, and the order of their files.
_BUCKETED = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


@contextmanager
def joined_in_buckets(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in _BUCKETED}
    try:
        for name, value in _BUCKETED.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Occurrences:
    """Occurrence relations of one run: written in buckets of pieces, sorted, and dropped at the end."""

    def __init__(self, spark: SparkSession, rows: int) -> None:
        self.spark, self.buckets, self.names = spark, max(1, -(-rows // BUCKET_ROWS)), []
        self.buckets = max(self.buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.folder = scratch_path(spark, "occurrences")

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "piece")

    def write(self, rows: DataFrame) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, "piece").sortBy("piece", "pos")
        # Word hashes are wide and few: they pay as a dictionary.
        writer.option("parquet.dictionary.page.size", 8 << 20).option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.folder)


def among(rows: DataFrame, frequent: DataFrame, key: str) -> DataFrame:
    """Occurrences of frequent groups, and beyond ``EXACT_ROWS`` groups a few others; ``key`` is a hash. No shuffle."""
    if frequent.count() <= EXACT_ROWS:
        return rows.join(F.broadcast(frequent), key, "left_semi")
    return sieve.passing(rows, frequent, key)


def adjacent(left: DataFrame, right: DataFrame, *columns: Column) -> DataFrame:
    """Occurrences that are followed by one at the next position of their piece."""
    left, right = left.alias("x"), right.alias("y")
    follows = (F.col("x.piece") == F.col("y.piece")) & (F.col("x.pos") + 1 == F.col("y.pos"))
    return left.join(right.hint("merge"), follows).select("x.piece", "x.pos", *columns)


def counted(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("f")).filter(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Written tables: words (lang, word, f, id), pairs (a, b, f) and triples (a, b, c, f) of ids, and sizes (lang, n).

    All but the sizes hold what occurs ``least`` times or more.
    """
    spark = docs.sparkSession
    cut = pieces(docs)
    known, seed = vocabulary(cut)
    sizes = through_table(known.groupBy("lang").agg(F.sum("f").alias("n")), scratch_path(spark, "sizes"))
    words = known.filter(F.col("f") >= least).withColumn("id", word_id(seed))
    words = through_table(words, scratch_path(spark, "frequent-words"))

    found = Occurrences(spark, int(sizes.agg(F.sum("n")).first()[0] or 0))
    try:
        with joined_in_buckets(spark):
            # Pieces are numbered where they are read, dealt as texts, and become occurrences where they arrive.
            numbered = found.dealt(cut.filter("text <> ''").withColumn("piece", F.monotonically_increasing_id()))
            rows = numbered.select("piece", "lang", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
            rows = rows.select("piece", "pos", word_id(seed).alias("id"))
            ones = found.write(among(rows, words.select("id"), "id"))

            twos = adjacent(ones, ones, F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            twos = twos.withColumn("pair", F.xxhash64("a", "b"))
            likely = through_table(counted(twos, ["pair"], least).select("pair"), scratch_path(spark, "likely-pairs"))
            twos = found.write(among(twos, likely, "pair").drop("pair"))
            pairs = through_table(counted(twos, ["a", "b"], least), scratch_path(spark, "pairs"))

            threes = adjacent(twos, twos, F.col("x.a"), F.col("x.b"), F.col("y.b").alias("c"))
            triples = through_table(counted(threes, ["a", "b", "c"], least), scratch_path(spark, "triples"))
    finally:
        found.drop()
    return words, pairs, triples, sizes


def _score(a: Column, left: Column, right: Column) -> Column:
    a, left, right = (value.cast(_WIDE) for value in (a, left, right))
    return F.call_function("div", a * a * F.lit(SCALE).cast("decimal(7,0)"), left * right)


def _cut(k: int, left: Column, right: Column) -> Column:
    """A cut after k words; structs compare by score, then by k."""
    return F.struct(_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of every language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of the language.
    """
    spark = docs.sparkSession
    words, pairs, triples, sizes = frequent_phrases(docs, least)

    def named(name: str) -> DataFrame:
        return words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("f").alias(f"{name}_f"))

    inside = triples.select("a", "b", "f").unionByName(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    longest = inside.groupBy("a", "b").agg(F.max("f").alias("longer"))
    whole = F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f"))
    two = pairs.join(longest, ["a", "b"], "left").filter(whole).join(named("a"), "a").join(named("b"), "b").join(
        words.select(F.col("id").alias("a"), "lang"), "a"
    ).select(
        "lang", F.concat_ws(" ", "a_word", "b_word").alias("phrase"), F.col("f").alias("a"), "a_f", "b_f",
    ).withColumn("cut", _cut(1, F.col("a_f"), F.col("b_f")))
    three = (
        triples.join(pairs.withColumnRenamed("f", "ab_f"), ["a", "b"])
        .join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("bc_f")), ["b", "c"])
        .join(named("a"), "a").join(named("b"), "b").join(named("c"), "c").join(words.select(F.col("id").alias("a"), "lang"), "a")
        .select("lang", F.concat_ws(" ", "a_word", "b_word", "c_word").alias("phrase"), F.col("f").alias("a"), "a_f", "ab_f", "bc_f", "c_f")
        .withColumn("cut", F.least(_cut(1, F.col("a_f"), F.col("bc_f")), _cut(2, F.col("ab_f"), F.col("c_f"))))
    )
    columns = ["lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")]
    rows = through_table(two.select(*columns).unionByName(three.select(*columns)), scratch_path(spark, "phrases"))
    return best(rows, top).join(F.broadcast(sizes), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language: first of each of many parts of a language, then of those."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    inside = Window.partitionBy("lang", "part").orderBy(*order)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn("rank", F.row_number().over(inside))
    ranked = rows.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint")).drop("part")
