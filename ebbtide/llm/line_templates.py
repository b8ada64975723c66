"""Line dedup by a log-template tree, in DataFrame functions only.

Lines descend a tree of fixed depth: number of tokens, then the first ``DEPTH`` tokens, those with a digit read as a
variable field. In a leaf, the tokens without digits of a line are ranked by the documents that have them at their place.
The first of them, ``MIN_CONSTANTS`` or more and at least ``CONSTANT`` of all, are its constants, and so are all with as
many documents as the last of these; every other token is a variable field. The rank depends on no count, so that values
of a field stay variable however often each occurs, and the constants part a leaf that mixes templates. Lines with equal
constants make a template; a line with too few tokens without digits is one by itself. Templates (and plain lines) that
occur in ``min_docs`` documents or more are dropped everywhere but in the document with the smallest id that has them, so
that of copied text one stays. A line that recurs as it is needs no more proof than a second document, ``REPEATS``,
whatever its length. Values that are more frequent at their place than constants (through other templates of the leaf)
make templates of their own.

Lines that recur as they are take part in all counts, as one row with its number of documents, and only leaves with
several lines and enough documents are split into tokens. Every text is parsed once, into a table of its lines. Lines under ``min_tokens`` tokens always stay. A leaf that a
third of all lines share is counted from distinct lines; all sums are combined before the shuffle. Nothing is collected,
and of the tables written on the way only the places of the dropped lines stay.

Null texts stay null, empty ones empty; a repeated row counts as one document and is treated like its twin. Rows with a
null id are documents; where all holders of a template have one, all keep it. Every input row comes back with its other
columns, whatever their names (``n_lines`` and ``n_dropped`` are replaced). An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import sieve
from ebbtide.sources.storage import passing_tables, scratch_path, through_table

DEPTH = 3
MIN_TOKENS = 5
MIN_DOCS = 3
CONSTANT = 0.7
MIN_CONSTANTS = 3
REPEATS = 2
BROADCAST_ROWS = 1_000_000
_BLANKS = " \t\x0b\f\r"
FIELD = "<*>"


def _masked(token: F.Column) -> F.Column:
    return F.when(token.rlike("[0-9]"), FIELD).otherwise(token)


def _small(rows: DataFrame) -> DataFrame:
    """Broadcast up to a bound that is checked, else left to a shuffle join."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _tokens(text: str) -> F.Column:
    return F.split(F.trim(F.col(text), F.lit(_BLANKS)), "\\s+")


def parsed_lines(docs: DataFrame, id_column: str, text_column: str, min_tokens: int) -> DataFrame:
    """(row, doc, pos, leaf, line, text): lines of at least ``min_tokens`` tokens at their leaf of the tree."""
    lines = docs.select(
        F.xxhash64(id_column, text_column).alias("row"), F.col(id_column).alias("doc"),
        F.posexplode(F.split(text_column, "\n")).alias("pos", "text"),
    )
    # Generated, so that the filter does not split a line a second time.
    lines = lines.select("row", "doc", "pos", "text", F.explode(F.array(_tokens("text"))).alias("tokens"))
    lead = [_masked(F.get("tokens", F.lit(i))) for i in range(DEPTH)]
    return lines.filter(F.size("tokens") >= min_tokens).select(
        "row", "doc", "pos", F.xxhash64(F.size("tokens"), *lead).alias("leaf"), F.xxhash64("tokens").alias("line"), "text"
    )


def recurring_lines(lines: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """(leaf, line, first): the lines to drop outside the document ``first``."""
    spark = lines.sparkSession
    holders = through_table(lines.select("leaf", "line", "row", "doc").distinct(), scratch_path(spark, "line-holders"))
    plain = holders.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("doc").alias("first"))
    plain = through_table(plain, scratch_path(spark, "line-counts"))
    # Leaves whose lines could make a template together; in the others a line is its own template.
    leaves = plain.groupBy("leaf").agg(F.sum("docs").alias("n"), F.count("*").alias("m")).filter(
        (F.col("n") >= min_docs) & (F.col("m") > 1)
    ).select("leaf")
    leaves = through_table(leaves, scratch_path(spark, "line-leaves"))
    texts = (
        lines.select("leaf", "line", "text").join(_small(leaves), "leaf")
        .groupBy("leaf", "line").agg(F.first("text").alias("text"))
    )
    places = plain.join(texts, ["leaf", "line"]).select(
        "leaf", "line", "docs", F.posexplode(_tokens("text")).alias("place", "token")
    ).filter(_masked(F.col("token")) != FIELD).select(
        "leaf", "line", "docs", F.xxhash64("place", "token").alias("slot")
    )
    places = through_table(places, scratch_path(spark, "line-places"))
    # A slot that a single line has is held by the documents of that line.
    shared = places.groupBy("leaf", "slot").agg(F.sum("docs").alias("held"), F.count("*").alias("lines")).filter(
        "lines > 1"
    ).select("leaf", "slot", "held")
    slots = places.join(shared, ["leaf", "slot"], "left").groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("held", "docs").alias("held"), "slot")), asc=False).alias("slots")
    ).filter(F.size("slots") >= MIN_CONSTANTS)
    needed = F.greatest(F.lit(MIN_CONSTANTS), F.ceil(F.size("slots") * F.lit(constant))).cast("int")
    slots = slots.withColumn("least", F.get("slots", needed - 1)["held"])
    kept = F.transform(F.filter("slots", lambda x: x["held"] >= F.col("least")), lambda x: x["slot"])
    templates = slots.select("leaf", "line", F.xxhash64(kept).alias("template"))
    named = plain.join(templates, ["leaf", "line"], "left").withColumn("own", F.col("template").isNull())
    named = named.withColumn("template", F.coalesce("template", "line"))
    named = through_table(named, scratch_path(spark, "line-templates"))
    key = ["leaf", "own", "template"]
    sums = named.groupBy(key).agg(
        F.sum("docs").alias("n"), F.max("docs").alias("most"), F.min("first").alias("first")
    ).filter(F.col("n") >= min_docs)
    sums = through_table(sums, scratch_path(spark, "line-sums"))
    # Documents with several lines of a template count once; one line in enough documents settles the count.
    sure = sums.filter(F.col("most") >= min_docs).select(*key, "first")
    open_lines = named.join(sums.filter(F.col("most") < min_docs).select(key), key).select(*key, "line")
    counted = (
        holders.join(open_lines, ["leaf", "line"]).select(*key, "row", "doc").distinct()
        .groupBy(key).agg(F.count("*").alias("n"), F.min("doc").alias("first"))
        .filter(F.col("n") >= min_docs).select(*key, "first")
    )
    again = F.col("docs") >= REPEATS
    drops = (
        named.join(sure.unionByName(counted).withColumnRenamed("first", "kept"), key, "left")
        .filter(F.col("kept").isNotNull() | again).select("leaf", "line", F.coalesce("kept", "first").alias("first"))
    )
    return through_table(drops, scratch_path(spark, "line-drops"))


def drop_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, constant: float = CONSTANT,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The documents with recurring lines taken out of ``text``; ``n_lines`` before, ``n_dropped``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "line-gone")
    with passing_tables(spark):
        lines = through_table(parsed_lines(docs, id_column, text_column, min_tokens), scratch_path(spark, "lines"))
        drops = recurring_lines(lines, min_docs, constant)
        gone = (
            lines.select("row", "doc", "pos", "leaf", "line").join(_small(drops), ["leaf", "line"])
            .filter(~F.col("doc").eqNullSafe(F.col("first")))
            .groupBy("row").agg(F.collect_set("pos").alias("_gone")).withColumnRenamed("row", "_row")
        )
        gone = through_table(gone, path)
    rows = docs.drop("n_lines", "n_dropped").withColumn("_row", F.xxhash64(id_column, text_column))
    # Only texts that lose lines are shuffled, and a few others.
    some, others = sieve.parted(rows, gone.select("_row"), "_row")
    met = some.join(gone, "_row", "left").unionByName(others.withColumn("_gone", F.lit(None).cast("array<int>")))
    split = F.split(text_column, "\n")
    kept = F.array_join(F.filter(split, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    return (
        met.withColumn("n_lines", F.when(F.col(text_column).isNull(), 0).otherwise(F.size(split)))
        .withColumn("n_dropped", F.when(F.col("_gone").isNull(), 0).otherwise(F.coalesce(F.size("_gone"), F.lit(0))))
        .withColumn(text_column, F.when(F.col("_gone").isNull(), F.col(text_column)).otherwise(kept))
        .drop("_row", "_gone")
    )
