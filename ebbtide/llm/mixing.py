"""Mixing sources to target weights: whole documents in random order up to the exact budget of each source.

Every document gets a key from a hash of its id and text. Within a source the documents stand in the order of their keys;
the sizes before a document are a prefix sum, of the sizes of whole ranges first and then inside the one range that the
budget ends in. A document whose words lie before the end of the budget is taken, the one at the end up to the word that
fills it. A budget above a source's size takes all of it as often as it fits (an epoch each) and cuts the rest.

The keys are hashes, so a second run makes the same choice. Only DataFrame functions are used, and the texts are read
once: what is ranged and summed is a few numbers a document. A source that holds any share of the rows lies in as many
ranges as its rows call for; repeated rows, which have equal keys, are told apart by where they stood in the input.

Null and empty texts and texts of blanks have size 0 and take no words. A null source is a source, the last one. Null ids
hash like a value of their own. Repeated rows are taken one by one. A source without words has target 0. An empty table
gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.workers import small
from ebbtide.operators.prefix import numbered
from ebbtide.sources.storage import scratch_path, through_table

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # of all sizes
EPOCHS = 2  # no document is taken more often
RANGE_ROWS = 500_000
_WORD = "[^ \\t-\\r]+"
_PLAN = ("doc_id", "size", "source_size", "target", "taken")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word, its white space kept."""
    parts = F.split(text, "(?<=[^ \\t-\\r])(?=[ \\t-\\r])")
    return F.when(n > 0, F.array_join(F.slice(parts, 1, n.cast("int")), "")).otherwise("")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    All sources get the same number of words per weight, the level; where that is over ``epochs`` times their size they
    stop there, and the level rises by what they leave over the weight of the others, until no further source stops.
    Every round is one sum over the sources, and two numbers come to the driver.
    """
    ordered = numbered(sizes, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("position") - 1, F.lit(len(weights))).cast("int") + 1)
    rows = through_table(
        ordered.withColumn("weight", weight).withColumn("most", epochs * F.col("source_size").cast("double")).drop("position"),
        scratch_path(sizes.sparkSession, "sources"),
    )
    words_in_all, all_weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * float(words_in_all or 0)
    level = wanted / all_weights if all_weights else 0.0
    while all_weights:
        over = F.col("most") < F.lit(level) * F.col("weight")
        stopped, left = rows.agg(F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight")))).first()
        if not left:
            break
        risen = (wanted - (stopped or 0.0)) / left
        if risen <= level:
            break
        level = risen
    return rows.select("source", "source_size", F.least("most", F.lit(level) * F.col("weight")).alias("target"))


def described(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """What the plan needs of each document: source, id, size, key and the place in the input."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))
    return docs.select(
        "source", "doc_id", words(F.col("text")).alias("size"), F.substring(key, 1, 16).alias("key"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )


def plan(
    described_docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, row) for every document.

    ``taken`` counts the words that the mix takes of it, of all epochs together. ``row`` is its place in the input.
    """
    spark = described_docs.sparkSession
    rows = through_table(described_docs, scratch_path(spark, "described"))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("row")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    ranges = rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id())
    ranges = through_table(ranges, scratch_path(spark, "ranges"))

    # One row for each source and range that has some of it.
    sums = through_table(
        ranges.groupBy("source", "range").agg(F.sum("size").alias("inside")), scratch_path(spark, "sums")
    )
    budgets = targets(sums.groupBy("source").agg(F.sum("inside").alias("source_size")), weights, share, epochs)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs)).cast("bigint")
    whole = F.when(F.col("source_size") > 0, whole).otherwise(0)
    rest = F.round("target").cast("bigint") - F.col("epochs") * F.col("source_size")
    starts = sums.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
    named = budgets.select(F.struct("source").alias("of"), "source_size", "target")
    starts = (
        starts.withColumn("of", F.struct("source")).join(named, "of").withColumn("epochs", whole).withColumn("rest", rest)
        .select("of", "range", "before", "inside", "source_size", "target", "epochs", "rest")
    )
    starts = through_table(starts, scratch_path(spark, "starts"))
    # A struct of a null is equal to another, a null is not.
    located = ranges.withColumn("of", F.struct("source")).join(small(starts), ["of", "range"])

    ends_inside = (F.col("before") < F.col("rest")) & (F.col("rest") < F.col("before") + F.col("inside"))
    upto = Window.partitionBy("of", "range").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    border = located.filter(ends_inside).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    beyond = F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(F.lit(0))

    def taken(rows: DataFrame, last_epoch: Column) -> DataFrame:
        return rows.withColumn("taken", (F.col("epochs") * F.col("size") + last_epoch).cast("bigint")).select(*_PLAN, "source", "row")

    return taken(located.filter(~ends_inside), beyond).unionByName(taken(border, cut))


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The mixed documents: a row for each epoch that takes words of a document, with all its columns and ``_epoch``.

    The text of the document at the end of a budget ends with its last word that is taken.
    """
    spark = docs.sparkSession
    whole = through_table(docs.withColumn("_row", F.monotonically_increasing_id()), scratch_path(spark, "mixed"))
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    chosen = plan(described(whole, F.col("_row")), weights, share, epochs).filter("taken > 0").select(
        F.col("row").alias("_row"), F.col("size").alias("_size"), F.col("taken").alias("_taken"),
        F.explode(F.sequence(F.lit(1), times)).alias("_epoch"),
    )
    left = F.col("_taken") - (F.col("_epoch") - 1) * F.col("_size")
    found = whole.join(chosen, "_row")
    text = F.when(left >= F.col("_size"), F.col("text")).otherwise(first_words(F.col("text"), left))
    return found.withColumn("text", text).select(*docs.columns, "_epoch")
