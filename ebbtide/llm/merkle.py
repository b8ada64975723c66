"""Merkle manifest of a dataset: a hash for every row, a tree for every language, one root, and a proof for every row.

The tree is cut into superblocks of ``2 ** HEIGHT`` neighbouring nodes. Going up, every superblock is reduced to its top
node; the tops, a thousandth as many rows, are the nodes of the next layer. Coming down, the nodes of a superblock and
the outer nodes it needs (what its top meets on the way to the root) are cogrouped by superblock: one call finishes the
reduction inside, joins inner and outer siblings to proofs, and folds the given leaves up to the root. A superblock is
bounded, so a language with any share of the rows is spread over as many tasks as it has superblocks. The subroots form
a tree of the same kind, however many languages there are.

A leaf is the lowercase hex sha256 of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte
count, a colon and its value. Leaves of a language are in the order of doc_id, null first, and rows of one doc_id in the
order of their leaves. Other columns are not looked at. Rows that are equal in all five columns have the same leaf at
several places, each with a proof of its own. Null, empty and very long texts are values like others. An empty table gives
an empty manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.workers import reachable, small
from ebbtide.sources.storage import scratch_path, through_table

HEIGHT = 10  # a superblock holds 1,024 nodes
RANGE_ROWS = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = ["tree", "block"]

_NODES = "tree string, block bigint, pos bigint, n bigint, node string"
_STEPS = "subroot string, root string, siblings array<string>, lefts array<boolean>"
_OUTER = f"tree string, block bigint, {_STEPS}"


def leaf_of(fields: Iterable[Column]) -> Column:
    """The hash of fields as text, each led by its length in bytes."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*parts), 256)


def tampered_leaf() -> Column:
    """The leaf after n_chars grew by one where 7 divides the crc32 of the id; null where nothing was changed."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    fields = [more.cast("decimal(20,0)") if name == "n_chars" else F.col(name) for name in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_of(fields))


def hex_hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def layers(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` layers over them; two neighbours become their hash, a last one its own."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([hex_hash(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def levels_inside(n: int, height: int) -> int:
    """Layers over a superblock of a tree of n nodes: up to the root of a small tree, else ``height``."""
    return min(height, (n - 1).bit_length())


def fold(node: str, siblings: Iterable[str], lefts: Iterable[bool]) -> str:
    """The root over a node by its proof; an empty sibling stands for a layer where the node was alone."""
    for sibling, left in zip(siblings, lefts):
        node = hex_hash(sibling, node) if left else hex_hash(node, sibling)
    return node


def placed(rows: DataFrame, order: list[str], height: int = HEIGHT) -> DataFrame:
    """Rows with pos (from 0) and n (the rows of the tree) in the order of (tree, *order), and their superblock.

    Ranges of the whole order are sorted one by one and written; the places follow from the counts of tree and range.
    Where a row stood in its input comes last in the order, so that equal rows can lie in different ranges.
    """
    spark = rows.sparkSession
    rows = through_table(rows.withColumn("_tie", F.monotonically_increasing_id()), scratch_path(spark, "nodes"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    order = ["tree", *order, "_tie"]
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie")
    ranges = ranges.select("*", F.monotonically_increasing_id().alias("_at"), F.spark_partition_id().alias("_range"))
    ranges = through_table(ranges, scratch_path(spark, "ranges"))
    counts = ranges.groupBy("tree", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
    )
    starts = through_table(starts, scratch_path(spark, "starts"))
    found = ranges.join(small(starts), ["tree", "_range"]).withColumn("pos", F.col("_at") + F.col("_shift"))
    return found.drop("_range", "_at", "_shift").withColumn("block", F.shiftright("pos", height))


def tops(nodes: DataFrame, height: int) -> DataFrame:
    """One node for each superblock, in its place in the layer above."""

    def reduced(block: pd.DataFrame) -> pd.DataFrame:
        n, number = int(block["n"].iloc[0]), int(block["block"].iloc[0])
        levels = levels_inside(n, height)
        top = layers(block.sort_values("pos")["node"].tolist(), levels)[-1][0]
        return pd.DataFrame({
            "tree": block["tree"].iloc[:1], "block": number >> height, "pos": number, "n": (n + (1 << levels) - 1) >> levels,
            "node": top,
        })

    return nodes.select("tree", "block", "pos", "n", "node").groupBy(*BLOCK).applyInPandas(reduced, _NODES)


def upward(nodes: DataFrame, label: str, height: int) -> list[DataFrame]:
    """The nodes and the layers over them, each written; the last holds the roots of the trees."""
    found = [nodes]
    # One number comes to the driver: the rows of the largest tree.
    most = nodes.agg(F.max("n")).first()[0] or 1
    while len(found) == 1 or most > 1:
        found.append(through_table(tops(found[-1], height), scratch_path(nodes.sparkSession, label)))
        most = (most + (1 << height) - 1) >> height
    return found


def with_steps(block: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    """The rows of a superblock with the steps of each to the root: its siblings, inner and outer, and their sides.

    Without outer nodes the top of the superblock is the root.
    """
    block = block.sort_values("pos").reset_index(drop=True)
    *inner, (top,) = layers(block["node"].tolist(), levels_inside(int(block["n"].iloc[0]), height))
    beyond, sides, subroot, root = [], [], top, top
    if len(outer):
        row = outer.iloc[0]
        beyond, sides, subroot, root = list(row["siblings"]), [bool(left) for left in row["lefts"]], row["subroot"], row["root"]
    siblings, lefts = [], []
    for i in range(len(block)):
        others = [(i >> depth) ^ 1 for depth in range(len(inner))]
        siblings.append([layer[j] if j < len(layer) else "" for layer, j in zip(inner, others)] + beyond)
        lefts.append([j % 2 == 0 for j in others] + sides)
    return block.assign(siblings=siblings, lefts=lefts, subroot=subroot, root=root)


def joined(nodes: DataFrame, outer: DataFrame | None, finish, schema: str) -> DataFrame:
    """Nodes and the outer nodes they need, cogrouped by superblock."""
    names = [part.split()[0] for part in schema.replace("array<", "").split(", ")]
    outer = nodes.sparkSession.createDataFrame([], _OUTER) if outer is None else outer

    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        # Only a superblock without nodes has nothing to return.
        return finish(block, outer)[names] if len(block) else pd.DataFrame(columns=names)

    return nodes.groupBy(*BLOCK).cogroup(outer.groupBy(*BLOCK)).applyInPandas(run, schema)


def downward(found: list[DataFrame], outer: DataFrame | None, label: str, height: int) -> DataFrame | None:
    """What the superblocks of the lowest layer need, given what the roots of the trees need."""

    def steps(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        # A node is the top of the superblock of its number in the layer below.
        return with_steps(block, outer, height).assign(block=lambda rows: rows["pos"])

    for nodes in reversed(found[1:-1]):
        outer = through_table(joined(nodes, outer, steps, _OUTER), scratch_path(nodes.sparkSession, label))
    return outer


def language_tree(subroots: DataFrame, height: int) -> DataFrame:
    """The tree over the subroots: what the root of each language's tree needs."""

    def steps(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = with_steps(block, outer, height)
        return rows.assign(tree=rows["name"], block=0, subroot=rows["node"])

    rows = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    nodes = placed(rows, ["name"], height)
    outer = downward(upward(nodes, "forest", height), None, "forest-steps", height)
    return through_table(joined(nodes, outer, steps, _OUTER), scratch_path(rows.sparkSession, "language-steps"))


def manifest(docs: DataFrame, given: Column | None = None, proofs: bool = True, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, siblings, lefts) for every row.

    ``given`` is the leaf as whoever checks a row would hash it (null: unchanged); it is folded up to ``folded_root``, and
    ``verified`` says whether that is the root. ``siblings`` is the proof from the leaf to the root, empty texts where a
    node was alone, and ``lefts`` says which siblings stand to the left; without ``proofs`` these two are left out, and
    only the hash of the proof is returned.
    """
    reachable(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    # Texts are read once; what follows has hashes only. Null sorts before every language.
    hashed = docs.select(
        F.coalesce(F.concat(F.lit(":"), "lang"), F.lit("-")).alias("tree"), "doc_id",
        leaf_of(F.col(name) for name in FIELDS).alias("node"),
        (F.lit(None).cast("string") if given is None else given).alias("given"),
    )
    # As text, since a null would turn whole numbers into floats in pandas.
    nodes = placed(hashed, ["doc_id", "node"], height).withColumn("doc_id", F.col("doc_id").cast("string"))
    trees = upward(nodes, "tops", height)
    outer = downward(trees, language_tree(trees[-1], height), "steps", height)

    def finish(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = with_steps(block, outer, height)
        given = rows["given"].where(rows["given"].notna(), rows["node"])
        folded = [fold(*row) for row in zip(given, rows["siblings"], rows["lefts"])]
        return rows.assign(
            leaf=rows["node"], proof_sha256=[hex_hash(*row) for row in rows["siblings"]], folded_root=folded,
            verified=[root == one for root, one in zip(rows["root"], folded)],
        )

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if proofs:
        schema += ", siblings array<string>, lefts array<boolean>"
    return joined(nodes, outer, finish, schema).withColumn("doc_id", F.col("doc_id").cast(kind))
