"""Word n-gram Jaccard join with PartEnum signatures, and the groups that its links make.

A document is the set of its distinct word n-grams. Sizes are cut into bands; within a band a Jaccard similarity bounds
the number k of n-grams by which two sets may differ. The n-grams are dealt into n1 partitions by a hash; as k < 2 * n1,
some partition holds at most one difference. Each partition is dealt into n2 parts, and a signature is a hash of all
parts but one, for every choice of the one: two sets within k share a signature. A set also signs for the next band if
a partner could be there. The width of the bands and n2 are chosen so that a signature covers several n-grams, for any
similarity. A signature that covers none would gather strangers; ``spare`` further partitions make up for up to as many
that have one, so those are left out (a set with more keeps them all, so no pair is lost).

Holders of one signature are compared inside their bucket, by sketches: counts of the n-grams in cells of their hash,
a quarter as many cells as n-grams. The differences of the counts add up to no more than the n-grams by which two sets
differ, so a pair whose sum is too large is not similar, for certain; strangers are far beyond. Pairs that pass are ties,
and tied sets a family. Exact similarities are then taken within families. Both comparisons go by blocks of bounded size
that return one spanning link per set: first within blocks, then among the heads that are left, and last between the
sets outside a group's largest part and all its members. No pair is written out, and none is skipped.

Equal sets are one, named by its smallest id. Where rows of one id have different sets, the sets are told apart by their
digests, and every row has its own component. ``sure`` is the similarity (percent) from which a link is certain to be
found; it may be set above ``percent`` to save signatures, links between the two are then found by chance.

Ids are whole numbers. Null and empty texts have no n-grams and link with nothing, nor do rows without an id; a text
with fewer words than n is one n-gram. Repeated rows are equal sets. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.components import connected, local_roots
from ebbtide.llm.workers import CODECS, release, small
from ebbtide.sources.storage import passing_tables, scratch_path, through_table

WORDS, PERCENT = 3, 90
BLOCK_ROWS, BLOCK_NGRAMS = 1024, 4_000_000
GROUP_CHARS = 2_000_000
MAX_WORDS_KEPT = 100_000
# Widths of bands and least numbers of parts to choose from, those with the fewest signatures first.
WIDTHS = ((3, 3), (2, 3), (1, 3), (1, 4))
COVERED = 5  # n-grams that a signature should cover
WEAK_SHARE = 1e-4
CELL_NGRAMS, MIN_CELLS, MAX_CELLS, MAX_COUNT = 4, 16, 4096, 127
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_U = np.uint64


# ---- sets


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word) >> 1  # fits a signed number
        if len(self) < MAX_WORDS_KEPT:
            self[word] = value
        return value


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def ngram_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words of a text, A-Z lower-cased."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).astype(np.uint64)
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mix(total ^ hashes[i : len(words) - n + 1 + i]) * _U(0x9E3779B97F4A7C15)
    return np.unique(total)


# ---- signatures


class Band(NamedTuple):
    low: int
    high: int
    tag: int
    partitions: int
    parts: int
    spare: int


def _widths(sure: int) -> tuple[int, int]:
    """Steps of a band and least parts of a partition, so that a signature covers enough n-grams of a set."""
    share = sure / 100
    for steps, parts in WIDTHS:
        differences = 2 * (1 - share) / (1 + share) / share**steps  # per n-gram of the smallest set of a band
        if 2 / max(differences, 1e-9) * (parts - 1) / parts >= COVERED:
            break
    return steps, parts


def _shape(k: int, least: float, least_parts: int) -> tuple[int, int, int]:
    """Partitions, parts and spare partitions for k differences and sets of at least ``least`` n-grams."""
    parts = 8 if k == 1 else 6 if k < 4 else 4 if k < 8 else least_parts
    need = k // 2 + 1
    for spare in range(need + 1):
        covered = least / (need + spare) * (parts - 1) / parts
        weak = (need + spare) * min(1.0, parts * math.exp(-covered))
        tail = 1 - sum(math.exp(-weak) * weak**i / math.factorial(i) for i in range(spare + 1))
        if tail < WEAK_SHARE or spare >= 6:
            return need + spare, parts, spare
    return need, parts, 0


@lru_cache(maxsize=8)
def bands(sure: int, largest: int) -> tuple[Band, ...]:
    """Bands of sizes up to at least ``largest``; ``partitions`` is 0 where only equal sets are that similar."""
    share, low, out = sure / 100, 1, []
    steps, least_parts = _widths(sure)
    while not out or out[-1].high < largest:
        high = max(low, math.floor(low / share**steps))
        k = 2 * high * (100 - sure) // (100 + sure)
        shape = _shape(k, low * share, least_parts) if k else (0, 1, 0)
        out.append(Band(low, high, len(out), *shape))
        low = high + 1
    return tuple(out)


def signatures(sets: list[np.ndarray], sure: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, position of its set) of all sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.size or not sizes.max():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, owners = [], []
    for band in bands(sure, 1 << int(sizes.max() * 2).bit_length()):
        # Members, and smaller sets that a member may be similar to.
        inside = np.flatnonzero((sizes <= band.high) & (sizes * 100 >= band.low * sure) & (sizes > 0))
        inside = inside[(sizes[inside] >= band.low) | (sizes[inside] * 100 // sure >= band.low)]
        if band.partitions and inside.size:
            cells = band.partitions * band.parts
            flat = np.concatenate([sets[i] for i in inside])
            part = (mix(flat + _U(band.tag)) % _U(cells)).astype(np.int64)
            cell = np.repeat(np.arange(len(inside)) * cells, sizes[inside]) + part
            sums = np.zeros(len(inside) * cells, np.uint64)
            np.add.at(sums, cell, mix(flat ^ _U(0xD6E8FEB86659FD93)))
            counts = np.bincount(cell, minlength=len(sums)).reshape(len(inside), band.partitions, band.parts)
            sums = sums.reshape(counts.shape)
            key = sums.sum(axis=2, keepdims=True) - sums
            covers = counts.sum(axis=2, keepdims=True) - counts
            place = np.arange(cells, dtype=np.uint64).reshape(1, band.partitions, band.parts) << _U(8)
            key = mix(key + mix(place + _U(band.tag + 1)))
            weak = (covers == 0).any(axis=2).sum(axis=1) > band.spare
            keep = (covers > 0) | weak[:, None, None]
            keys.append(key[keep])
            owners.append(np.repeat(inside, keep.reshape(len(inside), -1).sum(axis=1)))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


# ---- sketches


def sketch(grams: np.ndarray) -> bytes:
    """Counts of the n-grams in equal cells of their hash; more cells for larger sets, a power of two."""
    bits = max(MIN_CELLS, min(MAX_CELLS, -(-len(grams) // CELL_NGRAMS)) - 1).bit_length()
    cells = (mix(grams ^ _U(0x8BB84B93962EACC9)) >> _U(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=1 << bits), MAX_COUNT).astype(np.uint8).tobytes()


def sketch_table(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of counts, folded to the fewest cells among them; neighbouring cells add up."""
    width = min(map(len, sketches))
    rows = [np.frombuffer(s, np.uint8).astype(np.int16).reshape(width, -1).sum(axis=1) for s in sketches]
    return np.stack(rows).astype(np.int16)


def possible(left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that may be similar enough, from a lower bound of the n-grams by which their sets differ."""
    found = np.zeros((len(left), len(right)), bool)
    step = max(1, 2_000_000 // max(1, right.size))
    for at in range(0, len(left), step):
        apart = np.abs(left[at : at + step, None, :] - right[None, :, :]).sum(axis=2, dtype=np.int64)
        both = left_sizes[at : at + step, None] + right_sizes[None, :]
        found[at : at + step] = (100 + percent) * apart <= (100 - percent) * both
    return found


# ---- jobs over the documents


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str]]]:
    for batch in batches:
        ids, texts, held = [], [], 0
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(key)
            texts.append(value.as_py() or "")
            held += len(texts[-1])
            if held > GROUP_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _task(job):
    """The work of a task, after which its worker, which others use as well, keeps no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(*CODECS)
        try:
            yield from job(batches)
        finally:
            _HASHES.clear()

    return run


def _digest(grams: np.ndarray) -> tuple[int, int]:
    """The two signed halves of a set's 128-bit digest."""
    value = xxhash.xxh3_128_intdigest(grams.tobytes())
    return (value & (1 << 64) - 1) - (1 << 63), (value >> 64) - (1 << 63)


def set_digests(docs: DataFrame, words: int) -> DataFrame:
    """(id, n_ngrams, k1, k2, sketch): size, digest and sketch of every set; only the size of an empty set or a null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _groups(batches):
            sets = [ngram_set(text, words) for text in texts]
            named = [len(grams) > 0 and i is not None for i, grams in zip(ids, sets)]
            digests = [_digest(grams) if ok else (None, None) for ok, grams in zip(named, sets)]
            sketches = [sketch(grams) if ok else None for ok, grams in zip(named, sets)]
            columns = [ids, [len(grams) for grams in sets], [d[0] for d in digests], [d[1] for d in digests]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(sketches, pa.binary())],
                names=["id", "n_ngrams", "k1", "k2", "sketch"],
            )

    return docs.mapInArrow(_task(run), "id bigint, n_ngrams bigint, k1 bigint, k2 bigint, sketch binary")


def signature_rows(docs: DataFrame, words: int, sure: int) -> DataFrame:
    """(key, node) of documents (id, text, several): the signatures of their sets, each set once a batch.

    The node is the id, or the digest of the set where rows of the id have several sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            several = {i for i, flag in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()) if flag}
            for ids, texts in _groups([batch]):
                seen, nodes, sets = set(), [], []
                for i, text in zip(ids, texts):
                    grams = ngram_set(text, words) if i is not None else ()
                    digest = _digest(grams) if len(grams) else None
                    if digest is not None and digest not in seen:  # equal sets are known by their digests
                        seen.add(digest)
                        nodes.append(digest[0] if i in several else i)
                        sets.append(grams)
                keys, owners = signatures(sets, sure)
                holders = np.array(nodes, np.int64)[owners]
                for at in range(0, len(keys), 100_000):
                    # Six bytes of a key: others only bring strangers together, and they shuffle for less.
                    part = (keys[at : at + 100_000] >> _U(16)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(holders[at : at + 100_000])], names=["key", "node"])

    return docs.select("id", "text", "several").mapInArrow(_task(run), "key bigint, node bigint")


def family_sets(docs: DataFrame, words: int) -> DataFrame:
    """(family, id, n, ngrams) of documents (family, node, k1, text) whose set has the digest k1; the id is the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [ngram_set(value.as_py() or "", words) for value in part.column(3)]
                own = pa.array([len(s) > 0 and _digest(s)[0] == k for s, k in zip(sets, part.column(2).to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["family", "id", "n", "ngrams"],
                ).filter(own)

    schema = "family bigint, id bigint, n bigint, ngrams binary"
    return docs.select("family", "node", "k1", "text").mapInArrow(_task(run), schema)


def overlaps(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set."""
    sets = [np.frombuffer(s, np.uint64) for s in (*left, *right)]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1  # an n-gram of one set meets no other
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        table = np.zeros((len(sets), width), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        total += table[: len(left)] @ table[len(left) :].T
    return total.astype(np.int64)


def similar(sizes: np.ndarray, sets: list[bytes], percent: int):
    """Which sets at some positions are similar enough to which at others."""

    def relate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        common = overlaps([sets[i] for i in left], [sets[i] for i in right])
        union = sizes[left][:, None] + sizes[right][None, :] - common
        return (100 * common >= percent * union) & (union > 0)

    return relate


def alike(sizes: np.ndarray, sketches: list[bytes], percent: int):
    """As ``similar``, for pairs whose sketches do not rule it out."""
    table = sketch_table(sketches)
    return lambda left, right: possible(table[left], sizes[left], table[right], sizes[right], percent)


def connecting(n: int, relate) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of n positions that connect whatever the relation connects.

    What is related to the first needs no pairs among itself; only the others are compared with all.
    """
    all_of = np.arange(n)
    near = relate(all_of[:1], all_of)[0]
    near[0] = True
    rest = np.flatnonzero(~near)
    x, y = np.nonzero(relate(rest, all_of)) if len(rest) else (rest, rest)
    return np.concatenate([np.zeros(int(near.sum()), np.int64), rest[x]]), np.concatenate([np.flatnonzero(near), y])


def spanning(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link to the smallest id for every id that the pairs (x, y) of positions connect to a smaller one."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    root = local_roots(len(ids), rank[x], rank[y])
    ids = ids[order]
    linked = ids != ids[root]
    return ids[linked], ids[root[linked]]


def compare(group: pd.DataFrame, relation, percent: int) -> pd.DataFrame:
    """Spanning links of a group; with rows marked ``outside``, only pairs of such a row with another row count."""
    group = group.sort_values(["outside", "id"], ascending=[False, True], ignore_index=True)
    relate = relation(group["n"].to_numpy(), list(group["ngrams"]), percent)
    rows = int(group["outside"].sum())
    if rows == 0:
        x, y = connecting(len(group), relate)
    else:
        x, y = np.nonzero(relate(np.arange(rows), np.arange(rows, len(group)))) if rows < len(group) else ([], [])
        x, y = np.asarray(x, np.int64), np.asarray(y, np.int64) + rows
    a, b = spanning(group["id"].to_numpy(), x, y)
    return pd.DataFrame({"a": a, "b": b})


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _links(groups: DataFrame, keys: list[str], relation, percent: int) -> DataFrame:
    spark = groups.sparkSession
    # By a given number: what a join before has dealt out by family alone is dealt again, by block.
    dealt = groups.select(*keys, "id", "n", "ngrams", "outside").repartition(_tasks(groups), *keys)
    found = dealt.groupBy(*keys).applyInPandas(lambda group: compare(group, relation, percent), "a bigint, b bigint")
    return through_table(found, scratch_path(spark, "ngram-links"))


def _blocks(members: DataFrame, name: str) -> DataFrame:
    """Members with the number of blocks of their family and a block of bounded size for each."""
    sizes = members.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_NGRAMS)).cast("int").alias(f"{name}s")
    )
    return members.join(sizes, "family").withColumn(name, F.pmod(F.xxhash64("id"), F.col(f"{name}s")).cast("int"))


def verified_links(members: DataFrame, percent: int, relation=similar) -> DataFrame:
    """Spanning links (a, b) of all pairs within families (family, id, n, ngrams) that the relation holds for."""
    spark = members.sparkSession
    inside = F.lit(False).alias("outside")
    placed = _blocks(members, "block")
    links = _links(placed.select("*", inside), ["family", "block"], relation, percent)
    large = placed.filter("blocks > 1")
    if large.isEmpty():
        return links
    # Heads: one document for each group found within a block.
    found = connected(links).withColumnRenamed("component", "head")
    headed = lambda rows, groups: rows.join(groups, "id", "left").withColumn("head", F.coalesce("head", "id"))
    heads = headed(large.select("family", "id", "n", "ngrams"), found).filter("id = head")
    links = links.unionByName(_links(_blocks(heads, "block").select("*", inside), ["family", "block"], relation, percent))
    found = connected(links).withColumnRenamed("component", "head")
    rest = headed(large.select("family", "id", "n", "ngrams", "block", "blocks"), found)
    counts = rest.groupBy("family", "head").agg(F.count("*").alias("members"))
    largest = counts.groupBy("family").agg(F.max_by("head", F.struct("members", "head")).alias("largest"))
    rest = through_table(rest.join(largest, "family"), scratch_path(spark, "ngram-rest"))
    outside = rest.filter("head <> largest")
    if outside.isEmpty():
        return links
    outsiders = _blocks(outside.drop("blocks", "block"), "row")
    rows = outsiders.select(
        "family", "id", "n", "ngrams", "row", F.lit(True).alias("outside"), "rows",
    )
    # Every block of outsiders meets every block of members.
    shape = rows.groupBy("family").agg(F.max("rows").alias("rows"))
    columns = rest.join(shape, "family").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    blocks = rest.groupBy("family").agg(F.max("blocks").alias("blocks"))
    rows = rows.join(blocks, "family").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = columns.withColumn("outside", F.lit(False))
    shared = ["family", "row", "block", "id", "n", "ngrams", "outside"]
    met = rows.select(*shared).unionByName(columns.select(*shared))
    return links.unionByName(_links(met, ["family", "row", "block"], relation, percent))


def bucket_links(buckets: DataFrame, percent: int) -> DataFrame:
    """Spanning links (a, b) of the pairs within buckets (family, id, n, ngrams, held) that their sketches allow.

    Most buckets have a few holders; those of a partition are gone through in order. Large ones go by blocks.
    """
    spark = buckets.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            ends = np.flatnonzero(np.diff(rows["family"].to_numpy())) + 1
            if len(ends):
                yield _in_order(rows[: ends[-1]], ends[:-1], percent)
                rows = rows[ends[-1] :]
            rest = rows.reset_index(drop=True)
        if rest is not None and len(rest):
            yield _in_order(rest, np.empty(0, np.int64), percent)

    few = buckets.filter(F.col("held") <= BLOCK_ROWS).select("family", "id", "n", "ngrams")
    few = few.repartition(_tasks(buckets), "family").sortWithinPartitions("family")
    links = through_table(few.mapInPandas(run, "a bigint, b bigint"), scratch_path(spark, "bucket-links"))
    many = buckets.filter(F.col("held") > BLOCK_ROWS).drop("held")
    return links if many.isEmpty() else links.unionByName(verified_links(many, percent, alike))


def _in_order(rows: pd.DataFrame, ends: np.ndarray, percent: int) -> pd.DataFrame:
    """Links of whole buckets, which lie one after another."""
    ids, sizes, sketches = rows["id"].to_numpy(), rows["n"].to_numpy(), list(rows["ngrams"])
    left, right = [], []
    for start, end in zip([0, *ends], [*ends, len(rows)]):
        relate = alike(sizes[start:end], sketches[start:end], percent)
        a, b = spanning(ids[start:end], *connecting(end - start, relate))
        left.append(a)
        right.append(b)
    return pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)}).drop_duplicates()


def near_duplicate_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sure: int | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable over links, itself included)."""
    rows = document_groups(docs, words, percent, sure, id_column, text_column)
    return rows.select(F.col("id").alias(id_column), F.col("n_ngrams").alias("n_shingles"), "component_id")


def document_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sure: int | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_ngrams, k1, k2, group, component_id) of every row, written; tables written on the way are gone.

    k1 and k2 are the digest of its set and ``group`` is the number of its component, null without a set. Components are
    named by their smallest id, which is the group's number unless rows of one id have different sets.
    """
    spark, sure = docs.sparkSession, max(percent, sure or percent)
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    path = scratch_path(spark, "document-groups")
    with passing_tables(spark):
        sets, several = _named_sets(source, words)
        one = sets.filter("node = rep").groupBy("rep").agg(
            F.first("n_ngrams").alias("n"), F.first("sketch").alias("ngrams"), F.first("k1").alias("k1"), F.first("id").alias("text_id")
        ).withColumnRenamed("rep", "id")
        families = _families(source.join(small(several), "id", "left"), sets, one, words, percent, sure)
        listed = families.join(one.select(F.col("id").alias("node"), "k1", F.col("text_id").alias("id")), "node")
        listed = through_table(listed, scratch_path(spark, "ngram-families"))
        # A small list of members spares the shuffle of all texts; a long one is joined by shuffle.
        members = family_sets(source.join(small(listed), "id"), words).dropDuplicates(["id"])
        members = through_table(members, scratch_path(spark, "ngram-members"))
        groups = connected(verified_links(members, percent)).withColumnRenamed("id", "rep")
        grouped = sets.join(groups, "rep", "left").withColumn("group", F.coalesce("component", "rep"))
        least = grouped.filter("group IS NOT NULL").groupBy("group").agg(F.min("least").alias("component_id"))
        found = grouped.join(least, "group", "left").select(
            "id", "n_ngrams", "k1", "k2", "group", F.coalesce("component_id", "id").alias("component_id")
        )
        return through_table(found, path)


def _named_sets(source: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows with what they are known by, and the ids whose rows have different sets (seldom any)."""
    spark = source.sparkSession
    sets_path, several_path = scratch_path(spark, "ngram-reps"), scratch_path(spark, "ngram-several")
    with passing_tables(spark):
        digests = through_table(set_digests(source, words), scratch_path(spark, "ngram-sets"))
        halves = [bound(half).alias(f"{name}_{half}") for half in ("k1", "k2") for name, bound in (("least", F.min), ("most", F.max))]
        several = digests.filter("k1 IS NOT NULL").groupBy("id").agg(*halves).filter("least_k1 < most_k1 OR least_k2 < most_k2")
        several = through_table(several.select("id", F.lit(True).alias("several")), several_path)
        named = digests.join(small(several), "id", "left").withColumn("node", F.when(F.col("several"), F.col("k1")).otherwise(F.col("id")))
        reps = named.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("node").alias("rep"), F.min("id").alias("least"))
        sets = named.join(reps, ["k1", "k2"], "left").select("id", "n_ngrams", "k1", "k2", "node", "rep", "least", "sketch")
        return through_table(sets, sets_path), several


def _families(docs: DataFrame, sets: DataFrame, one: DataFrame, words: int, percent: int, sure: int) -> DataFrame:
    """(node, family) of the sets that are tied; ``docs`` are (id, text, several), ``one`` has a row for each distinct set."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ngram-ties")
    with passing_tables(spark):
        buckets_path = scratch_path(spark, "ngram-buckets")
        with passing_tables(spark):
            keys = signature_rows(docs, words, sure)
            held = keys.withColumn("held", F.count("*").over(Window.partitionBy("key"))).filter("held > 1").drop("held")
            held = through_table(held, scratch_path(spark, "ngram-holders"))
            nodes = sets.filter("rep IS NOT NULL").select("node", "rep").distinct()
            held = held.join(nodes, "node").select(F.col("key").alias("family"), F.col("rep").alias("id")).distinct()
            counts = held.groupBy("family").agg(F.count("*").alias("held")).filter("held > 1")
            buckets = held.join(counts, "family").join(one.select("id", "n", "ngrams"), "id")
            buckets = through_table(buckets, buckets_path)
        tied = connected(bucket_links(buckets, percent))
        return through_table(tied.select(F.col("id").alias("node"), F.col("component").alias("family")), path)


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sure: int | None = None) -> DataFrame:
    """The documents without near copies: of each component a row with its smallest doc_id stays, with all columns.

    Rows without words or id stay, rows that repeat another in id and text go.
    """
    spark = docs.sparkSession
    groups = document_groups(docs, words, percent, sure)
    repeated = groups.filter("id IS NOT NULL").groupBy(F.col("id").alias("doc_id")).count().filter("count > 1").select("doc_id")
    repeated = through_table(repeated, scratch_path(spark, "repeated-ids"))
    copies = groups.filter("id <> component_id").select(F.col("id").alias("doc_id")).join(repeated, "doc_id", "left_anti")
    kept = docs.join(small(copies), "doc_id", "left_anti")
    if repeated.isEmpty():
        return kept.select(docs.columns)
    # Rows of a repeated id are told apart by their sets.
    of_set = groups.filter("k1 IS NOT NULL").selectExpr(
        "id AS doc_id", "k1 AS _k1", "k2 AS _k2", "group AS _group", "id <> component_id AS _copy"
    ).distinct()
    again = _with_digests(docs.join(small(repeated), "doc_id", "left_semi"), words)
    again = again.join(of_set, ["doc_id", "_k1", "_k2"], "left").filter(~F.coalesce("_copy", F.lit(False)))
    same = F.coalesce(F.col("_group").cast("string"), F.concat(F.lit("text "), F.xxhash64("text").cast("string")))
    first = F.row_number().over(Window.partitionBy("doc_id", same).orderBy("text"))
    again = again.withColumn("_first", first).filter("_first = 1")
    return kept.join(small(repeated), "doc_id", "left_anti").select(docs.columns).unionByName(again.select(docs.columns))


def _with_digests(docs: DataFrame, words: int) -> DataFrame:
    """The documents with _k1 and _k2, the digest of the set of their text."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngram_set(value.as_py() or "", words) for value in batch.column(place)]
            digests = [_digest(grams) if len(grams) else (None, None) for grams in sets]
            names = [*batch.schema.names, "_k1", "_k2"]
            halves = [pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *halves], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField("_k1", T.LongType()), T.StructField("_k2", T.LongType())])
    return docs.mapInArrow(_task(run), schema)
