"""Benchmark decontamination: documents that hold a benchmark passage up to a few edits.

The random walk of Chakraborty, Goldenberg and Koucky turns edit distance into Hamming distance: it reads a text and at
each step, by a random bit that depends on step and byte, moves on or reads the byte again. Two texts that differ by few
edits fall into step again soon after each, so sampling a few places of the walk is a locality-sensitive hash. Every
word of a document starts a walk; every word of a passage that leaves room starts one too, so a passage as long as its
window has dozens of independent chances in each of ``REPEATS`` walks. A hit proposes the item-sized window around it,
and the exact number of edits decides (Myers' bit-vector search, the window's ends free).

Texts are compared in lower case with runs of white space as one space. ``max_edits`` is a share of a passage's
characters. ``benchmark`` is read to the driver in blocks of at most ``BLOCK_CHARS``; each block is an index of bounded
size that goes out with the tasks, and documents pass through the blocks one after the other, without a shuffle.
Passages too short for a walk are looked for as they are, between word borders.

Null and empty texts hold nothing, null and empty passages are held by nothing. One row per input row, repeated rows
and null ids included; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.workers import filtered

MAX_EDITS = 0.1
REPEATS = 3
STEPS = 48
PLACES = 16
EARLY = 6
SEED = 17
BLOCK_CHARS = 2_000_000
GROUP_BYTES = 1 << 20
_TABLE_BITS = 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def word_starts(data: np.ndarray) -> np.ndarray:
    """Places that follow a blank or a zero, and the first."""
    blank = (data == 32) | (data == 0)
    return np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))


class Walks:
    """The repeated walks: bits by step and byte, and the sampled steps."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.bits = rng.integers(0, 2, (REPEATS, STEPS, 256)).astype(np.int64)
        self.places = [np.sort(rng.choice(STEPS, PLACES, replace=False)) for _ in range(REPEATS)]
        self.factors = rng.integers(1, 1 << 62, PLACES, dtype=np.int64) | 1

    def run(self, data: np.ndarray, at: np.ndarray, repeat: int, early: np.ndarray | None) -> tuple:
        """(hash, early hash, start, end) of the walks from ``at``; with ``early``, only of those that table lets go on."""
        start, place, key, half, taken = at, at.copy(), np.zeros(len(at), np.int64), None, 0
        for step in range(int(self.places[repeat][-1]) + 1):
            byte = data.take(place, mode="clip")
            if step == self.places[repeat][taken]:
                key = key * 31 + byte * self.factors[taken]
                taken += 1
                if taken == EARLY:
                    half = _fold(key)
                    if early is not None:
                        on = np.flatnonzero(early[half])
                        start, place, key, half, byte = start[on], place[on], key[on], half[on], byte[on]
            place += self.bits[repeat, step].take(byte)
        return key, half, start, place


def _fold(key: np.ndarray) -> np.ndarray:
    mixed = key * np.int64(-7046029254386353131)
    return (mixed >> np.int64(63 - _TABLE_BITS)) & np.int64((1 << _TABLE_BITS) - 1)


class PassageIndex:
    """Walk hashes of a block of passages."""

    def __init__(self, items: list[tuple], max_edits: float) -> None:
        self.walks, self.max_edits = Walks(), max_edits
        self.items = [(key, text) for key, text in ((k, normal(t or "")) for k, t in items) if text]
        self.tables = []
        hashed = np.zeros(len(self.items), bool)
        for repeat in range(REPEATS):
            keys, owners, offsets, early = [], [], [], np.zeros(1 << _TABLE_BITS, bool)
            for owner, (_, text) in enumerate(self.items):
                data = np.frombuffer(text.encode(), np.uint8)
                key, half, start, end = self.walks.run(data, word_starts(data), repeat, None)
                whole = end <= len(data)
                early[half[whole]] = True
                keys.append(key[whole])
                offsets.append(start[whole])
                owners.append(np.full(whole.sum(), owner))
                hashed[owner] |= whole.any()
            keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
            order = np.argsort(keys, kind="stable")
            owners = np.concatenate(owners)[order] if len(keys) else np.empty(0, int)
            offsets = np.concatenate(offsets)[order] if len(keys) else np.empty(0, int)
            self.tables.append((keys[order], owners, offsets, early))
        self.short = [(key, f" {text} ") for (key, text), done in zip(self.items, hashed) if not done]
        self.masks = {}

    def candidates(self, data: np.ndarray) -> set[tuple[int, int]]:
        """(passage, byte at which it would begin) for every hash that a walk of ``data`` shares with a passage."""
        starts, found = word_starts(data), set()
        for repeat, (keys, owners, offsets, early) in enumerate(self.tables):
            if not len(keys):
                continue
            key, _, start, _ = self.walks.run(data, starts, repeat, early)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for i in np.flatnonzero(high > low):
                span = slice(low[i], high[i])
                found.update(zip(owners[span].tolist(), (start[i] - offsets[span]).tolist()))
        return found

    def holds(self, owner: int, window: str) -> bool:
        """Is the passage within its edits of some part of the window?"""
        text = self.items[owner][1]
        limit, m = int(self.max_edits * len(text)), len(text)
        if text in window:
            return True
        masks = self.masks.get(owner)
        if masks is None:
            masks = {}
            for i, char in enumerate(text):
                masks[char] = masks.get(char, 0) | 1 << i
            self.masks[owner] = masks
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        for char in window:
            match = masks.get(char, 0)
            x = match | minus
            diagonal = (((match & plus) + plus) ^ plus) | x
            up = minus | ~(diagonal | plus) & full
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            if score <= limit:
                return True
            up = up << 1 & full
            down = down << 1 & full
            plus = down | ~(diagonal | up) & full
            minus = up & diagonal
        return False

    def find(self, texts: list[str]) -> list[set]:
        """The passages (by id) that each text holds."""
        texts = [normal(text) for text in texts]
        joined = [text.encode() for text in texts]
        # Zeros keep a walk from running into the next text unnoticed: no passage holds them.
        data = np.frombuffer(b"".join(text + bytes(STEPS) for text in joined), np.uint8)
        begins = np.cumsum([0] + [len(text) + STEPS for text in joined])
        found = [{key for key, passage in self.short if passage in f" {text} "} for text in texts]
        failed = set()
        for owner, at in sorted(self.candidates(data)):
            row = int(np.searchsorted(begins, max(at, 0), "right")) - 1
            key, passage = self.items[owner]
            size, slack = len(passage.encode()), 4 * int(self.max_edits * len(passage)) + 4
            for row in {row, min(row + 1, len(texts) - 1)}:  # a begin before a text's first byte names its neighbour
                low = at - int(begins[row])
                if key in found[row] or low + size + slack <= 0 or low >= len(joined[row]):
                    continue
                place = low // max(1, slack // 2)
                if (owner, row, place) in failed:
                    continue
                window = joined[row][max(0, low - slack) : low + size + slack].decode(errors="ignore")
                if self.holds(owner, window):
                    found[row].add(key)
                else:
                    failed.add((owner, row, place))
        return found


def passage_blocks(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """Passages in lists of at most ``limit`` characters."""
    block, held = [], 0
    for row in benchmark.select(key, text).filter(F.col(key).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        if block and held + len(row[1]) > limit:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += len(row[1])
    yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, block_chars: int = BLOCK_CHARS,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document: id, ``items`` (ids of the passages it holds, sorted), ``contaminated``."""
    id_type, item_type = dict(docs.dtypes)[id_column], dict(benchmark.dtypes)[item_column]
    spark = docs.sparkSession
    schema = f"id {id_type}, text string, items array<{item_type}>"
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.array().cast(f"array<{item_type}>").alias("items")
    )
    for block in passage_blocks(benchmark, item_column, item_text, block_chars):
        index = spark.sparkContext.broadcast(PassageIndex(block, max_edits))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for part in _parts(batch.column(1)):
                    found.extend(index.value.find(part))
                items = [sorted(f.union(before.as_py())) for f, before in zip(found, batch.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(items, batch.column(2).type)], names=["id", "text", "items"]
                )

        rows = rows.mapInArrow(run, schema)
    return rows.select(F.col("id").alias(id_column), "items", (F.size("items") > 0).alias("contaminated"))


def clean(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, block_chars: int = BLOCK_CHARS,
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents, all columns, that hold no passage."""
    for block in passage_blocks(benchmark, item_column, item_text, block_chars):
        index = docs.sparkSession.sparkContext.broadcast(PassageIndex(block, max_edits))
        docs = filtered(
            docs, text_column,
            lambda texts, index=index: [not found for part in _parts(texts) for found in index.value.find(part)],
        )
    return docs


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of bounded length, so that the arrays of their walks stay in the processor's cache."""
    part, held = [], 0
    for value in texts:
        text = value.as_py() or ""
        if part and held + len(text) > GROUP_BYTES:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part
