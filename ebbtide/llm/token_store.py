"""Token ids in a compact binary table: written in document order, read back in parallel.

A static range asymmetric numeral system codes the ids. Documents are placed by range of their id and sorted, so that
the order of the partitions and the order within them is the order of the corpus. A task gathers whole documents into
segments of about ``SEGMENT`` ids; the ids of a segment share one frequency table. Its blocks are independent: each has
``LANES`` interleaved coder states (its checkpoint), its own stream of 32-bit words and a checksum, so any block can be
decoded alone. Segments are rows of a Parquet table, hence Spark's writer commits them and a repeated task leaves no
second copy.

Null and empty texts are stored as the end id alone. Repeated rows are stored as often as they occur; null ids come
first. Other columns of the input are not looked at. An empty table gives an empty store. A damaged block is an error.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm.texts import MAX_CHARS, PieceMemory, space_pieces, text_groups

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SEGMENT = 1 << 22
BLOCK = 1 << 20
LANES = 4096
SCALE = 20
LOW = np.uint64(1 << 31)
_32 = np.uint64(32)

BLOCK_TYPE = pa.struct(
    [("n", pa.int32()), ("lanes", pa.int32()), ("crc", pa.int64()), ("states", pa.binary()), ("words", pa.binary())]
)
BLOCK_SQL = "struct<n int, lanes int, crc bigint, states binary, words binary>"


# ---- coding


def frequency_table(ids: np.ndarray) -> np.ndarray:
    """Shares of 2^SCALE per id, at least 1 for every id that occurs."""
    counts = np.bincount(ids)
    seen = counts > 0
    shares = np.where(seen, np.maximum(1, counts * (1 << SCALE) // max(1, counts.sum())), 0)
    # The rounding difference goes to the most frequent ids, which it distorts least.
    left = (1 << SCALE) - int(shares.sum())
    for i in np.argsort(-shares, kind="stable"):
        step = left if left > 0 else max(left, 1 - int(shares[i]))
        shares[i] += step
        left -= step
        if left == 0:
            break
    return shares.astype(np.uint32)


def encode_block(ids: np.ndarray, shares: np.ndarray, starts: np.ndarray) -> dict:
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    state = np.full(lanes, LOW, np.uint64)
    words = []
    for at in range((n - 1) // lanes * lanes, -1, -lanes):
        symbols = ids[at : at + lanes]
        x = state[: len(symbols)]
        share = shares[symbols]
        full = x >= share << np.uint64(63 - SCALE)
        if full.any():
            words.append(x[full].astype(np.uint32))
            x[full] >>= _32
        whole, rest = np.divmod(x, share)
        x[:] = (whole << np.uint64(SCALE)) + rest + starts[symbols]
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    return {
        "n": n, "lanes": lanes, "crc": zlib.crc32(ids.astype("<u4").tobytes()),
        "states": state.astype("<u8").tobytes(), "words": stream.astype("<u4").tobytes(),
    }


def decode_block(block: dict, shares: np.ndarray, starts: np.ndarray, slots: np.ndarray) -> np.ndarray:
    n, lanes = block["n"], block["lanes"]
    state = np.frombuffer(block["states"], "<u8").astype(np.uint64)
    words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
    ids = np.empty(n, np.uint32)
    mask, used = np.uint64((1 << SCALE) - 1), 0
    for at in range(0, n, lanes):
        x = state[: min(lanes, n - at)]
        slot = x & mask
        symbols = slots[slot]
        ids[at : at + len(x)] = symbols
        x[:] = shares[symbols] * (x >> np.uint64(SCALE)) + slot - starts[symbols]
        empty = np.flatnonzero(x < LOW)
        if empty.size:
            x[empty] = x[empty] << _32 | words[used : used + empty.size]
            used += empty.size
    if used != len(words) or zlib.crc32(ids.astype("<u4").tobytes()) != block["crc"]:
        raise ValueError("a block of the token store is damaged")
    return ids


def pack(ids: np.ndarray) -> tuple[bytes, list[dict]]:
    """The compressed frequency table and the blocks of one segment."""
    table = frequency_table(ids)
    shares = table.astype(np.uint64)
    starts = np.cumsum(shares) - shares
    blocks = [encode_block(ids[at : at + BLOCK], shares, starts) for at in range(0, len(ids), BLOCK)]
    return zlib.compress(table.astype("<u4").tobytes(), 1), blocks


def unpack(table: bytes, blocks: list[dict]) -> np.ndarray:
    shares = np.frombuffer(zlib.decompress(table), "<u4").astype(np.uint64)
    starts = np.cumsum(shares) - shares
    slots = np.repeat(np.arange(len(shares), dtype=np.uint32), shares.astype(np.int64))
    return np.concatenate([decode_block(block, shares, starts, slots) for block in blocks])


# ---- encoding texts


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct piece once per worker.

    Unseen pieces go to the library as one text; since the bytes of the tokens add up to those of the text, the ids
    are dealt back to the pieces by running sums of lengths.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a character of a token stands for one byte
            self.sizes[i] = len(token)
        self.first = PieceMemory(self._one_by_one)
        self.rest = PieceMemory(self._together, 2 * MAX_CHARS)

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _together(self, pieces: list[str]) -> list[bytes]:
        # Only the end of a text can leave a piece that ends in white space; it must not meet the next space.
        tails = [p for p in pieces if not p or p[-1].isspace()]
        if tails:
            known = dict(zip(tails, self._one_by_one([f" {p}" for p in tails])))
            plain = [p for p in pieces if p not in known]
            if plain:
                known.update(zip(plain, self._together(plain)))
            return [known[p] for p in pieces]
        text = f" {' '.join(pieces)}"
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(p.encode()) + 1 for p in pieces])
        cuts = np.searchsorted(ends, wanted) + 1
        if not np.array_equal(ends[cuts - 1], wanted):
            return self._one_by_one([f" {p}" for p in pieces])
        raw, cuts = ids.tobytes(), (4 * cuts).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        cut = [space_pieces(text) for text in texts]
        first = self.first.joined([[piece] for piece, _ in cut])
        rest = self.rest.joined([row for _, row in cut])
        return [a + b + end for a, b in zip(first, rest)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


# ---- the table


def write_store(
    docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Writes ``part, seq, first, doc_ids, lengths, table, blocks``, a row per segment."""
    file = public_tokenizers.path(vocabulary)
    id_type = dict(docs.dtypes)[id_column]
    end = np.array([end_id], "<u4").tobytes()

    def segment(part: int, seq: int, first: int, keys: list[pa.Array], rows: list[bytes]) -> pa.RecordBatch:
        table, blocks = pack(np.frombuffer(b"".join(rows), "<u4"))
        doc_ids = pa.concat_arrays(keys)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                pa.array([[len(row) // 4 for row in rows]], pa.list_(pa.int32())),
                pa.array([table], pa.binary()), pa.array([blocks], pa.list_(BLOCK_TYPE)),
            ],
            names=["part", "seq", "first", "doc_ids", "lengths", "table", "blocks"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        keys, rows, held = [], [], 0
        for ids, texts in text_groups(batches):
            found = _encoder(file).encode(texts, end)
            keys.append(ids)
            rows.extend(found)
            held += sum(map(len, found)) // 4
            if held >= SEGMENT:
                yield segment(part, seq, first, keys, rows)
                seq, first, keys, rows, held = seq + 1, first + held, [], [], 0
        if rows:
            yield segment(part, seq, first, keys, rows)

    schema = (
        f"part int, seq int, first bigint, doc_ids array<{id_type}>, lengths array<int>, table binary, "
        f"blocks array<{BLOCK_SQL}>"
    )
    placed = docs.select(id_column, text_column).repartitionByRange(F.col(id_column).asc_nulls_first())
    placed.sortWithinPartitions(F.col(id_column).asc_nulls_first()).mapInArrow(run, schema).write.parquet(path)


def read_store(
    spark: SparkSession, path: str, with_ids: bool = True, id_column: str = "doc_id",
) -> DataFrame:
    """A row per stored document: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``, ``ids``."""
    stored = spark.read.parquet(path)
    id_type = dict(stored.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, doc_ids, lengths, table, blocks = (batch.column(c)[row] for c in range(6))
                ids = unpack(table.as_py(), blocks.as_py())
                lengths = lengths.values.to_numpy()
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(lengths.tolist(), ends.tolist())]
                columns = [
                    doc_ids.values, pa.array(np.full(len(crc), part.as_py(), np.int32)),
                    pa.array(first.as_py() + ends - lengths), pa.array(lengths.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ]
                names = [id_column, "part", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_column}` {id_type}, part int, within bigint, n_tokens bigint, ids_crc32 bigint"
    rows = stored.select("part", "first", "doc_ids", "lengths", "table", "blocks").mapInArrow(
        run, schema + (", ids array<int>" if with_ids else "")
    )
    # One row per written file; the running sum over them is the only step in one task.
    sizes = stored.select("part", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        id_column, (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []),
    )
