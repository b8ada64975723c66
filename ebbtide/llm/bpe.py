"""Byte-level byte-pair encoding and decoding.

Texts are cut by the published pattern. Within one match every byte starts as a token of its own; a segment tree over
the byte positions holds the rank of each live neighbour pair, so that its root is the lowest rank and, among equals,
the leftmost place. A merge is three point updates: the merged pair, the pair to its left and the place that ceased to
exist. Many matches are merged at a time: row r of the numpy arrays is the tree of match r, and one step merges the
root of every unfinished row.

Distinct pieces of text are encoded once per worker (see ``texts``). Null and empty texts give no tokens; a row comes
back for every input row, repeated rows and null ids included; other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ebbtide.llm.texts import PieceMemory, space_pieces, text_groups

VOCABULARY = "byte_bpe_50k.tiktoken"
NO_PAIR = np.int64(1) << 40
CELLS = 1 << 18


class BytePairs:
    """A rank file: tokens by id and the rank of every pair of ids that merges."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.ranks[token[:cut]] << 32 | self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        pairs.sort()
        self.pair_keys = np.array([key for key, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs] + [0], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that left and right make together, ``NO_PAIR`` where there is none or no neighbour."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], NO_PAIR)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece; a piece is one match of the pattern."""
        found: list[list[int] | None] = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                found[i] = [rank]
            elif piece:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
            else:
                found[i] = []
        for width, members in by_width.items():
            rows = max(1, CELLS // width)
            for start in range(0, len(members), rows):
                part = members[start : start + rows]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], width)):
                    found[i] = ids
        return found

    def _merge(self, pieces: list[bytes], width: int) -> list[list[int]]:
        n = len(pieces)
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        length = np.array([len(p) for p in pieces])
        place = np.arange(width)
        # One spare place at the end, id -1, stands for "no neighbour" on either side.
        ids = np.full((n, width + 1), -1, np.int64)
        ids[:, :width] = np.where(place < length[:, None], self.byte_ids[text], -1)
        after = np.broadcast_to(np.minimum(place + 1, width), (n, width)).copy()
        before = np.broadcast_to(np.where(place > 0, place - 1, width), (n, width)).copy()
        after = np.concatenate([after, np.full((n, 1), width)], axis=1)
        before = np.concatenate([before, np.full((n, 1), width)], axis=1)

        none = NO_PAIR * width
        tree = np.full((n, 2 * width), none, np.int64)
        tree[:, width:] = np.minimum(self.pair_rank(ids[:, :-1], ids[:, 1:]) * width + place, none)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while node.size and node[0] > 1:
                value = np.minimum(value, tree[rows, node ^ 1])
                node = node >> 1
                tree[rows, node] = value

        live = np.arange(n)
        while True:
            live = live[tree[live, 1] < none]
            if not live.size:
                break
            rank, at = np.divmod(tree[live, 1], width)
            gone = after[live, at]
            following, preceding = after[live, gone], before[live, at]
            ids[live, at], ids[live, gone] = rank, -1
            after[live, at] = following
            before[live, following] = at
            put(live, gone, np.full(live.size, none))
            put(live, at, np.minimum(self.pair_rank(rank, ids[live, following]) * width + at, none))
            left = preceding < width
            rows, at, rank, preceding = live[left], at[left], rank[left], preceding[left]
            put(rows, preceding, np.minimum(self.pair_rank(ids[rows, preceding], rank) * width + preceding, none))
        kept = ids >= 0
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class TextCodec:
    """Whole texts to ids and back, with a bounded memory of pieces.

    Remembered ids are bytes of little-endian 32-bit numbers: they join fast and the garbage collector skips them.
    """

    def __init__(self, path: str) -> None:
        self.pairs = BytePairs(path)
        self.decimal = {rank: str(rank) for rank in self.pairs.tokens}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.matches = PieceMemory(self._matches)
        self.first = PieceMemory(self._pieces)
        self.rest = PieceMemory(lambda pieces: self._pieces([f" {piece}" for piece in pieces]))

    def _matches(self, found: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.pairs.encode([m.encode() for m in found])]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(piece) for piece in pieces]
        return self.matches.joined(cut)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [space_pieces(text) for text in texts]
        first = self.first.joined([[piece] for piece, _ in cut])
        rest = self.rest.joined([row for _, row in cut])
        return [np.frombuffer(a + b, "<u4") for a, b in zip(first, rest)]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.pairs.decode(ids.tolist())

    def decimals(self, ids: np.ndarray) -> str:
        return " ".join(map(self.decimal.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> TextCodec:
    return TextCodec(path)


def encode(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: id and ``ids``, the token ids of the whole text in order."""
    path = public_tokenizers.path(vocabulary)
    id_type = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_groups(batches):
            rows = codec(path).encode(texts)
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.concatenate(rows).astype(np.int32))
            yield pa.RecordBatch.from_arrays([keys, ids], names=[id_column, "ids"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {id_type}, ids array<int>")


def decode(
    encoded: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", ids_column: str = "ids",
) -> DataFrame:
    """One row per row of ids: id and ``bytes``; null ids give empty bytes, an unknown id is an error."""
    path = public_tokenizers.path(vocabulary)
    id_type = dict(encoded.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [codec(path).pairs.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_column, "bytes"])

    return encoded.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {id_type}, bytes binary")


def round_trip(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encodes, decodes the ids, and returns digests of both: ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    path = public_tokenizers.path(vocabulary)
    id_type = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_groups(batches):
            tool = codec(path)
            rows = tool.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(ids) for ids in rows], pa.int64()),
                    pa.array([hashlib.sha256(tool.decimals(ids).encode()).hexdigest() for ids in rows]),
                    pa.array([hashlib.sha256(tool.decode(ids)).hexdigest() for ids in rows]),
                ],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"`{id_column}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(run, schema)
