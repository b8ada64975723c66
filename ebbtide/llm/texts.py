"""Cutting texts where a tokenizer cannot tell, and remembering what each piece gave.

The byte-level pattern lets a match begin with one space but never lets a match run from a non-space character into a
space. A text may therefore be cut before every space that follows a non-space character, and the pieces encoded one by
one. Words repeat, so a worker encodes each distinct piece once and puts a text together from remembered results. The
memory is bounded: beyond ``MAX_CHARS`` a new generation begins, pieces still in use move over from the one before, and
the rest is forgotten, which costs time and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

MAX_CHARS = 80_000_000
PIECE_CHARS = 150  # what an entry takes beside its text
GROUP_CHARS = 2_000_000
CALL_CHARS = 200_000

_ASCII_BLANK = tuple(f"{c} " for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
_BLANK_THEN_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
# Unicode white space; str.split() would also take the separators 1C to 1F.
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def space_pieces(text: str) -> tuple[str, list[str]]:
    """The first piece, and the others without the space that each of them begins with."""
    if text.isascii():
        plain = not any(pair in text for pair in _ASCII_BLANK)
    else:
        plain = _BLANK_THEN_SPACE.search(text) is None
    if plain:
        first, *rest = text.split(" ")
        return first, rest
    first, *rest = _CUT.split(text)
    return first, [piece[1:] for piece in rest]


def white_words(text: str) -> list[str]:
    """Runs of characters that are not Unicode white space."""
    if _SEPARATORS.search(text) is None:
        return text.split()
    return [word for word in _WHITE.split(text) if word]


def balanced(pieces: Iterable[str], limit: int = CALL_CHARS) -> Iterator[list[str]]:
    """Lists of pieces of about equal total length, so that no call to a tokenizer is much larger than another."""
    group, held = [], 0
    for piece in pieces:
        if group and held + len(piece) > limit:
            yield group
            group, held = [], 0
        group.append(piece)
        held += len(piece)
    if group:
        yield group


class PieceMemory:
    """What ``encode`` gave for each piece; ``encode`` takes a list of pieces and returns a list of results."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = MAX_CHARS) -> None:
        self.encode, self.limit, self.size = encode, limit, 0
        self.known, self.older = {}, {}

    def learn(self, rows: Iterable[list[str]]) -> dict:
        """A mapping that holds the pieces of all rows, for use until the next call."""
        self._age()
        self._add(set().union(*rows) - self.known.keys())
        return self.known

    def joined(self, rows: list[list[str]]) -> list[bytes]:
        """The results of each row's pieces, which are bytes, joined."""
        self._age()
        # One look at the large mapping for each piece; what it lacks is filled in by place.
        found = [list(map(self.known.get, row)) for row in rows]
        gaps = [[i for i, result in enumerate(results) if result is None] for results in found]
        self._add({row[i] for row, places in zip(rows, gaps) for i in places})
        for row, results, places in zip(rows, found, gaps):
            for i in places:
                results[i] = self.known[row[i]]
        return [b"".join(results) for results in found]

    def _age(self) -> None:
        if self.size > self.limit:
            self.known, self.older, self.size = {}, self.known, 0

    def _add(self, unseen: set[str]) -> None:
        self.size += sum(map(len, unseen)) + PIECE_CHARS * len(unseen)
        kept = unseen & self.older.keys()
        self.known.update((piece, self.older[piece]) for piece in kept)
        for part in balanced(unseen - kept):
            self.known.update(zip(part, self.encode(part)))


def text_groups(batches: Iterator[pa.RecordBatch], limit: int = GROUP_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of bounded total length from batches of (id, text); a null text counts as empty."""
    for batch in batches:
        start, texts, held = 0, [], 0
        for value in batch.column(1):
            text = value.as_py() or ""
            if texts and held + len(text) > limit:
                yield batch.column(0).slice(start, len(texts)), texts
                start, texts, held = start + len(texts), [], 0
            texts.append(text)
            held += len(text)
        if texts:
            yield batch.column(0).slice(start, len(texts)), texts
