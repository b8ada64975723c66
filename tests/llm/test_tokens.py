"""Encoding, counting and storing tokens against the libraries themselves."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ebbtide.llm import bpe, texts, token_counts, token_store
from tests.llm.helpers import ODD, no_documents, odd_documents

ALPHABET = list("ab '\"\n\t éß　sS19.,!\x1c\x1f\x85") + ["<|endoftext|>", "\U0001F600", "́", " the", "'ll"]
odd_texts = st.lists(st.sampled_from(ALPHABET), max_size=60).map("".join)


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@settings(max_examples=300, deadline=None)
@given(odd_texts)
def test_pieces_put_the_text_together(text):
    first, rest = texts.space_pieces(text)
    assert first + "".join(f" {piece}" for piece in rest) == text


@settings(max_examples=300, deadline=None)
@given(text=odd_texts)
def test_merges_equal_the_library(reference, text):
    ids = bpe.codec(PATH).encode([text])[0]
    assert ids.tolist() == reference.encode_ordinary(text)
    assert bpe.codec(PATH).decode(ids) == text.encode()


def test_long_pieces_and_forgotten_pieces(reference):
    long = ["ab" * 4000, "z" * 9001, "!?" * 700, " " * 3000 + "x"]
    assert [i.tolist() for i in bpe.codec(PATH).encode(long)] == [reference.encode_ordinary(t) for t in long]
    memory = texts.PieceMemory(lambda pieces: [p.upper() for p in pieces], limit=500)
    for i in range(50):
        row = [f"w{i}", f"w{i + 1}", "common"]
        known = memory.learn([row])
        assert [known[p] for p in row] == [p.upper() for p in row]
    assert len(memory.known) + len(memory.older) < 20


def test_round_trip_query(spark, reference):
    rows = bpe.round_trip(odd_documents(spark)).collect()
    want = []
    for doc, text, *_ in ODD:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((doc, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert bpe.round_trip(no_documents(spark)).count() == 0
    encoded = bpe.encode(odd_documents(spark))
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(encoded).collect()}
    assert back == {doc: (text or "").encode() for doc, text, *_ in ODD}


@settings(max_examples=300, deadline=None)
@given(text=odd_texts)
def test_counts_equal_the_library(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False)) if text else 0
    assert token_counts.count_tokens([text], path) == [want]


def test_counts_query(spark):
    rows = token_counts.token_counts(odd_documents(spark), limit=3).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc, text, *_ in ODD:
        n = len(tokenizer.encode(text or "", add_special_tokens=False))
        want.append((doc, len((text or "").encode()), n, n > 3))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert token_counts.token_counts(no_documents(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 63, 64, 1000, 100_000])
def test_coder_round_trip(size):
    rng = np.random.default_rng(size)
    ids = (50_256 * rng.random(size) ** 4).astype(np.uint32)
    table, blocks = token_store.pack(ids)
    assert np.array_equal(token_store.unpack(table, blocks), ids)
    broken = [{**blocks[0], "crc": blocks[0]["crc"] ^ 1}, *blocks[1:]]
    with pytest.raises(ValueError, match="damaged"):
        token_store.unpack(table, broken)


def test_blocks_decode_alone(monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 1000)
    ids = np.arange(5500, dtype=np.uint32) % 97
    table, blocks = token_store.pack(ids)
    assert len(blocks) == 6
    assert np.array_equal(token_store.unpack(table, blocks[3:4]), ids[3000:4000])


@pytest.mark.parametrize("segment", [1 << 22, 10])
def test_store(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(token_store, "SEGMENT", segment)
    path = str(tmp_path / "store")
    token_store.write_store(odd_documents(spark), path)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ordered = sorted(ODD, key=lambda row: (row[0] is not None, row[0] or 0))
    start, want = 0, []
    for doc, text, *_ in ordered:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    rows = [tuple(r) for r in token_store.read_store(spark, path).orderBy("start").collect()]
    assert rows == want
    empty = str(tmp_path / "empty")
    token_store.write_store(no_documents(spark), empty)
    assert token_store.read_store(spark, empty).count() == 0
