"""Token counts: how many tokens a published tokenizer gives for every text, without keeping the tokens.

White space never reaches the merges of this tokenizer (it is normalised and then removed), so a text is cut at white
space, and every distinct word is encoded once per worker, in calls balanced by length, of which only the lengths are
kept. Special strings hold no white space and are handled by the library inside their word.

Null and empty texts count 0 tokens and 0 bytes; a row is returned for every input row, repeated rows and null ids
included; other columns of the input are not looked at.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ebbtide.llm.texts import PieceMemory, text_groups, white_words

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


@lru_cache(maxsize=4)
def _memory(path: str) -> PieceMemory:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return PieceMemory(lambda words: [len(e) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


def count_tokens(texts: list[str], path: str) -> list[int]:
    words = [white_words(text) for text in texts]
    length = _memory(path).learn(words).__getitem__
    return [sum(map(length, row)) for row in words]


def token_counts(
    docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``."""
    path = public_tokenizers.path(vocabulary)
    id_type = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_groups(batches):
            counts = count_tokens(texts, path)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_column}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(id_column, text_column).mapInArrow(run, schema)
