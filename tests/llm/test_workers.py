"""What a worker drops between operators."""

import gc
import weakref
from functools import lru_cache

import public_tokenizers

from ebbtide.llm import bpe, token_store, workers


def test_memories_of_other_operators_go_whatever_they_are_called(monkeypatch):
    kept = lru_cache(lambda path: [path])
    for module, name in ((bpe, "codec"), (token_store, "_encoder")):
        monkeypatch.setattr(module, name, kept)
        first = kept("a")
        workers.release(module.__name__, "ebbtide.llm.not_imported_here")
        assert kept("a") is not first


def test_memories_that_refer_to_their_codec_are_freed_at_once():
    codec = bpe.codec(public_tokenizers.path(bpe.VOCABULARY))
    codec.encode(["some words to remember"])
    left = weakref.ref(codec.rest)
    del codec
    gc.disable()
    try:
        workers.release(bpe.__name__)
        assert left() is None
    finally:
        gc.enable()


def test_a_filter_runs_in_workers_without_memories_of_the_codecs(spark):
    docs = spark.range(400, numPartitions=16).selectExpr("id AS doc_id", "concat('text ', id) AS text")

    def remembered(texts):
        return [bpe.codec.cache_info().currsize == 0] * len(texts)

    for _ in range(2):
        assert bpe.encode(docs).count() == 400
    assert workers.filtered(docs, "text", remembered).count() == 400
