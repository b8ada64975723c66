"""Toxicity by compression distance: windows of a text are compressed with two zstandard dictionaries.

Both dictionaries are trained from labelled texts. The ordinary one is made of the words most used in ordinary texts,
the toxic one of those that toxic texts use beside the words they use far more (a likelihood-ratio test on the number
of distinct neighbourhoods of a word, so that copies of a text count once). What the classes share therefore costs the
same with either dictionary, and a window is the nearer to toxic text the more bytes the toxic dictionary saves. The
savings of overlapping windows over the whole text are summed up (largest, mean, shares over fixed savings) and a
logistic curve, fitted on sample texts that no dictionary has seen, turns them into one probability.

Fitting runs on the driver over a bounded sample (``PER_CLASS``, ``MAX_CHARS``); scoring is a pass without a shuffle.
Null and empty texts are scored as one empty window. Without labels of both classes every score is 0. One row per
input row, repeated rows and null ids included; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.labelled import Sample, held_out, sample

PER_CLASS = 3000
MAX_CHARS = 16_384
WINDOW = 40
DICTIONARY_BYTES = 8192
LEVEL, MIN_MATCH = 5, 3
EVIDENCE = 15.0
RATIO = 3.0
SAVINGS = (2, 3, 4, 6)
THRESHOLD = 0.5
_WORD = re.compile(r"\w+")


def neighbourhoods(texts: list[str]) -> dict[str, int]:
    """For each word the number of distinct (word before, word after)."""
    found = defaultdict(set)
    for text in texts:
        words = _WORD.findall(text)
        for before, word, after in zip(["", *words], words, [*words[1:], ""]):
            found[word].add((before, after))
    return {word: len(pairs) for word, pairs in found.items()}


def evidence(a: int, all_a: int, b: int, all_b: int) -> float:
    """Likelihood-ratio statistic of a word's share in two corpora."""
    share, total = (a + b) / (all_a + all_b), 0.0
    for count, size in ((a, all_a), (b, all_b)):
        for seen, expected in ((count, size * share), (size - count, size * (1 - share))):
            if seen:
                total += 2 * seen * math.log(seen / expected)
    return total


def content(words: list[str], limit: int = DICTIONARY_BYTES) -> bytes:
    """Words by falling weight, the weightiest at the end, where offsets are cheapest."""
    held, size = [], 0
    for word in words:
        size += len(word.encode()) + 1
        if size > limit:
            break
        held.append(word)
    return f" {' '.join(reversed(held))} ".encode()


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary."""
    a, b = neighbourhoods(toxic), neighbourhoods(ordinary)
    all_a, all_b = max(1, sum(a.values())), max(1, sum(b.values()))
    weights = {
        word: evidence(n, all_a, b.get(word, 0), all_b)
        for word, n in a.items()
        if n > 1 and (n + 0.5) / all_a > RATIO * (b.get(word, 0) + 0.5) / all_b
    }
    marked = sorted((w for w, g in weights.items() if g >= EVIDENCE), key=lambda w: (-weights[w], w))
    shared = content(sorted(b.keys() - set(marked), key=lambda w: (-b[w], w)))
    return shared, shared + content(marked)


def windows(text: str) -> list[bytes]:
    """Overlapping windows of whole words that cover the text; a very long word is cut."""
    data = b" %b " % b" ".join(text.lower().encode().split())
    cuts, size = [0], len(data)
    while cuts[-1] < size:
        blank = data.find(b" ", cuts[-1] + WINDOW // 2, cuts[-1] + 2 * WINDOW)
        cuts.append(min(size, cuts[-1] + 2 * WINDOW) if blank < 0 else blank)
    return [data[a : b + 1] for a, b in zip(cuts, cuts[2:])] or [data]


class ToxicityModel:
    """Two dictionaries and a logistic curve; compressors are made where they are used."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.contents = (ordinary, toxic)
        self.curve = None
        self.compressors = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"compressors": None}

    def _compressors(self) -> list[zstandard.ZstdCompressor]:
        if self.compressors is None:
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=MIN_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            self.compressors = []
            for data in self.contents:
                made = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                made.precompute_compress(compression_params=settings)
                self.compressors.append(zstandard.ZstdCompressor(dict_data=made, compression_params=settings))
        return self.compressors

    def features(self, text: str) -> list[float]:
        ordinary, toxic = (c.compress for c in self._compressors())
        saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], float)
        n = len(saved)
        shares = [np.count_nonzero(saved >= s) / m for s in SAVINGS for m in (n, math.sqrt(n))]
        return [1.0, saved.max(), np.sort(saved)[-3:].mean(), saved.mean(), saved.sum() / math.sqrt(n), *shares]

    def calibrate(self, texts: list[str], labels: np.ndarray, weights: np.ndarray) -> ToxicityModel:
        """Logistic regression by Newton steps with a small penalty."""
        x = np.array([self.features(text) for text in texts])
        centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        centre[0], spread[0] = 0, 1
        x = (x - centre) / spread
        beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
        penalty[0] = 1e-3
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (weights * (p - labels)) + penalty * beta
            bend = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            beta -= np.linalg.solve(bend, slope)
        self.curve = centre, spread, beta
        return self

    def score(self, text: str) -> float:
        centre, spread, beta = self.curve
        return float(1 / (1 + np.exp(-np.clip(((np.array(self.features(text)) - centre) / spread) @ beta, -30, 30))))


def train(data: Sample) -> ToxicityModel | None:
    """Two thirds of the sample make the dictionaries, the rest the curve."""
    texts = [text.decode().lower() for text in data.texts]
    rest = np.arange(len(texts)) % 3 == 0
    if not data.fits or len(np.unique(data.labels[rest])) < 2 or len(np.unique(data.labels[~rest])) < 2:
        return None
    toxic, ordinary = ([texts[i] for i in np.flatnonzero(~rest & (data.labels == y))] for y in (1, 0))
    model = ToxicityModel(*train_dictionaries(toxic, ordinary))
    return model.calibrate([texts[i] for i in np.flatnonzero(rest)], data.labels[rest], data.weights[rest])


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS,
) -> ToxicityModel | None:
    return train(sample(docs, labels, "toxic", per_class, max_chars))


def score(
    docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted`` (1 when score >= threshold)."""
    id_type = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(value.as_py() or "") if model else 0.0 for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=[id_column, "score"]
            )

    scored = docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {id_type}, score double")
    return scored.select(
        id_column, held_out(F.col(id_column)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
