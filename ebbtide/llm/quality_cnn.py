"""Quality classifier: a convolutional network over bytes, written and trained in numpy.

Every byte has a learned vector; filters ``WIDTH`` bytes wide run over the whole text every ``STEP`` bytes. Their
responses are max-pooled over overlapping chunks of two ``HALF`` blocks, a hidden layer turns each chunk into a logit,
and the maximum, minimum and mean of a document's chunk logits are combined into one probability.

The network is fitted on the driver on a bounded sample of labelled texts (``PER_CLASS``, ``MAX_CHARS``); documents
are scored where they lie, without a shuffle. Null and empty texts are scored as a chunk of padding; without labels of
both classes every score is 0.5. One row per input row, repeated rows and null ids included; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.labelled import Sample, held_out, sample
from ebbtide.llm.workers import filtered

PER_CLASS = 2000
MAX_CHARS = 16_384
EPOCHS = 6
STEP, BLOCKS, DIM, FILTERS, HIDDEN, HALF = 4, 4, 8, 32, 32, 256
WIDTH = STEP * BLOCKS
GROUP_BYTES = 1 << 18
THRESHOLD = 0.3
SEED = 11


def pad(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in whole blocks, each followed by at least ``WIDTH`` zeros; blocks per text."""
    blocks = np.array([(len(text) + WIDTH) // HALF + 1 for text in texts])
    joined = b"".join(text.ljust(HALF * n, b"\0") for text, n in zip(texts, blocks))
    return np.frombuffer(joined, np.uint8), blocks


class Network:
    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {
            "embed": normal(256, DIM, scale=0.5), "filters": normal(WIDTH * DIM, FILTERS, scale=(WIDTH * DIM) ** -0.5),
            "shift": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
            "hidden_shift": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=HIDDEN**-0.5),
            "mix": np.array([0.4, 0.4, 0.4], np.float32), "bias": np.zeros(1, np.float32),
        }

    def responses(self, text: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Filter responses by (block, position, filter); windows that reach into the next text have none."""
        w = self.weights
        steps = w["embed"][text].reshape(-1, STEP * DIM)
        taps = w["filters"].reshape(BLOCKS, STEP * DIM, FILTERS).transpose(1, 0, 2).reshape(STEP * DIM, -1)
        parts = (steps @ taps).reshape(len(steps), BLOCKS, FILTERS)
        total = parts[:, 0].copy()
        for tap in range(1, BLOCKS):
            total[:-tap] += parts[tap:, tap]
        total = total.reshape(-1, HALF // STEP, FILTERS)
        # The last places of a text lie in its padding.
        total[np.cumsum(blocks) - 1, 1 - BLOCKS :] = -np.inf
        return total

    def chunks(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second block of every chunk, and how many chunks each text has."""
        ends = np.cumsum(blocks)
        last = np.zeros(ends[-1], bool)
        last[ends - 1] = True
        alone = np.repeat(blocks == 1, blocks)
        first = np.flatnonzero(~last | alone)
        return first, np.maximum(blocks - 1, 1)

    def logits(self, chunk: np.ndarray, counts: np.ndarray) -> tuple:
        w = self.weights
        hidden = np.maximum(chunk @ w["hidden"] + w["hidden_shift"], 0)
        score = hidden @ w["out"]
        starts = np.cumsum(counts) - counts
        high, low = np.maximum.reduceat(score, starts), np.minimum.reduceat(score, starts)
        mean = np.add.reduceat(score, starts) / counts
        return hidden, score, starts, high, low, mean, w["mix"] @ np.stack([high, low, mean]) + w["bias"]

    def score(self, texts: list[bytes]) -> np.ndarray:
        text, blocks = pad(texts)
        best = self.responses(text, blocks).max(axis=1)
        first, counts = self.chunks(blocks)
        second = np.where(np.repeat(blocks == 1, counts), first, np.minimum(first + 1, len(best) - 1))
        chunk = np.maximum(np.maximum(best[first], best[second]) + self.weights["shift"], 0)
        return 1 / (1 + np.exp(-self.logits(chunk, counts)[-1].astype(np.float64)))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        text, blocks = pad(texts)
        responses = self.responses(text, blocks)
        where = responses.argmax(axis=1)
        best = np.take_along_axis(responses, where[:, None], axis=1)[:, 0]
        first, counts = self.chunks(blocks)
        second = np.where(np.repeat(blocks == 1, counts), first, np.minimum(first + 1, len(best) - 1))
        winner = np.where(best[first] >= best[second], first[:, None], second[:, None])
        column = np.arange(FILTERS)
        before = best[winner, column] + w["shift"]
        chunk = np.maximum(before, 0)
        hidden, score, starts, high, low, mean, logit = self.logits(chunk, counts)
        error = ((1 / (1 + np.exp(-logit)) - labels) * weights / weights.sum()).astype(np.float32)
        grad = {"mix": np.array([error @ high, error @ low, error @ mean]), "bias": np.array([error.sum()])}
        owner = np.repeat(np.arange(len(texts)), counts)
        d_score = (error * w["mix"][2] / counts)[owner]
        for extreme, mix in ((high, w["mix"][0]), (low, w["mix"][1])):
            at = np.flatnonzero(score == extreme[owner])
            at = at[np.unique(owner[at], return_index=True)[1]]
            d_score[at] += error * mix
        grad["out"] = hidden.T @ d_score
        d_hidden = np.outer(d_score, w["out"]) * (hidden > 0)
        grad["hidden"], grad["hidden_shift"] = chunk.T @ d_hidden, d_hidden.sum(axis=0)
        d_chunk = (d_hidden @ w["hidden"].T) * (before > 0)
        grad["shift"] = d_chunk.sum(axis=0)
        begin = winner * HALF + where[winner, column] * STEP
        window = text[np.minimum(begin[:, :, None] + np.arange(WIDTH), len(text) - 1)]
        vectors = w["embed"][window].reshape(len(begin), FILTERS, -1)
        grad["filters"] = np.einsum("cf,cfk->kf", d_chunk, vectors)
        spread = d_chunk[:, :, None, None] * w["filters"].T.reshape(FILTERS, WIDTH, DIM)
        grad["embed"] = np.stack(
            [np.bincount(window.ravel(), spread[..., d].ravel(), minlength=256) for d in range(DIM)], axis=1
        )
        return grad

    def fit(self, data: Sample, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.004) -> Network:
        rng = np.random.default_rng(SEED)
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.weights.items()}
        step, total = 0, epochs * -(-len(data.texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(data.texts))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grad = self.gradients([data.texts[i] for i in rows], data.labels[rows], data.weights[rows])
                step += 1
                speed = rate * (1 - step / (total + 1))
                for k, g in grad.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.weights[k] -= (speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(
                        np.float32
                    )
        return self


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Network | None:
    """A network fitted on ``labels.quality``; None without labels of both classes."""
    data = sample(docs, labels, "quality", per_class, max_chars)
    return Network().fit(data) if data.fits else None


def score_batches(network: Network | None, texts: Iterator[bytes]) -> list[float]:
    """Scores of texts, some ``GROUP_BYTES`` at a time."""
    scores, group, held = [], [], 0

    def flush() -> None:
        if group:
            # Sums in single precision depend on what is scored together; the digits kept do not.
            scores.extend(np.round(network.score(group), 5).tolist() if network else [0.5] * len(group))

    for text in texts:
        if held + len(text) > GROUP_BYTES:
            flush()
            group, held = [], 0
        group.append(text)
        held += len(text) + HALF
    flush()
    return scores


def score(
    docs: DataFrame, network: Network | None, threshold: float = THRESHOLD, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (high is good), ``predicted`` (1 when score >= threshold)."""
    id_type = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_batches(network, (value.as_py() or b"" for value in batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=[id_column, "score"]
            )

    scored = docs.select(id_column, F.col(text_column).cast("binary").alias("_text")).mapInArrow(
        run, f"`{id_column}` {id_type}, score double"
    )
    return scored.select(
        id_column, held_out(F.col(id_column)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, network: Network | None, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The documents, all columns, that score at least ``threshold``."""

    def keep(texts: pa.Array) -> list[bool]:
        return [s >= threshold for s in score_batches(network, ((t.as_py() or "").encode() for t in texts))]

    return filtered(docs, text_column, keep)
