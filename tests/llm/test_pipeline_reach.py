"""The signatures of the pipeline's join reach every pair from its similarity on."""

import numpy as np

import corpus_pipeline as cp
from ebbtide.llm import ngram_join as nj


def test_containment_across_every_band_border():
    rng = np.random.default_rng(80)
    borders = {size for sure in (80, 85) for band in nj.bands(sure, 5000) for size in (band.low, band.low + 1, band.high)}
    missed = []
    for size in sorted(size for size in borders if 5 <= size <= 5000):
        whole = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
        least = -(-len(whole) * cp.PERCENT // 100)
        for part in {least, (least + len(whole)) // 2}:
            keys, owners = nj.signatures([whole, np.sort(rng.permutation(whole)[:part])], cp.SURE)
            if not set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist()):
                missed.append((len(whole), part))
    assert missed == []
