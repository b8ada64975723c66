"""Groups of near vectors against all pairs."""

import numpy as np
import pytest

from ebbtide.llm import vector_dedup as vd

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, key string, rep string"


def rows_of(seed, n=260, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dims) * rng.choice([0.0, 0.02, 0.08, 0.15, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3)), "a", "b", "c"))
    rows += [
        (1000, None, 1, "a", "b", "c"), (1001, [0.0] * dims, 1, "a", "b", "c"), (1002, [float("nan")] * dims, 1, "a", "b", "c"),
        (1003, [1.0, None, 2.0], 1, "a", "b", "c"), (1004, rows[0][1], None, "a", "b", "c"), (1005, [], 1, "a", "b", "c"),
        (1006, [2 * x for x in rows[0][1]], rows[0][2], "a", "b", "c"), (1007, [3.0, 4.0], 0, "a", "b", "c"),
        (1008, [6.0, 8.0], 0, "a", "b", "c"), (5, rows[5][1], rows[5][2], "a", "b", "c"), (1009, [float("inf")] * dims, 0, "a", "b", "c"),
    ]
    return rows


def brute(rows):
    n = len(rows)
    units = []
    for _, v, label, *_ in rows:
        good = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(v) if good else None)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                link[i, j] = link[j, i] = units[i] @ units[j] >= vd.COSINE
    root = list(range(n))
    for _ in range(n):
        for i, j in zip(*np.nonzero(link)):
            low = min(rows[root[i]][0], rows[root[j]][0])
            for k in (i, j):
                if rows[root[k]][0] > low:
                    root[k] = root[i] if rows[root[i]][0] == low else root[j]
        if all(rows[root[i]][0] == rows[root[j]][0] for i, j in zip(*np.nonzero(link))):
            break
    return sorted((rows[i][0], int(link[i].sum()), rows[root[i]][0], rows[i][0] == rows[root[i]][0]) for i in range(n))


@pytest.mark.parametrize("cell_rows, block", [(4096, 1024), (20, 1024), (40, 8)])
def test_equals_brute_force(spark, cell_rows, block):
    rows = rows_of(cell_rows + block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in vd.near_duplicates(df, cell_rows=cell_rows, block=block).collect())
    assert got == brute(rows)
    assert sum(n for _, n, *_ in got) > 100


def test_recall_with_a_shorter_reach(spark):
    rows = rows_of(9)
    df = spark.createDataFrame(rows, SCHEMA)
    full = sum(n for _, n, *_ in brute(rows))
    got = vd.near_duplicates(df, reach=0.5, cell_rows=20).collect()
    assert sum(r.n_links for r in got) >= 0.9 * full


def test_hot_vector_and_empty_table(spark):
    rows = [(i, [1.0, 2.0], 1, "", "", "") for i in range(3000)] + [(5000, [2.0, -1.0], 1, "", "", "")]
    got = {r.vec_id: r for r in vd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].n_links == 2999 and got[i].component_id == 0 for i in range(3000)) and got[5000].kept
    assert vd.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(None, [1.0], 1, "", "", ""), (None, [1.0], 1, "", "", "")], SCHEMA)
    assert [tuple(r) for r in vd.near_duplicates(odd).collect()] == [(None, 0, None, True)] * 2
