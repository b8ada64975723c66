"""Benchmark passages against edit distance over all windows."""

import random

import pytest

from ebbtide.llm import decontaminate as dc
from tests.llm.helpers import CLASHES, SCHEMA, no_documents, odd_documents, prose


def edits(text, window):
    """Fewest edits between the text and any part of the window, by the textbook table."""
    row = [0] * (len(window) + 1)
    for i, a in enumerate(text, 1):
        row, old = [i], row
        for j, b in enumerate(window, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (a != b)))
    return min(row)


def changed(rng, text, n):
    letters = list(text)
    for _ in range(n):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("abcdefgh ")
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, rng.choice("abcdefgh "))
    return "".join(letters)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(1)
    return [(i, " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(30)))
            for i in range(40)]


def test_exact_check_is_the_edit_distance(passages):
    rng = random.Random(2)
    index = dc.PassageIndex(passages[:5], 0.1)
    for owner, (_, text) in enumerate(passages[:5]):
        for n in (0, 5, 10, 14, 16, 20, 25):
            window = prose(rng, 5) + " " + changed(rng, text, n) + " " + prose(rng, 5)
            assert index.holds(owner, window) == (edits(text, window) <= int(0.1 * len(text)))


@pytest.mark.parametrize("share, least", [(0.0, 1.0), (0.05, 0.97), (0.09, 0.9)])
def test_recall(spark, passages, share, least):
    rng = random.Random(3)
    rows, want = [], {}
    for i, text in passages:
        inside = changed(rng, text.upper(), int(share * len(text)))
        body = f"{prose(rng, 60)} {inside} {prose(rng, 60)}"
        if edits(dc.normal(text), dc.normal(inside)) <= int(0.1 * len(text)):
            want[i] = [i]
        rows.append((i, body, None, None, None))
    clean = [(1000 + i, prose(rng, 150), None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows + clean, SCHEMA)
    items = spark.createDataFrame(passages, "item_id bigint, text string")
    got = {r.doc_id: r["items"] for r in dc.contaminated(docs, items).collect() if r.contaminated}
    assert all(found == [i] for i, found in got.items()) and all(i < 1000 for i in got)
    assert len(set(got) & set(want)) >= least * len(want)


def test_blocks_give_the_same_and_short_passages_are_found(spark, passages):
    items = spark.createDataFrame([*passages, (500, "so short"), (501, None), (502, " ")], "item_id bigint, text string")
    rng = random.Random(4)
    rows = [(i, f"{prose(rng, 9)}\n{passages[i][1]}\n{passages[i + 1][1]}", None, None, None) for i in range(20)]
    rows += [(50, "this is SO  short, no", None, None, None), (51, "it is so short", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    one = {r.doc_id: r["items"] for r in dc.contaminated(docs, items).collect()}
    many = {r.doc_id: r["items"] for r in dc.contaminated(docs, items, block_chars=400).collect()}
    assert one == many and all(one[i] == [i, i + 1] for i in range(20))
    assert one[50] == [] and one[51] == [500]
    assert [r.doc_id for r in dc.clean(docs, items, block_chars=400).collect()] == [50]


def test_odd_rows(spark, passages):
    rows = odd_documents(spark)
    items = spark.createDataFrame(passages, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    for benchmark in (items, none):
        got = dc.contaminated(rows, benchmark)
        assert got.count() == rows.count() and got.filter("contaminated").count() == 0
        kept = dc.clean(rows, benchmark)
        assert kept.columns == rows.columns and kept.exceptAll(rows).count() == 0 and kept.count() == rows.count()
        assert all(r[c] == "outside" for r in kept.collect() for c in CLASHES)
    assert dc.contaminated(no_documents(spark), items).count() == 0
