"""Near-duplicate groups against all pairs."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from ebbtide.llm import ngram_join as nj
from ebbtide.llm import components
from ebbtide.llm.components import connected
from tests.llm.helpers import SCHEMA, no_documents, odd_documents, prose


def shingles(text, n):
    """As text, from the definition."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute(rows, words, percent):
    """Rows by their place: sets from the words themselves, links of all pairs."""
    sets = [shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: (len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = prose(rng, rng.choice([2, 4, 9, 15, 30, 80, 250, 700])).split(" ")
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(doc, text, None, None, None) for doc, text in rows], SCHEMA).repartition(5)


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("words, percent, block", [(3, 90, 1024), (3, 90, 4), (5, 80, 4)])
def test_groups_equal_brute_force(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(nj, "BLOCK_ROWS", block)  # small blocks take all three rounds
    rows = near_copies(words * percent)
    assert found(nj.near_duplicate_groups(documents(spark, rows), words, percent)) == brute(rows, words, percent)


@pytest.mark.parametrize("sure", [80, 90])
def test_similar_sets_share_a_signature(sure):
    rng = np.random.default_rng(sure)
    for size in [1, 2, 5, 9, 10, 11, 14, 19, 20, 27, 28, 40, 76, 120, 300, 1000]:
        for _ in range(12):
            base = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
            drop = rng.integers(0, size + 1)
            other = np.concatenate([base[drop:], rng.integers(0, 2**63, rng.integers(0, 1 + size // 8), dtype=np.int64).astype(np.uint64)])
            other = np.unique(other)
            common = len(np.intersect1d(base, other))
            union = len(base) + len(other) - common
            if not len(other) or 100 * common < sure * union or common == union:
                continue
            keys, owners = nj.signatures([base, other], sure)
            assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist()), (size, common, union)


def test_recall_below_the_sure_similarity():
    """With sure = 85, pairs from 0.8 on share a signature nearly always unless they are short."""
    rng = np.random.default_rng(4)
    hits = {60: 0, 400: 0}
    for size in hits:
        for _ in range(60):
            base = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
            changed = size // 9
            fresh = rng.integers(0, 2**63, changed, dtype=np.int64).astype(np.uint64)
            keys, owners = nj.signatures([base, np.unique(np.concatenate([base[changed:], fresh]))], 85)
            hits[size] += bool(set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist()))
    assert hits[60] >= 45 and hits[400] >= 59


def test_blocks_of_one_family_run_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_ROWS", 100)
    rows = spark.range(3000).selectExpr("1L AS family", "id", "3L AS n", "encode('aaaaaaaabbbbbbbbcccccccc', 'utf-8') AS ngrams")
    placed = nj._blocks(rows, "block")
    dealt = placed.repartition(nj._tasks(placed), "family", "block")
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert nj.verified_links(rows, 90).select("a").distinct().count() == 2999


def test_sketches_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(7)
    for size in [1, 3, 10, 50, 64, 65, 400, 3000, 30_000]:
        base = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
        for percent in (80, 90):
            least = -(-len(base) * percent // 100)
            part = np.sort(rng.permutation(base)[:least])
            table = nj.sketch_table([nj.sketch(base), nj.sketch(part)])
            sizes = np.array([len(base), len(part)])
            assert nj.possible(table, sizes, table, sizes, percent).all()
        other = np.unique(rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
        table, sizes = nj.sketch_table([nj.sketch(base), nj.sketch(other)]), np.array([len(base), len(other)])
        assert size < 50 or not nj.possible(table, sizes, table, sizes, 80)[0, 1]


def test_large_buckets_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_ROWS", 6)
    rows = near_copies(5, groups=4, copies=40)
    assert found(nj.near_duplicate_groups(documents(spark, rows), 5, 80)) == brute(rows, 5, 80)


def test_rows_of_one_id_with_different_texts(spark):
    rng = random.Random(2)
    base = prose(rng, 300).split(" ")
    change = lambda at: " ".join([*base[:at], "changed", *base[at + 1 :]])
    rows = [(1, " ".join(base)), (2, change(40)), (7, change(90)), (7, change(200)), (8, prose(rng, 50)), (8, prose(rng, 60)), (9, "")]
    df = documents(spark, rows)
    got = sorted((r.doc_id, r.component_id) for r in nj.near_duplicate_groups(df, 3, 90).collect())
    assert got == [(1, 1), (2, 1), (7, 1), (7, 1), (8, 8), (8, 8), (9, 9)]
    # Both texts of 8 are clean; of 7, one is a copy and one is not.
    rows = [(1, " ".join(base)), (7, change(90)), (7, prose(rng, 80)), (7, prose(rng, 80)), (8, "a b c d e f"), (8, "a b c d e f")]
    kept = nj.one_of_each(documents(spark, rows), 3, 90)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([rows[0], rows[2], rows[3], rows[4]])


def test_odd_rows(spark):
    got = sorted(map(repr, map(tuple, nj.near_duplicate_groups(odd_documents(spark)).collect())))
    want = [(1, 0, 1), (2, 0, 2), (None, 4, None), (3, 0, 3), (4, 1, 4), (5, 1, 5), (6, 1, 6), (7, 2, 7), (7, 2, 7), (8, 1, 8)]
    nine = (9, len(nj.ngram_set("tabs\tand\r\nlines\x1c and é́ 　x", 3)), 9)
    assert got == sorted(map(repr, [*want, nine]))
    assert nj.near_duplicate_groups(no_documents(spark)).count() == 0


def test_words_are_cut_at_ascii_blanks_alone():
    assert len(nj.ngram_set("A b\x0bC\x0cd e", 3)) == 3
    assert np.array_equal(nj.ngram_set("ABC DEF", 3), nj.ngram_set("abc\tdef", 3))
    assert not np.array_equal(nj.ngram_set("É", 3), nj.ngram_set("é", 3))


def test_equal_copies_in_many_partitions_are_one_group(spark):
    rows = [(i, "the same few words in every one of them") for i in range(400)] + [(999, "something else entirely here")]
    got = found(nj.near_duplicate_groups(documents(spark, rows)))
    assert {c for doc, (_, c) in got.items() if doc < 400} == {0} and got[999][1] == 999


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    edges = [*path, (100, 101), (101, 100), (7, 7), (None, 3), (200, 205), (205, 203)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200, 203: 200, 205: 200}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_run_no_round_on_stars(spark, monkeypatch):
    """Edges that are stars are done; others are flattened the same with minima broadcast and with minima joined."""
    rounds = []
    once = components._round
    monkeypatch.setattr(components, "_round", lambda edges, few: rounds.append(few) or once(edges, few))
    stars = [(5, 1), (1, 9), (9, 1), (7, 8), (4, 4), (None, 2)]
    got = sorted(map(tuple, connected(spark.createDataFrame(stars, "a bigint, b bigint")).collect()))
    assert got == [(1, 1), (5, 1), (7, 7), (8, 7), (9, 1)] and rounds == []
    edges = [(i, i * 7 % 301) for i in range(300)] + [(2, 1), (1, 2), (-5, -6), (-6, -4), (-7, -6)]
    few = sorted(map(tuple, connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert set(rounds) == {True}
    rounds.clear()
    monkeypatch.setattr(components, "FEW_EDGES", 0)
    assert sorted(map(tuple, connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect())) == few
    assert set(rounds) == {False} and {i: c for i, c in few if i < 0} == {-4: -7, -5: -7, -6: -7, -7: -7}
    words = spark.createDataFrame([("c", "b"), ("b", "a"), ("x", "x")], "a string, b string")
    assert sorted(map(tuple, connected(words).collect())) == [("a", "a"), ("b", "a"), ("c", "a")]
