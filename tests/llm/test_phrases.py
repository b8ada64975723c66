from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import phrases, sieve
from tests.llm.helpers import ODD, SCHEMA, no_documents, odd_documents

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute(rows, least=10, covered=50, top=2000):
    f = Counter()
    for _, text, lang, _, _ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate({ord(c): c.lower() for c in UPPER})):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in (1, 2, 3):
                f.update((lang or "und", *words[i : i + size]) for i in range(len(words) - size + 1))
    sizes = Counter()
    for (lang, *words), count in f.items():
        if len(words) == 1:
            sizes[lang] += count
    found = {}
    for (lang, *words), a in f.items():
        if len(words) == 1 or a < least:
            continue
        longer = [n for (other, *w), n in f.items() if other == lang and n >= least and len(w) == 3 > len(words) and words in (w[:2], w[1:])]
        if any(100 * n >= covered * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, own in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(rows)


def corpus(seed, n=80):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randrange(120))]
        if rng.random() < 0.5:
            words[3:3] = ["New", "york", "City"]
        if rng.random() < 0.3:
            words[1:1] = ["É", "É", "É", "É"]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"]), "s", 1))
    return rows


def collected(df, **settings):
    return sorted(map(tuple, phrases.collocations(df, **settings).collect()))


def test_equals_brute_force(spark):
    rows = corpus(1)
    assert collected(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_first_of_each_language_and_ties(spark):
    rows = corpus(2)
    expected = brute(rows, least=3, top=7)
    assert collected(spark.createDataFrame(rows, SCHEMA), least=3, top=7) == expected
    assert {row[0] for row in expected} == {"en", "de", "und"}


@pytest.mark.parametrize("rows, words", [(1 << 19, 8), (4, 2)])
def test_frequent_groups_in_a_sieve(spark, monkeypatch, rows, words):
    """A wide sieve, and one so narrow that much passes that should not."""
    monkeypatch.setattr(phrases, "EXACT_ROWS", 5)
    monkeypatch.setattr(sieve, "ROWS", rows)
    monkeypatch.setattr(sieve, "WORDS", words)
    rows = corpus(3, 40)
    assert collected(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_sieve_passes_all_members_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(phrases, "EXACT_ROWS", 5)
    rows = spark.range(20_000).selectExpr("id", "xxhash64(id) AS h")
    passed = phrases.among(rows, rows.filter("id < 2000").select("h"), "h")
    assert passed.columns == ["id", "h"] and passed.filter("id < 2000").count() == 2000
    assert passed.count() < 2010


def test_odd_rows_clashing_names_and_no_rows(spark):
    df = odd_documents(spark)
    for name in ("word", "piece", "pair", "f", "a", "b", "rank", "cut"):
        df = df.withColumn(name, F.lit("outside"))
    rows = ODD * 6
    for _ in range(5):
        df = df.unionByName(odd_documents(spark).select(*df.columns[: len(odd_documents(spark).columns)], *[F.lit("outside").alias(n) for n in df.columns[len(odd_documents(spark).columns) :]]))
    assert collected(df, least=4) == brute(rows, least=4) != []
    assert collected(no_documents(spark)) == []


def test_overlapping_and_exact_numbers(spark):
    """Overlaps count, and products beyond 64 bits are exact."""
    rows = [(1, "a a a a a a a a a a a a", "en", None, None)]
    assert collected(spark.createDataFrame(rows, SCHEMA), covered=101) == brute(rows, covered=101)
    big = spark.createDataFrame([(3_000_000_001, 3_000_000_019, 3_000_000_007)], "a bigint, l bigint, r bigint")
    a, left, right = 3_000_000_001, 3_000_000_019, 3_000_000_007
    assert big.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


def test_joins_shuffle_no_occurrences(spark):
    """The join at adjacent positions reads both sides from their buckets."""
    found = phrases.Occurrences(spark, 10)
    before = {name: spark.conf.get(name) for name in phrases._BUCKETED}
    try:
        with phrases.joined_in_buckets(spark):
            rows = spark.range(100).selectExpr("id % 7 AS piece", "int(id div 7) AS pos", "id")
            ones = found.write(found.dealt(rows))
            plan = phrases.adjacent(ones, ones, F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Sort [") == 1
            assert plan.count() == 93
    finally:
        found.drop()
    assert {name: spark.conf.get(name) for name in phrases._BUCKETED} == before
