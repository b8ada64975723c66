from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import mixing
from tests.llm.helpers import ODD, SCHEMA, no_documents, odd_documents


def size(text):
    return len(re.findall("[^ \t-\r]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, fixed = Fraction(share) * sum(sizes.values()), {}
    while len(fixed) < len(order):
        open_weight = sum(weight[s] for s in order if s not in fixed)
        level = (wanted - sum(fixed.values())) / open_weight
        over = [s for s in order if s not in fixed and level * weight[s] > epochs * sizes[s]]
        if not over:
            return {s: fixed.get(s, level * weight[s]) for s in order}
        fixed |= {s: Fraction(epochs * sizes[s]) for s in over}
    return fixed


def brute(rows, **settings):
    sizes, docs = Counter(), defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        sizes[source] += size(text)
        key = hashlib.md5(f"{'-' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()[:16]
        docs[source].append((key, doc_id if doc_id is not None else -1, doc_id, size(text)))
    found = []
    for source, target in brute_targets(sizes, **settings).items():
        total = sizes[source]
        whole = target // total if total else 0
        left = int(target + Fraction(1, 2)) - whole * total
        for _, _, doc_id, n in sorted(docs[source], key=lambda row: row[:2]):
            part = max(0, min(n, left))
            left -= part
            found.append((doc_id, n, total, round(float(target), 6), whole * n + part))
    return sorted(found, key=repr)


def planned(df, **settings):
    rows = mixing.plan(mixing.described(df), **settings).collect()
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in rows), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    names = ["a"] * 12 + ["b", "B", "é", None, "zz", "z"]
    return [
        (i, " \n".join("word" for _ in range(rng.randrange(40))) if rng.random() > 0.05 else None, "en", rng.choice(names), 1)
        for i in range(400)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert planned(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_sources_stop_one_after_another(spark):
    rows = [(i, "w " * (1 + i * i), "en", f"s{i:02d}", 1) for i in range(40)]
    assert planned(spark.createDataFrame(rows, SCHEMA), weights=(5, 2, 1)) == brute(rows)


def test_budgets_are_filled_exactly(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.plan(mixing.described(df))
    sums = plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(row.taken == int(row.target + 0.5) for row in sums)
    assert plan.filter("taken > 2 * size OR taken < 0").count() == 0
    again = mixing.plan(mixing.described(df.repartition(5)))
    assert sorted(map(tuple, again.drop("row").collect()), key=repr) == sorted(map(tuple, plan.drop("row").collect()), key=repr)


def test_a_third_of_all_rows_is_one_row(spark):
    """Equal rows lie in several ranges, and the budget ends among them."""
    one = spark.range(3000).selectExpr("7L AS doc_id", "'x y z' AS text", "'en' AS lang", "'hot' AS source", "5L AS n_chars")
    other = spark.range(3000).selectExpr("id AS doc_id", "'x y' AS text", "'en' AS lang", "'cold' AS source", "5L AS n_chars")
    plan = mixing.plan(mixing.described(one.unionByName(other)))
    sums = {r.source: (r.taken, r.target) for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    assert sums["cold"] == (12000, 12000.0) and sums["hot"] == (10500, 10500.0)
    assert plan.filter("source = 'hot'").groupBy("taken").count().count() == 2


def test_odd_rows_clashing_names_and_no_rows(spark):
    df = odd_documents(spark)
    for name in ("size", "key", "range", "of", "target", "before", "taken", "_row"):
        df = df.withColumn(name, F.lit("outside"))
    assert planned(df) == brute(ODD)
    assert planned(no_documents(spark)) == []
    assert mixing.mixture(no_documents(spark)).collect() == []


def test_mixture_has_the_words_that_the_plan_takes(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("taken", F.lit("outside"))
    mixed = mixing.mixture(df)
    assert mixed.columns == [*df.columns, "_epoch"]
    got, texts = Counter(), {row[0]: row[1] for row in rows}
    for row in mixed.collect():
        got[row.doc_id] += size(row.text)
        assert texts[row.doc_id].startswith(row.text)
    assert got == Counter({row[0]: row[4] for row in brute(rows) if row[4]})


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(corpus(5), SCHEMA)
    text = mixing.plan(mixing.described(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
