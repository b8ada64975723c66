from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import merkle
from tests.llm.helpers import ODD, SCHEMA, no_documents, odd_documents


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, added=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + added
    fields = [None if value is None else str(value) for value in (doc_id, source, lang, n_chars, text)]
    return digest(*["-" if value is None else f"{len(value.encode())}:{value}" for value in fields])


def tree(nodes):
    """The root and for each node what it meets: (sibling or empty, whether that stands to the left)."""
    met, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            other = place + 1 if place % 2 == 0 else place - 1
            met[k].append((nodes[other] if other < len(nodes) else "", place % 2 == 1))
            at[k] = place // 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], met


def brute(rows):
    trees = []
    for lang in sorted({row[2] for row in rows}, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(((row, leaf(row)) for row in rows if row[2] == lang), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append((own, *tree([node for _, node in own])))
    root, above = tree([subroot for _, subroot, _ in trees])
    found = []
    for (own, subroot, inside), outside in zip(trees, above):
        for (row, node), steps in zip(own, inside):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, 1) if changed else node
            for sibling, left in steps + outside:
                folded = digest(sibling, folded) if left else digest(folded, sibling)
            proof = digest(*[sibling for sibling, _ in steps + outside])
            found.append((row[0], node, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def collected(df, height=merkle.HEIGHT):
    return sorted(map(tuple, merkle.manifest(df, merkle.tampered_leaf(), False, height).collect()), key=repr)


def corpus():
    rng = random.Random(4)
    rows = [
        (i if rng.random() > 0.05 else None, f"text {rng.randrange(50)}" if rng.random() > 0.1 else None,
         rng.choice(["en", "en", "en", "de", "é", None, "", "zz"]), rng.choice(["a", None]), rng.choice([None, 3]))
        for i in range(300)
    ]
    return rows + rows[:40] + [(7, "x", "only", "s", 1)]


@pytest.mark.parametrize("height", [2, 10])
def test_equals_brute_force(spark, height):
    rows = corpus()
    assert collected(spark.createDataFrame(rows, SCHEMA), height) == brute(rows)


def test_many_languages(spark):
    rows = [(i, "t", f"l{i % 70}", "s", i) for i in range(200)]
    assert collected(spark.createDataFrame(rows, SCHEMA), 2) == brute(rows)


def test_odd_rows_and_clashing_names(spark):
    df = odd_documents(spark)
    for name in ("tree", "block", "node", "n", "given", "root", "_tie"):
        df = df.withColumn(name, F.lit("outside"))
    assert collected(df) == brute(ODD)


def test_one_row_and_none(spark):
    rows = [(1, "a", None, None, None)]
    assert collected(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert merkle.manifest(no_documents(spark)).collect() == []


def test_proofs_lead_to_the_root(spark):
    rows = corpus()
    for row in merkle.manifest(spark.createDataFrame(rows, SCHEMA), height=3).collect():
        assert merkle.fold(row.leaf, row.siblings, row.lefts) == row.root == row.folded_root and row.verified


def test_superblocks_are_spread(spark):
    """One language, and still no task with more than its superblocks."""
    rows = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    nodes = merkle.placed(rows.selectExpr("':en' AS tree", "doc_id", "sha2(text, 256) AS node"), ["doc_id"], 5)
    assert [tuple(r) for r in nodes.orderBy("pos").select("doc_id", "pos", "block", "n").collect()] == [(i, i, i >> 5, 3000) for i in range(3000)]
    counts = nodes.groupBy("tree", "block").count()
    assert counts.count() == 94 and counts.agg(F.max("count")).first()[0] == 32
