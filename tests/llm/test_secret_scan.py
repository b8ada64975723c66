"""Secret scan: candidates against a regular expression, features by hand, and the forest's verdicts."""

import random
import re

from ebbtide.llm import secret_scan as ss
from tests.llm.helpers import SCHEMA, no_documents, odd_documents, prose


def corpus(n=120):
    rng = random.Random(5)
    key = lambda size, letters="0123456789abcdef": "".join(rng.choice(letters) for _ in range(size))
    rows = []
    for i in range(n):
        kind = i % 4
        extra = [
            f'token = "{key(40)}"', f"card {key(16, '0123456789')} paid", f"mail me.{key(6)}@mail{i}.example.com now",
            f"see wordlist/another_word/file{i}.html here",
        ][kind]
        rows.append((i, f"{prose(rng, 20)} {extra} {prose(rng, 20)} wordlist another word file", "en", "s", 0))
    return rows


def test_candidates(spark):
    rows = corpus()
    found = ss.findings(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for doc, text, *_ in rows:
        for k, m in enumerate(re.finditer(ss.CANDIDATE, text)):
            want.append((doc, k, m.group(0), text[: m.start()][-ss.CONTEXT :], text[m.end() :][: ss.CONTEXT]))
    mixed = lambda c: re.search("[0-9]", c) or (re.search("[a-z]", c) and re.search("[A-Z]", c))
    by_hand = {(d, c, a) for d, _, c, _, a in want if mixed(c) and len(list(re.finditer(ss.CANDIDATE, rows[d][1]))) == 1}
    assert by_hand <= {(r.doc, r.candidate, r.after) for r in found}
    assert {(r.doc, r.ordinal, r.candidate) for r in found} == {(d, k, c) for d, k, c, *_ in want if mixed(c)}


def test_secrets_stay_and_false_positives_go(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    got = ss.scan(docs).collect()
    by_kind = {kind: [r.is_secret for r in got if r.doc_id % 4 == kind] for kind in range(4)}
    assert len(by_kind[0]) == 30 and all(by_kind[0])
    assert not any(by_kind[1] + by_kind[2] + by_kind[3])
    assert [r.coverage for r in got if r.doc_id % 4 == 3][0] > 0.4


def test_given_findings_decide(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    found = ss.findings(docs)
    labels = found.selectExpr("candidate", "CAST(doc % 4 = 1 AS INT) AS label")
    got = ss.scan(docs, labels).collect()
    assert all(r.is_secret == (r.doc_id % 4 == 1) for r in got)


def test_odd_rows(spark):
    assert ss.scan(no_documents(spark)).count() == 0
    got = ss.scan(odd_documents(spark)).collect()  # no finding has a label: nothing is removed
    assert all(r.score == 0.5 and r.is_secret for r in got)
    twice = spark.createDataFrame([(1, 'token = "0123456789abcdef0123"', None, None, None)] * 2, SCHEMA)
    assert ss.scan(twice).count() == 2


def test_main_path_is_native(spark):
    plan = ss.scan(spark.createDataFrame(corpus(40), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
