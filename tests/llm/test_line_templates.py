"""Line dedup against a plain Python version."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from ebbtide.llm import line_templates as lt
from tests.llm.helpers import CLASHES, SCHEMA, no_documents, odd_documents, prose


def brute(rows, min_docs=lt.MIN_DOCS, min_tokens=lt.MIN_TOKENS):
    """From the definition: every line takes part in the counts of its leaf. Text and dropped lines of each document."""
    digit = lambda token: any(c.isascii() and c.isdigit() for c in token)
    split = lambda line: tuple(t for t in re.split("[ \t\n\x0b\f\r]+", line) if t)
    holders, leaves = defaultdict(set), defaultdict(set)
    for doc, text in rows:
        for line in map(split, (text or "").split("\n")):
            if len(line) >= min_tokens:
                holders[line].add(doc)
                leaves[len(line), tuple(lt.FIELD if digit(t) else t for t in line[: lt.DEPTH])].add(line)
    first = {line: min(docs) for line, docs in holders.items() if len(docs) >= lt.REPEATS}
    for lines in leaves.values():
        held, groups = Counter(), defaultdict(set)
        for line in lines:
            held.update({slot: len(holders[line]) for slot in enumerate(line)})
        for line in lines:
            slots = sorted((s for s in enumerate(line) if not digit(s[1])), key=held.get, reverse=True)
            if len(slots) >= lt.MIN_CONSTANTS:
                least = held[slots[max(lt.MIN_CONSTANTS, math.ceil(lt.CONSTANT * len(slots))) - 1]]
                groups[frozenset(s for s in slots if held[s] >= least)].add(line)
            else:
                groups[line].add(line)
        for group in groups.values():
            docs = set().union(*(holders[line] for line in group))
            if len(docs) >= min_docs:
                first.update((line, min(docs)) for line in group)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(split(x), doc) == doc]
        out[doc] = ("\n".join(kept), len(lines) - len(kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    shared = [prose(rng, 8) for _ in range(5)] + ["All rights reserved. Page 1 of 2", "Terms and conditions do apply here"]
    rows = []
    for doc in range(60):
        lines = [prose(rng, rng.randrange(1, 12), 30) for _ in range(4)] + rng.sample(shared, 2)
        lines.append(f"Posted by user{rng.randrange(99)} on day {rng.randrange(31)} at {rng.randrange(24)}h sharp")
        lines.append(f"See also {prose(rng, 1, 9)} in the other {prose(rng, 1, 9)} part of this long guide")
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.n_dropped) for r in lt.drop_recurring_lines(df).collect()}
    assert got == brute(rows)
    posted = [doc for doc, (text, _) in got.items() if "Posted by" in text]
    assert posted == [0]  # a template with variable fields stays in the first document alone


def test_passages_go_and_clean_text_stays(spark):
    rng = random.Random(3)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40)) for i in range(5)] + [(9, prose(rng, 200))]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(df).collect()}
    assert [i for i in range(5) if passage in got[i]] == [0]
    assert got[9] == rows[5][1] and all(got[i].split("\n")[0] == rows[i][1].split("\n")[0] for i in range(5))


def test_odd_rows(spark):
    rows = odd_documents(spark)
    got = lt.drop_recurring_lines(rows)
    assert got.columns == [*rows.columns, "n_lines", "n_dropped"]
    assert got.select(rows.columns).exceptAll(rows).count() == 0 and got.count() == rows.count()
    assert got.filter("n_dropped > 0").count() == 0 and all(r[c] == "outside" for r in got.collect() for c in CLASHES)
    assert lt.drop_recurring_lines(no_documents(spark)).count() == 0


def test_main_path_is_native(spark):
    rows = spark.createDataFrame([(d, t, None, None, None) for d, t in corpus(4)], SCHEMA)
    plan = lt.drop_recurring_lines(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
