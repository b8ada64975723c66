"""Line templates: word-valued fields, dominant variants, lines that recur as they are."""

import random

import pytest

from ebbtide.llm import line_templates as lt
from tests.llm.helpers import SCHEMA, prose
from tests.llm.test_line_templates import brute, corpus


def word(number):
    """A word without digits for a number."""
    return "x" + "".join(chr(97 + int(digit)) for digit in str(number))


def kept(spark, rows):
    df = spark.createDataFrame([(doc, text, None, None, None) for doc, text in rows], SCHEMA)
    return {r.doc_id: r.text for r in lt.drop_recurring_lines(df).collect()}


def account(name, city):
    return f"The account named {word(name)} was opened in {word(city)} by our sales team today"


@pytest.mark.parametrize("names, cities", [(60, 1), (100, 100)])
def test_word_fields_at_any_size(spark, names, cities):
    pairs = [(i, i + j) for i in range(names) for j in range(cities)]
    got = kept(spark, [(doc, account(*pair)) for doc, pair in enumerate(pairs)])
    assert [doc for doc, text in got.items() if text] == [0]


def test_fields_of_templates_that_share_a_leaf(spark):
    rows = [(doc, account(doc % 20, doc // 20)) for doc in range(400)]
    rows += [(1000 + doc, f"The account named {word(doc % 7)} has been closed by {word(doc % 9)} for good and ever since") for doc in range(90)]
    rows += [(2000, "The account named after him shows prose that nobody else wrote down before")]
    got = kept(spark, rows)
    assert [doc for doc, text in got.items() if text] == [0, 1000, 2000]


def test_dominant_variant_takes_its_template_along(spark):
    rows = [(10 + doc, account(7, 7)) for doc in range(200)] + [(3, account(7, 8)), (400, account(9, 7))]
    got = kept(spark, rows)
    assert [doc for doc, text in got.items() if text] == [3]


def test_one_copy_for_a_template_of_recurring_variants(spark):
    rows = [(doc, f"Posted by user{doc % 4} on day {doc % 4} sharp") for doc in range(40)]
    got = kept(spark, rows)
    assert [doc for doc, text in got.items() if text] == [0]


@pytest.mark.parametrize("seed", [5, 6])
def test_equals_the_definition(spark, seed):
    rng = random.Random(seed)
    rows = corpus(seed)
    for doc in range(100, 400):
        name, city = (int(rng.paretovariate(0.7)) % 50 for _ in range(2))
        lines = [account(name, city), " ".join(rng.choice(["a", "b", "c", "d9"]) for _ in range(rng.randrange(4, 8)))]
        rows.append((doc, "\n".join(lines * rng.choice([1, 1, 2]))))
    assert kept(spark, rows) == {doc: text for doc, (text, _) in brute(rows).items()}


def test_a_line_of_any_length_goes_from_its_second_document_on(spark):
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (5, 49, 60)]
    rows = [(i, "\n".join([prose(rng, 80), *passages, "too short to see", prose(rng, 80)])) for i in range(2)]
    got = kept(spark, rows)
    lines = rows[1][1].split("\n")
    assert got[0] == rows[0][1] and got[1].split("\n") == [lines[0], *lines[-2:]]


def test_null_and_empty_texts_among_others(spark):
    rows = corpus(7) + [(500, None), (501, "")]
    df = spark.createDataFrame([(doc, text, None, None, None) for doc, text in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.n_dropped) for r in lt.drop_recurring_lines(df).collect()}
    assert got.pop(500) == (None, 0)
    assert got == {doc: value for doc, value in brute(rows).items() if doc != 500}
