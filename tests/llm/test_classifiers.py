"""Quality and toxicity: held-out accuracy, and inputs at the edges."""

import numpy as np
import pytest

from ebbtide.llm import quality_cnn, toxicity
from ebbtide.llm.labelled import Sample, held_out, sample
from pyspark.sql import functions as F
from tests.llm.helpers import ODD, no_documents, odd_documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return spark.read.parquet(f"{SF}/documents.parquet").join(F.broadcast(labels.select("doc_id")), "doc_id").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(rows):
    scores, truth = (np.array(x, float) for x in zip(*rows))
    good, bad = scores[truth == 1], scores[truth == 0]
    return ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean()


def judged(scored, labels, column):
    rows = scored.filter("held_out").join(labels, "doc_id").select("score", column, "predicted").collect()
    return auc([(r.score, r[column]) for r in rows]), rows


def test_quality_on_held_out_documents(docs, labels):
    network = quality_cnn.fit(docs, labels, per_class=700)
    area, rows = judged(quality_cnn.score(docs, network), labels, "quality")
    assert area > 0.97
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in good) > 0.98 * len(good)  # clean documents are kept
    first = {r.doc_id: r.score for r in quality_cnn.score(docs, network).collect()}
    again = quality_cnn.score(docs.repartition(3), quality_cnn.fit(docs, labels, per_class=700)).collect()
    assert all(abs(r.score - first[r.doc_id]) < 1e-3 for r in again)


def test_toxicity_on_held_out_documents(docs, labels):
    model = toxicity.fit(docs, labels)
    area, rows = judged(toxicity.score(docs, model), labels, "toxic")
    assert area > 0.88
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) < 0.03 * len(clean)


def test_held_out_is_the_crc_rule(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_sample_is_bounded_and_weighted(spark, docs, labels):
    data = sample(docs, labels.unionByName(labels), "toxic", 100, 10**6)
    assert len(data.texts) == 200 and np.bincount(data.labels).tolist() == [100, 100]
    assert data.weights[data.labels == 0].sum() > 5 * data.weights[data.labels == 1].sum()


@pytest.mark.parametrize("operator, otherwise", [(quality_cnn, 0.5), (toxicity, 0.0)])
def test_odd_rows(spark, operator, otherwise):
    rows = odd_documents(spark)
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = operator.fit(rows, empty)
    assert model is None
    got = operator.score(rows, model).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {otherwise}
    assert operator.score(no_documents(spark), model).count() == 0
    texts = [b"good text of words " * 30, b"@@@@ ### !!! $$$ " * 30] * 40
    data = Sample(texts, np.array([1, 0] * 40), np.ones(80))
    model = quality_cnn.Network().fit(data, epochs=2) if operator is quality_cnn else toxicity.train(data)
    got = operator.score(rows, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    seven = [r.score for r in got if r.doc_id == 7]
    assert len(seven) == 2 and abs(seven[0] - seven[1]) < 1e-4


def test_every_part_of_a_text_counts():
    texts = [b"good text of words " * 30, b"@@@@ ### !!! $$$ " * 30] * 40
    network = quality_cnn.Network().fit(Sample(texts, np.array([1, 0] * 40), np.ones(80)), epochs=4)
    clean = b"good text of words " * 800
    at_the_end = clean + b"@@@@ ### !!! $$$ " * 40
    whole, spoilt = network.score([clean, at_the_end])
    assert spoilt < whole
    alone = [network.score([t])[0] for t in (clean, b"x", at_the_end)]
    assert np.allclose(network.score([clean, b"x", at_the_end]), alone, atol=1e-4)


def test_windows_cover_the_text():
    for text in ["", "a", "one two", "word " * 300, "x" * 1000, "é" * 300 + " end"]:
        found = toxicity.windows(text)
        data = b" %b " % b" ".join(text.lower().encode().split())
        assert data.startswith(found[0][:-1] or found[0]) and found[-1].rstrip() == data[len(data) - len(found[-1]) :].rstrip()
        assert max(map(len, found)) <= 4 * toxicity.WINDOW + 1
