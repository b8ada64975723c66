"""The pipeline, a stage at a time, each against a plain version on what the stage was given."""

import public_tokenizers
import pytest

import corpus_pipeline as cp
from ebbtide.llm import bpe, decontaminate, quality_cnn
from ebbtide.sources import storage
from ebbtide.sources.storage import scratch_path, through_table
from tests.llm.helpers import odd_documents
from tests.llm.test_line_templates import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        out = through_table(stage(spark, docs, SF), scratch_path(spark, "test-stage"))
        seen.append((docs, out))
        docs = out
    return seen


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(out.columns == docs.columns for docs, out in stages[:-1])
    assert stages[-1][1].columns == ["doc_id", "ids"]


def test_quality(spark, stages):
    docs, out = stages[0]
    network = quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality_cnn.score(docs, network).filter("predicted = 1").collect()}
    assert set(texts(out)) == good and out.exceptAll(docs).count() == 0


def test_lines(stages):
    docs, out = stages[1]
    want = {d: text for d, (text, n) in brute_lines(list(texts(docs).items())).items() if not n or text.split()}
    assert texts(out) == want
    assert all(r.n_chars == len(r.text) for r in out.join(docs.select("doc_id", docs.text.alias("was")), "doc_id").filter("text <> was").collect())


def test_near_duplicates(stages):
    docs, out = stages[2]
    groups = brute_groups(sorted(texts(docs).items()), cp.WORDS, cp.PERCENT)
    assert set(texts(out)) == {doc for doc, (_, component) in groups.items() if doc == component}


def test_benchmark(spark, stages):
    docs, out = stages[3]
    passages = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = texts(out)
    for doc, text in texts(docs).items():
        if any(p in decontaminate.normal(text) for p in passages):
            assert doc not in kept
        else:
            assert doc in kept


def test_tokens(stages):
    docs, out = stages[4]
    codec = bpe.codec(public_tokenizers.path(bpe.VOCABULARY))
    want = texts(docs)
    got = {r.doc_id: r.ids for r in out.collect()}
    assert set(got) == set(want) and all(codec.pairs.decode(got[d]) == want[d].encode() for d in got)


def test_repeated_and_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in cp.STAGES:
        columns = docs.columns
        docs = through_table(stage(spark, docs, SF), scratch_path(spark, "test-odd"))
        assert name == cp.STAGES[-1][0] or docs.columns == columns
    docs = odd_documents(spark)
    near = cp.near_duplicates(spark, docs, SF)
    assert near.count() == docs.count() - 1 and near.filter("doc_id = 7").count() == 1


def test_stages_leave_no_tables_but_those_their_result_reads(spark, monkeypatch, tmp_path):
    """A stage's result may be read for long; lines, signatures and buckets must not lie on the disk beside it."""
    monkeypatch.setattr(storage, "shared_folder", lambda *_: str(tmp_path))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage, results in ((cp.lines, {"line-gone"}), (cp.near_duplicates, {"document-groups", "repeated-ids"})):
        out = stage(spark, docs, SF)
        left = {path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()}
        assert left == results
        assert 0 < out.count() < docs.count()
        for path in tmp_path.iterdir():
            storage.remove(spark, str(path))


def test_tables_of_a_block_go_at_its_end(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "shared_folder", lambda *_: str(tmp_path))
    path = scratch_path(spark, "result")
    with pytest.raises(ZeroDivisionError), storage.passing_tables(spark):
        outer = through_table(spark.range(5), scratch_path(spark, "outer"))
        with storage.passing_tables(spark):
            inner = through_table(outer.filter("id > 1"), scratch_path(spark, "inner"))
            kept = through_table(inner, path)
            scratch_path(spark, "never-written")
        assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"outer", "result"} and outer.count() == 5
        1 / 0
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["result"] and kept.count() == 3
    through_table(spark.range(1), scratch_path(spark, "later"))
    assert len(list(tmp_path.iterdir())) == 2
