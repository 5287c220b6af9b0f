"""The stages in a row: what each keeps, and that its decisions take effect."""

import hashlib

import cases
import corpus_pipeline
import pytest

from tradewind.llm import decontaminate, linededup, quality, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows after each stage, the documents first."""
    cases.frame(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
        out.append((name, docs))
    return out


def test_stages_keep_the_columns(kept):
    for name, docs in kept[:-1]:
        assert docs.columns == kept[0][1].columns, name
        assert [f.dataType for f in docs.schema.fields] == [f.dataType for f in kept[0][1].schema.fields]
    ids = [{r["doc_id"] for r in docs.select("doc_id").collect()} for _, docs in kept]
    assert all(after <= before for before, after in zip(ids, ids[1:], strict=False)) and ids[-1]


def test_each_stage_does_its_part(spark, kept):
    (_, raw), (_, good), (_, lines), (_, single), (_, clean), (_, tokens) = kept
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.report(raw, labels).filter("kept")
    assert sorted(r[0] for r in judged.select("doc_id").collect()) == cases.ids(good.collect())
    text = {r["doc_id"]: r["text"] for r in good.collect()}
    for r in lines.collect():
        old, new = text[r["doc_id"]].split("\n"), iter(text[r["doc_id"]].split("\n"))
        assert r["text"] in ("", "\n".join(old)) or all(x in new for x in r["text"].split("\n"))
        assert r["n_chars"] == len(r["text"])
    assert linededup.report(good).filter("n_removed > 0").count() > 0
    groups = {r["component_id"] for r in simhash.report(lines).collect()}
    assert cases.ids(single.collect()) == sorted(groups)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = {r["doc_id"] for r in decontaminate.matches(single, items).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - hit
    sha = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in clean.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in tokens.collect()} == sha


def test_run_is_the_stages(spark, kept):
    same = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, same.collect())) == sorted(map(str, kept[-1][1].collect()))


def test_odd_documents_pass_through(spark):
    odd = cases.frame(spark)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, odd, SF).count() <= len(cases.rows())
        assert stage(spark, odd.limit(0), SF).count() == 0
