import hashlib

import pytest
from plain import base_spans, contamination, deduplicated, library

import corpus_pipeline as pipeline
from slotwise.llm import common, kneser_ney, pii, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "pii", "bpe"]


def test_each_stage_on_its_input(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(d.columns == docs.columns for d in steps[:-1])
    keep = {r["doc_id"] for r in kneser_ney.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["keep"]}
    assert set(rows(steps[0])) == keep
    before = [(d, r["text"]) for d, r in rows(steps[0]).items()]
    assert set(rows(steps[1])) == {d for d, _ in deduplicated(before)}
    before = [(d, r["text"]) for d, r in rows(steps[1]).items()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(rows(steps[2])) == {x[0] for x in contamination(before, items) if not x[-1]}
    before, after = rows(steps[2]), rows(steps[3])
    assert set(before) == set(after)
    for d, r in after.items():
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == before[d]["text"] or "[" in r["text"]
        assert [k for *_, k in base_spans(before[d]["text"])] == [] or r["text"] != before[d]["text"]
    lib = library()
    assert set(rows(steps[4])) == set(after)
    for d, r in rows(steps[4]).items():
        ids = lib.encode(after[d]["text"], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_the_stages(spark, steps):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[-1].collect()))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_documents(spark, odd, none, k):
    name, stage = pipeline.STAGES[k]
    for docs in (odd, none):
        out = stage(spark, docs, SF)
        out.collect()
        assert name == "bpe" or out.columns == docs.columns


def test_masking_stays_clean(spark, odd):
    assert pii.mask(odd, pii.learn(odd)).count() == odd.count()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
