"""The pipeline, stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusweft.llm import mixing, near_dedup, pieces, quality_model, suffix_dedup
from corpusweft.llm.shared import written


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf), name))
    return out


def test_stages(spark, sf, stages):
    docs, good, one, cut, mix, ids = stages
    assert all(s.columns == docs.columns for s in stages[:-1]) and ids.columns == ["doc_id", "source", "lang", "ids", "text"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in quality_model.quality_scores(docs, labels).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scores.items() if p}
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(good).collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(classes.values()))
    rows = one.select("doc_id", "text").collect()
    want = {x[0]: x[2] for x in suffix_dedup.brute_force([(r["doc_id"], r["text"].encode()) for r in rows])}
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert set(kept) == set(want) and all(kept[r["doc_id"]] == r["text"] for r in rows if not want[r["doc_id"]])
    assert all(len(r["text"].encode()) - len(kept[r["doc_id"]].encode()) >= want[r["doc_id"]] for r in rows)
    copies = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(kept) and max(copies.values()) == 2
    assert all(kept[r["doc_id"]] == r["text"] for r in mix.collect())
    lib = pieces.load(pieces.MODEL).lib
    got = ids.collect()
    assert len(got) == mix.count() and all(list(r["ids"]) == lib.encode(r["text"]) and r["text"] == kept[r["doc_id"]] for r in got)


def test_odd_rows_pass_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(10**9, None, None, None, None), (10**9 + 1, "", "en", "a", 0), (None, "no id " * 30, "en", None, 180), (10**9 + 2, "twice " * 9, "en", "a", 54), (10**9 + 2, "twice " * 9, "en", "a", 54)], docs.schema)
    for d in (docs.unionByName(odd).withColumns({"_spans": F.lit(1), "_rid": F.lit(2)}), docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before, d = d.columns, written(stage(spark, d, sf), name)
            assert name == "pieces" or d.columns == before


def test_run(spark, sf, stages):
    assert corpus_pipeline.run(spark, sf).count() == stages[-1].count()


def test_mix_reads_texts_once_for_sizes(spark, sf, monkeypatch):
    names, own = [], mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, name: names.append(name) or own(df, name))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    times = {r["doc_id"]: r["count"] for r in mixing.mixed(docs.withColumns({"_size": F.lit(1), "_shuffle": F.lit("x")})).groupBy("doc_id").count().collect()}
    assert names == ["marked", "targets"]
    assert times == {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["taken"]}
