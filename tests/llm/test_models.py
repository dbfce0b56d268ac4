"""Toxicity, language and quality by held-out accuracy; the pipeline from end to end."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import SF_DIR
from triplake.llm import language, quality, queries, toxicity
from triplake.llm.words import fold

LARGER = "/root/testdata/sf0.01"


def test_toxicity_of_held_out_texts(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic")
    out = queries.op9_toxicity(spark, LARGER).join(labels, "doc_id").where("held_out").toPandas()
    assert len(out) > 50 and (out.predicted == out.toxic).mean() > 0.9
    assert out.score.between(0, 1).all()


def test_toxicity_learns_nothing_from_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.ids == b.ids).all() and np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_odd_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (9, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    out = toxicity.score(odd, model)
    assert out.columns == [*odd.columns, "_toxicity"] and out.where("_toxicity BETWEEN 0 AND 1").count() == odd.count()
    assert toxicity.score(none, toxicity.train(none, labels.where("false"))).count() == 0


def test_language_of_held_out_texts(spark):
    langs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    out = queries.op10_language_id(spark, LARGER).join(langs, "doc_id").where("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()


def test_odd_languages(spark, odd, none):
    model = language.fit(["the cat and the dog"] * 20 + ["der hund und die katze"] * 20, ["en"] * 20 + ["de"] * 20, epochs=5)
    out = {r.score: r._language for r in language.identify(odd, model).collect()}
    assert out[2].lang == out[3].lang == out[5].lang == "und" and not out[2].accepted and out[4] == out[0]
    assert language.identify(none, model).count() == 0
    empty = language.train(none)
    assert {r._language.lang for r in language.identify(odd, empty).collect()} == {"und"}
    numbers = spark.createDataFrame([("12 34",), ("und die katze",)], "text string")
    assert [r._language.lang for r in language.identify(numbers, model).collect()] == ["und", "de"]


def test_labellers_are_told_from_their_votes():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(20_000) < np.where(good, 0.02, 0.7), 0, -1) for _ in range(4)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts)
    assert abs(model.good - 0.8) < 0.03 and np.abs(model.tables[0][:, 1] - 0.7).max() < 0.05


def test_quality_from_weak_labels(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "quality")
    out = queries.op6_quality_classifier(spark, LARGER).join(labels, "doc_id").toPandas()
    assert (out.predicted == out.quality).mean() > 0.9


def test_odd_quality(odd, none):
    _, scorer = quality.train(odd)
    assert quality.score(odd, scorer).where("_quality BETWEEN 0 AND 1").count() == odd.count()
    assert quality.score(none, quality.train(none)[1]).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == corpus_pipeline.COLUMNS and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert out.count() <= docs.count()
        docs = out
    assert {"sequence_id", "offset", "doc_id"} <= set(docs.columns)


def test_pipeline_of_odd_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    kept = {r.doc_id for r in docs.collect()}
    # Document 1 repeats the null id's only line; empty ones are left alone.
    assert {2, 3, 4, 5, 6, None} <= kept and 1 not in kept


def test_pipeline_runs_over_empty_tables(spark, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
