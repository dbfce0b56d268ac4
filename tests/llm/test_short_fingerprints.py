"""Texts of few words have a fingerprint of their own."""

import random

from pyspark.sql import functions as F

from triplake.llm import fingerprint


def test_no_text_with_words_lacks_an_anchor(spark):
    rng = random.Random(2)
    texts = sorted({" ".join(rng.choices([f"w{i}" for i in range(500)], k=n)) for n in range(1, 13) for _ in range(150)})
    frame = spark.createDataFrame([(t,) for t in [*texts, "", " \n"]], "text string")
    found = {r.text: r.f for r in frame.select("text", fingerprint.written(fingerprint.hashes(F.col("text"))).alias("f")).collect()}
    assert found.pop("") == found.pop(" \n") == ""
    assert all(found.values())
    # Short texts of different words share no whole fingerprint.
    short = [t for t in texts if len(t.split()) <= 6]
    assert len({found[t] for t in short}) == len(short)


def test_unrelated_short_texts_are_not_alike(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{i}w{k}" for k in range(5))) for i in range(40)], "doc_id long, text string")
    assert {r.near_next for r in fingerprint.fingerprint_changes(docs).collect()} == {0.0}
