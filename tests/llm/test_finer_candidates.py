"""Members of a bucket that stay unlinked are told apart before they are compared in pairs; tables of a step go after it."""

import os

import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_duplicates import brute_lines, brute_sets, edits
from triplake.llm import line_dedup, ngram_join, shared


def counting(module, monkeypatch, counts):
    """The module's linked() writes the number of pairs that each verify() gets into counts."""
    plain = module.linked

    def linked(postings, fits, verify, *more):
        def counted(pairs):
            counts.append(pairs.count())
            return verify(pairs)

        return plain(postings, fits, counted, *more)

    monkeypatch.setattr(module, "linked", linked)


def test_texts_around_one_text_that_are_not_linked_to_it(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"c{k}" for k in range(200)]
    docs = []
    for k in range(150):
        own = list(base)
        for at in rng.choice(200, 9, replace=False):
            own[at] = f"d{k}x{at}"
        docs.append((k, " ".join(own)))
        if k % 10 == 0:
            docs.append((1_000 + k, " ".join([*own, "end"])))
    counts = []
    counting(ngram_join, monkeypatch, counts)
    out = ngram_join.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(r) for r in out.collect()) == brute_sets(docs)
    # In pairs they would be 13,000.
    assert sum(counts) < 3 * len(docs)


def test_short_lines_that_share_a_word(spark, monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7))
    lines = [" ".join(["common", *(word() for _ in range(4))]) for _ in range(160)]
    docs = [(k, t) for k, t in enumerate(lines)] + [(1_000 + k, t + "x") for k, t in enumerate(lines[:20])]
    counts = []
    counting(line_dedup, monkeypatch, counts)
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc_id): r.text for r in out.collect()} == {i: t for (i, _), t in brute_lines(docs).items()}
    # The first comparison is with centres only.
    assert counts[0] < 10 * len(docs) and sum(counts[1:]) < 10 * len(docs)


def test_letters_rule_out_no_pair_within_the_edits(spark):
    rng = np.random.default_rng(6)
    some = list("eeetaoin shrdzé")
    rows = []
    for _ in range(150):
        a = "".join(rng.choice(some, int(rng.integers(0, 150))))
        b = list(a)
        for _ in range(int(rng.integers(0, 12))):
            at = int(rng.integers(0, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = rng.choice(some, int(rng.integers(0, 2)))
        rows.append((a, "".join(b), edits(a, "".join(b))))
    rows += [("e" * 100, "e" * 70 + "t" * 30, 30), ("zzzz", "eeee", 4)]
    df = spark.createDataFrame(rows, "a string, b string, d int")
    bag = lambda c: F.struct(*(x.alias(f"bag{k}") for k, x in enumerate(line_dedup.letter_counts(F.col(c)))))
    df = df.select("d", bag("a").alias("x"), bag("b").alias("y"))
    assert df.where(line_dedup.letters_near("x", "y", F.col("d"))).count() == len(rows)
    # Unlike lines are ruled out, also where a number is cut.
    assert df.where(F.col("d").isin(30, 4) & line_dedup.letters_near("x", "y", F.lit(1))).where("x.bag0 <> y.bag0 and d = 30").count() == 0


def test_tables_of_a_settled_step_are_deleted(spark):
    folder = shared.shared_folder(spark)
    there = lambda: {x for x in os.listdir(folder.removeprefix("file:")) if x.startswith("table-")}
    before = there() if os.path.isdir(folder.removeprefix("file:")) else set()

    def inner():
        return shared.settled(lambda: shared.stored(spark.range(5))).unionByName(shared.stored(spark.range(5, 9)))

    out = shared.settled(inner)
    assert sorted(r.id for r in out.collect()) == list(range(9))
    assert len(there() - before) == 1
