"""Phrase mining against plain Python."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from triplake.llm import collocations as mining

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def brute_counts(rows, longest):
    """Counter of (lang, words) and Counter of all words by lang."""
    grams, totals = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                grams.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return grams, totals


def brute(rows, least, longest=5, top=2000):
    grams, totals = brute_counts(rows, longest)
    frequent = {g: f for g, f in grams.items() if f >= least}
    found = {}
    for (lang, w), a in frequent.items():
        if len(w) > 1:
            cuts = [(1000 * a * totals[lang] // (grams[lang, w[:k]] * grams[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((w, a, grams[lang, w[:k]], grams[lang, w[k:]], totals[lang], score))
    inside = {(lang, w[i : i + m]) for (lang, w), f in frequent.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if grams[lang, w[i : i + m]] <= f}
    out = []
    for lang, phrases in found.items():
        left = [p for p in phrases if (lang, p[0]) not in inside]
        left.sort(key=lambda p: (-p[5], -p[1], " ".join(p[0]).encode()))
        out += [(lang, n, " ".join(p[0]), *p[1:]) for n, p in enumerate(left[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{n}" for n in range(60)] + ["É", "naïve", " ", "\U0001f600"]
    said = ["in the middle of", "In  THE\tmiddle", "a b c d e f g", "a a a a", "x, y", "new york\rcity"]
    out = []
    for i in range(240):
        parts = [rng.choice(said) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(40))]
        out.append((i, rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", "  ", ". ", "\n", " ", "\t"]) for p in parts)))
    # One copied text makes up a third of all rows; ids repeat and are missing.
    out += [(1000 + i, "en", "of all the hot copies this one is said most, in the middle of it all") for i in range(120)]
    return out + [(1000, "en", "repeat me repeat me"), (1000, "en", "repeat me repeat me"), (None, "en", None), (None, None, ""), (5, "en", " \t .,\n"), (6, "fr", "long " * 30_000), (7, "fr", "x" * 50_000)]


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_collocations_against_plain_python(spark, rows):
    assert result(mining.collocations(frame(spark, rows), least=6)) == brute(rows, 6)
    assert result(mining.collocations(frame(spark, rows), least=20, longest=3, top=3)) == brute(rows, 20, 3, 3)


def test_a_sample_that_knows_nothing_costs_passes_only(spark, rows):
    """No document is in the sample: every frequent word fails, then every pair, and so on until the border is closed."""
    told = []
    found = mining.frequent_phrases(frame(spark, rows), least=6, sample=10**9, passes=told.append)
    grams, totals = brute_counts(rows, 5)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.where("words > 0").collect()}
    assert got == {g: f for g, f in grams.items() if f >= 6}
    assert {r.lang: r.n for r in found.where("words = 0").collect()} == dict(totals)
    assert len(told) == 5 and told[-1] == 0 and all(told[:-1])


def test_a_filter_that_is_full_costs_counts_only(spark, rows, monkeypatch):
    """With every bit set the filter lets all through: everything is counted once, in the first pass."""
    full = mining.Proposals(np.full(mining.BITS // 8, 255, np.uint8))
    got = {(r.lang, r.phrase): r.n for r in mining.count_phrases(frame(spark, rows).withColumn("lang", F.coalesce("lang", F.lit("und"))), range(1, 6), full).where("words > 0").collect()}
    grams, _ = brute_counts(rows, 5)
    assert got == {(lang, " ".join(w)): f for (lang, w), f in grams.items()}


def test_small_flushes_change_nothing(rows):
    """Words of a part, in order and by number, whatever is in between."""
    for _, _, text in rows[-10:] + rows[:20]:
        part = mining.Part()
        part.add(text)
        ids, words = part.words()
        words = [w.as_py().decode() for w in words]
        pieces = re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(str.maketrans(UPPER, LOWER)))
        told = [w for piece in pieces for w in [*re.findall("[^\x20\x09]+", piece), None]]
        assert [words[i] if i >= 0 else None for i in ids] == told


def test_hashes_of_phrases_are_those_of_tasks(rows):
    part = mining.Part()
    for _, _, text in rows:
        part.add(text)
    among = mining.Proposals(np.full(mining.BITS // 8, 255, np.uint8))
    phrases = [p.as_py().decode() for k, ps, _ in mining.bordering(part, "en", range(1, 4), among) if k for p in ps][:5000]
    hashes = mining.phrase_hashes(pd.Series(["en"] * len(phrases)), pd.Series(phrases))
    some = mining.Proposals()
    for places in mining.Proposals.places(hashes[::2]):
        for p in places:
            some.bits[int(p) >> 3] |= 1 << (int(p) & 7)
    assert some.holds(hashes[::2]).all() and not some.holds(hashes[1::2]).any()


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r, n = 9 * 10**11, 10**12 - 1, 10**12 - 3, 10**13 + 7  # noqa: E741
    found = spark.createDataFrame([("en", 0, "", n), ("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], mining.COUNTS)
    row = mining.scored(found).first()
    assert row.score == 1000 * a * n // (l * r) and (row.a, row.l, row.r, row.n) == (a, l, r, n)
    # A quotient just below a whole number is not rounded up.
    found = spark.createDataFrame([("en", 0, "", 10**10), ("en", 1, "x", 10**12 + 1), ("en", 1, "y", 10**10), ("en", 2, "x y", 10**9)], mining.COUNTS)
    assert mining.scored(found).first().score == 0 == Decimal(10**22) // Decimal((10**12 + 1) * 10**10)


def test_empty_table_and_clashing_columns(spark, rows):
    none = frame(spark, [])
    assert mining.collocations(none).count() == 0
    docs = frame(spark, rows[:100])
    for name in ("words", "phrase", "n", "a", "l", "r", "score", "rank", "_share", "k"):
        docs = docs.withColumn(name, F.lit(1))
    assert result(mining.collocations(docs, least=6)) == brute(rows[:100], 6)
