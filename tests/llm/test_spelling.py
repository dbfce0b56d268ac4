"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from triplake.llm import spelling

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(rows):
    n = brute_words(rows)
    words = sorted(n)
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in words)


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    letters = "abcéÿ×"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 8))) for _ in range(60)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "Colour", "color", "colors", "COLOURS", "Éclair", "éclair", "eclair", "eclairs"]
    # Around the length at which words leave the trie, with edits at both ends, in the middle and in runs of one letter.
    long = "abcdefghijklmnopqrstuvwxyzabcdefgh"
    for size in (31, 32, 33, 34):
        w = long[:size]
        words += [w, "x" + w[1:], w[:-1] + "x", w[:15] + "x" + w[16:], w[:14] + "x" + w[15:], w[1:], w[:-1], w + "x", "y" + w, w[:16] + w[17:], "a" * size, "a" * (size + 1)]
    huge = "".join(rng.choice(letters) for _ in range(20_000))
    words += [huge, huge[:9_000] + "b" + huge[9_001:], huge[1:], huge[:9_000] + "c" + huge[9_001:]]
    out = []
    for i in range(150):
        out.append((i, " ".join(rng.choice(words[:-4]) for _ in range(40)) + rng.choice([" ", "1", "_", "\n"])))
    out += [(200 + i, f"{w}-{w} {w}!") for i, w in enumerate(words) for _ in range(rng.choice([1, 1, 1, 5]))]
    # A chain of forms.
    out += [(3000 + k, "chainx " * 3 + "chainxy " * 8 + "chainxyz " * 20 + "chainxyzz " * 45 + "chainz " * 3) for k in range(2)]
    # One text a third of all rows; repeated rows; missing ids and texts.
    out += [(1000 + i, "Colour colours of the copied text") for i in range(150)]
    return out + [(1000, "repeated wordes")] * 4 + [(None, "nullid nullid nullid"), (None, None), (7, None), (8, ""), (9, "1234 - ab abcd")]


def test_variants_against_plain_python(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("word", "n", "way", "w", "node", "at", "form"):
        docs = docs.withColumn(name, F.lit("other"))
    got, want = result(spelling.spelling_variants(docs)), brute(rows)
    assert got == want
    assert sum(r[1] is not None for r in want) > 15 and any(r[2] != r[1] and r[1] is not None for r in want)
    assert sum(len(r[0]) > spelling.DEPTH and r[4] > 0 for r in want) > 20


def test_every_position_of_an_edit(spark):
    """All near words of one word, and some that are two edits away."""
    word = "spelling"
    other = {word[:i] + c + word[i + k :] for i in range(9) for k in (0, 1) for c in ("", "a", "z", "l", "ÿ")} - {word}
    far = {word[2:], "xx" + word[2:], "psellingx"}
    words = spark.createDataFrame([(w,) for w in sorted({word} | other | far)], "word string")
    pairs = {(r.a, r.b) for r in spelling.near_pairs(words).collect()}
    everything = sorted({word} | other | far)
    assert pairs == {(a, b) for a in everything for b in everything if near(a, b)}


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, "no")], "doc_id long, text string")).count() == 0


def test_on_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").where("doc_id < 60").collect()]
    got = result(spelling.spelling_variants(documents.where("doc_id < 60")))
    assert got == brute(rows)
