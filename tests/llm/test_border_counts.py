"""The border is counted by hash first, and only what may be frequent is counted by its text."""

import random
from collections import Counter

import numpy as np

from triplake.llm import collocations as mining


def test_only_likely_phrases_are_spelled_and_no_frequent_one_is_lost(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(60)) + " x y z." * (i % 3) for i in range(300)]
    docs = spark.createDataFrame([("en" if i % 4 else "de", t) for i, t in enumerate(texts)], "lang string, text string").repartition(7)
    full = mining.Proposals(np.full(mining.BITS // 8, 255, np.uint8))
    for least in (30, 300):
        likely = mining.likely_frequent(docs, range(1, 4), full, least)
        got = {(r.lang, r.phrase): r.n for r in mining.count_phrases(docs, range(1, 4), full, likely).where("words > 0").collect()}
        want = Counter()
        for i, t in enumerate(texts):
            for piece in t.split("."):
                w = piece.split()
                want.update(("en" if i % 4 else "de", " ".join(w[j : j + k])) for k in (1, 2, 3) for j in range(len(w) - k + 1))
        frequent = {g: n for g, n in want.items() if n >= least}
        assert frequent.items() <= got.items() and len(got) <= len(frequent) + 5 < len(want) / 10
