"""Benchmark items with scattered character edits, and short items beside punctuation."""

import random

from tests.llm.test_texts import sellers
from triplake.llm.decontaminate import Items, leaks


def edited(text, edits, rng):
    out = list(text)
    for at in sorted(rng.sample(range(len(out)), edits), reverse=True):
        other = rng.choice("etaoinshrdlu")
        out[at : at + 1] = rng.choice([[other], [], [other, out[at]]])
    return "".join(out)


def test_scattered_edits_are_found_to_the_target():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8)))
    # The first items have 45 to 130 characters, the others up to 350.
    items = [" ".join(word() for _ in range(rng.randint(*((8, 20) if k % 2 else (21, 55))))) for k in range(80)]
    block = Items(list(range(80)), items)
    for share in (0.15, 0.19):
        texts, want = [], []
        for k, item in enumerate(items):
            texts.append(" ".join(word() for _ in range(40)) + " " + edited(item, int(share * len(item)), rng) + " " + " ".join(word() for _ in range(40)))
            if sellers(item, texts[-1]) <= int(0.2 * len(item) + 1e-9):
                want.append(k)
        found = block.search(texts)
        short = [k for k in want if k % 2]
        assert len(want) > 70 and all(d == sellers(items[k], texts[n]) or d <= 0.2 * len(items[k]) for n, hits in enumerate(found) for k, (d, _) in hits.items())
        assert sum(k in found[k] for k in want) >= 0.9 * len(want) and sum(k in found[k] for k in short) >= 0.85 * len(short)


def test_short_items_are_found_beside_punctuation_and_with_edits(spark):
    items = [(1, "the quick brown fox"), (2, "pi"), (3, "what is a monad"), (4, "jumps over it all")]
    docs = [(1, 'He said: "The quick brown fox!" and left'), (2, "(pi) is a number"), (3, "a pile of things"), (4, "So what is e monaad, then"), (5, "jumps, over it al."), (6, "nothing of that sort")]
    got = {(r.doc_id, r.item_id): r.distance for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1): 0, (2, 2): 0, (4, 3): 2, (5, 4): 2}
