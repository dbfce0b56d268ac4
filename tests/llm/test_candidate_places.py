"""Walks by pairs of characters, and places that are left out before the edit distance."""

import random

import numpy as np

from triplake.llm import decontaminate
from triplake.llm.decontaminate import STEPS, Items, Walks, codes, infix_distance, normal, word_starts

LETTERS = "etaoinshrdlucmfwypvb"


def test_walks_by_pairs_are_walks_step_by_step():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices(LETTERS + "é漢", k=rng.randint(1, 9))) for _ in range(500))
    c = np.concatenate([codes(text), np.zeros(STEPS, np.uint8)])
    walks = Walks(12)
    for r in range(12):
        at, want = word_starts(c), np.zeros(len(word_starts(c)), np.uint64)
        for j in range(walks.places[r][-1] + 1):
            if j in walks.places[r]:
                want = want * np.uint64(0x100000001B3) ^ c[at]
            at = at + walks.bits[r, j][c[at]]
        starts, first, key = walks.keys(c, word_starts(c), r)
        assert (key == want).all() and (starts == word_starts(c)).all() and len(first) == len(decontaminate.FIRST)


def test_no_place_within_the_limit_is_left_out(monkeypatch):
    rng = random.Random(8)
    some = lambda n: " ".join("".join(rng.choices(LETTERS, k=rng.randint(1, 8))) for _ in range(n))
    texts = [normal(some(rng.randint(3, 60))) for _ in range(40)]
    block = Items(list(range(40)), texts)
    tried = 0
    for k, text in enumerate(texts):
        most = block._most(k)
        for share in (0.5, 0.8, 1.0):
            out = list(text)
            # Edits together at one place as well as scattered ones.
            places = sorted(rng.sample(range(len(out)), int(share * most)), reverse=True)
            together = rng.randrange(len(out))
            for at in places if rng.random() < 0.7 else [min(together, len(out) - 1)] * len(places):
                at = min(at, len(out) - 1)
                out[at : at + 1] = rng.choice([["x"], [], ["y", out[at]]])
            near = some(rng.randint(0, 9)) + "".join(out) + some(rng.randint(0, 9))
            if infix_distance(text, near, most)[0] <= most and block.least[k] > 0:
                tried += 1
                assert block._alike(k, block._grams(codes(near), 3))
    assert tried > 80
    # Other texts with the same beginnings need few exact distances.
    called = []
    monkeypatch.setattr(decontaminate, "infix_distance", lambda *a: called.append(1) or infix_distance(*a))
    long = [k for k, t in enumerate(texts) if len(t) > 100]
    assert block.search([texts[k][:60] + " " + some(60) for k in long]) == [{} for _ in long]
    assert len(called) <= len(long) // 4
