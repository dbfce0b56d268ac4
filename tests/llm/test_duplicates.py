"""Line de-duplication and the n-gram join against brute force."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash

from triplake.llm import line_dedup, ngram_join
from triplake.llm.graph import components


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (9, 8), (8, 9)]
    want = Groups()
    for a, b in edges:
        want.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: want.find(x) for x in list(want)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def words(line):
    return [w for w in re.split(r"[^\w]|_", line.lower()) if w]


def simhash(ws):
    """The blocks' bits, and the number of words in each."""
    at = [round(64 * i / 5) for i in range(6)]
    own = [[] for _ in range(5)]
    for w in dict.fromkeys(ws):
        h = xxhash.xxh64(w.encode(), seed=42).intdigest()
        own[(h - (1 << 64) * (h >> 63)) % 5].append(h)
    return [sum(1 << i for i in range(at[k], at[k + 1]) if 2 * sum(h >> i & 1 for h in own[k]) > len(own[k])) for k in range(5)], [len(x) for x in own]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(docs):
    """Kept text of each (doc_id, text), by the definition in the operator's docstring."""
    lines = {tuple(ws): simhash(ws) for _, t in docs for line in (t or "").split("\n") if (ws := words(line))}
    groups = Groups()
    for (a, (x, n)), (b, (y, m)) in combinations(lines.items(), 2):
        meet = any(x[i] == y[i] and x[j] == y[j] and all(0 < c[i] + c[j] >= len(set(ws)) // 5 for c, ws in ((n, a), (m, b))) for i, j in combinations(range(5), 2))
        if meet and bin(sum(x) ^ sum(y)).count("1") <= 18:
            s, t = " ".join(a), " ".join(b)
            if edits(s, t) <= int(max(len(s), len(t)) * (1 - 0.8) + 1e-9):
                groups.join(a, b)
    seen, out = set(), {}
    for i, t in sorted(set(docs), key=lambda d: d[0]):
        kept = []
        for line in t.split("\n"):
            ws = tuple(words(line))
            group = groups.find(ws) if ws in groups else ws
            if not ws or group not in seen:
                kept.append(line)
            seen.add(group)
        out[i, t] = "\n".join(kept)
    return out


def test_lines_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog while many other animals watch the scene from a distant hill"
    varied = [base.replace(w, f"{w}x") for w in ("quick", "lazy", "scene", "hill", "other")]
    docs = [(i, f"{v}\nown line of document number {i}\n\n--\nshared footer") for i, v in enumerate([base, *varied, base.upper() + "!"])]
    docs += [(90, "word " * 300 + "end\nshared footer"), (91, "word " * 300 + "End.\n" + base)]
    got = {(r.doc_id, t): r.text for r, (_, t) in zip(line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id").collect(), docs)}
    assert got == brute_lines(docs)
    # Most variants of the line are found.
    assert sum(base.split()[-1] in t.split("\n")[0] for (i, _), t in got.items() if i < 7) <= 4


def test_real_lines_against_brute_force(documents):
    some = documents.orderBy("doc_id").limit(60).select("doc_id", "text")
    docs = [(r.doc_id, r.text) for r in some.collect()]
    got = {(r.doc_id): r.text for r in line_dedup.dedup_lines(some).collect()}
    assert got == {i: t for (i, _), t in brute_lines(docs).items()}


def test_odd_lines(odd, none):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == [*odd.columns, "_lines", "_dropped"] and out.count() == odd.count()
    by = {r.score: r for r in out.collect()}
    assert by[2].text is None and by[3].text == "" and by[5].text == "  \n \n" and by[7].text == "eins zwei\ndrei"
    # A null id comes first; rows that repeat id and text get one result.
    assert by[4].text == "alpha beta gamma delta epsilon zeta" and by[0].text == by[1].text == ""
    assert line_dedup.dedup_lines(none).count() == 0


def brute_sets(docs):
    sets = []
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()))
    groups, lists = Groups(), defaultdict(list)
    for n, (i, s) in enumerate(sets):
        shared = Counter(m for g in s for m in lists[g])
        groups.find(i)
        for g in s:
            lists[g].append(n)
        for m, k in shared.items():
            if 100 * k >= 90 * (len(s) + len(sets[m][1]) - k):
                groups.join(i, sets[m][0])
    return sorted((i, len(s), groups.find(i)) for i, s in sets)


def test_sets_against_brute_force(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    docs += [(10_000 + k, " ".join(w for n, w in enumerate(docs[3][1].split()) if n != 7 * k)) for k in range(40)]
    docs += [(20_000, "A b"), (20_001, "a B"), (20_002, "a"), (20_003, "   "), (20_004, None), (20_005, "")]
    out = ngram_join.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(r) for r in out.collect()) == brute_sets(docs)


def test_near_copies_around_a_common_text_meet_through_it(spark):
    text = [f"w{k}" for k in range(200)]
    docs = [(500, " ".join(text))] + [(k, " ".join("x" if n == k * 7 else w for n, w in enumerate(text))) for k in range(1, 28)]
    out = ngram_join.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.component_id for r in out.collect()} == {1}


def test_odd_sets(odd, none):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_sets(odd).collect()), key=str)
    assert (2, 0, 2) in rows and (3, 0, 3) in rows and (4, 0, 4) in rows and (5, 1, 5) in rows
    # The null id is the smallest, and its text is that of document 1.
    assert rows.count((1, 4, None)) == 2 and (None, 4, None) in rows
    assert ngram_join.similar_sets(none).count() == 0


def test_texts_around_a_hot_passage_are_not_compared_in_pairs(spark):
    """A passage that is a third of 300 unrelated texts, a large group of near copies, and a shingle that all share."""
    passage = " ".join(f"p{k}" for k in range(60))
    docs = [(k, f"{passage} " + " ".join(f"d{k}x{j}" for j in range(120)) + " the last three") for k in range(300)]
    copy = [f"c{j}" for j in range(200)]
    docs += [(1_000 + k, " ".join("x" if j in (k % 190, k // 3) else w for j, w in enumerate(copy)) + " the last three") for k in range(80)]
    out = ngram_join.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(tuple(r) for r in out.collect())
    assert got == brute_sets(docs)
    assert len({c for i, _, c in got if i >= 1_000}) < 5 and len({c for i, _, c in got if i < 1_000}) == 300


def test_short_lists_hold_what_links_need():
    """Of any two sets that reach the similarity, enough members are in both sets' short lists, and one brings them together."""
    rng = np.random.default_rng(7)
    for percent in (80, 90):
        for n in (1, 2, 9, 10, 31, 200, 900):
            base = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
            lists = {int(m): int(rng.integers(1, 9)) for m in base}
            for _ in range(20):
                gone = rng.permutation(n)[: rng.integers(0, n * (100 - percent) // 100 + 1)]
                a, b = base, np.delete(base, gone)
                sides = []
                for s in (a, b):
                    some = ngram_join.leading(s, percent)
                    held = [m for m in some.tolist() if m < ngram_join.counted_below(percent) and (lists[m] > 1 or m in b)]
                    lengths = np.array([max(2, lists[m]) if m in b else lists[m] for m in held], np.int64)
                    sides.append(ngram_join.divided(some, len(s), np.array(held, np.int64), lengths, percent))
                t = -(-percent * (len(a) + len(b)) // (100 + percent))
                if len(b) < t:
                    continue
                spare = min(ngram_join.asked(len(s), percent) - ngram_join.least_shared(len(s), percent) for s in (a, b))
                assert len(np.intersect1d(sides[0][0], sides[1][0])) >= t + spare
                assert len(np.intersect1d(sides[0][1], sides[1][1])) >= 1
