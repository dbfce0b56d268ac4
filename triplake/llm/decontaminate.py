"""Benchmark decontamination: CGK embedding, bit-sampling LSH over windows of documents, exact edit verification.

A random walk (CGK) copies a string's characters to an output and steps on or waits by a random bit for each output
place and character; small edit distance becomes small Hamming distance. A repetition of the LSH samples places of the
output; equal samples make a candidate. Windows begin at words, in documents and in items alike, and are as long as the
item; sampled places lie in the part of the walk that the shortest items cover, so one walk from a word serves items of
all lengths. An item has a window at each of its words, so an edit spoils only the windows it falls in. How many
repetitions an item takes part in is derived from `target_recall`: as many as find that share of copies of items of its
length with scattered edits at the largest distance allowed (tried on a sample of the block's items).

Items without a window, and lengths that MOST_REPETITIONS do not suffice for, are found by pigeonhole: of one piece
more than the edits allowed, one is left as it is. Every place that holds such a piece is a candidate.

A candidate is verified exactly: the least edit distance between the item and any substring of the document around
it, by a bit-parallel dynamic programme. An edit spoils at most GRAM of an item's runs of GRAM characters and
moves the rest by one, so places that hold too few of them, as far apart as in the item up to the edits allowed, go before. A document holds an item if that distance is at most (1 - similarity) times
the item's length. Texts are compared in lower case with white space collapsed.

Items are searched for in blocks of at most BLOCK: a block's tables have a fixed bound and go to every task; each block
reads the documents once. Defined results: null and empty texts hold nothing; null and empty items are held by nothing;
items too short for an edit (under 5 characters at 0.8) are not found inside longer words; repeated items and documents each give their rows; other
columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIMILARITY = 0.8
TARGET_RECALL = 0.9
MOST_REPETITIONS = 48
STEPS = 40
SAMPLED = 10

#: Sampled places after which windows without a partner so far are given up.
FIRST = (4, 6)

#: Characters of the runs that a candidate's place must share with the item.
GRAM = 3

#: Edited copies tried for each class of lengths, and the width and number of the classes.
TRIED = 100
CLASS = 20
LAST_CLASS = 20

#: Items in a block.
BLOCK = 20_000

#: Characters of documents that are walked at once.
PORTION = 1 << 20


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    """A byte for each code point; a space is 1, and 0 stands between documents."""
    wide = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = ((wide ^ (wide >> 8)) % 254 + 2).astype(np.uint8)
    out[wide == 32] = 1
    return out


def word_starts(c: np.ndarray) -> np.ndarray:
    return np.flatnonzero((c > 1) & (np.concatenate([[1], c[:-1]]) <= 1))


class Walks:
    def __init__(self, repetitions: int = MOST_REPETITIONS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bits = rng.integers(0, 2, (repetitions, STEPS, 256), dtype=np.uint8)
        self._jumps: dict[tuple[int, int], np.ndarray] = {}
        width = STEPS // SAMPLED
        self.places = [[int(k * width + rng.integers(width)) for k in range(SAMPLED)] for _ in range(repetitions)]

    def jump(self, r: int, j: int) -> np.ndarray:
        """Characters that steps j and j + 1 advance, by the pair of characters at the place (first + 256 * second)."""
        if (r, j) not in self._jumps:
            now, then = self.bits[r, j], self.bits[r, j + 1]
            self._jumps[r, j] = np.where(now, 1 + then[:, None], then).ravel().astype(np.uint8)
        return self._jumps[r, j]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_jumps": {}}

    def keys(self, c: np.ndarray, starts: np.ndarray, r: int, hopeful=None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Starts that stay, their keys after each of FIRST, and their keys. c ends with STEPS zeros; hopeful(n, keys so far)
        tells who stays after the n-th of FIRST.

        Two steps at a time, but a sampled place begins anew: its character is the first of the pair at the place.
        """
        pairs = c.astype(np.uint16)
        pairs[:-1] |= pairs[1:] << 8
        at, key = starts.astype(np.int64), np.zeros(len(starts), np.uint64)
        first: list[np.ndarray] = []
        places = self.places[r]
        j = 0
        for n, place in enumerate(places):
            while j < place:
                pair = pairs[at]
                if j + 1 < place:
                    at += self.jump(r, j)[pair]
                    j += 2
                else:
                    at += self.bits[r, j][pair.astype(np.uint8)]
                    j += 1
            pair = pairs[at]
            key = key * np.uint64(0x100000001B3) ^ (pair & np.uint16(255))
            if n + 1 in FIRST:
                first.append(key)
                if hopeful is not None:
                    stays = hopeful(len(first) - 1, key)
                    starts, at, key, pair = starts[stays], at[stays], key[stays], pair[stays]
                    first = [x[stays] for x in first]
            if n + 1 == len(places):
                break
            if places[n + 1] > place + 1:
                at += self.jump(r, place)[pair]
                j = place + 2
            else:
                at += self.bits[r, place][pair.astype(np.uint8)]
                j = place + 1
        return starts, first, key


def infix_distance(item: str, text: str, most: int) -> tuple[int, int]:
    """The least edit distance of item to a substring of text, and where that ends; (most + 1, -1) if it is larger."""
    peq = dict.fromkeys(text, 0)
    for i, ch in enumerate(item):
        peq[ch] = peq.get(ch, 0) | (1 << i)
    m = len(item)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = (m, 0) if m <= most else (most + 1, -1)
    for j, eq in enumerate(map(peq.__getitem__, text)):
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = mh | (~(xv | ph) & mask)
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def scattered(text: str, edits: int, rng: np.random.Generator) -> str:
    """text with so many characters replaced, left out or put in at scattered places."""
    out = list(text)
    for at in sorted(rng.choice(len(out), edits, replace=False).tolist(), reverse=True):
        kind, other = rng.integers(3), text[rng.integers(len(text))]
        out[at : at + 1] = [[other], [], [other, out[at]]][kind]
    return normal("".join(out))


def windows(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' codes in a row, and number, place in the text and place in the row of windows with `least` characters."""
    pad = np.zeros(STEPS, np.uint8)
    owner, offset, parts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
    begins = [np.zeros(0, np.int64)]
    for k, text in enumerate(texts):
        c = codes(text)
        starts = word_starts(c)
        starts = starts[starts <= len(c) - least]
        owner.append(np.full(len(starts), k))
        offset.append(starts)
        begins.append(starts + at)
        parts += [c, pad]
        at += len(c) + STEPS
    return np.concatenate([*parts, pad]), np.concatenate(owner), np.concatenate(offset), np.concatenate(begins)


def needed(walks: Walks, texts: list[str], similarity: float, target_recall: float) -> int:
    """Repetitions that find target_recall of edited copies of texts; one more than there are if all are too few."""
    rng = np.random.default_rng(11)
    tried = [texts[k % len(texts)] for k in range(TRIED)]
    edited = [scattered(t, int((1 - similarity) * len(t) + 1e-9), rng) for t in tried]
    whole, owner, _, begins = windows(tried, STEPS)
    other, other_owner, _, other_begins = windows(edited, 1)
    hit = np.zeros(TRIED, bool)
    mixed = lambda key, n: key ^ (n.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(len(walks.places)):
        mine = mixed(walks.keys(whole, begins, r)[2], owner)
        hit[other_owner[np.isin(mixed(walks.keys(other, other_begins, r)[2], other_owner), mine)]] = True
        if hit.mean() >= target_recall:
            return r + 1
    return len(walks.places) + 1


class Items:
    """A block of items, ready to be searched for."""

    def __init__(self, ids: list, texts: list[str], similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL):
        self.similarity, self.walks = similarity, Walks()
        self.items = [(i, n) for i, n in ((i, normal(t)) for i, t in zip(ids, texts, strict=True)) if n]
        whole, self.owner, self.offset, starts = windows([t for _, t in self.items], STEPS)
        classes: dict[int, list[int]] = {}
        for k in np.unique(self.owner).tolist():
            classes.setdefault(min(len(self.items[k][1]) // CLASS, LAST_CLASS), []).append(k)
        #: Repetitions of each item; 0 for those found by pigeonhole.
        self.repetitions = np.zeros(len(self.items), np.int64)
        for members in classes.values():
            n = needed(self.walks, [self.items[k][1] for k in members], similarity, target_recall)
            self.repetitions[members] = n if n <= MOST_REPETITIONS else 0
        self.tables = []
        for r in range(int(self.repetitions.max(initial=0))):
            own = np.flatnonzero(self.repetitions[self.owner] > r)
            _, first, key = self.walks.keys(whole, starts[own], r)
            bits = min(22, max(12, (64 * len(key)).bit_length()))
            early, late = np.zeros((len(FIRST), 1 << bits), bool), np.zeros(1 << bits, bool)
            for n, keys in enumerate(first):
                early[n, self._short(keys, bits)] = True
            late[self._short(key, bits)] = True
            order = np.argsort(key, kind="stable")
            self.tables.append((bits, early, late, key[order], own[order]))
        self._pieces()
        #: Each item's distinct runs, sorted, where each begins in the list of their places, how often it occurs, and that list.
        runs = [self._grams(codes(t), GRAM) for _, t in self.items]
        self.runs = []
        for x in runs:
            places = np.argsort(x, kind="stable")
            own, firsts, times = np.unique(x[places], return_index=True, return_counts=True)
            self.runs.append((own, firsts, times, places))
        self.least = [len(x) - GRAM * self._most(k) for k, x in enumerate(runs)]

    def _pieces(self) -> None:
        """For each length of pieces: a table of their hashes, the sorted pieces, their items and their places there."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k in np.flatnonzero(self.repetitions == 0).tolist():
            c = codes(self.items[k][1])
            n = min(len(c), self._most(k) + 1)
            width = len(c) // n
            size = min(width, 8)
            grams = self._grams(c, size)
            found.setdefault(size, []).extend((int(grams[j * width]), k, j * width) for j in range(n))
        self.pieces = {}
        for size, rows in found.items():
            rows.sort()
            key = np.array([x for x, _, _ in rows], dtype=np.uint64)
            table = np.zeros(1 << 20, bool)
            table[self._short(key, 20)] = True
            self.pieces[size] = (table, key, np.array([k for _, k, _ in rows]), np.array([at for _, _, at in rows]))

    @staticmethod
    def _grams(c: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(max(0, len(c) - size + 1), np.uint64)
        for j in range(size):
            out = (out << np.uint64(8)) | c[j : j + len(out)]
        return out

    @staticmethod
    def _short(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _most(self, item: int) -> int:
        return int((1 - self.similarity) * len(self.items[item][1]) + 1e-9)

    def candidates(self, c: np.ndarray) -> list[tuple[int, int]]:
        """(item, about where in c it would begin) of items of which a window or a piece is found there."""
        starts = word_starts(c)
        found = []

        def partners(own, key, keys):
            low = np.searchsorted(keys, key, "left")
            times = np.searchsorted(keys, key, "right") - low
            return np.repeat(own, times), np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())

        for r, (bits, early, late, keys, order) in enumerate(self.tables):
            own, _, key = self.walks.keys(c, starts, r, lambda n, first, early=early, bits=bits: early[n, self._short(first, bits)])
            likely = late[self._short(key, bits)]
            at, n = partners(own[likely], key[likely], keys)
            found.append(np.stack([self.owner[order[n]], (at - self.offset[order[n]]) // 32]))
        for size, (table, keys, owner, offset) in self.pieces.items():
            grams = self._grams(c, size)
            own = np.flatnonzero(table[self._short(grams, 20)])
            at, n = partners(own, grams[own], keys)
            found.append(np.stack([owner[n], (at - offset[n]) // 32]))
        if not found:
            return []
        return [(int(i), int(at) * 32) for i, at in np.unique(np.concatenate(found, axis=1), axis=1).T]

    def search(self, texts: list[str | None]) -> list[dict[int, tuple[int, int]]]:
        """For each text {item: (distance, end of the match in the normalised text)}."""
        normed = [normal(t) for t in texts]
        out: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        pad = np.zeros(STEPS, np.uint8)
        group, size = [], 0
        for k, t in enumerate(normed):
            group.append(k)
            size += len(t)
            if size < PORTION and k + 1 < len(normed):
                continue
            parts = [codes(normed[g]) for g in group]
            begins = np.cumsum([0, *(len(p) + STEPS for p in parts)])
            whole = np.concatenate([x for p in parts for x in (p, pad)])
            runs = self._grams(whole, GRAM)
            for item, at in self.candidates(whole):
                # The place is one of 32; near the edge of a text both texts come into question.
                for n in range(int(np.searchsorted(begins, max(at, 0), side="right")) - 1, int(np.searchsorted(begins, at + 31, side="right"))):
                    if 0 <= n < len(group):
                        self._verify(item, normed[group[n]], runs[begins[n] :], at - int(begins[n]), out[group[n]])
            group, size = [], 0
        return out

    def _verify(self, item: int, text: str, runs: np.ndarray, at: int, found: dict[int, tuple[int, int]]) -> None:
        wanted = self.items[item][1]
        most = self._most(item)
        if item in found and found[item][0] == 0:
            return
        low = max(0, at - most)
        near = text[low : max(0, at + 32 + len(wanted) + most)]
        place = near.find(wanted)
        if not most:  # too short for an edit: not inside a longer word
            beside = lambda n: 0 <= n < len(text) and text[n].isalnum()
            while place >= 0 and (beside(low + place - 1) or beside(low + place + len(wanted))):
                place = near.find(wanted, place + 1)
            if place < 0:
                return
        if place < 0 and self.least[item] > 0 and not self._alike(item, runs[low : low + max(0, len(near) - GRAM + 1)]):
            return
        distance, end = (0, place + len(wanted)) if place >= 0 else infix_distance(wanted, near, most)
        if distance <= most and (item not in found or distance < found[item][0]):
            found[item] = (distance, low + end)


    def _alike(self, item: int, near: np.ndarray) -> bool:
        """Whether so many of the item's runs are among near, the runs of a part of a text, as a match holds.

        From one run that a match leaves as it is to another, the places in item and text drift apart by no more than the
        edits allowed, so all of them are in one band of drifts. Drifts are told by thirds of the edits allowed.
        """
        own, firsts, times, places = self.runs[item]
        most = self._most(item)
        n = np.minimum(np.searchsorted(own, near), len(own) - 1)
        at = np.flatnonzero(own[n] == near)
        if len(at) == 0:
            return False
        n = n[at]
        often = times[n]
        ends = np.cumsum(often)
        place = places[np.repeat(firsts[n] - ends + often, often) + np.arange(ends[-1])]
        width = max(1, most // 3)
        drift = (np.repeat(at, often) - place + len(places)) // width
        drift -= drift.min()
        band = -(-most // width) + 1
        held = np.zeros((max(int(drift.max()) + 1, band), len(places)), bool)
        held[drift, place] = True
        joined = 1
        while joined < band:
            step = min(joined, band - joined)
            held = held[:-step] | held[step:]
            joined += step
        return int(held.sum(axis=1).max()) >= self.least[item]


def blocks(items: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> Iterator[Items]:
    """The items (item_id, text), BLOCK at a time."""
    ids, texts = [], []
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        if len(ids) == BLOCK:
            yield Items(ids, texts, similarity, target_recall)
            ids, texts = [], []
    if ids:
        yield Items(ids, texts, similarity, target_recall)


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, item_id, distance, similarity, end: each item a document holds, with its best match."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, similarity double, end int"
    out = spark.createDataFrame([], schema)
    for block in blocks(items, similarity, target_recall):
        shared = spark.sparkContext.broadcast(block)

        def found(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own = shared.value
            for b in batches:
                rows = [(d, own.items[k][0], n, 1 - n / len(own.items[k][1]), end) for d, hits in zip(b.doc_id, own.search(b.text.tolist()), strict=True) for k, (n, end) in hits.items()]
                t = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "similarity", "end"])
                yield t.astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(docs.select("doc_id", "text").mapInPandas(found, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> DataFrame:
    """The documents that hold no item."""
    spark = docs.sparkSession
    for block in blocks(items, similarity, target_recall):
        shared = spark.sparkContext.broadcast(block)

        docs = docs.withColumn("_holds", _holds(shared)("text")).where("NOT _holds").drop("_holds")
    return docs


def _holds(shared):
    """Whether a text holds an item of the broadcast block."""

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([bool(x) for x in shared.value.search(texts.tolist())], dtype=bool)

    # So the optimizer leaves it where it stands, once for each text.
    return holds.asNondeterministic()
