"""Spelling variants: words one edit apart, found by walking a relational trie level by level.

Words are runs of Latin letters (RUN), lower-cased (A-Z only); near words differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of largest n, if that is at least RATIO times its own n; its root is where
following forms ends.

The trie is a table of edges: parent node, letter, child node. A node is the beginning that it stands for. States (word,
position, node, edits) are rows. A word without edits walks its own path, so those states need no table: the first join
takes every word at every position to the edges of its node and makes there the states of one edit, by a replaced letter
(another edge, one letter on) or by a skipped letter (the edge of the letter after it). From then on a state has one edge to
take, that of its next letter; each round joins all states with the edges, and a state that ends its word on a node that
is a word is a pair of near words. An inserted letter is a skipped one seen from the longer word, and of two words that
differ in a letter one has the smaller letter, so each pair is met once.

The beginnings of words are crowded: every word passes the root. An edit lies in the second half of a word or, read
backwards, in the second half again. So there are two tries, of words and of reversed words, each walked with edits in the
second half alone, where nodes have few edges and no key is common to many words. Each edge also tells by a 64-bit
signature what endings follow below it, which stops most states that lead nowhere before they are written.

Words longer than DEPTH would need as many levels. They are found without a trie, and exactly: two of them are near only if
they have the same rest after a letter is taken out of one or both; rests have rolling hashes, made in one pass over a
word, and candidates are verified by edit distance. Words that share the rest after one place are at most as many as
letters, so no group of candidates grows.

Defined results: a null text has no words; a null doc_id counts as an empty text in the hash that deletes letters; rows that
repeat count again; ties go to the smallest word in code-point order; an empty table gives an empty result. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.shared import BROADCAST_ROWS, stored

SHORTEST = 5
LEAST = 3
RATIO = 2

#: One run in so many loses a letter.
DAMAGED = 97

#: Letters up to which a word is walked; longer ones have their own path.
DEPTH = 32

#: Distinct words that a task counts in memory.
FLUSH = 400_000

RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def damaged(doc_id: int | None, runs: Counter) -> Iterator[tuple[str, int]]:
    """The runs of a document with their numbers, some without a letter, as crc32 of id and run tells."""
    start = zlib.crc32(("" if doc_id is None else f"{doc_id}").encode() + b":")
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        yield run, n


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """word, n of every word of docs(doc_id, text) with n >= least."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(total), "n": list(total.values())})
            total.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.doc_id, b.text, strict=True):
                if text:
                    # A run of fewer letters can't become a word, and a longer one is taken whole.
                    runs = Counter(RUN.findall(text.encode("utf-8", "replace").lower().decode()))
                    for word, n in damaged(doc_id, runs):
                        total[word] += n
                    if len(total) > FLUSH:
                        yield flush()
        if total:
            yield flush()

    # Ids as text, so that a null id doesn't turn the others into floating-point numbers.
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(counted, "word string, n long")
    return stored(found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def ending_bit(rest: Column) -> Column:
    """The bit of an ending in a signature: the last bit for none left, one of the others by hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.when(rest == "", 63).otherwise(F.pmod(F.xxhash64(rest), F.lit(63)).cast("int")))


def both_ways(words: DataFrame) -> DataFrame:
    """way ('>' or '<'), w (the word as it is walked), size, first (position where edits begin)."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    there = words.select(F.lit(">").alias("way"), F.col("word").alias("w"), size.alias("size"), half.alias("first"))
    back = words.select(F.lit("<").alias("way"), F.reverse("word").alias("w"), size.alias("size"), (size - half).alias("first"))
    return there.unionByName(back)


def _beginning(n: Column) -> Column:
    return F.concat("way", F.substr(F.col("w"), F.lit(1), n))


def _letter(at: Column) -> Column:
    return F.substr(F.col("w"), at + 1, F.lit(1))


def _rest(at: Column) -> Column:
    return F.substr(F.col("w"), at + 1)


def edge_table(walked: DataFrame) -> DataFrame:
    """parent, letter, follows: edges of the two tries from the depth at which edits can begin; follows: endings below."""
    i = F.col("i")
    # No word begins its edits before half of the shortest one.
    rows = walked.select("way", "w", F.explode(F.sequence(F.lit(SHORTEST // 2), F.col("size") - 1)).alias("i"))
    rows = rows.select(_beginning(i).alias("parent"), _letter(i).alias("letter"), ending_bit(_rest(i + 1)).alias("bit"))
    return stored(rows.groupBy("parent", "letter").agg(F.bit_or("bit").alias("follows")))


def _state(at: Column) -> Column:
    """A state behind the edge that a row has taken; its word's next letter is at position `at`."""
    return F.struct(at.alias("at"), F.concat("parent", "letter").alias("node"))


def first_states(walked: DataFrame, edges: DataFrame) -> DataFrame:
    """way, w, at, node of all states right after their edit."""
    i = F.col("i")
    rows = walked.select("way", "w", "size", F.explode(F.sequence("first", F.col("size") - 1)).alias("i"))
    rows = rows.select("way", "w", "size", "i", _beginning(i).alias("parent"), _letter(i).alias("own"), _letter(i + 1).alias("next"), ending_bit(_rest(i + 1)).alias("b1"), ending_bit(_rest(i + 2)).alias("b2"))
    met = rows.join(edges, "parent")
    replaced = F.when((F.col("letter") > F.col("own")) & (F.col("follows").bitwiseAND(F.col("b1")) != 0), _state(i + 1))
    skipped = F.when((F.col("letter") == F.col("next")) & (i + 1 < F.col("size")) & (F.col("follows").bitwiseAND(F.col("b2")) != 0), _state(i + 2))
    states = met.select("way", "w", F.explode(F.array_compact(F.array(replaced, skipped))).alias("s"))
    return states.select("way", "w", "s.at", "s.node")


def trie_pairs(words: DataFrame) -> DataFrame:
    """a, b: near words of at most DEPTH letters; each pair once or twice."""
    walked = both_ways(words.select("word"))
    edges = edge_table(walked)
    states = stored(first_states(walked, edges))
    # A last letter skipped leaves the node before it, without an edge to take.
    cut = walked.select("w", "way", _beginning(F.col("size") - 1).alias("node"), F.col("size").alias("at"))
    ended = [cut.join(walked.select(F.concat("way", "w").alias("node")), "node").select("way", "w", "node")]
    over = F.col("at") >= F.length("w")
    while True:
        # The bit of no ending is exact: such a node is a word.
        ended.append(states.where(over).select("way", "w", "node"))
        open_states = states.where(~over)
        left = open_states.count()
        if not left:
            break
        at = F.col("at")
        moving = open_states.select("way", "w", "at", F.col("node").alias("parent"), _letter(at).alias("letter"), ending_bit(_rest(at + 1)).alias("bit"))
        if left <= BROADCAST_ROWS:
            moving = F.broadcast(moving)
        moved = edges.join(moving, ["parent", "letter"]).where(F.col("follows").bitwiseAND(F.col("bit")) != 0)
        states = stored(moved.select("way", "w", (at + 1).alias("at"), F.concat("parent", "letter").alias("node")))
    found = ended[0]
    for part in ended[1:]:
        found = found.unionByName(part)
    read = lambda text: F.when(F.col("way") == "<", F.reverse(text)).otherwise(text)
    return found.select(read(F.col("w")).alias("a"), read(F.substr(F.col("node"), F.lit(2))).alias("b"))


def rests(word: str) -> tuple[int, np.ndarray]:
    """Rolling hash of the word, and those of it without each of its letters."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    power = np.full(len(letters), _BASE, np.uint64)
    power[0] = 1
    sums = np.append(np.uint64(0), np.cumsum(letters * np.cumprod(power, dtype=np.uint64), dtype=np.uint64))
    return int(sums[-1]), sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE)


def long_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """a, b: near words of which one has more than depth letters; each pair once or twice."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for word_id, word in zip(b.id, b.word, strict=True):
                whole, without = rests(word)
                key = np.append(without, np.uint64(whole)).view(np.int64)
                for lo in range(0, len(key), 50_000):
                    part = key[lo : lo + 50_000]
                    at = np.arange(lo, lo + len(part))
                    # A place is told with the word's number of letters; the whole word has none.
                    yield pd.DataFrame({"id": word_id, "rest": part, "size": len(word) - 1 + (at == len(word)), "at": np.where(at == len(word), -1, at)})

    long = words.select(F.xxhash64("word").alias("id"), "word").where(F.length("word") >= depth)
    keys = stored(long.mapInPandas(hashed, "id long, rest long, size int, at int"))
    other = keys.select(F.col("id").alias("id2"), "rest", "size", F.col("at").alias("at2"))
    same = (F.col("at") == F.col("at2")) & (F.col("at") >= 0) & (F.col("id") != F.col("id2"))
    met = keys.join(other, ["rest", "size"]).where(same | ((F.col("at") >= 0) & (F.col("at2") < 0))).select("id", "id2").distinct()
    pairs = met.join(long.withColumnRenamed("word", "a"), "id").join(long.select(F.col("id").alias("id2"), F.col("word").alias("b")), "id2")
    near = F.call_function("levenshtein", F.col("a"), F.col("b"), F.lit(1)) == 1
    return pairs.where(near & (F.greatest(F.length("a"), F.length("b")) > depth)).select("a", "b")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: every two near words, both ways, each once."""
    pairs = trie_pairs(words.where(F.length("word") <= DEPTH)).unionByName(long_pairs(words))
    return stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word of forms(word, form): pointers doubled until none moves. n grows along forms, so none circles."""
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        found = joined.select("word", "root")
        if not joined.where("moved").limit(1).count():
            return found


def spelling_variants(docs: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs(doc_id, text)."""
    words = word_counts(docs, least)
    near = near_pairs(words).join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), "b")).alias("m"))
    told = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(-F.col("m.n") >= F.lit(ratio) * F.col("n"), F.col("m.b")).alias("form"), (-F.col("m.n")).alias("m_n"))
    told = stored(told.select("word", "n", "n_near", "form", F.when(F.col("form").isNotNull(), F.col("m_n")).alias("form_n")))
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
