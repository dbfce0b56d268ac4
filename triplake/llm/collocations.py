"""Phrase collocation mining as by Toivonen: a sample proposes, one full pass counts proposals and their negative border.

Texts are lower-cased (A-Z only) and cut into pieces at PIECE_ENDS and into words at spaces and tabs. f(phrase) is the number of
its contiguous occurrences within pieces, per language. All phrases of up to LONGEST words with f >= least are wanted.

1. A sample of documents (one in SAMPLE, by a hash) is counted: words, then pairs of frequent words, then longer phrases
   all of whose pairs are frequent. A lower limit than the sample's share of `least` makes a phrase a proposal.
2. The full pass counts, exactly, every phrase whose first and last words less one are both proposed: these are the proposals
   themselves and their negative border, so far as it occurs at all. Most of the border occurs a few times, so it is counted
   by hash first; only phrases whose hash reaches `least` are spelled out and counted by their text.
3. A phrase of the border that turns out frequent is a failure of the sample: its extensions were not counted. A further pass
   counts every occurring phrase one word longer whose two halves (all but its last, all but its first word) are frequent and
   one of them a failure; those of them that are frequent are failures again. Passes go on until there is no failure; then
   every frequent phrase has been counted, whatever the sample was. The sample changes the work, never the result.

Tasks count their own texts first: words become numbers, a phrase of k words is the pair (number of its first k - 1 words,
last word), so numpy counts pairs of integers without any collision, and only distinct phrases leave a task. Spark adds up
counts by the phrase's text; in the count by hash, by the 42 upper bits of its hash, which leave a task as sorted 32-bit
numbers, a row for each of GROUPS shares of the hashes. Phrases that share these bits are counted together there, so none
is lost. Proposals reach the tasks as one bit set of a fixed 8 MiB, filled by their hashes: a false
positive counts a phrase in vain, and with very many proposals the filter lets more through, never less.

Memory of a task is bounded by FLUSH characters (and by the longest text); no language or phrase gathers in one task, and the
first rows of a language are chosen in two steps over SALTS shares.

Defined results: a null text is empty; a null lang is `und`; rows that repeat are counted as often as they are there; ties are
broken by the phrase's bytes; an empty table gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.llm.shared import stored

LEAST = 100
LONGEST = 5
TOP = 2000

#: One document in so many is in the sample; a proposal occurs there at least this share of its expected number.
SAMPLE = 8
LOWERED = 0.6

#: Bytes of text whose words a task counts at a time.
FLUSH = 14 << 20

#: Bits of the proposals' set and hashes of each.
BITS = 1 << 26
HASHES = 4
_SHIFT = np.uint64(64 - (BITS.bit_length() - 1))

#: Shares of the hashes, by their first bits, in which a task's counts leave it; the next 32 bits tell the hashes of a share apart.
GROUPS = 1 << 10
_GROUP_SHIFT = np.uint64(64 - (GROUPS.bit_length() - 1))
_REST_SHIFT = _GROUP_SHIFT - np.uint64(32)

#: Shares of a language in which its first rows are chosen before they are chosen of all.
SALTS = 64

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_PIECES = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")
_BREAK = -1

COUNTS = "lang string, words int, phrase string, n long"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _extended(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase without its last word, and that word's."""
    return _mixed(h * np.uint64(0xBF58476D1CE4E5B9) + last)


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace"))


def word_hashes(words: pa.Array, seed: int | np.ndarray) -> np.ndarray:
    """64-bit hashes of words (large_binary), by powers of a fixed number over their bytes. Only a filter relies on them."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].astype(np.uint64) + np.uint64(1)
    sizes = np.diff(at)
    power = np.ones(max(int(sizes.max(initial=0)), 1), np.uint64)
    power[1:] = np.uint64(0x9E3779B97F4A7C15)
    data *= np.cumprod(power, dtype=np.uint64)[np.arange(len(data)) - np.repeat(at[:-1] - at[0], sizes)]
    sums = np.append(np.uint64(0), np.cumsum(data, dtype=np.uint64))
    return _mixed((sums[at[1:] - at[0]] - sums[at[:-1] - at[0]]) ^ np.asarray(seed, np.uint64))


class Proposals:
    """A bit set of a fixed size that holds hashes of phrases; it may say yes in vain, never no in vain."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(BITS // 8, np.uint8) if bits is None else bits

    @staticmethod
    def places(h: np.ndarray) -> Iterator[np.ndarray]:
        step = _mixed(h) | np.uint64(1)
        for k in range(HASHES):
            yield (h + np.uint64(k) * step) >> _SHIFT

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        left = np.arange(len(h))
        step = _mixed(h) | np.uint64(1)
        for k in range(HASHES):
            p = (h[left] + np.uint64(k) * step[left]) >> _SHIFT
            left = left[(self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        out[left] = True
        return out


class Part:
    """Texts of one language, and their words as numbers."""

    def __init__(self):
        self.texts: list[bytes] = []

    def add(self, text: str | None) -> int:
        """Bytes added."""
        data = (text or "").encode("utf-8", "replace").lower().translate(_TO_PIECES)
        self.texts.append(data)
        return len(data)

    def words(self) -> tuple[np.ndarray, pa.Array]:
        """The number of every word in order, _BREAK between pieces, and the distinct words by number."""
        data = b"\n".join(self.texts).replace(b"\n", b" \n ") + b" "
        # A token is a word with the space after it; a space alone is none, a line end is the end of a piece.
        kind, offset = (pa.binary(), np.int32) if len(data) < 2**31 else (pa.large_binary(), np.int64)
        ends = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1).astype(offset)
        tokens = pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = tokens.dictionary_encode()
        ids, known = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.large_binary())
        del data, ends, tokens, coded
        word = pc.binary_slice(known, 0, -1)
        size = pc.binary_length(word).to_numpy()
        plain = (size > 0) & ~pc.equal(word, pa.scalar(b"\n", word.type)).to_numpy(zero_copy_only=False)
        number = np.where(plain, np.cumsum(plain) - 1, _BREAK).astype(np.int32)
        ids = number[ids[(size > 0)[ids]]]
        return np.append(ids, np.int32(_BREAK)), word.filter(pa.array(plain))


def _spelled(prefix: pa.Array, last: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(prefix, last, pa.scalar(b" ", prefix.type))


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts key, starts of the runs of equal values in it, and their lengths."""
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return order, starts, np.diff(np.append(starts, len(key)))


def _border(part: Part, lang: str, sizes: range, among: Proposals | None) -> Iterator[tuple[int, np.ndarray | None, Callable[[np.ndarray], pa.Array], np.ndarray]]:
    """(k, hashes, spell, counts) of the sizes: all words for k = 1; longer ones whose first and last k - 1 words are both in
    among. spell(numbers) gives the texts of those phrases.

    (0, None, ..., [all words]) comes with k = 1.
    """
    ids, words = part.words()
    if 1 in sizes:
        yield 0, None, lambda some: pa.array([b""], pa.large_binary()), np.array([int((ids >= 0).sum())])
    own = hashes = word_hashes(words, _seed(lang))
    steps: list[tuple[np.ndarray, np.ndarray]] = []

    def spell(some: np.ndarray, k: int) -> pa.Array:
        if k == 1:
            return words.take(pa.array(some))
        prefix, last = steps[k - 2]
        return _spelled(spell(prefix[some], k - 1), words.take(pa.array(last[some])))

    if 1 in sizes:
        yield 1, hashes, lambda some: spell(some, 1), np.bincount(ids[ids >= 0], minlength=len(words))
    names = ids
    for k in range(2, max(sizes) + 1):
        # One place more, for names below zero.
        names = np.where(np.append(among.holds(hashes), False)[names], names, _BREAK)
        at = np.flatnonzero((names[:-1] >= 0) & (names[1:] >= 0))
        if not len(at):
            return
        key = names[at].astype(np.int64) << 32
        key |= ids[at + k - 1]
        order, starts, counts = _runs(key)
        first = key[order[starts]]
        del key
        prefix, last = first >> 32, first & 0xFFFFFFFF
        steps.append((prefix.astype(np.int32), last.astype(np.int32)))
        hashes = _extended(hashes[prefix], own[last])
        if k in sizes:
            yield k, hashes, lambda some, k=k: spell(some, k), counts
        if k < max(sizes):
            names = np.full(len(names), _BREAK, np.int32)
            names[at[order]] = np.repeat(np.arange(len(starts), dtype=np.int32), counts)


def _upper(h: np.ndarray) -> np.ndarray:
    """The bits of hashes by which they are counted."""
    return h >> _REST_SHIFT << _REST_SHIFT


def bordering(part: Part, lang: str, sizes: range, among: Proposals | None, likely: Proposals | None = None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(k, phrases, counts) of _border, or of those of its phrases whose upper bits are in likely."""
    for k, hashes, spell, counts in _border(part, lang, sizes, among):
        some = np.arange(len(counts))
        if likely is not None and hashes is not None:
            some = np.flatnonzero(likely.holds(_upper(hashes)))
        if len(some):
            yield k, spell(some), counts[some]


def extending(part: Part, lang: str, sizes: range, failed: Proposals, frequent: Proposals) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(k, phrases, counts) of the phrases whose first and last k - 1 words are both in frequent and one of them in failed."""
    ids, words = part.words()
    own = np.append(word_hashes(words, _seed(lang)), np.uint64(0))
    hashes, whole = own[ids], ids >= 0
    for k in range(2, max(sizes) + 1):
        at = np.flatnonzero(whole)
        at = at[failed.holds(hashes[at])]
        # Phrases that begin or end with a failure, within one piece, whose other half is frequent too.
        begins = at[(at + 1 < len(whole))]
        begins = begins[whole[begins + 1]]
        begins = begins[frequent.holds(hashes[begins + 1])]
        ends = at[at > 0] - 1
        ends = ends[whole[ends]]
        ends = ends[frequent.holds(hashes[ends])]
        at = np.union1d(begins, ends)
        hashes, whole = _extended(hashes[:-1], own[ids[k - 1 :]]), whole[:-1] & (ids[k - 1 :] >= 0)
        if not len(at):
            continue
        names, texts = ids[at], words
        for step in range(1, k):
            key = names.astype(np.int64) << 32 | ids[at + step]
            order, starts, counts = _runs(key)
            first = key[order[starts]]
            texts = _spelled(texts.take(pa.array(first >> 32)), words.take(pa.array(first & 0xFFFFFFFF)))
            names = np.empty(len(at), np.int32)
            names[order] = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
        yield k, texts, counts


def _in_parts(flush: Callable[[dict[str, Part]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's texts by language, handed to flush, which empties them, FLUSH bytes at a time."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, Part] = {}
        ready = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                ready += state.setdefault(lang.as_py(), Part()).add(text.as_py())
                if ready >= FLUSH:
                    yield from flush(state)
                    ready = 0
        yield from flush(state)

    return parts


def count_phrases(docs: DataFrame, sizes: range, *by: Proposals | None, select=bordering) -> DataFrame:
    """lang, words, phrase, n: exact counts over docs(lang, text) of the phrases that select takes by the sets."""
    share = docs.sparkSession.sparkContext.broadcast([s.bits if s is not None else None for s in by])

    def flush(state: dict[str, Part]) -> Iterator[pa.RecordBatch]:
        sets = [Proposals(bits) if bits is not None else None for bits in share.value]
        while state:
            lang, part = state.popitem()
            for _, phrases, counts in select(part, lang, sizes, *sets):
                of = pa.scalar(lang.encode("utf-8", "replace"), phrases.type)
                for lo in range(0, len(phrases), 100_000):
                    keys = pc.binary_join_element_wise(phrases[lo : lo + 100_000], of, pa.scalar(b"\t", phrases.type))
                    yield pa.record_batch([keys.cast(pa.large_string()).cast(pa.string()), pa.array(counts[lo : lo + 100_000].astype(np.int64))], names=["key", "n"])

    # One short key for phrase and language, as words hold no tab: rows of the exchange are a third smaller. A task's phrases
    # are distinct already, so they are not added up again before it.
    found = docs.select("lang", "text").mapInArrow(_in_parts(flush), "key string, n long").repartition("key")
    found = found.groupBy("key").agg(F.sum("n").alias("n")).withColumn("phrase", F.substring_index("key", "\t", 1))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ", -1))).alias("words")
    return found.select(F.substr(F.col("key"), F.length("phrase") + 2).alias("lang"), words, "phrase", "n")


def likely_frequent(docs: DataFrame, sizes: range, among: Proposals, least: int) -> Proposals:
    """The upper bits of the hashes of all phrases that bordering takes over docs(lang, text) and that occur `least` times."""
    share = docs.sparkSession.sparkContext.broadcast(among.bits)
    # A count of `least` in one task is enough, so greater ones are not told.
    kind = np.uint8 if least < 2**8 else np.uint32 if least < 2**32 else np.uint64

    def flush(state: dict[str, Part]) -> Iterator[pa.RecordBatch]:
        hashes, counts = [], []
        while state:
            lang, part = state.popitem()
            for _, h, _, n in _border(part, lang, sizes, Proposals(share.value)):
                if h is not None:
                    hashes.append(h >> _REST_SHIFT)
                    counts.append(np.minimum(n, least).astype(kind))
        key, n = np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(counts or [np.zeros(0, kind)])
        if not len(key):
            return
        order = np.argsort(key)
        key, n = key[order], n[order]
        group = key >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        ends = np.append(starts, len(key)).astype(np.int64)
        told = lambda x: pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(x)]).cast(pa.binary())
        yield pa.record_batch([pa.array(group[starts].astype(np.int32)), told(key.astype(np.uint32)), told(n)], names=["group", "rest", "n"])

    def reached(b: pd.DataFrame) -> pd.DataFrame:
        rest = np.concatenate([np.frombuffer(x, np.uint32) for x in b["rest"]])
        n = np.concatenate([np.frombuffer(x, kind) for x in b["n"]]).astype(np.int64)
        order, starts, _ = _runs(rest)
        h = rest[order[starts]][np.add.reduceat(n[order], starts) >= least].astype(np.uint64)
        return _words_of_bits((np.uint64(b["group"].iloc[0]) << np.uint64(32) | h) << _REST_SHIFT)

    told = docs.select("lang", "text").mapInArrow(_in_parts(flush), "group int, rest binary, n binary")
    return _collected(told.groupBy("group").applyInPandas(reached, "word long, bits long"))


def phrase_hashes(lang: pd.Series, phrase: pd.Series) -> np.ndarray:
    """The hashes that tasks give to phrases, from their texts."""
    split = pc.split_pattern(pa.array(phrase.tolist(), pa.large_string()).cast(pa.large_binary()), b" ")
    sizes = pc.list_value_length(split).to_numpy()
    seeds = {x: _seed(x) for x in set(lang)}
    seed = np.fromiter((seeds[x] for x in lang), np.uint64, len(lang))
    words = split.flatten()
    own = word_hashes(words if isinstance(words, pa.LargeBinaryArray) else words.cast(pa.large_binary()), np.repeat(seed, sizes))
    at = np.append(0, np.cumsum(sizes))[:-1]
    out = own[at]
    for k in range(1, int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > k)
        out[longer] = _extended(out[longer], own[at[longer] + k])
    return out


def _words_of_bits(h: np.ndarray) -> pd.DataFrame:
    """The places of hashes in a set, as bits of its 64-bit words."""
    p = np.concatenate(list(Proposals.places(h))).astype(np.int64)
    return pd.DataFrame({"word": p >> 6, "bits": np.uint64(1).astype(np.int64) << (p & 63)})


def _collected(words: DataFrame, before: Proposals | None = None) -> Proposals:
    """before and the places of words(word, bits). What comes to the driver is the set itself, at most BITS / 64 words."""
    rows = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(BITS // 64, np.int64) if before is None else before.bits.view(np.int64).copy()
    bits[rows["word"].to_numpy()] |= rows["bits"].to_numpy()
    return Proposals(bits.view(np.uint8))


def proposed(found: DataFrame, before: Proposals | None = None) -> Proposals:
    """before and the phrases of found."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield _words_of_bits(phrase_hashes(b.lang, b.phrase))

    return _collected(found.select("lang", "phrase").mapInPandas(places, "word long, bits long"), before)


def not_proposed(found: DataFrame, by: Proposals) -> DataFrame:
    share = found.sparkSession.sparkContext.broadcast(by.bits)

    def missing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b[~Proposals(share.value).holds(phrase_hashes(b.lang, b.phrase))]

    return found.mapInPandas(missing, COUNTS)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE, lowered: float = LOWERED, passes: Callable[[int], None] = lambda n: None) -> DataFrame:
    """lang, words, phrase, n of every phrase of at most `longest` words with n >= least, and of the totals (words = 0).

    docs(doc_id, lang, text). passes is told the number of frequent phrases outside the proposals after each full pass.
    """
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(sample)) == 0)
    limit = max(1, int(least / sample * lowered))
    proposals = None
    for sizes in (range(1, 2), range(2, 3), range(3, longest)):
        if len(sizes):
            found = count_phrases(some, sizes, proposals).where((F.col("n") >= limit) & (F.col("words") > 0))
            proposals = proposed(found, proposals)
    kept = (F.col("n") >= least) | (F.col("words") == 0)
    sizes = range(1, longest + 1)
    found = stored(count_phrases(docs, sizes, proposals, likely_frequent(docs, sizes, proposals, least)).where(kept))
    shorter = (F.col("words") > 0) & (F.col("words") < longest)
    failed = stored(not_proposed(found.where(shorter), proposals))
    while True:
        n = failed.count()
        passes(n)
        if not n:
            return found
        counted = count_phrases(docs, range(2, longest + 1), proposed(failed), proposed(found.where(shorter)), select=extending).where(kept)
        # What the sets' false positives let through may have been counted before.
        counted = stored(counted.join(found.where("words > 0").select("lang", "phrase"), ["lang", "phrase"], "left_anti").select("lang", "words", "phrase", "n"))
        found = found.unionByName(counted)
        failed = counted.where(shorter)


def _cut(k: Column, words: Column) -> tuple[Column, Column]:
    return F.array_join(F.slice(words, F.lit(1), k), " "), F.array_join(F.slice(words, k + 1, F.size(words) - k), " ")


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every frequent phrase of two words or more, by its lowest-scoring cut."""
    totals = found.where("words = 0").select("lang", F.col("n").alias("total"))
    counts = found.where("words > 0").select("lang", F.col("phrase").alias("p"), F.col("n").alias("f"))
    phrases = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ", -1).alias("w"))
    cuts = phrases.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first, rest = _cut(F.col("k"), F.col("w"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", first.alias("first"), rest.alias("rest"))
    side = lambda name, out: counts.withColumnsRenamed({"p": name, "f": out})
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    # Exact: products stay below 10^38, and div on decimals truncates.
    score = F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(total AS DECIMAL(18,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(18,0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "words", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """phrases without those that lie inside a longer one which occurs in at least `percent` of their places."""
    longer = phrases.where("words > 2").select("lang", "a", F.split("phrase", " ", -1).alias("w"), F.explode(F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), s -> struct(s, k))))")).alias("x"))
    inside = longer.select("lang", F.array_join(F.slice("w", F.col("x.s"), F.col("x.k")), " ").alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    left = phrases.join(inside, ["lang", "phrase"], "left")
    return left.where(f"_most IS NULL OR 100 * _most < {percent} * a").drop("_most")


def first_of_each(phrases: DataFrame, top: int) -> DataFrame:
    """The `top` first rows of each language with their rank; no language's rows gather in one task."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = phrases.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = share.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("_n") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's strongest maximal phrases."""
    phrases = stored(scored(frequent_phrases(docs, least, longest)))
    out = first_of_each(maximal(phrases), top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The result of collocations over documents, as DuckDB SQL with every phrase counted."""
    ends = r"[.,;:!?\x0A-\x0D]"
    return rf"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ends}')) AS piece
          FROM documents),
        worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
        grams AS (
          SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
          FROM placed, range(1, {LONGEST + 1}) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM grams WHERE k = 1 GROUP BY lang),
        frequent AS (SELECT * FROM grams WHERE f >= {LEAST}),
        cuts AS (
          SELECT lang, phrase, k, f AS a, c, string_split(phrase, ' ') AS w
          FROM frequent, range(1, {LONGEST}) AS cut(c) WHERE c < k),
        valued AS (
          SELECT cuts.lang, cuts.phrase, cuts.k, a, c, x.f AS l, y.f AS r, n, 1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
          FROM cuts
          JOIN frequent x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:c], ' ')
          JOIN frequent y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1:cuts.k], ' ')
          JOIN totals ON totals.lang = cuts.lang),
        best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        inside AS (
          SELECT lang, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase, max(f) AS most
          FROM frequent, range(2, {LONGEST}) AS sizes(m), range(1, {LONGEST}) AS starts(s)
          WHERE m < k AND s + m - 1 <= k GROUP BY ALL),
        kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR most < a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}"""
