"""Jaccard join of shingle sets by T-occurrence search.

A document's set holds the hashes of its distinct word shingles. Two sets of n and m members reach the similarity only if
they share t members, and no partner of a set of n shares fewer than T. As in DivideSkip, a document's inverted lists are
divided by length, the number of distinct sets that hold a member (by 44 bits of its hash): the long ones are set aside, the
n - T + c shortest are merged. Of any partner's members at least one is in the first n - T + 1 lists, which bring the
candidates together (lists of one set name no candidate and are dropped), and at least c + t - T are in all short lists.
So the short lists of two candidates are merged first and the occurrences counted; the few pairs that reach that number are
settled by binary search in the whole sets, which stops once the required overlap is reached or out of reach. A member may
be short in one set and long in the other, so this last search takes all members of the smaller set.

All documents must divide their lists by one order of the shingles. Lists are counted, over all documents, for the hashes
below a limit, a share of the hash space that grows with what partners may lack (COUNTED); they come first, by count, the
other hashes after them, by value. The order affects speed alone; any order gives every link.

The first shared member of sets of n and m, in that order, has t - 1 shared ones behind it in both, so it stands in the first
n - t + 1 of the one and m - t + 1 of the other: a pair is a candidate only by a list that has such places in both. Sets whose
lists still mix groups after a round of centres (texts around one text, but not linked to it) are ordered anew, all their
members counted among them alone. What one of them has for itself comes first then, and as unlinked sets have much of that,
hardly any two meet.

Copies of one set are one class before any list is made. A list is compared as `graph.linked` does: groups of near
copies are joined through centres, not pair by pair, and lose no link between classes.

Defined results: a null text or one without words has an empty set and is linked with nothing; with fewer words than a
shingle has, the whole sequence is the only member; rows that repeat an id are one document, whose sets are all linked;
a null id is the smallest id; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.graph import components, linked
from triplake.llm.shared import known_id, public_id, semi, settled, stored
from triplake.llm.words import MEMORY

SHINGLE = 3
PERCENT = 90

#: Share of the hash space whose lists are counted, as a multiple of the share of a set that a partner may lack.
COUNTED = 2.5

#: Low bits of a hash that give way to its list's length; its 64 - LENGTH_BITS upper bits tell the lists apart.
LENGTH_BITS = 20

#: One in so many of the T shared members is asked of the short lists (c); more lengthens them and leaves fewer pairs.
MERGED = 16

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text. known: memory of words seen.

    Words are what stands between ASCII white space; A-Z are lower-cased. Hashes are of all words in order.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    if len(known) > MEMORY:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ h[k : k + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out.view(np.int64))


def least_shared(n: int, percent: int) -> int:
    """Members that a set of n must share with any partner: the partner has at least as many as are shared."""
    return -(-percent * n // 100)


def asked(n: int, percent: int) -> int:
    """Occurrences (c) that a set of n asks of its short lists."""
    return max(1, least_shared(n, percent) // MERGED)


def counted_below(percent: int) -> int:
    """The limit under which hashes' lists are counted."""
    share = min(1.0, COUNTED * (100 - percent) / 100)
    return min(2**63 - 1, -(2**63) + int(share * 2**64))


def leading(members: np.ndarray, percent: int) -> np.ndarray:
    """The members from which short lists are chosen: all that are counted, and the next hashes where those are too few."""
    n = len(members)
    least = n - least_shared(n, percent) + asked(n, percent)
    return members[: max(least, int(np.searchsorted(members, counted_below(percent))))]


def divided(some: np.ndarray, n: int, shared: np.ndarray, lengths: np.ndarray, percent: int, below: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of the short lists, sorted, and those of them whose lists bring candidates, with their places in the order.

    some: the set's leading members; shared: the counted ones, below a limit (counted_below(percent) if none is given),
    that other sets hold too, with their lists' lengths.
    """
    below = counted_below(percent) if below is None else below
    length = np.ones(len(some), np.int64)
    length[np.searchsorted(some, shared)] = lengths
    uncounted = some >= below
    order = np.lexsort((some, length, uncounted))
    first = n - least_shared(n, percent) + 1
    bring = order[:first]
    place = np.flatnonzero((length[bring] > 1) | uncounted[bring])
    return np.sort(some[order[: first - 1 + asked(n, percent)]]), some[bring[place]], place.astype(np.int32)


def enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sorted sets a and b have 100 * shared >= percent * union."""
    if len(a) > len(b):
        a, b = b, a
    # shared >= percent * (|a| + |b|) / (100 + percent)
    needed = -(-percent * (len(a) + len(b)) // (100 + percent))
    shared = 0
    for at in range(0, len(a), 256):
        probe = a[at : at + 256]
        place = np.searchsorted(b, probe)
        shared += int((b[np.minimum(place, len(b) - 1)] == probe).sum())
        if shared + len(a) - at - len(probe) < needed:
            return False
        if shared >= needed:
            return True
    return shared >= needed


def upper(members: np.ndarray) -> np.ndarray:
    """The upper 44 bits of hashes, counted from the smallest hash on; sorted as the hashes are."""
    return (members.view(np.uint64) ^ np.uint64(2**63)) >> np.uint64(LENGTH_BITS)


def counted(some: np.ndarray, below: int) -> np.ndarray:
    return some[: np.searchsorted(some, below)]


def held_by_several(classes: DataFrame, percent: int, below: int | None = None) -> DataFrame:
    """node, member, length: the counted members of classes(node, some), by their upper bits, that several nodes hold.

    Counted are the hashes below a limit, counted_below(percent) if none is given.

    Members and nodes meet in one exchange, packed: a row holds what the sets of a batch have in one share of the hashes, the
    first 12 bits, as 32 bits a member and its node. Members of equal upper bits are counted as one, in all sets alike.
    """
    below = counted_below(percent) if below is None else below

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            some = [counted(s, below) for s in b.some]
            sizes = [len(s) for s in some]
            if not sum(sizes):
                continue
            member, node = upper(np.concatenate(some)), np.repeat(b.node.to_numpy(), sizes)
            order = np.argsort(member)
            member, node = member[order], node[order]
            share = member >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, share[1:] != share[:-1])).tolist()
            parts = list(zip(starts, [*starts[1:], len(share)], strict=True))
            rest = member.astype(np.uint32)
            yield pd.DataFrame({"share": share[starts].astype(np.int32), "members": [rest[i:j].tobytes() for i, j in parts], "nodes": [node[i:j].tobytes() for i, j in parts]})

    def met(b: pd.DataFrame) -> pd.DataFrame:
        member, node = np.frombuffer(b"".join(b.members), np.uint32), np.frombuffer(b"".join(b.nodes), np.int64)
        order = np.argsort(member)
        member, node = member[order], node[order]
        times = np.diff(np.append(np.flatnonzero(np.append(True, member[1:] != member[:-1])), len(member)))
        length = np.repeat(times, times)
        several = length > 1
        whole = np.int64(b["share"].iloc[0]) << np.int64(32) | member[several].astype(np.int64)
        return pd.DataFrame({"node": node[several], "member": whole, "length": length[several]})

    rows = classes.select("node", "some").mapInPandas(packed, "share int, members binary, nodes binary")
    return rows.groupBy("share").applyInPandas(met, "node long, member long, length long")


def divided_lists(classes: DataFrame, percent: int, below: int) -> DataFrame:
    """node, _id, times, n, short, bring, place of classes(node, _id, times, n, some), by the lists' lengths in them."""
    # A set's own members come back to it, no more than it has.
    # Upper bits and length come as one number; lengths beyond its low bits are equally long, in all sets alike.
    entry = F.shiftleft("member", LENGTH_BITS).bitwiseOR(F.least("length", F.lit(2**LENGTH_BITS - 1)))
    # Stored, so that the packed exchange is gone from disk before the classes' members are exchanged.
    shared = stored(held_by_several(classes, percent, below).select("node", entry.alias("entry")).groupBy("node").agg(F.collect_list("entry").alias("shared")))
    no = F.array().cast("array<long>")

    def divide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lists = []
            for s, n, x in zip(b.some, b.n, b.shared, strict=True):
                own, x = counted(s, below), np.unique(x.view(np.uint64))
                # All members of equal upper bits have their list's length.
                at = np.searchsorted(x >> np.uint64(LENGTH_BITS), upper(own))
                held = np.append(x >> np.uint64(LENGTH_BITS), np.uint64(2**63))[at] == upper(own)
                lists.append(divided(s, n, own[held], (x[at[held]] & np.uint64(2**LENGTH_BITS - 1)).astype(np.int64), percent, below))
            yield b[["node", "_id", "times", "n"]].assign(short=[x for x, _, _ in lists], bring=[y for _, y, _ in lists], place=[z for _, _, z in lists])

    found = classes.join(shared, "node", "left").withColumn("shared", F.coalesce("shared", no))
    return found.mapInPandas(divide, "node long, _id long, times int, n int, short array<long>, bring array<long>, place array<int>")


def similar_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs(doc_id, text): doc_id, n_shingles, component_id."""
    texts = docs.select(known_id().alias("_id"), "text")
    sets, groups = settled(lambda: class_groups(texts, size, percent))
    # From classes to documents: rows of an id belong together, and so do rows of a class.
    cls = F.coalesce("component", F.xxhash64("key"))
    rows = stored(sets.select("_id", "n", "key").join(groups.withColumnRenamed("node", "cls"), F.xxhash64("key") == F.col("cls"), "left").select("_id", "n", F.when(F.col("n") > 0, cls).alias("cls")))
    several = rows.where("cls is not null").groupBy("_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b")
    least = rows.where("cls is not null").groupBy("cls").agg(F.min("_id").alias("least"))
    if several.limit(1).count():
        pairs = rows.where("cls is not null").join(several.select("_id", "a"), "_id").select("a", F.col("cls").alias("b"))
        joined = components(pairs)
        least = least.join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        best = least.groupBy("component").agg(F.min("least").alias("best"))
        least = least.join(best, "component").select("cls", F.col("best").alias("least"))
    out = rows.join(least, "cls", "left").select("_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "_id").alias("_component"))
    return out.select(public_id("_id").alias("doc_id"), "n_shingles", public_id("_component").alias("component_id"))


def sets_and_classes(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(_id, n, key) of every row of texts(_id, text), and node, _id, times, n, some of every class of equal sets."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for b in batches:
            rows = []
            for i, t in zip(b["_id"], b.text, strict=True):
                s = shingles(t, size, known)
                rows.append((i, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, leading(s, percent)))
            yield pd.DataFrame(rows, columns=["_id", "n", "key", "some"])

    sets = stored(texts.mapInPandas(summed, "_id long, n int, key binary, some array<long>"))
    # One row a set: its smallest document stands for it, and its lists are made once.
    of = lambda c: F.min_by(c, "_id").alias(c)
    classes = sets.where("n > 0").groupBy("key").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).cast("int").alias("times"), of("n"), of("some"))
    return sets.select("_id", "n", "key"), classes.select(F.xxhash64("key").alias("node"), "_id", "times", "n", "some")


def class_groups(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(_id, n, key) of every row of texts(_id, text), and (node, component) of the classes of equal sets that are linked to
    another; node is the key's hash."""

    def divided_sets() -> tuple[DataFrame, DataFrame]:
        # Members are the most that this join stores: each table of them goes as soon as the next one is there.
        sets, classes = settled(lambda: sets_and_classes(texts, size, percent))
        return sets, divided_lists(classes, percent, counted_below(percent))

    sets, own = settled(divided_sets)

    def postings(lists: DataFrame) -> DataFrame:
        each = lists.select(F.posexplode("bring").alias("at", "bucket"), "node", (-F.col("times")).alias("rank"), "n", "place")
        return each.select("bucket", "node", "rank", F.struct("n", F.col("place")[F.col("at")].alias("place")).alias("info"))

    def fits(a: str, b: str) -> Column:
        """Sets that must share t members meet in the first n - t + 1 lists of both."""
        n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
        t = F.expr(f"cast(ceil({percent}L * ({a}.n + {b}.n) / {100 + percent}) AS int)")
        near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
        return near & (F.col(f"{a}.place") <= n - t) & (F.col(f"{b}.place") <= m - t)

    def merged(pairs: DataFrame) -> DataFrame:
        """Pairs that occur together in as many short lists as a link needs."""
        least = lambda n: f"cast(ceil({percent}L * n{n} / 100) AS int)"
        spare = lambda n: f"greatest(1, {least(n)} div {MERGED}) - {least(n)}"
        both = f"cast(ceil({percent}L * (na + nb) / {100 + percent}) AS int)"
        side = lambda c: own.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("short").alias(f"s{c}"))
        enough_short = f"size(array_intersect(sa, sb)) >= {both} + least({spare('a')}, {spare('b')})"
        return stored(pairs.join(side("a"), "a").join(side("b"), "b").where(enough_short).select("a", "b"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = merged(pairs)
        nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(own.select("node", "_id"), "node"))
        full = whole_sets(nodes)
        side = lambda c: full.select(F.col("node").alias(c), F.col("s").alias(f"s{c}"))

        def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                good = [enough(x, y, percent) for x, y in zip(b.sa, b.sb, strict=True)]
                yield b.loc[good, ["a", "b"]]

        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInPandas(reached, "a long, b long")

    def whole_sets(nodes: DataFrame) -> DataFrame:
        """node, s: the whole sets of nodes(node, _id)."""

        def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known: dict = {}
            for b in batches:
                found = [shingles(t, size, known) for t in b.text]
                yield pd.DataFrame({"key": [xxhash.xxh3_128_digest(s.tobytes()) for s in found], "s": found})

        full = semi(texts.where("text is not null"), nodes, "_id").select("text").mapInPandas(members, "key binary, s array<long>")
        # Other rows of these ids have other sets; rows that repeat id and text give their set once.
        # Not stored: its one exchange serves both sides of the pairs.
        return semi(full.select(F.xxhash64("key").alias("node"), "s"), nodes, "node").dropDuplicates(["node"])

    def again(rows: DataFrame) -> tuple[DataFrame, Callable[[str, str], Column]]:
        """All lists of the sets in rows, whatever their hash, counted among these sets alone: what few of them hold comes first."""
        nodes = stored(rows.select("node").distinct().join(own.select("node", "_id", "times"), "node"))
        some = stored(whole_sets(nodes).join(nodes, "node").select("node", "_id", "times", F.size("s").alias("n"), F.col("s").alias("some")))
        return postings(divided_lists(some, percent, 2**63 - 1)), fits

    return sets, linked(postings(own), fits, verify, again)
