"""Connected components, and the links of a bucket join without its pairs inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.llm.shared import settled, stored

#: Star rounds before what is left is compared in full.
STAR_ROUNDS = 8

#: Comparisons for each posting that the full comparison may need; beyond it, another star round comes first, as long
#: as star rounds halve what is left.
FULL_PER_POSTING = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges(a, b); component is the smallest node that links reach.

    Each round hooks every node to the neighbour that a hash, another one each round, ranks lowest, and contracts
    the edges. A constant share of nodes goes each round, also along chains. A node of many edges is one row after
    map-side aggregation. Self loops are nodes without links.
    """
    return settled(lambda: _contracted(edges))


def _contracted(edges: DataFrame) -> DataFrame:
    edges = stored(edges.select("a", "b").distinct())
    steps, number = [], 0
    live = edges.where("a <> b")
    while live.limit(1).count():
        rank = lambda name, n=number: F.xxhash64(F.col(name), F.lit(n))
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("h"), F.col("b").alias("n"))).alias("m"))
        hook = stored(best.select(F.col("a").alias("node"), F.when(F.col("m.h") < rank("a"), F.col("m.n")).otherwise(F.col("a")).alias("parent")))
        steps.append(hook)
        to = lambda name: hook.select(F.col("node").alias(name), F.col("parent").alias(f"p{name}"))
        live = live.join(to("a"), "a").join(to("b"), "b").where("pa <> pb")
        live = stored(live.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        number += 1
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    found = nodes.withColumn("root", F.col("node"))
    for hook in steps:
        found = found.join(hook.select(F.col("node").alias("root"), "parent"), "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
    found = stored(found)
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(least, "root").select("node", "component")


def linked(
    postings: DataFrame,
    fits: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame],
    again: Callable[[DataFrame], tuple[DataFrame, Callable[[str, str], Column]]] | None = None,
) -> DataFrame:
    """(node, component) of nodes that share a bucket with another node and are linked to it, directly or on a way.

    postings: bucket, node (long), rank (low: near the middle of its group), and a struct `info` that fits(a, b)
    compares; every true link must fit in one of its buckets. verify keeps of pairs(a, b) the true links.

    Pairs within a bucket grow with its square, so they are not listed. Each bucket's members are compared with one
    centre first; members of one component need no more comparisons. A bucket whose members are then still in
    several components compares those outside its largest component with the others. Where that is more than a comparison
    for each posting, again(rows of these buckets) first gives postings and fits that tell the members apart better, in
    which every true link between nodes of these rows must fit; they replace the first ones. Then come new centres while
    many are left, and the full comparison at the end. No link between different components is left out.
    """
    return settled(lambda: _linked(postings, fits, verify, again))


def _several(postings: DataFrame) -> DataFrame:
    """Postings of buckets with more than one member."""
    return stored(postings.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where("n > 1").drop("n"))


def _mixed(many: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """Postings of buckets whose members are in several components, with `component` and the bucket's `largest` one, and the
    number of comparisons of members outside the largest component with all."""
    at = many.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by = at.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = by.groupBy("bucket").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"), F.max(F.struct("n", "component")).alias("major")).where("k > 1")
    at = stored(at.join(mixed.select("bucket", F.col("major.component").alias("largest"), ((F.col("total") - F.col("major.n")) * F.col("total")).alias("work")), "bucket"))
    work = at.groupBy("bucket").agg(F.first("work").alias("work")).agg(F.sum("work")).first()[0] or 0
    return at, work


def _linked(postings, fits, verify, again) -> DataFrame:
    many = _several(postings)
    rows = many.count()
    first = many.groupBy("bucket").agg(F.min(F.struct("rank", "node", "info")).alias("c"))
    pairs = many.join(first, "bucket").where("node <> c.node").where(fits("info", "c.info"))
    links = tested = before = None
    for number in range(STAR_ROUNDS):
        pairs = pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        good = settled(lambda p=pairs: verify(p))
        links = good if links is None else links.unionByName(good)
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = components(links)
        if not rows:
            break
        at, work = _mixed(many, found)
        if again is not None and work > rows:
            postings, fits = again(at.select("bucket", "node", "rank", "info"))
            again = None
            many = _several(postings)
            rows = many.count()
            at, work = _mixed(many, found)
        if not work:
            break
        outside = at.where("component <> largest").select("bucket", F.struct("rank", "node", "info", "component").alias("c"))
        if work <= FULL_PER_POSTING * rows or (before is not None and work > before / 2) or number == STAR_ROUNDS - 1:
            # Two nodes outside the largest component meet twice; distinct() above leaves one.
            pairs = at.join(outside, "bucket").where("component <> c.component").where(fits("info", "c.info"))
            pairs = pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
            pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"))
            return components(links.unionByName(settled(lambda: verify(pairs))))
        before = work
        picked = outside.withColumn("h", F.xxhash64("c.node", F.lit(number))).groupBy("bucket").agg(F.min_by("c", "h").alias("c"))
        pairs = at.join(picked, "bucket").where("component <> c.component").where(fits("info", "c.info"))
    return found
