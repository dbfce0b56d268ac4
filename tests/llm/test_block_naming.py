"""Exact de-duplication by block naming against plain Python."""

import hashlib
import random

from pyspark.sql import functions as F

from triplake.llm import block_naming
from triplake.llm.block_naming import LOWER, UPPER, drop_copies, exact_groups, identities

LOWERED = str.maketrans(UPPER, LOWER)


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) of every (doc_id, text), sorted."""
    order = lambda i: (i is not None, i or 0)
    texts = [(i, (t or "").translate(LOWERED)) for i, t in rows]
    groups = {}
    for i, t in texts:
        groups.setdefault(t, []).append(i)
    out, stays = [], set()
    for i, t in texts:
        keep = max(groups[t], key=order)
        first = i == keep and t not in stays
        if first:
            stays.add(t)
        out.append((i, keep, len(groups[t]), first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def varied():
    """Texts that share blocks, positions, lengths and beginnings, with copies in other letter cases."""
    rng = random.Random(3)
    parts = ["abcdefgh", "ABCDEFGH", "abcdefgé", "abcdefg\U0001f600", "        ", "\n\n\n\n\n\n\n\n", "É", "ab"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for i in range(300)]
    rows += [(1000 + i, "x" * n) for i, n in enumerate([7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 7, 64])]
    rows += [(None, "ab"), (None, None), (None, None), (5000, None), (5000, None), (5001, ""), (7, "ab"), (7, "ab"), (7, "ab")]
    return rows + [(6000, "ab" * 50_000), (6001, "AB" * 50_000), (6002, "ab" * 50_000 + "b")]


def test_groups_against_plain_python(spark):
    rows = varied()
    got = sorted((tuple(r) for r in exact_groups(frame(spark, rows), size=8).collect()), key=str)
    assert got == brute(rows)


def test_default_blocks(spark):
    rows = varied()[-20:]
    got = sorted((tuple(r) for r in exact_groups(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_addresses_that_clash_are_replaced(spark):
    """Hashes that fail at first: all blocks of a length share an address. Names stay those of the blocks."""
    tried = []

    def weak(block, attempt):
        tried.append(attempt)
        real = block_naming.address(block, attempt)
        return real if attempt > 1 else F.struct(F.length(block).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))

    rows = varied()[:80]
    named = identities(frame(spark, rows), 8, weak).join(frame(spark, rows).select(F.col("doc_id").alias("_id"), "text"), "_id").collect()
    assert max(tried) == 2
    assert len({(r["_blocks"], r["_name"]) for r in named}) == len({r.text.translate(LOWERED) for r in named}) == len({(r["_blocks"], r["_name"], r.text.translate(LOWERED)) for r in named})


def test_other_columns_pass_through(spark):
    names = ["_id", "_sha", "_row", "_blocks", "_name", "n", "pos", "name", "kept", "_keep", "x", "_text", "_block"]
    texts = [(1, "Same text"), (2, "same TEXT"), (2, "same TEXT"), (3, None), (None, ""), (None, "own")]
    rows = [(i, t, *[10 * k + n for n in range(len(names))]) for k, (i, t) in zip([1, 2, 2, 3, 4, 5], texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{name} long" for name in names))
    out = drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([rows[1], rows[3], rows[5]], key=str)


def test_empty_table(spark):
    none = frame(spark, [])
    assert exact_groups(none).count() == 0 and drop_copies(none).count() == 0


def test_no_python_and_no_rdd(spark):
    plan = exact_groups(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
