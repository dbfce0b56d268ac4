"""Exact de-duplication by deterministic block naming. DataFrame functions only.

A text is cut into blocks of a fixed number of characters. The distinct blocks of all texts are sorted and numbered, so a
text becomes a sequence of integer names, one for each block. Then adjacent pairs of names are sorted and numbered in the
same way, level by level: each level halves the sequences, and after the last one every text is one name. Names of a level
are equal exactly where the text under them is equal, so (number of blocks, last name) tells texts apart without any
collision; no digest takes part in the decision.

Blocks travel once, to be numbered. To find a block's number again its two 64-bit hashes are its address; the numbers are
given to blocks, not to hashes, and two blocks with one address would make more rows than there are blocks. That is
counted, and other hashes are taken until it does not happen.

A block or pair that a third of all texts share is one row after map-side aggregation; looking its number up is a plain
equi-join, whose hot partitions adaptive execution splits. A level is a table in the shared folder.

Defined results: a null text counts as empty, and all empty texts are copies of each other; texts are compared after
lower-casing A-Z only. Of equal texts the row of the largest doc_id stays; a null doc_id is smaller than any other. Of rows
that repeat the id too, one stays. An empty table gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.shared import NULL_ID, known_id, public_id, stored

#: Characters in a block.
BLOCK = 512

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Stands for the missing partner of a last, odd name.
NONE = -1


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone take the quick way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normalised() -> Column:
    return ascii_lower(F.coalesce(F.col("text"), F.lit("")))


def blocks(text: Column, size: int) -> Column:
    """The text in pieces of `size` characters, the last one shorter; none for an empty text. One walk over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def address(block: Column, attempt: int) -> Column:
    """Two hashes of a block, others in each attempt."""
    return F.struct(F.xxhash64(F.lit(2 * attempt), block).alias("x"), F.xxhash64(F.lit(2 * attempt + 1), block).alias("y"))


def numbered(distinct: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """`keep` of distinct rows, and their name: a number by the order of `by` within the partition. Stored, so it is fixed."""
    return stored(distinct.sortWithinPartitions(*by).select(*keep, F.monotonically_increasing_id().alias("name")))


def first_names(docs: DataFrame, size: int, address: Callable[[Column, int], Column], attempt: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows, names): the rows with an identity _row of their own, and _row, n (blocks), pos, name of every block."""
    texts = docs.select(known_id().alias("_id"), normalised().alias("_text"))
    addresses = F.transform(blocks(F.col("_text"), size), lambda b: address(b, attempt))
    rows = stored(texts.select(F.monotonically_increasing_id().alias("_row"), "_id", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"), addresses.alias("_at")))
    found = texts.select(F.explode(blocks(F.col("_text"), size)).alias("_block"))
    found = found.select(address(F.col("_block"), attempt).alias("_a"), "_block").select("_a.x", "_a.y", "_block").distinct()
    number = numbered(found, ["_block"], ["x", "y"])
    at = rows.select("_row", F.size("_at").alias("n"), F.posexplode("_at").alias("pos", "_a")).select("_row", "n", "pos", "_a.x", "_a.y")
    names = stored(at.join(number, ["x", "y"]).select("_row", "n", "pos", "name"))
    if names.count() != (rows.agg(F.sum(F.size("_at"))).first()[0] or 0):
        return first_names(docs, size, address, attempt + 1)
    return rows, names


def pair_names(names: DataFrame) -> DataFrame:
    """The next level: names of the pairs of neighbours, at half the positions."""
    side = lambda odd: F.coalesce(F.max(F.when(F.col("pos") % 2 == odd, F.col("name"))), F.lit(NONE).cast("long"))
    pairs = names.groupBy("_row", "n", F.expr("pos div 2").cast("int").alias("half")).agg(side(0).alias("l"), side(1).alias("r"))
    number = numbered(pairs.select("l", "r").distinct(), ["l", "r"], ["l", "r"])
    return stored(pairs.join(number, ["l", "r"]).select("_row", "n", F.col("half").alias("pos"), "name"))


def identities(docs: DataFrame, size: int = BLOCK, address: Callable[[Column, int], Column] = address) -> DataFrame:
    """_row, _id, _sha, _blocks, _name of every row of docs(doc_id, text); the last two are equal exactly for equal texts."""
    rows, names = first_names(docs, size, address)
    longest = rows.agg(F.max(F.size("_at"))).first()[0] or 0
    done, width = [], 1
    while True:
        done.append(names.where(F.col("n") <= width).select("_row", "name"))
        if width >= longest:
            break
        names, width = pair_names(names.where(F.col("n") > width)), 2 * width
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return rows.select("_row", "_id", "_sha", F.size("_at").alias("_blocks")).join(found.withColumnRenamed("name", "_name"), "_row", "left").withColumn("_name", F.coalesce("_name", F.lit(NONE).cast("long")))


def exact_groups(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs(doc_id, text)."""
    named = stored(identities(docs, size))
    last = F.max(F.struct("_id", "_row"))
    groups = named.groupBy("_blocks", "_name").agg(last.alias("_keep"), F.count(F.lit(1)).alias("group_size"))
    # Stored, so that the join exchanges both sides itself and adaptive execution can split the rows of a large group.
    out = named.join(stored(groups.where("group_size > 1")), ["_blocks", "_name"], "left")
    keep = F.coalesce("_keep", F.struct("_id", "_row"))
    kept = (keep["_row"] == F.col("_row")).alias("kept")
    size = F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")
    return out.select(public_id("_id").alias("doc_id"), F.when(keep["_id"] != NULL_ID, keep["_id"]).alias("keep_id"), size, kept, F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """docs with one row of each text, all columns as they were.

    The row that stays is found again by its id and the digest of its text. Rows that agree in both are repeated rows.
    """
    free = lambda name: next(n for n in (f"{name}{'_' * k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    i, s = free("_id"), free("_sha")
    left = exact_groups(docs.select("doc_id", "text"), size).where("kept").select(known_id().alias(i), F.col("text_sha256").alias(s))
    keyed = docs.withColumns({i: known_id(), s: F.sha2(normalised().cast("binary"), 256)})
    return keyed.join(left, [i, s], "left_semi").dropDuplicates([i, s]).drop(i, s)


def oracle() -> str:
    """The result of exact_groups over documents, as DuckDB SQL."""
    return f"""
        WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)"""
