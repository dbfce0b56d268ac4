"""Document fingerprints of closed syncmers; DataFrame functions only.

A text is the sequence of its words (lower case, between white space). Of every k = 5 words in a row the inner runs of
s = 2 words are hashed; the k-mer is a syncmer if the least of those hashes is that of its first or its last run. The
choice looks at the k words alone, so the same passage gives the same anchors in any context, and anchors of two texts
can be matched position by position. A fingerprint is the list of anchors: 32-bit hashes in text order, written as eight
hex digits each. Texts of fewer than k words, and those without a syncmer, have one anchor, of all their words.

Defined results: a null text counts as empty; an empty text, or one of white space, has the empty fingerprint. The
likeness of two fingerprints is the share of distinct anchors that both have, 2 |A & B| / (|A| + |B|); two empty ones
are alike (1), an empty and another one not (0). Repeated rows get equal results; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.llm.shared import let

WORDS = 5
INNER = 2

#: Portions of the ids in which neighbours are looked up, at most; their borders are all that the driver gets.
MOST_PORTIONS = 4096
PER_PORTION = 2048


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def anchors(text: Column) -> Column:
    """array<struct<pos, hash>>: word number and 32-bit hash of each closed syncmer, in text order."""

    def chosen(h: Column) -> Column:
        n = F.size(h)
        pairs = F.zip_with(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1), lambda a, b: F.xxhash64(a, b))

        def closed(m: Column) -> Column:
            at = F.filter(F.sequence(F.lit(0), n - WORDS), lambda i: F.least(m[i], m[i + 3]) <= F.least(m[i + 1], m[i + 2]))
            low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
            return F.transform(at, lambda i: F.struct(i.alias("pos"), low(F.xxhash64(m[i], m[i + 2], h[i + 4])).alias("hash")))

        few = F.transform(F.slice(h, 1, F.least(n, F.lit(1))), lambda _: F.struct(F.lit(0).alias("pos"), F.xxhash64(h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash")))
        # Of a short text with enough words none may be a syncmer; its words are one anchor then, as those of a shorter text.
        return F.when(n < WORDS, few).otherwise(let(let(pairs, closed), lambda c: F.when(F.size(c) == 0, few).otherwise(c)))

    return let(word_hashes(text), chosen)


def hashes(text: Column) -> Column:
    return F.transform(anchors(text), lambda x: x["hash"])


def written(found: Column) -> Column:
    """Anchor hashes as text."""
    return F.array_join(F.transform(found, lambda h: F.lpad(F.hex(h), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of anchor hashes."""

    def share(x: Column, y: Column) -> Column:
        total = F.size(x) + F.size(y)
        return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / total)

    return let(F.array_distinct(a), lambda x: let(F.array_distinct(b), lambda y: share(x, y)))


def matches(a: Column, b: Column) -> Column:
    """array<struct<a, b>>: positions of anchors that occur once in each of two arrays of anchors and are equal."""
    once = lambda x: F.map_from_entries(F.transform(F.filter(x, lambda p: F.size(F.filter(x, lambda q: q["hash"] == p["hash"])) == 1), lambda p: F.struct(p["hash"], p["pos"])))
    return let(once(b), lambda at: F.transform(F.filter(a, lambda p: F.map_contains_key(at, p["hash"])), lambda p: F.struct(p["pos"].alias("a"), at[p["hash"]].alias("b"))))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """docs(doc_id, _carried) with _next, _carried of the next document in descending doc_id (after the last: of the first).

    Ids are dealt over portions by approximate quantiles, so no task sorts all. Each portion's first document is sent
    to the portion before as well, as a row with _g = 1, for the last row there. Null ids come last; equal ids go by text.
    """
    null = -(2**63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(null))
    rows = docs.count()
    parts = max(1, min(MOST_PORTIONS, rows // PER_PORTION))
    share = [i / parts for i in range(1, parts)]
    borders = sorted(set(docs.agg(F.percentile_approx(key, share, 100 * parts)).first()[0] or [])) if share and rows else []
    portion = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= F.col("_key"))) if borders else F.lit(0)
    keyed = docs.withColumn("_key", key).withColumn("_portion", portion)
    # One number for each portion: its greatest id.
    heads = {r._portion: r.head for r in keyed.groupBy("_portion").agg(F.max("_key").alias("head")).collect()}
    held = sorted(heads)
    # The first document of portion p follows the last of the next higher portion that has any; the top one follows the lowest.
    above = {heads[p]: held[(i + 1) % len(held)] for i, p in enumerate(held)}
    if above:
        at = F.create_map(*(F.lit(x).cast(kind) for pair in above.items() for x, kind in zip(pair, ("long", "int"))))
        also = F.when(at[F.col("_key")].isNull(), F.array(F.struct(F.col("_portion").alias("p"), F.lit(0).alias("g")))).otherwise(F.array(F.struct(F.col("_portion").alias("p"), F.lit(0).alias("g")), F.struct(at[F.col("_key")].alias("p"), F.lit(1).alias("g"))))
        keyed = keyed.withColumn("_to", F.explode(also))
    else:
        keyed = keyed.withColumn("_to", F.struct(F.lit(0).alias("p"), F.lit(0).alias("g")))
    # Columns of their own, so that windows over one order share its shuffle and sort.
    keyed = keyed.select("doc_id", "_carried", "_key", F.col("_to.p").alias("_p"), F.col("_to.g").alias("_g"), F.xxhash64("_carried").alias("_tie"))
    order = Window.partitionBy("_p").orderBy("_g", F.col("_key").desc(), "_tie")
    return keyed.withColumn("_next", F.lead("_carried").over(order)), order


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, _text, _edited, _n, _anchors (hashes), _next_anchors of every document."""
    found, order = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_carried")))
    n = F.length("_carried")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.call_function("left", F.col("_carried"), n - half), F.call_function("left", F.col("_next"), half))
    found = found.select("doc_id", "_key", "_p", "_g", "_tie", F.col("_carried"), edited.alias("_edited"), n.cast("long").alias("_n"), hashes(F.col("_carried")).alias("_anchors"))
    found = found.withColumn("_next_anchors", F.lead("_anchors").over(order))
    return found.where("_g = 0").drop("_key", "_p", "_g", "_tie").withColumnRenamed("_carried", "_text")


def fingerprint_changes(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    found = edited_texts(docs).withColumn("_edited_anchors", hashes(F.col("_edited")))
    own, changed, following = F.col("_anchors"), F.col("_edited_anchors"), F.col("_next_anchors")
    return found.select(
        "doc_id",
        F.col("_n").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        written(own).alias("fingerprint"),
        written(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, following).alias("near_next"),
    )
