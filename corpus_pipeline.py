"""The corpus pipeline: toxicity, line de-duplication, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns the columns of
documents; the last returns the pieces of the packed sequences. A stage's result is written as Parquet to the shared
folder and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import decontaminate, ngram_join, packing, toxicity
from triplake.llm.line_dedup import dedup_lines
from triplake.llm.queries import ranks_path
from triplake.llm.shared import known_id, shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near duplicates by the general rule; op8's own query has a contract of its own (3 words, 0.9).
NEAR_SHINGLE = 5
NEAR_PERCENT = 80

#: No SQL expresses a trained classifier, a connected component or a tokenizer; the stages have brute-force tests.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; a null or empty text is not rejected."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model)
    return scored.where("_toxicity < 0.5 or coalesce(text, '') = ''").select(*COLUMNS)


def dedup_document_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that has lost lines and has no word left goes. n_chars is of the new text."""
    out = dedup_lines(docs.select(*COLUMNS))
    left = (F.col("_dropped") == 0) | F.col("text").rlike(r"[\p{L}\p{N}]")
    n = F.when(F.col("_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return out.where(left).withColumn("n_chars", n).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of documents linked by 5-word shingles at 0.8 or more."""
    groups = ngram_join.similar_sets(docs.select("doc_id", "text"), size=NEAR_SHINGLE, percent=NEAR_PERCENT)
    others = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(known_id().alias("_id")).distinct()
    return docs.withColumn("_id", known_id()).join(others, "_id", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' token pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, ranks_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_document_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
