"""From raw to silver: standardise, keep what is plausible, instrument, de-duplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.functions.flags import flag_expressions
from triplake.functions.keys import RECORD_HASH, RIDE_KEY
from triplake.operators.dedup import numbered_copies, one_per_content
from triplake.operators.rules import keep_valid, rules_for
from triplake.schema import CANONICAL, SILVER, require
from triplake.sources.canonical import to_canonical


def instrumented(df: DataFrame, taxi_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Add the keys and the flags to canonical rows, which may have the columns `keep` besides."""
    added = {"record_hash": RECORD_HASH, "ride_key": RIDE_KEY, **flag_expressions(taxi_type)}
    full = df.selectExpr("*", *[f"{value} AS {name}" for name, value in added.items()])
    require(full.drop(*keep), SILVER, f"silver {taxi_type}")
    return full


def valid(raw: DataFrame, taxi_type: str, settings: Settings, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical rows that satisfy every rule of the category, with the columns `keep`."""
    return keep_valid(to_canonical(raw, taxi_type, keep), rules_for(taxi_type, settings))


def silver(raw: DataFrame, taxi_type: str, settings: Settings) -> DataFrame:
    """The silver table of a category.

    Only fhv repeats records, and there copies go before the keys are added, so
    the shuffle carries neither digests nor the columns fhv leaves empty.
    """
    kept = valid(raw, taxi_type, settings)
    if taxi_type == "fhv":
        kept = one_per_content(kept)
    return instrumented(kept, taxi_type)


#: Columns of stored silver that its contract doesn't have: month of the file (a partition column), and for fhv the month of
#: pickup (a partition column too) and the place among the copies of a record, 1 for the one that users see.
SOURCE_MONTH, PICKUP_MONTH, COPY = "_source_month", "_pickup_month", "_copy"
FHV_PARTITIONS = (PICKUP_MONTH, SOURCE_MONTH)
SEEN = f"{COPY} = 1"


def with_source_month(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn(SOURCE_MONTH, F.col("_partition_year") * 100 + F.col("_partition_month"))


def by_source(bronze: DataFrame, taxi_type: str, settings: Settings) -> DataFrame:
    """Silver rows with the month of their file, of a category that repeats no record: one pass."""
    return instrumented(valid(with_source_month(bronze), taxi_type, settings, (SOURCE_MONTH,)), taxi_type, (SOURCE_MONTH,))


def fhv_candidates(bronze: DataFrame, settings: Settings) -> DataFrame:
    """Valid fhv rows, one of each content and file: those that can be the content's survivor, whatever other files hold."""
    rows = valid(with_source_month(bronze), "fhv", settings, (SOURCE_MONTH,))
    return one_per_content(rows, (SOURCE_MONTH,)).withColumn(PICKUP_MONTH, F.expr("year(pickup_datetime) * 100 + month(pickup_datetime)"))


def fhv_with_copies(candidates: DataFrame) -> DataFrame:
    """The candidates of whole months of pickup as silver rows, numbered among the copies of their content.

    Copies agree in the time of pickup, so a month of pickup has all of them, and no other month needs to be looked at.
    """
    hidden = (SOURCE_MONTH, PICKUP_MONTH, COPY)
    numbered = numbered_copies(candidates.select(*CANONICAL.fieldNames(), SOURCE_MONTH, PICKUP_MONTH), COPY)
    return by_pickup_month(instrumented(numbered, "fhv", hidden))


def by_pickup_month(clean: DataFrame) -> DataFrame:
    """Rows dealt so that those of a month of pickup lie together.

    Copies are found by content, which leaves rows of every month in every file,
    and a write partitioned by month would then open a file for each task and
    month. The rebalance hint lets adaptive execution split a month that is large
    and merge small ones.
    """
    dealt = clean.withColumn("_month", F.trunc("pickup_datetime", "month")).hint("rebalance", F.col("_month"))
    return dealt.drop("_month")
