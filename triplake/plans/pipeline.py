"""The layers as catalog tables: monthly files to bronze, silver, fact, KPIs and views."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import STORED_KPI_NAMES, TAXI_TYPES, Settings
from triplake.operators import kpi, quality
from triplake.operators.drift import drift_history
from triplake.operators.fact import fact_trips
from triplake.operators.rejects import rejected
from triplake.plans import silver as layer
from triplake.plans import versions
from triplake.plans.catalog import create_database, replace_partitions, write_table
from triplake.schema import SILVER, conformance
from triplake.session import configure
from triplake.sources.canonical import to_canonical
from triplake.sources.files import month_files
from triplake.sources.ingest import month_frames, read_months


class Pipeline:
    """Each step reads the tables of the step before, so any step can be run again alone."""

    def __init__(self, spark: SparkSession, settings: Settings = Settings()):
        self.spark, self.settings, self.names = configure(spark), settings, settings.names

    # Tables

    def bronze(self, taxi_type: str) -> DataFrame:
        return self.spark.table(self.names.bronze_table(taxi_type))

    def silver(self, taxi_type: str) -> DataFrame:
        return self.spark.table(self.names.silver_table(taxi_type))

    def gold(self, name: str) -> DataFrame:
        return self.spark.table(self.names.gold_table(name))

    def fact(self) -> DataFrame:
        return self.gold(self.names.fact)

    # Steps; each returns the rows it wrote

    def ingest(self, taxi_type: str, replace_all: bool = False) -> int:
        """The settings' months of a category in one write. A task reads one month, so no shuffle is needed.

        Months that the table has and the settings don't name stay, unless replace_all.
        """
        months = read_months(self.spark, month_files(self.settings, taxi_type))
        create_database(self.spark, self.names.bronze)
        table, keys = self.names.bronze_table(taxi_type), ["_partition_year", "_partition_month"]
        if replace_all or not self.spark.catalog.tableExists(table):
            return write_table(months, table, self.settings, keys)
        return replace_partitions(months, table, self.settings, keys, self.settings.year_months)

    def _months(self) -> list[int]:
        return [year * 100 + month for year, month in self.settings.year_months]

    def _of_months(self, bronze: DataFrame) -> DataFrame:
        named = " OR ".join(f"(_partition_year = {y} AND _partition_month = {m})" for y, m in self.settings.year_months)
        return bronze.where(named)

    def _has_months(self, table: str, column: str) -> bool:
        """Whether a stored table can be loaded by month: it exists in this layout."""
        at = versions.current(self.spark, table)
        return self.settings.table_format != "delta" and bool(at) and at != table and column in self.spark.table(at).columns

    def build_silver(self, taxi_type: str, months_only: bool = False) -> int:
        """The silver table, or only what the settings' months change in it; the rows written.

        Its files are partitioned by the month of the source file, which the contract's columns don't show. A month's load
        reads and writes that month alone. The rules are counted again by the write, before users see the result.
        """
        table, bronze = self.names.silver_table(taxi_type), self.bronze(taxi_type)
        create_database(self.spark, self.names.silver)
        seen = {"columns": SILVER.fieldNames(), "expected": quality.rule_expectations(taxi_type, self.settings)}
        if taxi_type == "fhv":
            return self._build_fhv(table, bronze, months_only, seen | {"where": layer.SEEN})
        keys = [layer.SOURCE_MONTH]
        if months_only and self._has_months(table, layer.SOURCE_MONTH):
            rows = layer.by_source(self._of_months(bronze), taxi_type, self.settings)
            return replace_partitions(rows, table, self.settings, keys, [(m,) for m in self._months()], **seen)
        return write_table(layer.by_source(bronze, taxi_type, self.settings), table, self.settings, keys, **seen)

    def _build_fhv(self, table: str, bronze: DataFrame, months_only: bool, seen: dict) -> int:
        """fhv repeats records, also across files. Stored are the candidates of all files, numbered among their copies.

        Copies share the time of pickup, so a load rebuilds the months of pickup that its files' rows have now or had
        before, from the stored candidates of the other files and the new ones, in whatever order files are loaded.
        """
        keys = list(layer.FHV_PARTITIONS)
        if not (months_only and self._has_months(table, layer.COPY)):
            rows = layer.fhv_with_copies(layer.fhv_candidates(bronze, self.settings))
            return write_table(rows, table, self.settings, keys, **seen)
        new = layer.fhv_candidates(self._of_months(bronze), self.settings)
        stored, loaded = versions.current(self.spark, table), set(self._months())
        there = versions.partitions(self.spark, stored)
        # Months of pickup: a number for each calendar month of the period at most.
        touched = {pickup for pickup, source in there if source in loaded}
        touched |= {row[0] for row in new.select(layer.PICKUP_MONTH).distinct().collect()}
        if not touched:
            return 0
        others = self.spark.table(stored).where(F.col(layer.PICKUP_MONTH).isin(*touched) & ~F.col(layer.SOURCE_MONTH).isin(*loaded))
        rows = layer.fhv_with_copies(others.select(*new.columns).unionByName(new))
        gone = [value for value in there if value[0] in touched]
        return replace_partitions(rows, table, self.settings, keys, gone, **seen)

    def _picked_up_in(self, months: Collection[int]) -> Column:
        """Pickups in some months of any year, with the ranges of time that let files be skipped."""
        years = range(self.settings.period_start.year, self.settings.period_end.year + 1)
        ends = lambda y, m: (y, m + 1) if m < 12 else (y + 1, 1)
        at = lambda y, m: f"TIMESTAMP_NTZ '{y:04d}-{m:02d}-01 00:00:00'"
        ranges = [f"(pickup_datetime >= {at(y, m)} AND pickup_datetime < {at(*ends(y, m))})" for y in years for m in months]
        return F.expr(" OR ".join(ranges)) if ranges else F.lit(False)

    def build_fact(self, pickup_months: Collection[int] | None = None) -> int:
        """The fact table, or only the partitions of some months of pickup; the rows written."""
        trips = fact_trips([self.silver(taxi_type) for taxi_type in TAXI_TYPES])
        create_database(self.spark, self.names.gold)
        table, keys = self.names.gold_table(self.names.fact), ["pickup_month"]
        expected = quality.total_expectations()
        if pickup_months is None or not self.spark.catalog.tableExists(table):
            return write_table(trips, table, self.settings, keys, expected=expected)
        trips = trips.where(self._picked_up_in(pickup_months))
        return replace_partitions(trips, table, self.settings, keys, [(month,) for month in pickup_months], expected=expected)

    def pickup_months(self, taxi_type: str) -> set[int]:
        """Months of pickup in the bronze rows of the settings' months: at most twelve numbers."""
        table = self.names.bronze_table(taxi_type)
        if not self.spark.catalog.tableExists(table):
            return set()
        rows = to_canonical(self._of_months(self.bronze(taxi_type)), taxi_type)
        found = rows.select(F.month("pickup_datetime").alias("m")).where("m IS NOT NULL").distinct()
        return {row.m for row in found.collect()}

    def load(self) -> dict[str, int]:
        """Load the settings' months into existing tables and rebuild what they touch; rows written per table.

        A file's month is not the month of pickup: fact partitions are rebuilt for the months of pickup of the rows
        that were there and of those that come, and the KPIs' partial states for the same months.
        """
        written, touched = {}, set()
        for taxi_type in TAXI_TYPES:
            touched |= self.pickup_months(taxi_type)
            written[self.names.bronze_table(taxi_type)] = self.ingest(taxi_type)
            touched |= self.pickup_months(taxi_type)
        for taxi_type in TAXI_TYPES:
            written[self.names.silver_table(taxi_type)] = self.build_silver(taxi_type, months_only=True)
        written[self.names.gold_table(self.names.fact)] = self.build_fact(sorted(touched))
        written |= {self.names.gold_table(name): rows for name, rows in self.build_kpis(sorted(touched)).items()}
        self.create_views()
        return written

    def build_kpis(self, pickup_months: Collection[int] | None = None) -> dict[str, int]:
        """The KPI tables from partial states, which are first brought up to date for some or all months of pickup.

        States of a month come from that partition of the fact table; the other months' are kept as they are.
        """
        table, keys = self.names.gold_table(self.names.kpi_states), ["pickup_month"]
        trips = self.fact()
        if pickup_months is None or not self.spark.catalog.tableExists(table):
            write_table(kpi.partial_states(trips), table, self.settings, keys)
        else:
            some = trips.where(F.col("pickup_month").isin(*pickup_months) if pickup_months else F.lit(False))
            replace_partitions(kpi.partial_states(some), table, self.settings, keys, [(m,) for m in pickup_months])
        states = self.gold(self.names.kpi_states)
        results = {
            self.names.kpi_monthly: kpi.merged_totals(states),
            self.names.kpi_hourly: kpi.merged_hourly(states, self.settings.hourly_month),
        }
        return {
            name: write_table(df.withColumnsRenamed(STORED_KPI_NAMES), self.names.gold_table(name), self.settings)
            for name, df in results.items()
        }

    def create_views(self) -> None:
        fact = self.names.gold_table(self.names.fact)
        self.spark.sql(kpi.view_sql(self.names.gold_table(self.names.view), fact))
        self.spark.sql(kpi.view_sql(self.names.gold_table(self.names.extended_view), fact, extended=True))

    def run(self) -> dict[str, int]:
        """Every step in order, replacing all tables; rows written per table."""
        written = {}
        for taxi_type in TAXI_TYPES:
            written[self.names.bronze_table(taxi_type)] = self.ingest(taxi_type, replace_all=True)
        for taxi_type in TAXI_TYPES:
            written[self.names.silver_table(taxi_type)] = self.build_silver(taxi_type)
        written[self.names.gold_table(self.names.fact)] = self.build_fact()
        for name, rows in self.build_kpis().items():
            written[self.names.gold_table(name)] = rows
        self.create_views()
        return written

    # Reports

    def monthly(self) -> DataFrame:
        """The stored monthly KPI in order, under the library's own names."""
        own = {stored: name for name, stored in STORED_KPI_NAMES.items()}
        return self.gold(self.names.kpi_monthly).withColumnsRenamed(own).orderBy("pickup_year", "pickup_month")

    def hourly(self) -> DataFrame:
        own = {stored: name for name, stored in STORED_KPI_NAMES.items()}
        return self.gold(self.names.kpi_hourly).withColumnsRenamed(own).orderBy("pickup_hour")

    def type_summary(self) -> DataFrame:
        """Trips, average total and trips with a total per category, from the partial states: the fact is not read."""
        return kpi.merged_summary(self.gold(self.names.kpi_states))

    def reconciliation(self) -> DataFrame:
        return quality.reconciliation(
            {taxi_type: self.bronze(taxi_type) for taxi_type in TAXI_TYPES},
            {taxi_type: self.silver(taxi_type) for taxi_type in TAXI_TYPES},
        )

    def violations(self) -> DataFrame:
        return quality.violations({taxi_type: self.silver(taxi_type) for taxi_type in TAXI_TYPES}, self.settings)

    def rejected(self) -> DataFrame:
        """The bronze rows that silver doesn't have, in canonical form, with the first rule each fails."""
        return rejected({t: to_canonical(self.bronze(t), t) for t in TAXI_TYPES}, self.settings)

    def drift(self, taxi_type: str) -> DataFrame:
        """How the landed files of the settings' months differ from their common schema, and the values it rewords."""
        return drift_history(month_frames(self.spark, month_files(self.settings, taxi_type)))

    def conformance(self) -> DataFrame:
        schemas = {self.names.silver_table(t): self.silver(t).schema for t in TAXI_TYPES}
        return conformance(self.spark, schemas, SILVER)

    def gold_counts(self) -> DataFrame:
        names = (self.names.fact, self.names.kpi_monthly, self.names.kpi_hourly)
        return quality.row_counts({name: self.gold(name) for name in names})
