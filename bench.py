"""Time the pipeline and the headline queries; print one JSON line.

The stand-in sources are written once as monthly-style files. From there every
step is timed as users run it: files to bronze, silver, fact and KPI tables,
then questions and checks over the stored tables. A second group times queries
straight from the driver's tables, raw rows to result. All results are consumed
in full, by a table write or the noop sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from dataclasses import replace

from triplake.config import FILE_PREFIXES, TAXI_TYPES
from triplake.operators import audit, kpi, quality
from triplake.plans.pipeline import Pipeline
from triplake.plans.registry import all_queries
from triplake.session import local_session
from triplake.sources import standins

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

FROM_RAW = (
    "canonical_yellow",
    "silver_yellow",
    "dedup_fhv",
    "fact_trips",
    "kpi_monthly",
    "kpi_hourly",
    "type_summary",
    "removed_by_rule",
    "bronze_union_months",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def land(spark, folder: str) -> dict[str, tuple[tuple[int, int], ...]]:
    """A file per month of each category, as a folder of part files; the months landed.

    Spark cannot store untyped columns, so the all-empty ones are left out.
    """
    months = {}
    for taxi_type in TAXI_TYPES:
        raw = standins.raw(spark, SF_DIR, taxi_type).drop("ingested_at", "source_file", "SR_Flag", "ehail_fee")
        clock = next(name for name in raw.columns if name.endswith("pickup_datetime"))
        target = f"{folder}/{taxi_type}"
        by_month = raw.selectExpr("*", f"month({clock}) AS m").repartition("m").write.partitionBy("m")
        by_month.parquet(target)
        parts = sorted(int(part[2:]) for part in os.listdir(target) if part.startswith("m="))
        for month in parts:
            os.rename(f"{target}/m={month}", f"{target}/{FILE_PREFIXES[taxi_type]}_2023-{month:02d}.parquet")
        months[taxi_type] = tuple((2023, month) for month in parts)
    return months


def main() -> None:
    work = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(CPUS, int(CPUS), **{"spark.sql.warehouse.dir": f"{work}/warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    months = land(spark, f"{work}/landing")
    settings = replace(standins.SETTINGS, landing=f"{work}/landing")
    pipeline = Pipeline(spark, settings)
    landed = {t: Pipeline(spark, replace(settings, year_months=months[t])) for t in TAXI_TYPES}

    steps = {f"ingest_{t}": lambda t=t: landed[t].ingest(t, replace_all=True) for t in TAXI_TYPES}
    steps |= {f"table_silver_{t}": lambda t=t: pipeline.build_silver(t) for t in TAXI_TYPES}
    steps["table_fact"] = pipeline.build_fact
    steps["table_kpis"] = pipeline.build_kpis
    reports = {
        "ask_monthly": lambda: kpi.yellow_totals(pipeline.fact()),
        "ask_hourly": lambda: kpi.hourly_passengers(pipeline.fact()),
        "ask_type_summary": lambda: kpi.type_summary(pipeline.fact()),
        "ask_contributors": lambda: kpi.contributors(pipeline.fact()),
        "check_violations": pipeline.violations,
        "check_reconciliation": pipeline.reconciliation,
        "check_null_totals": lambda: quality.null_totals(pipeline.fact()),
        "audit_duration_p99": lambda: audit.duration_p99(pipeline.fact()),
        "audit_null_ratio": lambda: audit.null_ratio(pipeline.fact()),
        "audit_provider_share": lambda: audit.provider_share(pipeline.fact()),
        "audit_varying_fields": lambda: audit.varying_fields(pipeline.fact()),
        "audit_fare_conflicts": lambda: audit.fare_conflicts(pipeline.fact()),
    }
    steps |= {name: lambda build=build: consume(build()) for name, build in reports.items()}
    queries = all_queries()
    steps |= {f"raw_{name}": lambda name=name: consume(queries[name](spark, SF_DIR)) for name in FROM_RAW}

    seconds = {}
    for timed in (False, True):
        for name, step in steps.items():
            started = time.perf_counter()
            step()
            if timed:
                seconds[name] = round(time.perf_counter() - started, 3)

    rows = sum(pipeline.bronze(t).count() for t in TAXI_TYPES)
    through = sum(s for name, s in seconds.items() if name.startswith(("ingest_", "table_")))
    print(
        json.dumps(
            {
                "metric": "pipeline_and_headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "bronze_rows": rows,
                "pipeline_rows_per_sec": round(rows / through),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
