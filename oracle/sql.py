"""The queries again in DuckDB SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

TYPES = ("yellow", "green", "hvfhv", "fhv")

# Each category's stand-in rows as canonical columns (FIXTURES.md, section 3).
CANONICAL = {
    "yellow": """
        SELECT 'yellow' AS taxi_type, pickup AS pickup_datetime,
               pickup + to_seconds(CAST((l_quantity * 60 - 120)
                   * CASE WHEN l_linenumber = 7 THEN 40 ELSE 1 END AS BIGINT)) AS dropoff_datetime,
               CAST(l_suppkey AS VARCHAR) AS provider_id, CAST(NULL AS VARCHAR) AS dispatch_base_id,
               CAST(l_partkey % 263 + 1 AS INTEGER) AS pickup_location_id,
               CAST(l_suppkey % 263 + 1 AS INTEGER) AS dropoff_location_id,
               CAST(l_linenumber - 1 AS INTEGER) AS passenger_count,
               l_quantity * 5 AS trip_distance,
               CASE WHEN l_quantity = 10 THEN 0.0 ELSE l_extendedprice - 2000 END AS fare_amount,
               l_discount * 100 - 1 AS tip_amount,
               CASE WHEN l_quantity = 10 THEN 0.0
                    ELSE l_extendedprice - 2000 + l_quantity * 10 - 250 END AS total_amount,
               CAST(NULL AS BOOLEAN) AS is_shared_ride, CAST(NULL AS DOUBLE) AS base_passenger_fare,
               CAST(NULL AS DOUBLE) AS tolls, CAST(NULL AS DOUBLE) AS bcf, CAST(NULL AS DOUBLE) AS sales_tax,
               CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
               'lineitem.parquet' AS source_file
        FROM (SELECT *, l_shipdate + to_seconds(CAST(l_partkey % 24 * 3600 AS BIGINT)) AS pickup FROM lineitem)""",
    "green": """
        SELECT 'green' AS taxi_type, pickup AS pickup_datetime,
               pickup + to_seconds(CAST((o_custkey % 60 - 2) * 60
                   * CASE WHEN o_orderkey % 50 = 0 THEN 40 ELSE 1 END AS BIGINT)) AS dropoff_datetime,
               CAST(o_custkey % 2 + 1 AS VARCHAR) AS provider_id, CAST(NULL AS VARCHAR) AS dispatch_base_id,
               CAST(o_custkey % 263 + 1 AS INTEGER) AS pickup_location_id,
               CAST(o_orderkey % 263 + 1 AS INTEGER) AS dropoff_location_id,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 7 AS INTEGER) END AS passenger_count,
               CAST(o_orderkey % 250 AS DOUBLE) AS trip_distance,
               o_totalprice - 5000 AS fare_amount,
               CAST(o_orderkey % 21 - 1 AS DOUBLE) AS tip_amount,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice - 6000
                    ELSE o_totalprice - 4000 END AS total_amount,
               CAST(NULL AS BOOLEAN) AS is_shared_ride, CAST(NULL AS DOUBLE) AS base_passenger_fare,
               CAST(NULL AS DOUBLE) AS tolls, CAST(NULL AS DOUBLE) AS bcf, CAST(NULL AS DOUBLE) AS sales_tax,
               CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
               'orders.parquet' AS source_file
        FROM (SELECT *, o_orderdate + to_seconds(CAST(o_orderkey % 24 * 3600 AS BIGINT)) AS pickup FROM orders)""",
    "hvfhv": """
        SELECT 'hvfhv' AS taxi_type, ts AS pickup_datetime,
               ts + to_seconds(CAST(floor(value) AS BIGINT) * 30 - 60) AS dropoff_datetime,
               event_type AS provider_id, 'B' || CAST(user_id AS VARCHAR) AS dispatch_base_id,
               CAST(user_id % 263 + 1 AS INTEGER) AS pickup_location_id,
               CAST(event_id % 263 + 1 AS INTEGER) AS dropoff_location_id,
               CAST(NULL AS INTEGER) AS passenger_count,
               value AS trip_distance, CAST(NULL AS DOUBLE) AS fare_amount,
               CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value / 10 - 1 END AS tip_amount,
               CAST(NULL AS DOUBLE) AS total_amount,
               CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_shared_ride,
               CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE value - 5 END AS base_passenger_fare,
               CAST(event_id % 10 AS DOUBLE) AS tolls, CAST(0.5 AS DOUBLE) AS bcf,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 8 END AS sales_tax,
               CAST(2.75 AS DOUBLE) AS congestion_surcharge,
               CASE WHEN event_id % 2 = 0 THEN CAST(2.5 AS DOUBLE) END AS airport_fee,
               'events.parquet' AS source_file
        FROM events""",
    "fhv": """
        SELECT 'fhv' AS taxi_type, l_shipdate AS pickup_datetime,
               l_shipdate + to_seconds(CAST((l_linenumber - 1) * 3600
                   * CASE WHEN l_suppkey % 10 = 0 THEN 5 ELSE 1 END AS BIGINT)) AS dropoff_datetime,
               'B' || CAST(l_suppkey AS VARCHAR) AS provider_id, CAST(NULL AS VARCHAR) AS dispatch_base_id,
               CASE WHEN l_suppkey % 5 = 0 THEN CAST(l_suppkey AS INTEGER) END AS pickup_location_id,
               CASE WHEN l_suppkey % 4 = 0 THEN CAST(l_linenumber AS INTEGER) END AS dropoff_location_id,
               CAST(NULL AS INTEGER) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
               CAST(NULL AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS tip_amount,
               CAST(NULL AS DOUBLE) AS total_amount, CAST(NULL AS BOOLEAN) AS is_shared_ride,
               CAST(NULL AS DOUBLE) AS base_passenger_fare,
               CAST(NULL AS DOUBLE) AS tolls, CAST(NULL AS DOUBLE) AS bcf, CAST(NULL AS DOUBLE) AS sales_tax,
               CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
               'lineitem.parquet' AS source_file
        FROM lineitem""",
}

_KNOWN = "pickup_datetime IS NOT NULL"
_PERIOD = "pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '2024-01-25'"
_ORDER = "pickup_datetime <= dropoff_datetime"
_DURATION = "date_diff('second', pickup_datetime, dropoff_datetime) <= 86400"
_DISTANCE = "trip_distance >= 0 AND trip_distance <= 200"
_CLOCK = [
    ("pickup_known", _KNOWN),
    ("pickup_in_period", _PERIOD),
    ("pickup_before_dropoff", _ORDER),
    ("duration_plausible", _DURATION),
]
_METERED = [
    ("fare_amount_not_negative", "fare_amount >= 0"),
    ("total_amount_not_negative", "total_amount >= 0"),
    *_CLOCK,
    ("distance_plausible", _DISTANCE),
]
RULES = {
    "yellow": _METERED,
    "green": _METERED,
    "hvfhv": [
        ("base_passenger_fare_not_negative", "base_passenger_fare >= 0"),
        *_CLOCK,
        ("distance_plausible", _DISTANCE),
    ],
    "fhv": _CLOCK,
}

_METERED_FLAGS = (
    "tip_amount < 0 OR total_amount < fare_amount",
    "trip_distance > 0 AND fare_amount = 0 AND total_amount = 0",
)
FLAGS = {
    "yellow": _METERED_FLAGS,
    "green": _METERED_FLAGS,
    "hvfhv": ("tip_amount < 0", "trip_distance > 0 AND base_passenger_fare = 0 AND tip_amount = 0"),
    "fhv": ("false", "false"),
}


def _text(name: str) -> str:
    return f"coalesce(CAST({name} AS VARCHAR), 'null')"


def _sha(*names: str) -> str:
    return "sha256(" + " || '|' || ".join(_text(n) for n in names) + ")"


_RECORD_HASH = _sha(
    "taxi_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
    "provider_id", "trip_distance", "fare_amount",
)
_RIDE_KEY = _sha(
    "taxi_type", "provider_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"
)

_TOTAL = (
    "coalesce(base_passenger_fare, 0) + coalesce(tip_amount, 0) + coalesce(tolls, 0) + coalesce(bcf, 0)"
    " + coalesce(sales_tax, 0) + coalesce(congestion_surcharge, 0) + coalesce(airport_fee, 0)"
)


def _keyed(source: str, taxi_type: str) -> str:
    inconsistent, free = FLAGS[taxi_type]
    return (
        f"SELECT *, {_RECORD_HASH} AS record_hash, {_RIDE_KEY} AS ride_key,"
        f" ({inconsistent}) AS financial_inconsistency_flag, ({free}) AS zero_fare_with_distance_flag FROM {source}"
    )


def _valid(taxi_type: str) -> str:
    condition = " AND ".join(f"({c})" for _, c in RULES[taxi_type])
    return f"SELECT * FROM canonical_{taxi_type} WHERE {condition}"


_ONE_COPY = (
    "SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER"
    " (PARTITION BY record_hash ORDER BY source_file, is_shared_ride) AS copy FROM valid_fhv) WHERE copy = 1"
)


def _all(prefix: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM {prefix}_{t}" for t in TYPES)


def _ctes() -> dict[str, str]:
    ctes = {f"canonical_{t}": CANONICAL[t] for t in TYPES}
    ctes |= {f"kept_{t}": _valid(t) for t in TYPES}
    ctes |= {f"valid_{t}": _keyed(f"kept_{t}", t) for t in TYPES}
    ctes |= {
        f"corrected_{t}": f"SELECT * FROM kept_{t} UNION ALL SELECT * REPLACE (total_amount + 2 AS total_amount,"
        " base_passenger_fare + 1 AS base_passenger_fare, coalesce(NOT is_shared_ride, true) AS is_shared_ride)"
        f" FROM kept_{t}"
        for t in TYPES
    }
    ctes |= {f"reissued_{t}": _keyed(f"corrected_{t}", t) for t in TYPES}
    ctes |= {f"unruled_{t}": _keyed(f"canonical_{t}", t) for t in TYPES}
    ctes |= {f"silver_{t}": f"SELECT * FROM valid_{t}" for t in TYPES if t != "fhv"}
    ctes["silver_fhv"] = _ONE_COPY
    ctes |= {f"{layer}_all": _all(layer) for layer in ("canonical", "valid", "reissued", "silver")}
    ctes["fact"] = f"""
        SELECT * EXCLUDE (total_amount),
               CASE WHEN taxi_type = 'hvfhv' THEN {_TOTAL} ELSE total_amount END AS total_amount,
               CAST(pickup_datetime AS DATE) AS pickup_date,
               CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
               CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
               CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour
        FROM silver_all"""
    ctes["trips_view"] = """
        SELECT taxi_type, provider_id AS "VendorID", passenger_count, total_amount,
               pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime
        FROM fact"""
    ctes["monthly"] = """
        SELECT pickup_year, pickup_month, round(avg(total_amount), 2) AS avg_total_amount,
               count(*) AS n_trips, round(sum(total_amount), 2) AS total_revenue
        FROM fact WHERE taxi_type = 'yellow' GROUP BY ALL"""
    ctes["hourly"] = """
        SELECT pickup_hour, round(avg(passenger_count), 4) AS avg_passenger_count, count(*) AS n_trips
        FROM fact WHERE pickup_month = 5 AND passenger_count > 0 GROUP BY ALL"""
    return ctes


_CTES = _ctes()


def _query(body: str) -> str:
    """The body with the CTEs it needs, directly or through others, in their order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name, definition in _CTES.items():
            if name not in needed and f"FROM {name}" in text:
                needed.add(name)
                todo.append(definition)
    parts = [f"{name} AS ({definition})" for name, definition in _CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _by_type(select: str, sources: str, group: str = "taxi_type") -> str:
    return f"SELECT {select} FROM {sources} GROUP BY {group}"


def _violations(prefix: str) -> str:
    checks = [
        f"SELECT '{t}' AS taxi_type, '{name}' AS check_name,"
        f" count(*) FILTER (WHERE NOT ({condition})) AS n_violations FROM {prefix}_{t}"
        for t in TYPES
        for name, condition in RULES[t]
    ]
    checks.append(
        "SELECT 'fhv' AS taxi_type, 'record_hash_unique' AS check_name, count(*) AS n_violations"
        f" FROM (SELECT record_hash FROM {prefix}_fhv GROUP BY record_hash HAVING count(*) > 1)"
    )
    return " UNION ALL ".join(checks)


def _rejected_rows() -> str:
    reports = []
    for t in TYPES:
        cases = " ".join(f"WHEN ({c}) IS NOT TRUE THEN '{name}'" for name, c in RULES[t])
        reports.append(f"SELECT * FROM (SELECT *, CASE {cases} END AS rule FROM canonical_{t}) WHERE rule IS NOT NULL")
    order = "PARTITION BY record_hash ORDER BY source_file, is_shared_ride"
    added = "copy, record_hash, ride_key, financial_inconsistency_flag, zero_fare_with_distance_flag"
    numbered = f"SELECT *, row_number() OVER ({order}) AS copy FROM valid_fhv"
    reports.append(f"SELECT * EXCLUDE ({added}), 'not_a_duplicate' AS rule FROM ({numbered}) WHERE copy > 1")
    return " UNION ALL BY NAME ".join(reports)


def _removed_by_rule() -> str:
    reports = []
    for t in TYPES:
        cases = " ".join(f"WHEN ({c}) IS NOT TRUE THEN '{name}'" for name, c in RULES[t])
        reports.append(
            f"SELECT '{t}' AS taxi_type, rule, count(*) AS n_removed"
            f" FROM (SELECT CASE {cases} END AS rule FROM canonical_{t}) WHERE rule IS NOT NULL GROUP BY rule"
        )
    reports.append(
        "SELECT 'fhv' AS taxi_type, 'not_a_duplicate' AS rule,"
        " count(*) - count(DISTINCT record_hash) AS n_removed FROM valid_fhv"
    )
    return " UNION ALL ".join(reports)


def _reconciliation() -> str:
    rows = [
        f"SELECT '{t}' AS taxi_type, (SELECT count(*) FROM canonical_{t}) AS bronze_rows,"
        f" (SELECT count(*) FROM silver_{t}) AS silver_rows"
        for t in TYPES
    ]
    return (
        "SELECT *, bronze_rows - silver_rows AS removed_rows,"
        " round((bronze_rows - silver_rows) / bronze_rows * 100, 1) AS removed_pct"
        f" FROM ({' UNION ALL '.join(rows)})"
    )


_MEASURED = (
    "pickup_datetime", "dropoff_datetime", "provider_id", "dispatch_base_id", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
    "is_shared_ride", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
    "airport_fee", "source_file",
)
_OUTSIDE_HASH = (
    "dispatch_base_id", "passenger_count", "tip_amount", "total_amount", "is_shared_ride", "base_passenger_fare",
    "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "source_file",
)


def _null_ratio() -> str:
    return " UNION ALL ".join(
        f"SELECT taxi_type, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) / count(*) AS null_ratio"
        " FROM canonical_all GROUP BY taxi_type"
        for c in _MEASURED
    )


def _varying_fields() -> str:
    # A NULL counts as one more value next to the distinct ones.
    return " UNION ALL ".join(
        f"SELECT taxi_type, count(*) AS n_groups, '{c}' AS column_name,"
        " count(*) FILTER (WHERE n_values > 1) AS n_varying FROM"
        f" (SELECT taxi_type, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_values"
        " FROM valid_all GROUP BY taxi_type, record_hash HAVING count(*) > 1) GROUP BY taxi_type"
        for c in _OUTSIDE_HASH
    )


_DRIFTED = """
    SELECT CAST(l_suppkey AS BIGINT) AS "VendorID", l_shipdate AS pickup_datetime, l_quantity AS trip_distance,
           l_extendedprice AS total_amount, l_discount AS tip_amount, CAST(l_linenumber AS VARCHAR) AS payment_type,
           CAST(NULL AS DOUBLE) AS ehail_fee, 'drift_2023-01.parquet' AS source_file,
           2023 AS _partition_year, 1 AS _partition_month FROM lineitem
    UNION ALL
    SELECT CAST(o_custkey AS BIGINT), o_orderdate, CAST(o_orderkey AS DOUBLE), o_totalprice, NULL, o_orderpriority,
           NULL, 'drift_2023-02.parquet', 2023, 2 FROM orders
    UNION ALL
    SELECT user_id, ts, value, NULL, NULL, event_type, value, 'drift_2023-03.parquet', 2023, 3 FROM events
"""

_P99 = """
    SELECT taxi_type, quantile_cont(seconds, 0.99) AS p99_seconds, max(seconds) AS max_seconds
    FROM (SELECT taxi_type, date_diff('second', pickup_datetime, dropoff_datetime) AS seconds FROM silver_all)
    GROUP BY taxi_type
"""

_OUTLIERS = """
    SELECT taxi_type, max(trip_distance) AS max_distance,
           max(CASE WHEN place = 1 THEN provider_id END) AS max_provider_id,
           count(*) FILTER (WHERE trip_distance > 200) AS n_over_bound
    FROM (SELECT *, row_number() OVER (PARTITION BY taxi_type ORDER BY trip_distance DESC, provider_id DESC) AS place
          FROM canonical_all WHERE trip_distance IS NOT NULL)
    GROUP BY taxi_type
"""

_SHARE = """
    SELECT taxi_type, provider_id, count(*) AS n_trips,
           count(*) / CAST(sum(count(*)) OVER (PARTITION BY taxi_type) AS DOUBLE) AS share
    FROM silver_all GROUP BY taxi_type, provider_id
"""

_CONFLICTS = """
    SELECT taxi_type, ride_key, count(*) AS n_rows, min(fare) AS lowest_fare, max(fare) AS highest_fare
    FROM (SELECT *, coalesce(base_passenger_fare, fare_amount) AS fare FROM valid_all)
    GROUP BY taxi_type, ride_key HAVING count(DISTINCT fare) > 1
"""

_REPEATS = """
    SELECT taxi_type, count(*) AS n_rides, count(*) FILTER (WHERE n > 1) AS n_repeated,
           count(*) FILTER (WHERE n_fares > 1) AS n_conflicting
    FROM (SELECT taxi_type, ride_key, count(*) AS n,
                 count(DISTINCT coalesce(base_passenger_fare, fare_amount)) AS n_fares
          FROM valid_all GROUP BY taxi_type, ride_key)
    GROUP BY taxi_type
"""

_OVERLAP = """
    SELECT taxi_type, count(*) FILTER (WHERE tip_amount < 0) AS n_negative_tip,
           count(*) FILTER (WHERE total_amount < fare_amount) AS n_total_below_fare,
           count(*) FILTER (WHERE tip_amount < 0 AND total_amount < fare_amount) AS n_both,
           count(*) FILTER (WHERE trip_distance > 0 AND CASE WHEN taxi_type = 'hvfhv'
               THEN base_passenger_fare = 0 AND tip_amount > 0
               ELSE fare_amount = 0 AND total_amount > 0 END) AS n_zero_fare_charged
    FROM silver_all GROUP BY taxi_type
"""

_CHANGE = """
    SELECT pickup_year, pickup_month, avg_total_amount,
           round((avg_total_amount / lag(avg_total_amount) OVER (ORDER BY pickup_year, pickup_month) - 1) * 100, 1)
               AS change_pct,
           round((avg_total_amount / first(avg_total_amount) OVER (ORDER BY pickup_year, pickup_month) - 1) * 100, 1)
               AS growth_pct
    FROM monthly
"""

_EXTREMES = """
    SELECT (SELECT pickup_hour FROM hourly ORDER BY avg_passenger_count, pickup_hour LIMIT 1) AS lowest_hour,
           (SELECT min(avg_passenger_count) FROM hourly) AS lowest_avg,
           (SELECT pickup_hour FROM hourly ORDER BY avg_passenger_count DESC, pickup_hour LIMIT 1) AS highest_hour,
           (SELECT max(avg_passenger_count) FROM hourly) AS highest_avg,
           (SELECT pickup_hour FROM hourly ORDER BY n_trips DESC, pickup_hour LIMIT 1) AS busiest_hour,
           (SELECT max(n_trips) FROM hourly) AS busiest_trips
"""

_VIEW_MONTH = "CAST(month(tpep_pickup_datetime) AS INTEGER)"
_VIEW_HOUR = "CAST(hour(tpep_pickup_datetime) AS INTEGER)"
_AVG_TOTAL = "round(avg(total_amount), 2) AS avg_total_amount"
_AVG_PASSENGERS = "round(avg(passenger_count), 4) AS avg_passenger_count"


# Three files of fhv rows that share records; of each content and file one row is stored, numbered by file.
_COPIES = """
    SELECT 'fhv_tripdata_2023-0' || m || '.parquet' AS source_file, count(*) AS n_rows,
           count(*) FILTER (WHERE copy = 1) AS n_seen, max(copy) AS most_copies
    FROM (
      SELECT m, row_number() OVER (PARTITION BY record_hash ORDER BY m) AS copy
      FROM (
        SELECT DISTINCT record_hash, unnest(list_filter(
                 [1, CASE WHEN n % 3 = 0 THEN 2 END, CASE WHEN n % 5 = 0 THEN 3 END], lambda m: m IS NOT NULL)) AS m
        FROM (SELECT record_hash, CAST(substr(provider_id, 2) AS BIGINT) AS n FROM valid_fhv)))
    GROUP BY m"""

_TOKENS = """
    SELECT CASE WHEN l_suppkey % 10 < 3 THEN TRUE WHEN l_suppkey % 10 < 6 THEN FALSE END AS is_shared_ride,
           count(*) AS n_trips, count(*) FILTER (WHERE l_suppkey % 7 = 0) AS n_without_pickup
    FROM lineitem GROUP BY 1"""


# Each drifting file's columns: common name, own name, own type, common type, status, source column, its value as reread.
_DRIFT_FILES = {
    ("lineitem", 1): [
        ("VendorID", "VendorID", "bigint", "bigint", "same", "l_suppkey", None),
        ("pickup_datetime", "pickup_datetime", "timestamp_ntz", "timestamp_ntz", "same", "l_shipdate", None),
        ("trip_distance", "trip_distance", "double", "double", "same", "l_quantity", None),
        ("total_amount", "total_amount", "double", "double", "same", "l_extendedprice", None),
        ("tip_amount", "tip_amount", "double", "double", "same", "l_discount", None),
        ("payment_type", "payment_type", "int", "string", "retyped", "l_linenumber", "CAST(l_linenumber AS VARCHAR)"),
        ("ehail_fee", None, None, "double", "missing", "NULL", None),
    ],
    ("orders", 2): [
        ("VendorID", "VendorID", "int", "bigint", "retyped", "CAST(o_custkey AS INTEGER)", "CAST(o_custkey AS BIGINT)"),
        ("pickup_datetime", "pickup_datetime", "timestamp_ntz", "timestamp_ntz", "same", "o_orderdate", None),
        ("trip_distance", "trip_distance", "bigint", "double", "retyped", "o_orderkey", "CAST(o_orderkey AS DOUBLE)"),
        ("total_amount", "total_amount", "double", "double", "same", "o_totalprice", None),
        ("tip_amount", None, None, "double", "missing", "NULL", None),
        ("payment_type", "payment_type", "string", "string", "same", "o_orderpriority", None),
        ("ehail_fee", "ehail_fee", "void", "double", "retyped", "NULL", None),
    ],
    ("events", 3): [
        ("VendorID", "vendorid", "bigint", "bigint", "respelled", "user_id", None),
        ("pickup_datetime", "PICKUP_DATETIME", "timestamp_ntz", "timestamp_ntz", "respelled", "ts", None),
        ("trip_distance", "Trip_Distance", "double", "double", "respelled", "value", None),
        ("total_amount", None, None, "double", "missing", "NULL", None),
        ("tip_amount", None, None, "double", "missing", "NULL", None),
        ("payment_type", "payment_type", "string", "string", "same", "event_type", None),
        ("ehail_fee", "ehail_fee", "double", "double", "same", "value", None),
    ],
}


def _drift_history() -> str:
    text = lambda value: "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"
    rows = []
    for (table, month), columns in _DRIFT_FILES.items():
        for name, own, kind, common, status, value, reread in columns:
            reworded = f"count(*) FILTER (CAST({value} AS VARCHAR) <> CAST({reread} AS VARCHAR))" if reread else "0"
            rows.append(
                f"SELECT 'drift_2023-{month:02d}.parquet' AS source_file, 2023 AS file_year, {month} AS file_month, '{name}' AS column_name,"
                f" {text(own)} AS file_column, {text(kind)} AS file_type, '{common}' AS common_type, '{status}' AS status,"
                f" count(*) AS n_rows, count({value}) AS n_values, {reworded} AS n_reworded FROM {table}"
            )
    return " UNION ALL ".join(rows)


def all_sql() -> dict[str, str]:
    bodies = {"bronze_union_months": _DRIFTED, "drift_history": _drift_history()}
    for t in TYPES:
        bodies[f"canonical_{t}"] = f"SELECT * FROM canonical_{t}"
        bodies[f"silver_{t}"] = f"SELECT * FROM silver_{t}"
    bodies |= {
        "record_hash": "SELECT taxi_type, record_hash FROM valid_all",
        "ride_key": "SELECT taxi_type, ride_key FROM valid_all",
        "financial_flags": "SELECT taxi_type, financial_inconsistency_flag, zero_fare_with_distance_flag,"
        " count(*) AS n_trips FROM valid_all GROUP BY ALL",
        "dedup_fhv": "SELECT * EXCLUDE (record_hash, ride_key, financial_inconsistency_flag,"
        " zero_fare_with_distance_flag) FROM silver_fhv",
        "fact_trips": "SELECT * FROM fact",
        "type_summary": _by_type(
            f"taxi_type, count(*) AS n_trips, {_AVG_TOTAL}, count(total_amount) AS with_total_amount", "fact"
        ),
        "kpi_monthly": "SELECT * FROM monthly",
        "kpi_month_only": f"SELECT pickup_month, {_AVG_TOTAL}, count(*) AS n_trips,"
        " round(sum(total_amount), 2) AS total_revenue FROM fact WHERE taxi_type = 'yellow' GROUP BY pickup_month",
        "kpi_month_average": f"SELECT pickup_month, {_AVG_TOTAL} FROM fact"
        " WHERE taxi_type = 'yellow' GROUP BY pickup_month",
        "kpi_hourly": "SELECT * FROM hourly",
        # In whole millionths, as halves of a cent would be rounded by chance otherwise.
        "kpi_monthly_merged": "SELECT pickup_year, pickup_month, ((u * 2 + n * 10000) // (n * 20000)) / 100.0 AS avg_total_amount,"
        " n AS n_trips, ((u + 5000) // 10000) / 100.0 AS total_revenue FROM (SELECT pickup_year, pickup_month, count(*) AS n,"
        " CAST(sum(CAST(total_amount AS DECIMAL(38, 6))) * 1000000 AS HUGEINT) AS u FROM fact"
        " WHERE taxi_type = 'yellow' GROUP BY ALL)",
        "kpi_hourly_merged": "SELECT * FROM hourly",
        "type_summary_merged": _by_type(
            f"taxi_type, count(*) AS n_trips, {_AVG_TOTAL}, count(total_amount) AS with_total_amount", "fact"
        ),
        "fhv_copies_by_file": _COPIES,
        "fhv_shared_tokens": _TOKENS,
        "kpi_hourly_average": "SELECT pickup_hour, avg_passenger_count FROM hourly",
        "view_projection": "SELECT * FROM trips_view",
        "kpi_monthly_view": f"SELECT {_VIEW_MONTH} AS pickup_month, {_AVG_TOTAL} FROM trips_view"
        " WHERE taxi_type = 'yellow' GROUP BY 1",
        "kpi_hourly_view": f"SELECT {_VIEW_HOUR} AS pickup_hour, {_AVG_PASSENGERS} FROM trips_view"
        f" WHERE {_VIEW_MONTH} = 5 AND passenger_count > 0 GROUP BY 1",
        "contributors": "SELECT taxi_type, count(*) AS n_trips FROM fact"
        " WHERE pickup_month = 5 AND passenger_count > 0 GROUP BY taxi_type",
        "view_type_counts": _by_type("taxi_type, count(*) AS n_trips", "trips_view"),
        "hours_present": "SELECT count(DISTINCT pickup_hour) AS hours_present FROM hourly",
        "duplicate_hashes": "SELECT record_hash, count(*) AS n_rows FROM valid_fhv"
        " GROUP BY record_hash HAVING count(*) > 1",
        "reconciliation": _reconciliation(),
        "violations": _violations("silver"),
        "violations_before_rules": _violations("unruled"),
        "null_totals": "SELECT taxi_type, count(*) FILTER (WHERE total_amount IS NULL) AS n_null_totals"
        " FROM fact WHERE taxi_type <> 'fhv' GROUP BY taxi_type",
        "null_totals_before_rules": "SELECT taxi_type, count(*) FILTER (WHERE total_amount IS NULL) AS n_null_totals"
        " FROM canonical_all WHERE taxi_type <> 'fhv' GROUP BY taxi_type",
        "month_coverage": "SELECT count(*) AS n_months, CAST(337 AS BIGINT) AS expected,"
        " count(*) = 337 AS complete FROM monthly",
        "month_coverage_whole": "SELECT count(*) AS n_months, CAST(71 AS BIGINT) AS expected,"
        " count(*) = 71 AS complete FROM monthly",
        "sample_limit": 'SELECT * FROM trips_view ORDER BY tpep_pickup_datetime, taxi_type, "VendorID",'
        " passenger_count NULLS FIRST, total_amount NULLS FIRST, tpep_dropoff_datetime LIMIT 10",
        "duration_p99": _P99,
        "distance_outliers": _OUTLIERS,
        "null_ratio": _null_ratio(),
        "provider_share": _SHARE,
        "varying_fields": _varying_fields(),
        "fare_conflicts": _CONFLICTS,
        "ride_repeats": _REPEATS,
        "varying_fields_reissued": _varying_fields().replace("valid_all", "reissued_all"),
        "fare_conflicts_reissued": _CONFLICTS.replace("valid_all", "reissued_all"),
        "ride_repeats_reissued": _REPEATS.replace("valid_all", "reissued_all"),
        "cast_losses": " UNION ALL ".join(
            f"SELECT 'yellow' AS taxi_type, '{name}' AS column_name, count(*) AS n_lost FROM lineitem"
            f" WHERE l_linenumber = {number}"
            for name, number in (("fare_amount", 7), ("trip_distance", 1))
        ),
        "removed_by_rule": _removed_by_rule(),
        "rejected_rows": _rejected_rows(),
        "flag_overlap": _OVERLAP,
        "mom_change": _CHANGE,
        "hour_extremes": _EXTREMES,
    }
    return {name: _query(body) for name, body in bodies.items()}
