"""Tables that change by one switch: failures before and after it, partitions that stay where they are, checks in the write."""

import pytest
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.plans import catalog, versions

SETTINGS = Settings()


@pytest.fixture
def table(spark, request):
    database = f"sw_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"CREATE DATABASE {database}")
    return f"{database}.trips"


def rows(spark, months, value=0):
    return spark.createDataFrame([(value, m) for m in months], "v int, m int")


def shown(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def files(spark, table):
    return {r.m: r.f for r in spark.table(table).selectExpr("m", "input_file_name() AS f").distinct().collect()}


@pytest.mark.parametrize("step", ["write_segment", "publish", "sweep"])
@pytest.mark.parametrize("partly", [False, True])
def test_a_failure_leaves_the_old_or_the_new_table(spark, table, monkeypatch, step, partly):
    catalog.write_table(rows(spark, (1, 2)), table, SETTINGS, ["m"])
    old = shown(spark, table)

    def run():
        if partly:
            catalog.replace_partitions(rows(spark, (2,), 7), table, SETTINGS, ["m"], [(2,)])
        else:
            catalog.write_table(rows(spark, (3,), 9), table, SETTINGS, ["m"])

    def dies(*args, **kwargs):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(versions, step, dies)
        with pytest.raises(RuntimeError):
            run()
    new = [(0, 1), (7, 2)] if partly else [(9, 3)]
    assert shown(spark, table) == (new if step == "sweep" else old)
    run()
    assert shown(spark, table) == new
    # What the broken run left goes with later replacements.
    run()
    run()
    assert shown(spark, table) == new and len(versions.stored_tables(spark, table)) <= 5


def test_a_write_that_fails_leaves_the_old_table(spark, table):
    catalog.write_table(rows(spark, (1,)), table, SETTINGS, ["m"])
    bad = rows(spark, (2,)).withColumn("v", F.raise_error("no such file").cast("int"))
    with pytest.raises(Exception, match="no such file"):
        catalog.write_table(bad, table, SETTINGS, ["m"])
    assert shown(spark, table) == [(0, 1)]
    assert catalog.write_table(rows(spark, (2,)), table, SETTINGS, ["m"]) == 1
    assert shown(spark, table) == [(0, 2)]


def test_other_partitions_keep_their_files(spark, table):
    catalog.write_table(rows(spark, (1, 2, 3)), table, SETTINGS, ["m"])
    before = files(spark, table)
    assert catalog.replace_partitions(rows(spark, (2,), 5), table, SETTINGS, ["m"], [(2,)]) == 1
    assert catalog.replace_partitions(rows(spark, (4,), 6), table, SETTINGS, ["m"], [(4,)]) == 1
    after = files(spark, table)
    assert shown(spark, table) == [(0, 1), (0, 3), (5, 2), (6, 4)]
    assert {m: after[m] for m in (1, 3)} == {m: before[m] for m in (1, 3)} and after[2] != before[2]
    # A partition without rows goes; month filters still read one directory.
    assert catalog.replace_partitions(rows(spark, ()), table, SETTINGS, ["m"], [(1,)]) == 0
    assert shown(spark, table) == [(0, 3), (5, 2), (6, 4)]
    plan = spark.table(table).where("m = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_new_columns_leave_files_and_wider_types_write_once(spark, table):
    catalog.write_table(rows(spark, (1, 2)), table, SETTINGS, ["m"])
    before = files(spark, table)
    more = rows(spark, (2,), 5).selectExpr("v", "'new' AS extra", "m")
    assert catalog.replace_partitions(more, table, SETTINGS, ["m"], [(2,)]) == 1
    assert sorted(map(str, spark.table(table).select("v", "extra", "m").collect())) == ["Row(v=0, extra=None, m=1)", "Row(v=5, extra='new', m=2)"]
    assert files(spark, table)[1] == before[1]
    wide = spark.createDataFrame([(2**40, 2)], "v long, m int")
    assert catalog.replace_partitions(wide, table, SETTINGS, ["m"], [(2,)]) == 1
    assert sorted((r.v, r.extra, r.m) for r in spark.table(table).collect()) == [(0, None, 1), (2**40, None, 2)]
    assert spark.table(table).schema["v"].dataType.simpleString() == "bigint"


def test_a_violated_expectation_leaves_the_old_table(spark, table):
    negative = {"not negative": F.count_if(F.col("v") < 0)}
    catalog.write_table(rows(spark, (1, 2)), table, SETTINGS, ["m"], expected=negative)
    for run in (
        lambda df: catalog.write_table(df, table, SETTINGS, ["m"], expected=negative),
        lambda df: catalog.replace_partitions(df, table, SETTINGS, ["m"], [(2,)], expected=negative),
    ):
        before = versions.stored_tables(spark, table)
        with pytest.raises(versions.Unexpected, match="not negative: 1 rows"):
            run(rows(spark, (2,), -1))
        assert shown(spark, table) == [(0, 1), (0, 2)] and versions.stored_tables(spark, table) == before


def test_hidden_columns_and_rows(spark, table):
    seen = {"columns": ["v"], "where": "m > 1"}
    assert catalog.write_table(rows(spark, (1, 2)), table, SETTINGS, ["m"], **seen) == 1
    assert shown(spark, table) == [(0,)] and spark.table(versions.current(spark, table)).count() == 2
    assert catalog.replace_partitions(rows(spark, (2, 3), 4), table, SETTINGS, ["m"], [(2,), (3,)], **seen) == 2
    assert shown(spark, table) == [(4,), (4,)] and spark.table(versions.current(spark, table)).count() == 3
    assert {r.tableName for r in catalog.list_tables(spark, table.split(".")[0]).collect()} == {"trips"}


def test_a_table_of_the_earlier_layout_is_taken_over(spark, table):
    rows(spark, (1, 2)).write.partitionBy("m").saveAsTable(table)
    assert versions.current(spark, table) == table
    assert catalog.replace_partitions(rows(spark, (2,), 5), table, SETTINGS, ["m"], [(2,)]) == 1
    assert shown(spark, table) == [(0, 1), (5, 2)]
    assert versions.current(spark, table) != table


def test_readers_of_the_version_before_go_on(spark, table):
    catalog.write_table(rows(spark, (1, 2)), table, SETTINGS, ["m"])
    reader = spark.table(table)
    catalog.write_table(rows(spark, (3,)), table, SETTINGS, ["m"])
    assert sorted(tuple(r) for r in reader.collect()) == [(0, 1), (0, 2)]
