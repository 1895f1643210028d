"""Versioned tables: readers see the old or the new slice, whatever step of a run fails."""

import threading
import uuid
from datetime import date

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.dates import DateWindow
from footfall.operators import rollup
from footfall.plans import jobs
from footfall.sources import sinks, tables, versions
from tests.test_tables import SMALL, convert_rows, rows_of
from workload import derive

DAYS = [date(2021, 1, d) for d in range(1, 6)]
OLD, NEW = {d: 1 for d in DAYS}, {DAYS[0]: 1, DAYS[1]: 1, DAYS[2]: 7, DAYS[4]: 7}


@pytest.fixture
def database(spark):
    name = "v" + uuid.uuid4().hex
    spark.sql(f"create database {name}")
    tables.create_reporting_tables(spark, name, versioned=True)
    yield name
    spark.sql(f"drop database {name} cascade")


def stored(spark, table):
    return {r.date: r.event_ct for r in spark.table(table).collect()}


def test_schema_and_slices(spark, database):
    for name, (schema, _) in tables.PARTITIONS.items():
        shown = spark.table(f"{database}.{name}").schema
        assert {f.name: f.dataType for f in shown} == {f.name: f.dataType for f in schema}
    table = f"{database}.convert_overview_summary"
    assert stored(spark, table) == {}
    sinks.replace_dates(convert_rows(spark, DAYS), table, DateWindow(DAYS[0], DAYS[-1]))
    for _ in range(2):
        sinks.replace_dates(convert_rows(spark, [DAYS[2], DAYS[4]], 7), table, DateWindow(DAYS[2], DAYS[4]))
        assert stored(spark, table) == NEW
    sinks.replace_dates(convert_rows(spark, []), table, DateWindow(DAYS[2], DAYS[4]))
    assert stored(spark, table) == {DAYS[0]: 1, DAYS[1]: 1}


STEPS = ("rows", "insert", "show partitions", "switch", "after the switch")


@pytest.mark.parametrize("step", STEPS)
def test_a_failure_at_any_step_shows_the_old_or_the_new_slice(spark, database, monkeypatch, step):
    table = f"{database}.convert_overview_summary"
    sinks.replace_dates(convert_rows(spark, DAYS), table, DateWindow(DAYS[0], DAYS[-1]))
    window = DateWindow(DAYS[2], DAYS[4])
    rows = convert_rows(spark, [DAYS[2], DAYS[4]], 7)
    before = spark.table(table)

    def fail(*_, **__):
        raise RuntimeError("stop")

    with monkeypatch.context() as patch:
        if step == "rows":
            run = convert_rows(spark, [DAYS[2], DAYS[4]], 7).withColumn("event_ct", F.expr("if(date = date'2021-01-05', bigint(raise_error('stop')), 7L)"))
        else:
            run = rows
        if step == "insert":
            patch.setattr("pyspark.sql.DataFrameWriter.insertInto", fail)
        elif step == "show partitions":
            patch.setattr(versions, "_stored", fail)
        elif step == "switch":
            patch.setattr(versions, "_show", fail)
        elif step == "after the switch":
            show = versions._show

            def shown_then_failed(*args):
                show(*args)
                fail()

            patch.setattr(versions, "_show", shown_then_failed)
        with pytest.raises(Exception, match="stop"):
            sinks.replace_dates(run, table, window)
    assert stored(spark, table) == (NEW if step == "after the switch" else OLD)
    # A reader that began before the run still reads what it saw.
    assert {r.date: r.event_ct for r in before.collect()} == OLD
    sinks.replace_dates(rows, table, window)
    assert stored(spark, table) == NEW
    versions.remove_old_versions(spark, table)
    assert stored(spark, table) == NEW
    assert spark.table(f"{table}_versions").count() == len(NEW)


def test_old_versions_go_by_age(spark, database):
    table = f"{database}.convert_overview_summary"
    marks = [versions.replace_slice(convert_rows(spark, DAYS[:2], n), table, lambda spec: True) for n in range(3)]
    assert marks == sorted(marks)
    assert versions.remove_old_versions(spark, table, before=marks[1]) == 2
    assert versions.remove_old_versions(spark, table) == 2 and versions.remove_old_versions(spark, table) == 0
    assert stored(spark, table) == {d: 2 for d in DAYS[:2]}


def test_only_the_shown_versions_are_read(spark, database):
    table = f"{database}.convert_overview_summary"
    for n in range(4):
        sinks.replace_dates(convert_rows(spark, DAYS, n), table, DateWindow(DAYS[0], DAYS[-1]))
    wanted = spark.table(table).filter(F.col("date") == DAYS[1])
    assert len(wanted.inputFiles()) >= 1
    scan = next(x for x in wanted._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "version" in scan[scan.index("PartitionFilters") :]
    wanted.collect()
    metrics = wanted._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    assert metrics.apply("numPartitions").value() == 1


def test_awkward_and_null_partition_values(spark, database):
    table = f"{database}.odd"
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])
    versions.create_versioned_table(spark, table, schema, ["name", "day"])
    names = ["it's", 'say "hi"', "a/b=c", "back\\slash", "é 日 %2F", None]
    rows = spark.createDataFrame([(i, n, None if i % 2 else DAYS[0]) for i, n in enumerate(names)], schema)
    versions.replace_slice(rows, table, lambda spec: True)
    assert {(r.n, r.name) for r in spark.table(table).collect()} == set(enumerate(names))
    versions.replace_slice(rows.filter("n = 2").withColumn("n", F.lit(20).cast("long")), table, lambda spec: spec["name"] in ("a/b=c", versions.NULL_PARTITION))
    assert {(r.n, r.name) for r in spark.table(table).collect()} == {(20 if i == 2 else i, n) for i, n in enumerate(names) if n is not None}
    versions.remove_old_versions(spark, table)
    assert spark.table(f"{table}_versions").count() == 5
    with pytest.raises(ValueError, match="no partition columns"):
        versions.create_versioned_table(spark, f"{database}.none", schema, [])


def test_threads_of_one_process_keep_each_others_slices(spark, database):
    table = f"{database}.convert_overview_summary"
    failed = []

    def run(day):
        try:
            for n in range(3):
                sinks.replace_dates(convert_rows(spark, [day], n), table, DateWindow(day, day))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(d,)) for d in DAYS]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and stored(spark, table) == {d: 2 for d in DAYS}


def test_jobs_write_the_same_tables(spark: SparkSession, database):
    logs = derive.Logs(spark, SMALL)
    for _ in range(2):
        jobs.run_reach_overview(logs.pageviews(), database, derive.AS_OF, derive.BEGIN_OFFSET, derive.END_OFFSET)
    expected = rollup.reach_overview_summary(logs.reach_events(), derive.WINDOW)
    assert rows_of(tables.read_summary(spark, f"{database}.reach_overview_summary").select(*expected.columns)) == rows_of(expected)
    jobs.run_page_insights(
        logs.pageviews(), "home", derive.home_page(), [(logs.convert_logs(), derive.engagement_labels())], [], database,
        derive.AS_OF, derive.BEGIN_OFFSET, derive.END_OFFSET, tie_break=["event_id"],
    )
    assert spark.table(f"{database}.page_insights_conversion").filter("event_name is not null").count() == 0
    assert spark.table(f"{database}.page_insights_conversion").count() == logs.home_sessions().count()
    jobs.run_ab_test(logs.pageviews(), logs.assigned_variation(), logs.metric_events(), derive.METRIC_EVENTS, derive.TEST, database, derive.AS_OF)
    assert spark.table(f"{database}.ab_variant_inference").count() == logs.ab_results().count() > 0
