"""Reporting tables: replaced slices, repeated runs and whole jobs."""

import threading
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.functions.dates import DateWindow, Years
from footfall.operators import inference, page_insights, rollup
from footfall.plans import jobs
from footfall.sources import sinks, tables
from tests.conftest import DATA
from workload import derive
from workload.scratch import scratch_table, shared_folder

SMALL = DATA.replace("sf0.01", "sf0.001")


@pytest.fixture
def database(spark):
    name = "d" + uuid.uuid4().hex
    spark.sql(f"create database {name}")
    tables.create_reporting_tables(spark, name)
    yield name
    spark.sql(f"drop database {name} cascade")


def rows_of(df):
    # as text, in which NaN equals itself
    return sorted(map(repr, df.collect()))


def convert_rows(spark, days, event_count=1):
    schema = tables.CONVERT_SUMMARY
    return spark.createDataFrame(
        [("Fully Segmented Events", d, "1", "1", "2021", "x", "x", "x", "x", "x", "x", "e", event_count) for d in days],
        schema,
    )


def test_tables_have_their_declared_schema(spark, database):
    for name, (schema, _) in tables.PARTITIONS.items():
        stored = spark.table(f"{database}.{name}").schema
        assert {f.name: f.dataType for f in stored} == {f.name: f.dataType for f in schema}


def test_replace_dates(spark, database):
    table = f"{database}.convert_overview_summary"
    days = [date(2021, 1, d) for d in range(1, 6)]
    sinks.replace_dates(convert_rows(spark, days), table, DateWindow(days[0], days[-1]))
    window = DateWindow(days[2], days[4])
    for _ in range(2):
        sinks.replace_dates(convert_rows(spark, [days[2], days[4]], 7), table, window)
        got = {r.date: r.event_ct for r in spark.table(table).collect()}
        assert got == {days[0]: 1, days[1]: 1, days[2]: 7, days[4]: 7}
    sinks.replace_dates(convert_rows(spark, []), table, window)
    assert {r.date for r in spark.table(table).collect()} == {days[0], days[1]}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_failed_run_keeps_the_old_slice(spark, database):
    table = f"{database}.convert_overview_summary"
    days = [date(2021, 1, 1)]
    sinks.replace_dates(convert_rows(spark, days), table, DateWindow(days[0], days[0]))
    broken = convert_rows(spark, days).withColumn("event_ct", F.expr("bigint(raise_error('stop'))"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_dates(broken, table, DateWindow(days[0], days[0]))
    assert spark.table(table).count() == 1


def test_replace_test_keeps_other_tests(spark, database):
    table = f"{database}.ab_variant_results"

    def results(name, *metrics):
        rows = [(name, "v", "c", date(2021, 1, 1), m, *[1] * 2, *[0.5] * 8) for m in metrics]
        return spark.createDataFrame(rows, tables.AB_RESULTS)

    sinks.replace_test(results("it's", "m1", "m2"), table, "it's")
    sinks.replace_test(results("b", "m1"), table, "b")
    sinks.replace_test(results("it's", "m3"), table, "it's")
    assert {(r.testname, r.metric_name) for r in spark.table(table).collect()} == {("it's", "m3"), ("b", "m1")}
    sinks.replace_test(results("it's"), table, "it's")
    assert {r.testname for r in spark.table(table).collect()} == {"b"}


def test_replace_summary(spark, database):
    table = f"{database}.reach_overview_summary"
    window = DateWindow(date(2021, 1, 2), date(2021, 1, 3))

    def summary(rows):
        return spark.createDataFrame(
            [(a, d, None, None, None, *[None] * 6, n, n, n) for a, d, n in rows],
            ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.REACH_SUMMARY if f.name not in ("grain", "period")),
        )

    before, inside = date(2021, 1, 1), date(2021, 1, 3)
    wide = DateWindow(before, inside)
    old = [("Daily Grand Total", before, 1), ("Daily Grand Total", inside, 1), ("Fully Segmented PVs", inside, 1),
           ("Weekly Grand Total", None, 1), ("Monthly Grand Total", None, 1)]
    sinks.replace_summary(summary(old), table, wide)
    assert tables.read_summary(spark, table).count() == 5
    sinks.replace_summary(summary([("Daily Grand Total", window.first, 2), ("Weekly Grand Total", None, 2)]), table, window)
    got = {(r.analysis, r.date, r.pv_ct) for r in tables.read_summary(spark, table).collect()}
    assert got == {("Daily Grand Total", before, 1), ("Daily Grand Total", window.first, 2), ("Weekly Grand Total", None, 2)}


@pytest.mark.parametrize("touched_only", [False, True])
def test_the_writer_filters_a_summary_behind_its_aggregation(spark, database, monkeypatch, touched_only):
    plans = []

    def seen(rows, table, ordered=sinks._in_table_order):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return ordered(rows, table)

    monkeypatch.setattr(sinks, "_in_table_order", seen)
    window = DateWindow(date(2024, 1, 29), date(2024, 1, 30))
    summary = rollup.summarize(derive.Logs(spark, SMALL).reach_events(None), window)
    sinks.replace_summary(summary, f"{database}.reach_overview_summary", window, touched_only=touched_only)
    above, below = plans[0].split("Aggregate", 1)
    assert "Filter" in above and "Weekly" in above
    assert "Weekly" not in below  # a group's name is not made for every row that the roll-up counts
    got = {r.grain for r in spark.table(f"{database}.reach_overview_summary").select("grain").distinct().collect()}
    assert got == ({"daily", "weekly"} if touched_only else {"daily", "weekly", "monthly"})


def test_replace_table_ignores_dynamic_mode(spark, database):
    table = f"{database}.convert_overview_summary"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.replace_table(convert_rows(spark, [date(2021, 1, 1)]), table)
        sinks.replace_table(convert_rows(spark, [date(2021, 1, 2)]), table)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.date for r in spark.table(table).collect()] == [date(2021, 1, 2)]


def test_reach_job_by_windows_equals_one_pass(spark, database):
    logs = derive.Logs(spark, SMALL)
    for as_of in (date(2024, 1, 16), date(2024, 1, 30), date(2024, 1, 30)):
        jobs.run_reach_overview(logs.pageviews(), database, as_of, -15, 0)
    window = DateWindow(date(2024, 1, 1), date(2024, 1, 30))
    stored = tables.read_summary(spark, f"{database}.reach_overview_summary")
    whole = rollup.reach_overview_summary(logs.reach_events(None), window)
    assert rows_of(stored.select(*whole.columns)) == rows_of(whole)


def test_refresh_of_touched_periods_equals_a_full_rebuild(spark, database):
    logs = derive.Logs(spark, SMALL)
    views = logs.pageviews()
    gone = date(2024, 1, 24)
    changed = views.filter(F.to_date("time") != F.lit(gone)).withColumn("region", F.when(F.dayofmonth("time") == 26, "Iowa").otherwise(F.col("region")))

    def summary(name, *runs, **options):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{spark.conf.get('spark.checkpoint.dir')}/{name}'")
        tables.create_reporting_tables(spark, name)
        for log, as_of, begin, touched in runs:
            jobs.run_reach_overview(log, name, as_of, begin, 0, month_years=True, touched_only=touched, **options)
        return rows_of(tables.read_summary(spark, f"{name}.reach_overview_summary"))

    history = (views, date(2024, 1, 22), -21, False)
    touched = summary(database, history, (changed, date(2024, 1, 30), -8, True), (changed, date(2024, 1, 28), -5, True))
    rebuilt = summary(f"{database}_full", history, (changed, date(2024, 1, 30), -8, False), (changed, date(2024, 1, 28), -5, False))
    assert touched == rebuilt
    with pytest.raises(ValueError, match="open years"):
        summary(database, (views, date(2024, 1, 30), -1, True), years=Years(2018, 2021))


def test_touched_periods_prune_other_days(spark, database):
    logs = derive.Logs(spark, SMALL)
    jobs.run_reach_overview(logs.pageviews(), database, date(2024, 1, 30), -29, 0)
    weekly = [rollup.Analysis("Weekly", "Grand Total"), rollup.Analysis("Daily", "Grand Total")]
    window = DateWindow(date(2024, 1, 30), date(2024, 1, 30))
    plan = rollup.summarize(spark.table(f"{database}.reach_overview_events"), window, weekly, touched_only=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "2024-01-28" in text and "2024-02-03" in text


def test_convert_job(spark, database):
    logs = derive.Logs(spark, SMALL)
    for _ in range(2):
        jobs.run_convert_overview(
            logs.conversions(), logs.ads_metadata(), database, derive.AS_OF, derive.BEGIN_OFFSET, derive.END_OFFSET
        )
    expected = rollup.convert_fully_segmented(logs.convert_events(), derive.WINDOW)
    stored = spark.table(f"{database}.convert_overview_summary").select(*expected.columns)
    assert rows_of(stored) == rows_of(expected)


def test_page_insights_job(spark, database):
    logs = derive.Logs(spark, SMALL)
    for page, where in (("home", derive.home_page()), ("issues", derive.issues_page()), ("home", derive.home_page())):
        jobs.run_page_insights(
            logs.pageviews(), page, where, [(logs.convert_logs(), derive.engagement_labels())],
            [(logs.convert_logs(), derive.core_labels())], database, derive.AS_OF, derive.BEGIN_OFFSET,
            derive.END_OFFSET, tie_break=["event_id"],
        )
    assert spark.table(f"{database}.page_insights_pv").filter("page = 'issues'").count() > 0
    first = logs.home_sessions()
    for name, expected in (
        ("page_insights_engagement", page_insights.engagement(first, logs.engagement_events())),
        ("page_insights_conversion", page_insights.conversion(first, logs.core_events())),
    ):
        stored = spark.table(f"{database}.{name}").filter("page = 'home'").select(*expected.columns)
        assert rows_of(stored) == rows_of(expected)


def test_conversion_filter_and_shrinking_pages(spark, database):
    logs = derive.Logs(spark, SMALL)

    def run(as_of, **options):
        jobs.run_page_insights(
            logs.pageviews(), "home", derive.home_page(), [(logs.convert_logs(), derive.engagement_labels())],
            [(logs.convert_logs(), derive.core_labels())], database, as_of, -2, 0, tie_break=["event_id"], **options,
        )
        return {r[0] for r in spark.table(f"{database}.page_insights_pv").select("date").distinct().collect()}

    assert min(run(date(2024, 1, 20))) == date(2024, 1, 18)
    assert run(date(2024, 1, 21), conversion_filter=F.col("path") == "/plans/") == {date(2024, 1, d) for d in (19, 20, 21)}
    kept = spark.table(f"{database}.page_insights_events").filter("funnel = 'conversion'").count()
    assert kept == logs.convert_logs().filter(
        "event_type in ('purchase', 'signup') and path = '/plans/' and date(time) between '2024-01-19' and '2024-01-21'"
    ).count()


def test_two_threads_keep_each_others_partitions(spark, database):
    days = [date(2021, 1, d) for d in range(1, 6)]
    kept, whole = f"{database}.convert_overview_summary", f"{database}.ab_variant_inference"
    sinks.replace_dates(convert_rows(spark, days), kept, DateWindow(days[0], days[-1]))
    empty = spark.createDataFrame([], tables.AB_INFERENCE)
    failed = []

    def repeat(action):
        try:
            for _ in range(6):
                action()
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    one_day = convert_rows(spark, days[:1])
    threads = [
        threading.Thread(target=repeat, args=(lambda: sinks.replace_dates(one_day, kept, DateWindow(days[0], days[0])),)),
        threading.Thread(target=repeat, args=(lambda: sinks.replace_table(empty, whole),)),
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert {r.date for r in spark.table(kept).collect()} == set(days)


def test_ab_job(spark, database):
    logs = derive.Logs(spark, SMALL)
    for _ in range(2):
        jobs.run_ab_test(
            logs.pageviews(), logs.assigned_variation(), logs.metric_events(), derive.METRIC_EVENTS, derive.TEST,
            database, derive.AS_OF,
        )
    expected = inference.ab_variant_inference(logs.ab_results())
    stored = spark.table(f"{database}.ab_variant_inference").select(*expected.columns)
    assert rows_of(stored) == rows_of(expected)


def test_scratch_tables_use_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    table = scratch_table(spark, "probe", tables.REACH_EVENTS, ["date"])
    location = spark.sql(f"describe extended {table}").filter("col_name = 'Location'").first().data_type
    assert folder in location


@pytest.mark.parametrize("kind", ["no logs", "no labels"])
def test_page_without_events(spark, database, kind):
    logs = derive.Logs(spark, SMALL)
    given = [] if kind == "no logs" else [(logs.convert_logs(), [])]
    jobs.run_page_insights(
        logs.pageviews(), "home", derive.home_page(), given, given, database, derive.AS_OF, derive.BEGIN_OFFSET, derive.END_OFFSET,
        tie_break=["event_id"],
    )
    sessions = logs.home_sessions().count()
    for funnel in ("engagement", "conversion"):
        stored = spark.table(f"{database}.page_insights_{funnel}")
        assert stored.count() == sessions > 0 and stored.filter("event_type is not null").count() == 0
