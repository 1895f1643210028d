"""What the physical plans must and must not contain."""

import pytest

from footfall.operators import classify, inference, page_insights, reports
from tests.conftest import DATA
from workload import derive
from workload.queries import registered

QUERIES = registered()
WRITERS = {
    *("window_replace", "versioned_window_replace", "summary_replace", "ab_results_replace", "reach_job_summary", "convert_job_summary"),
    *("page_reach_read", "page_insights_two_pages", "ab_job_inference"),
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_join_and_no_python(name, spark):
    plan = plan_of(QUERIES[name](spark, DATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_window_reaches_the_scan(spark):
    plan = plan_of(derive.Logs(spark, DATA).reach_events().select("date"))
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts,2024-01-17" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in pushed


def test_classification_does_not_shuffle(spark):
    assert "Exchange" not in plan_of(derive.Logs(spark, DATA).reach_events(None))


def test_reach_summary_scans_twice_and_only_needed_columns(spark):
    plan = plan_of(QUERIES["reach_overview_summary"](spark, DATA))
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange") == 4


def test_ab_results_read_each_log_once(spark):
    plan = plan_of(derive.Logs(spark, DATA).ab_results())
    # page views, variant log and two metric logs; the control is not computed a second time
    assert plan.count("FileScan") == 4


def test_first_views_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(derive.Logs(spark, DATA).home_sessions())


def without_broadcast(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = QUERIES[name](spark, DATA)
        result.collect()
        plan = plan_of(result)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return plan[: plan.index("== Initial Plan ==")]


def test_session_numbers_move_each_view_once(spark):
    plan = without_broadcast(spark, "session_pv_seq")
    # one shuffle of the views, by second; the others move counts, from a scan of three columns
    assert "Broadcast" not in plan and plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Window [row_number()") == 1
    after_window = plan[plan.index("Window [row_number()"):]
    assert "second#" in after_window[after_window.index("Exchange hashpartitioning"):].split("\n")[0]


def test_funnels_read_each_log_once(spark):
    # the page views, once for both funnels, and the two event logs
    for name in ("page_engagement_convert", "session_conversion_rate"):
        plan = without_broadcast(spark, name)
        assert plan.count("FileScan") == 3, plan


def test_dominant_session_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        events = spark.range(0, 90000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'hot', string(id % 500)) as session_id",
            "timestamp_ntz'2021-01-02 00:00:00' + make_dt_interval(0, 0, 0, id) as time",
            "'T' as event_type", "string(id) as event_name", "'D' as event_description",
        )
        views = spark.range(0, 1500, 1, 4).selectExpr(
            "'u' as user_id", "if(id % 3 = 0, 'hot', string(id % 500)) as session_id",
            "timestamp_ntz'2021-01-01 00:00:00' as time", "date'2021-01-01' as date", "'m' as device_type",
            "'r' as region", "'g' as state_group", "'c' as channel", "'/' as landing_page", "id",
        )
        first = page_insights.first_views(views, ["id"])
        result = page_insights.conversion(first, events)
        assert result.count() == 90000
        result.collect()
        assert "skew=true" in plan_of(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_generated_methods_stay_below_the_compilers_limit(spark, tmp_path):
    """HotSpot interprets methods of more than 8000 bytes. Logs are stored first, as those of a site are."""
    logs = derive.Logs(spark, DATA)
    for name in ("pageviews", "conversions"):
        getattr(logs, name)().write.parquet(str(tmp_path / name))
    views, conversions = (spark.read.parquet(str(tmp_path / name)) for name in ("pageviews", "conversions"))
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    frames = {
        "reach": classify.classify_pageviews(views, derive.WINDOW),
        "conversions": classify.classify_conversions(conversions, derive.WINDOW, logs.ads_metadata()),
        "interpretation": reports.with_interpretation(inference.ab_variant_inference(logs.ab_results())),
        "t-test": inference.ab_t_inference(logs.total_results("Sum")),
        "tables": logs.pages_by_table(),
    }
    for name, frame in frames.items():
        frame.collect()
        stages = debug.codegenStringSeq(frame._jdf.queryExecution().executedPlan())
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000, name
