"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Dates and timestamps are shown as text and doubles rounded to nine places, so that two engines can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import rules
from footfall.functions.dates import DateWindow, Years, calendar_columns, reporting_year
from footfall.functions.urls import traffic_source
from footfall.operators import classify, experiments, inference, monitoring, page_insights, reports, rollup, rule_tables
from footfall.plans import jobs
from footfall.sources import sinks, tables, versions
from workload.derive import (
    AS_OF,
    BEGIN_OFFSET,
    END_OFFSET,
    LONG_TEST,
    METRIC_EVENTS,
    TEST,
    WINDOW,
    Logs,
    convert_labels,
    core_labels,
    engagement_labels,
    home_page,
    issues_page,
)
from workload.scratch import scratch_reporting, scratch_table, scratch_versioned

# The years that the report of old covers; other queries leave them open.
YEARS = Years(2018, 2021)
REPORT_DATE = TEST.last_report(AS_OF)
REPORT_METRICS = ["DefaultEventName Rate"]


def comparable(result: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 9) + F.lit(0.0)
        return column.alias(field.name)

    return result.select(*[shown(f) for f in result.schema])


def state_group(logs: Logs) -> DataFrame:
    return logs.hits().select("event_id", "region", rules.state_group().alias("state_group"))


def state_group_page(logs: Logs) -> DataFrame:
    group = rules.state_group("region", rules.PAGE_STATE_GROUPS)
    return logs.hits().select("event_id", "region", group.alias("state_group"))


def page_name(logs: Logs) -> DataFrame:
    return classify.with_pages(logs.hits()).select("event_id", "domain", "path", "page_name")


def page_job(logs: Logs) -> DataFrame:
    return classify.with_pages(logs.hits()).select("event_id", "domain", "path", "page_job")


def page_name_from_table(logs: Logs) -> DataFrame:
    return logs.pages_by_table().select("event_id", "domain", "path", "page_name")


def page_job_from_table(logs: Logs) -> DataFrame:
    return logs.pages_by_table().select("event_id", "domain", "path", "page_job")


def channel_from_table(logs: Logs) -> DataFrame:
    rules_of_channels = rule_tables.channel_rule_table(logs.spark)
    return rule_tables.with_channel_by_table(logs.hits(), rules_of_channels).select("event_id", "channel")


def source(logs: Logs) -> DataFrame:
    return logs.hits().select("event_id", "query", traffic_source(F.col("query")).alias("source"))


def channel(logs: Logs) -> DataFrame:
    return classify.with_channel(logs.hits()).select("event_id", "channel")


def convert_event(logs: Logs) -> DataFrame:
    return classify.label_events(logs.convert_logs(), convert_labels(), "convert_event").select(
        "event_id", "convert_event"
    )


def engagement_label(logs: Logs) -> DataFrame:
    return page_insights.page_engagement_events(logs.convert_logs(), WINDOW, home_page(), engagement_labels())


def calendar(logs: Logs) -> DataFrame:
    orders = logs.spark.read.parquet(f"{logs.sf_dir}/orders.parquet")
    day = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        day.alias("date"),
        *[c.alias(n) for n, c in calendar_columns(day, YEARS).items()],
        reporting_year(day).cast("string").alias("open_wk_yr"),
    )


def date_window_filter(logs: Logs) -> DataFrame:
    return classify.rows_in_window(logs.pageviews(), WINDOW).select("event_id", F.to_date("time").alias("date"))


def exposure_path_filter(logs: Logs) -> DataFrame:
    exposed = F.col("path").isin(*TEST.exposure_paths)
    return classify.rows_in_window(logs.pageviews(), TEST.window, exposed).select("event_id", "time", "path")


def page_filter_hook(logs: Logs) -> DataFrame:
    audience = (F.col("domain") == "elizabethwarren.com") & ~F.col("path").startswith("/es") & (
        F.col("device_type") != "Tablet"
    )
    return classify.rows_in_window(logs.pageviews(), WINDOW, audience).select("event_id", "path", "device_type")


def ads_source_join(logs: Logs) -> DataFrame:
    events = logs.convert_logs().select("event_id", traffic_source(F.col("query")).alias("source"))
    return classify.join_publishers(events, logs.ads_metadata()).select("event_id", "source", "publisher")


def reach_analysis(analysis: rollup.Analysis) -> Callable[[Logs], DataFrame]:
    window = WINDOW if analysis.grain == "Daily" else None
    return lambda logs: rollup.summarize(logs.reach_events(window), WINDOW, [analysis], years=YEARS)


def reach_overview_summary(logs: Logs) -> DataFrame:
    return rollup.reach_overview_summary(logs.reach_events(None), WINDOW, YEARS)


def session_pv_seq(logs: Logs) -> DataFrame:
    return page_insights.with_session_sequence(logs.home_views(), ["event_id"])


def page_sessions(logs: Logs) -> DataFrame:
    return logs.home_sessions().drop("event_id")


def page_engagement(logs: Logs) -> DataFrame:
    return page_insights.engagement(logs.home_sessions(), logs.engagement_events())


def page_conversion(logs: Logs) -> DataFrame:
    return page_insights.conversion(logs.home_sessions(), logs.core_events())


def page_engagement_convert(logs: Logs) -> DataFrame:
    return page_engagement(logs).unionByName(page_conversion(logs))


def session_conversion_rate(logs: Logs) -> DataFrame:
    first = logs.home_sessions()
    engaged = page_insights.engagement(first, page_insights.latest_per_session(logs.engagement_events()), combined=True)
    converted = page_insights.conversion(first, page_insights.latest_per_session(logs.core_events()), combined=True)
    return page_insights.session_conversion_rate(engaged.unionByName(converted))


def first_variant_logs(logs: Logs) -> DataFrame:
    return experiments.first_variant_logs(logs.assigned_variation(), TEST)


def experiment_dates(logs: Logs) -> DataFrame:
    """Every reported day of the test with the sessions first logged on it."""
    first_logs = experiments.first_variant_logs(logs.assigned_variation(), TEST)
    sessions = first_logs.groupBy(F.to_date("first_log_time").alias("reporting_date")).agg(
        F.count_distinct("session_id").alias("sessions")
    )
    dates = experiments.experiment_dates(logs.spark, TEST, AS_OF)
    return dates.join(sessions, "reporting_date", "left").fillna(0, ["sessions"])


def user_date_pairs(logs: Logs) -> DataFrame:
    return experiments.user_date_pairs(logs.exposed(), TEST, AS_OF)


def user_metric_events(logs: Logs) -> DataFrame:
    return experiments.user_metric_events(logs.exposed(), experiments.metric_event_days(logs.metric_events(), TEST))


def user_cumulative_proportion(logs: Logs) -> DataFrame:
    return experiments.user_cumulative_proportion(logs.conversions_by_user(), TEST, AS_OF)


def variant_stats(logs: Logs) -> DataFrame:
    counts = experiments.cumulative_counts(logs.conversions_by_user(), TEST, AS_OF)
    return experiments.variant_stats(counts, TEST)


def variant_n(logs: Logs) -> DataFrame:
    return experiments.variant_n(logs.exposed(), TEST, AS_OF)


def rounded(result: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to fewer places, for sums that two engines add in different orders."""
    return result.select(
        *[F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in result.schema]
    )


def ab_inference(logs: Logs) -> DataFrame:
    return inference.ab_variant_inference(logs.ab_results())


def ab_significance(logs: Logs) -> DataFrame:
    return reports.with_significance(ab_inference(logs)).select(
        *reports.RESULT_KEY, "p_value", "diff", "is_significant", "color_class"
    )


def ab_interpretation(logs: Logs) -> DataFrame:
    return reports.with_interpretation(ab_inference(logs)).select(*reports.RESULT_KEY, "interpretation")


def ab_report_slice(logs: Logs) -> DataFrame:
    return reports.report_slice(ab_inference(logs), TEST.testname, REPORT_DATE, REPORT_METRICS)


def ab_variant_counts(logs: Logs) -> DataFrame:
    return reports.variant_counts(ab_inference(logs))


def ab_daily_series(logs: Logs) -> DataFrame:
    return reports.daily_series(ab_inference(logs))


def _without_one_day(logs: Logs) -> DataFrame:
    """Events of a re-run whose last day but two has no rows any more."""
    return logs.reach_events().filter(F.col("date") != F.date_sub(F.lit(AS_OF), 2))


def versioned_window_replace(logs: Logs) -> DataFrame:
    """The same on a versioned table, whose window changes in one step; old versions are removed."""
    table = scratch_versioned(logs.spark, "versioned_window", tables.REACH_EVENTS, ["date"])
    versions.replace_slice(logs.reach_events(None).withColumn("channel", F.lit("old")), table, lambda spec: True)
    sinks.replace_dates(_without_one_day(logs), table, WINDOW)
    versions.remove_old_versions(logs.spark, table)
    return logs.spark.table(table)


def window_replace(logs: Logs) -> DataFrame:
    """An old load of the whole month, then a re-run of the window."""
    table = scratch_table(logs.spark, "window_replace", tables.REACH_EVENTS, ["date"])
    history = logs.reach_events(None)
    sinks.replace_table(history.withColumn("channel", F.lit("old")), table)
    sinks.replace_dates(_without_one_day(logs), table, WINDOW)
    return logs.spark.table(table)


def summary_replace(logs: Logs) -> DataFrame:
    """An old summary whose daily part ends in the window, then a refresh from changed events."""
    table = scratch_table(logs.spark, "summary_replace", tables.REACH_SUMMARY, ["grain", "period"])
    history = logs.reach_events(None)
    whole_month = type(WINDOW)(WINDOW.first.replace(day=1), WINDOW.last)
    sinks.replace_summary(rollup.reach_overview_summary(history, whole_month, YEARS), table, whole_month)
    changed = history.filter(F.col("date") != F.date_sub(F.lit(AS_OF), 2))
    sinks.replace_summary(rollup.reach_overview_summary(changed, WINDOW, YEARS), table, WINDOW)
    return tables.read_summary(logs.spark, table)


def ab_results_replace(logs: Logs) -> DataFrame:
    """Two tests stored, then one of them replaced by a run that reports fewer metrics."""
    table = scratch_table(logs.spark, "ab_results_replace", tables.AB_RESULTS, ["testname"])
    results = logs.ab_results()
    other = results.withColumn("testname", F.lit("other_test"))
    sinks.replace_test(other, table, "other_test")
    sinks.replace_test(results, table, TEST.testname)
    sinks.replace_test(results.filter(F.col("metric_name").isin(REPORT_METRICS)), table, TEST.testname)
    return logs.spark.table(table)


def open_years(grain: str) -> Callable[[Logs], DataFrame]:
    """Totals over the dates of the orders, with every year of them."""
    window = DateWindow(AS_OF, AS_OF)
    total = [rollup.Analysis(grain, "Grand Total")]
    return lambda logs: rollup.summarize(logs.order_events(), window, total, month_years=True)


def experiment_dates_long(logs: Logs) -> DataFrame:
    """Every day of a test of a year and a half, with the orders of that day."""
    orders = logs.order_events().groupBy(F.col("date").alias("reporting_date")).agg(F.count("*").alias("orders"))
    dates = experiments.experiment_dates(logs.spark, LONG_TEST, AS_OF)
    return dates.join(orders, "reporting_date", "left").fillna(0, ["orders"])


def reach_anonymous(logs: Logs) -> DataFrame:
    events = classify.classify_pageviews(logs.partly_anonymous_views(), None)
    return rollup.reach_overview_summary(events, WINDOW, YEARS)


def session_pv_seq_anonymous(logs: Logs) -> DataFrame:
    """Views without a session id are one crowd, numbered as one session."""
    views = page_insights.page_views(logs.partly_anonymous_views(), WINDOW, home_page(), keep=["event_id"])
    return page_insights.with_session_sequence(views, ["event_id"])


def reach_job_summary(logs: Logs) -> DataFrame:
    database = scratch_reporting(logs.spark, "reach_job")
    jobs.run_reach_overview(logs.pageviews(), database, AS_OF, BEGIN_OFFSET, END_OFFSET, years=YEARS)
    return tables.read_summary(logs.spark, f"{database}.reach_overview_summary")


def convert_job_summary(logs: Logs) -> DataFrame:
    database = scratch_reporting(logs.spark, "convert_job")
    jobs.run_convert_overview(
        logs.conversions(), logs.ads_metadata(), database, AS_OF, BEGIN_OFFSET, END_OFFSET, years=YEARS
    )
    return logs.spark.table(f"{database}.convert_overview_summary")


def _store_page(logs: Logs, database: str, page: str, page_filter) -> None:
    clicks, rest = (logs.convert_logs().filter(c) for c in ("event_type = 'click'", "event_type <> 'click'"))
    jobs.run_page_insights(
        logs.pageviews(), page, page_filter, [(clicks, engagement_labels())], [(rest, core_labels()[:1]), (rest, core_labels()[1:])],
        database, AS_OF, BEGIN_OFFSET, END_OFFSET, tie_break=["event_id"],
    )


def page_reach_read(logs: Logs) -> DataFrame:
    database = scratch_reporting(logs.spark, "page_job")
    _store_page(logs, database, "home", home_page())
    return logs.spark.table(f"{database}.page_insights_pv")


def page_insights_two_pages(logs: Logs) -> DataFrame:
    """Two pages stored, the first of them once more; both funnels of both."""
    database = scratch_reporting(logs.spark, "pages_job")
    for page, page_filter in (("home", home_page()), ("issues", issues_page()), ("home", home_page())):
        _store_page(logs, database, page, page_filter)
    both = [logs.spark.table(f"{database}.page_insights_{f}") for f in ("engagement", "conversion")]
    return both[0].unionByName(both[1])


def ab_job_inference(logs: Logs) -> DataFrame:
    database = scratch_reporting(logs.spark, "ab_job")
    jobs.run_ab_test(
        logs.pageviews(), logs.assigned_variation(), logs.metric_events(), METRIC_EVENTS, TEST, database, AS_OF
    )
    return logs.spark.table(f"{database}.ab_variant_inference")


def reach_key(analysis: rollup.Analysis) -> str:
    summary = {"Specific Page Summary": "page", "Grand Total": "total"}.get(
        analysis.summary, analysis.summary.removesuffix(" Summary").lower().replace(" ", "_")
    )
    return f"reach_{analysis.grain.lower()}_{summary}"


QUERIES: dict[str, Callable[[Logs], DataFrame]] = {
    "state_group": state_group,
    "state_group_page": state_group_page,
    "page_name": page_name,
    "page_job": page_job,
    "page_name_from_table": page_name_from_table,
    "page_job_from_table": page_job_from_table,
    "channel_from_table": channel_from_table,
    "traffic_source": source,
    "channel": channel,
    "convert_event": convert_event,
    "engagement_labels": engagement_label,
    "calendar_columns": calendar,
    "date_window_filter": date_window_filter,
    "exposure_path_filter": exposure_path_filter,
    "page_filter_hook": page_filter_hook,
    "metric_events_union": Logs.metric_events,
    "ads_source_join": ads_source_join,
    "reach_overview_events": Logs.reach_events,
    "reach_fully_segmented": lambda logs: rollup.reach_fully_segmented(logs.reach_events(), WINDOW, YEARS),
    **{reach_key(a): reach_analysis(a) for a in rollup.ALL_ANALYSES},
    "reach_overview_summary": reach_overview_summary,
    "convert_overview_events": Logs.convert_events,
    "convert_fully_segmented": lambda logs: rollup.convert_fully_segmented(logs.convert_events(), WINDOW, YEARS),
    "session_pv_seq": session_pv_seq,
    "page_sessions": page_sessions,
    "page_engagement": page_engagement,
    "page_conversion": page_conversion,
    "page_engagement_convert": page_engagement_convert,
    "session_conversion_rate": session_conversion_rate,
    "first_variant_logs": first_variant_logs,
    "exposed_users": Logs.exposed,
    "exposed_users_by_user": lambda logs: logs.exposed_by("user_id"),
    "exposed_users_by_either": lambda logs: logs.exposed_by("user_id", "session_id"),
    "experiment_dates": experiment_dates,
    "user_date_pairs": user_date_pairs,
    "user_metric_events": user_metric_events,
    "user_cumulative_proportion": user_cumulative_proportion,
    "variant_stats": variant_stats,
    "variant_n": variant_n,
    "ab_variant_results": Logs.ab_results,
    "ab_variant_inference": ab_inference,
    "ab_sum_per_user": lambda logs: rounded(logs.total_results("Sum")),
    "ab_count_per_user": lambda logs: rounded(logs.total_results("Count")),
    "ab_t_inference": lambda logs: rounded(inference.ab_t_inference(logs.total_results("Sum"))),
    "ab_significance": ab_significance,
    "ab_interpretation": ab_interpretation,
    "ab_report_slice": ab_report_slice,
    "ab_variant_counts": ab_variant_counts,
    "ab_daily_series": ab_daily_series,
    "window_replace": window_replace,
    "versioned_window_replace": versioned_window_replace,
    "summary_replace": summary_replace,
    "ab_results_replace": ab_results_replace,
    "reach_weekly_total_open_years": open_years("Weekly"),
    "reach_monthly_total_by_year": open_years("Monthly"),
    "experiment_dates_long": experiment_dates_long,
    "reach_overview_summary_anonymous": reach_anonymous,
    "session_pv_seq_anonymous": session_pv_seq_anonymous,
    "reach_job_summary": reach_job_summary,
    "convert_job_summary": convert_job_summary,
    "page_reach_read": page_reach_read,
    "page_insights_two_pages": page_insights_two_pages,
    "ab_job_inference": ab_job_inference,
    "unmatched_share": lambda logs: monitoring.unmatched_share(logs.reach_events()),
    "metric_name_gaps": lambda logs: monitoring.metric_name_gaps(logs.metric_events(), METRIC_EVENTS[1:]),
    "variant_overlap": lambda logs: monitoring.variant_overlap(logs.exposed()),
    "daily_new_users": lambda logs: monitoring.daily_new_users(logs.exposed()),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Logs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: comparable(query(Logs(spark, sf_dir)))

    return {name: bind(query) for name, query in QUERIES.items()}
