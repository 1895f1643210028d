"""Daily jobs. Each reads logs, writes its reporting tables and leaves reports to read them.

Every job takes the run date once. Tables live in ``database`` (see ``create_reporting_tables``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.dates import ALL_YEARS, DateWindow, Years
from footfall.operators import classify, experiments, inference, page_insights, rollup
from footfall.sources import sinks


def run_reach_overview(
    pageviews: DataFrame,
    database: str,
    as_of: date,
    begin_offset: int,
    end_offset: int,
    *,
    years: Years = ALL_YEARS,
    month_years: bool = False,
    partitions: int | None = None,
    touched_only: bool = False,
    **classification,
) -> None:
    """Classify the window's page views, then refresh the summary from the stored events.

    ``touched_only`` reads the stored days of the weeks and months that the window touches and leaves other
    periods as they are; without it, every period is computed anew, as changed rules demand.

    ``partitions`` sizes the fan-out of the roll-ups: rows of the stored events, once per day and
    segments of a session or user, times 21, over the rows that a task should hold.
    """
    window = DateWindow.relative(as_of, begin_offset, end_offset)
    events = classify.classify_pageviews(pageviews, window, **classification)
    sinks.replace_dates(events, f"{database}.reach_overview_events", window)
    stored = pageviews.sparkSession.table(f"{database}.reach_overview_events")
    summary = rollup.reach_overview_summary(
        stored, window, years, month_years=month_years, partitions=partitions, touched_only=touched_only
    )
    sinks.replace_summary(summary, f"{database}.reach_overview_summary", window, touched_only=touched_only)


def run_convert_overview(
    conversions: DataFrame,
    ads_metadata: DataFrame,
    database: str,
    as_of: date,
    begin_offset: int,
    end_offset: int,
    *,
    years: Years = ALL_YEARS,
    **classification,
) -> None:
    """``conversions`` are event logs with a ``convert_event`` label (``label_events``, ``union_logs``)."""
    window = DateWindow.relative(as_of, begin_offset, end_offset)
    events = classify.classify_conversions(conversions, window, ads_metadata, **classification)
    sinks.replace_dates(events, f"{database}.convert_overview_events", window)
    stored = conversions.sparkSession.table(f"{database}.convert_overview_events")
    sinks.replace_dates(
        rollup.convert_fully_segmented(stored, window, years), f"{database}.convert_overview_summary", window
    )


def run_page_insights(
    pageviews: DataFrame,
    page: str,
    page_filter: Column,
    engagements: Sequence[tuple[DataFrame, Sequence[tuple[Column, str, str, str]]]],
    conversions: Sequence[tuple[DataFrame, Sequence[tuple[Column, str]]]],
    database: str,
    as_of: date,
    begin_offset: int,
    end_offset: int,
    *,
    conversion_filter: Column | None = None,
    tie_break: Sequence[str] = (),
    **classification,
) -> None:
    """Replace the tables' partitions of one page, known by its name ``page``.

    ``engagements`` and ``conversions`` list logs with the labels to look for in each. Every log is read
    once: its labelled events are stored, and so are the page's views; both funnels read the stored
    tables, which are far smaller.
    """
    window = DateWindow.relative(as_of, begin_offset, end_offset)
    spark = pageviews.sparkSession
    views = page_insights.page_views(pageviews, window, page_filter, keep=tie_break, **classification)
    sinks.replace_page(page_insights.with_session_sequence(views, tie_break), f"{database}.page_insights_pv", page)

    found = [
        page_insights.page_engagement_events(log, window, page_filter, labels).withColumn("funnel", F.lit("engagement"))
        for log, labels in engagements
    ]
    found += [
        page_insights.core_conversion_events(log, window, labels, where=conversion_filter).withColumn(
            "funnel", F.lit("conversion")
        )
        for log, labels in conversions
    ]
    # A page may have no log of one kind, or none at all: all its sessions are then without an event.
    found = found or [views.select("session_id", "time", *[F.lit(None).cast("string").alias(c) for c in (*page_insights.EVENT_LABELS, "funnel")]).limit(0)]
    labelled = classify.union_logs(found).withColumn("date", F.to_date("time"))
    sinks.replace_page(labelled, f"{database}.page_insights_events", page)

    of_page = F.col("page") == page
    first = spark.table(f"{database}.page_insights_pv").filter(of_page & (F.col("session_pv_seq") == 1))
    events = spark.table(f"{database}.page_insights_events").filter(of_page)
    for funnel, attach in (("engagement", page_insights.engagement), ("conversion", page_insights.conversion)):
        rows = attach(first, events.filter(F.col("funnel") == funnel).drop("funnel", "page", "date"))
        sinks.replace_page(rows, f"{database}.page_insights_{funnel}", page)


def run_ab_test(
    pageviews: DataFrame,
    assigned_variation: DataFrame,
    metric_events: DataFrame,
    metric_event_names: Sequence[str],
    test: experiments.Experiment,
    database: str,
    as_of: date,
    *,
    where: Column | None = None,
) -> None:
    """Recompute one test, then the inference table over all stored tests."""
    results = experiments.ab_variant_results(
        pageviews, assigned_variation, metric_events, metric_event_names, test, as_of, where=where
    )
    sinks.replace_test(results, f"{database}.ab_variant_results", test.testname)
    stored = pageviews.sparkSession.table(f"{database}.ab_variant_results")
    sinks.replace_table(inference.ab_variant_inference(stored), f"{database}.ab_variant_inference")
