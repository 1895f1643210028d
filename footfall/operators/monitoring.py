"""Checks that belong beside the reports: what rules miss, names that do not fit, users in several variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.rules import OTHER, UNCLASSIFIED
from footfall.operators.experiments import VARIANT_KEY, rate_name


def unmatched_share(events: DataFrame) -> DataFrame:
    """Share of classified rows per day that no channel rule and no page rule matched."""
    return events.groupBy("date").agg(
        F.count("*").alias("rows"),
        F.avg((F.col("channel") == OTHER).cast("double")).alias("other_channel"),
        F.avg((F.col("page_name") == UNCLASSIFIED).cast("double")).alias("unclassified_page"),
    )


def metric_name_gaps(metric_events: DataFrame, metric_event_names: Sequence[str]) -> DataFrame:
    """Metrics that occur but are not listed (results ignore them), and listed ones that never occur."""
    listed = metric_events.sparkSession.createDataFrame([(f"{n} Rate",) for n in metric_event_names], "metric_name string")
    seen = metric_events.groupBy(rate_name(F.col("metric_event_name")).alias("metric_name")).agg(F.count("*").alias("events"))
    both = seen.join(listed.withColumn("listed", F.lit(True)), "metric_name", "full")
    gaps = both.filter("listed is null or events is null")
    return gaps.select("metric_name", F.coalesce("events", F.lit(0)).cast("bigint").alias("events"), F.coalesce("listed", F.lit(False)).alias("listed"))


def variant_overlap(exposed: DataFrame) -> DataFrame:
    """Users of a test by how many of its variants they were exposed to; more than one blurs the result."""
    per_user = exposed.filter("user_id is not null").groupBy("testname", "user_id").agg(F.count_distinct("variation").alias("variants"))
    return per_user.groupBy("testname", "variants").agg(F.count("*").alias("users"))


def daily_new_users(exposed: DataFrame) -> DataFrame:
    """Users that each variant gained per day."""
    day = F.to_date("first_exposure_time").alias("date")
    return exposed.filter("user_id is not null").groupBy(*VARIANT_KEY, day).agg(F.count("*").alias("new_users"))
