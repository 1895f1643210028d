"""Cumulative ``Sum per User`` and ``Count per User`` metrics per variant and day.

A user's value on a day is the sum (or number) of the user's metric events from the first exposure through that day; the
variant reports the total of its users and their sample variance, zeros included. Users are never expanded by days:
a user-day with amount ``today`` on top of ``before`` changes the variant's sum by ``today`` and its sum of squares by
``(before + today)^2 - before^2``, so running totals of these changes give every day's moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.rules import sql_text
from footfall.operators import experiments
from footfall.operators.experiments import USER_KEY, VARIANT_KEY, Experiment

CHANGE_KEY = (*VARIANT_KEY, "metric_name")


@dataclass(frozen=True)
class UserMetric:
    event_name: str
    kind: Literal["Sum", "Count"] = "Sum"

    @property
    def name(self) -> str:
        return f"{self.event_name} {self.kind} per User"


def user_day_amounts(exposed: DataFrame, metric_events: DataFrame, test: Experiment, metrics: Sequence[UserMetric]) -> DataFrame:
    """``today`` of each exposed user, metric and day that has events at or after the exposure.

    ``metric_events``: ``user_id``, ``metric_time``, ``metric_event_name``, ``metric_value``; a NULL value adds nothing
    to a sum and one to a count. Events of the exposure day are split at the exposure time by the join. Its key is a
    column of its own, so that AQE may split a user who owns much of the log; the pieces are combined map-side before
    the second shuffle, which moves a row per user, event name and day.
    """
    events = metric_events.filter(
        test.window.has_time(F.col("metric_time")) & F.col("metric_event_name").isin(*sorted({m.event_name for m in metrics}))
    ).selectExpr("concat('=', user_id) as join_key", "metric_time", "metric_event_name", "double(metric_value) as metric_value")
    # A key that is never NULL asks for no filter below the users, so that these are computed once for both uses.
    users = exposed.selectExpr("coalesce(concat('=', user_id), '') as join_key", *USER_KEY, "first_exposure_time")
    daily = (
        users.join(events, "join_key")
        .filter(F.col("first_exposure_time") <= F.col("metric_time"))
        .groupBy(*USER_KEY, "metric_event_name", F.to_date("metric_time").alias("date"))
        .agg(F.sum("metric_value").alias("Sum"), F.count("*").cast("double").alias("Count"))
    )
    listed = ", ".join(
        f"struct({sql_text(m.event_name)} as event, {sql_text(m.name)} as metric_name, coalesce({m.kind}, 0D) as today)" for m in metrics
    )
    return daily.selectExpr(*USER_KEY, "date", "metric_event_name", f"inline(array({listed}))").filter("event = metric_event_name").drop(
        "event", "metric_event_name"
    )


def cumulative_moments(exposed: DataFrame, amounts: DataFrame, test: Experiment, metrics: Sequence[UserMetric], as_of: date) -> DataFrame:
    """``n`` users, ``flags`` values, their sum ``x`` and ``variance`` per variant, metric and reported day.

    As in ``cumulative_counts``, views without a user id form one more value of the variant (zero: no event can be
    theirs) that is not a user. The variance comes from the sum of squares about the mean of the day; amounts are
    added in double precision.
    """
    last = test.last_report(as_of)
    names = ", ".join(sql_text(m.name) for m in metrics)
    members = exposed.groupBy(*VARIANT_KEY, F.greatest(F.to_date("first_exposure_time"), F.lit(test.start)).alias("date")).agg(
        F.count("user_id").alias("n"), F.count("*").alias("flags")
    )
    arrivals = members.selectExpr(*VARIANT_KEY, f"explode(array({names})) as metric_name", "date", "n", "flags", "0D as x", "0D as squares")
    before = (
        "coalesce(sum(today) over (partition by user_id, testname, variation, metric_name order by date "
        "rows between unbounded preceding and 1 preceding), 0D) as before"
    )
    changes = amounts.filter(F.col("date") <= F.lit(last)).selectExpr(*CHANGE_KEY, "date", "today", before)
    gained = changes.selectExpr(*CHANGE_KEY, "date", "0L as n", "0L as flags", "today as x", "today * (2 * before + today) as squares")
    daily = (
        arrivals.unionByName(gained)
        .filter(F.col("date") <= F.lit(last))
        .groupBy(*CHANGE_KEY, "date")
        .agg(*[F.sum(c).alias(c) for c in ("n", "flags", "x", "squares")])
    )
    totals = experiments.running_totals(daily, ("n", "flags", "x", "squares"), last)
    # Rounding may leave a hair below zero where all values are equal.
    variance = "if(flags > 1, greatest(squares - x * x / flags, 0D) / (flags - 1), null) as variance"
    return totals.selectExpr(*CHANGE_KEY, "reporting_date", "n", "flags", "x", variance)


def user_total_stats(
    exposed: DataFrame, metric_events: DataFrame, metrics: Sequence[UserMetric], test: Experiment, as_of: date
) -> DataFrame:
    return cumulative_moments(exposed, user_day_amounts(exposed, metric_events, test, metrics), test, metrics, as_of)


def ab_user_total_results(
    pageviews: DataFrame,
    assigned_variation: DataFrame,
    metric_events: DataFrame,
    metrics: Sequence[UserMetric],
    test: Experiment,
    as_of: date,
    *,
    where: Column | None = None,
    identities: Sequence[str] | None = None,
) -> DataFrame:
    """Cumulative results of every treatment against the control, with the columns of ``ab_variant_results``."""
    exposed = experiments.exposures(pageviews, assigned_variation, test, as_of, where=where, identities=identities)
    return experiments.compare_stats(user_total_stats(exposed, metric_events, metrics, test, as_of), test)
