"""Cumulative A/B test metrics per variant, metric and day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.dates import DateWindow

VARIANT_KEY = ("testname", "variation")
USER_KEY = ("user_id", *VARIANT_KEY)
# The columns of the results.
RESULT_COLUMNS = (
    "testname", "variation", "control_description", "reporting_date", "metric_name", "n_tre", "n_con",
    "metric_total_tre", "metric_total_con", "metric_normalized_tre", "metric_normalized_con",
    "variance_tre", "variance_con", "diff", "diff_pct",
)


@dataclass(frozen=True)
class Experiment:
    testname: str
    control_variation: str
    start: date
    end: date
    exposure_paths: tuple[str, ...]
    # Days reported at most, from the start on; None reports all of them.
    max_days: int | None = None

    @property
    def window(self) -> DateWindow:
        return DateWindow(self.start, self.end)

    def last_report(self, as_of: date) -> date:
        last = min(self.end, as_of)
        return last if self.max_days is None else min(last, self.start + timedelta(days=self.max_days - 1))


def rate_name(event_name: Column) -> Column:
    return F.concat(event_name, F.lit(" Rate"))


def first_variant_logs(assigned_variation: DataFrame, test: Experiment) -> DataFrame:
    """First time each session was logged in each variant of the test."""
    return (
        assigned_variation.filter((F.col("testname") == test.testname) & test.window.has_time(F.col("time")))
        .groupBy("session_id", *VARIANT_KEY)
        .agg(F.min("time").alias("first_log_time"))
    )


def exposed_users(
    pageviews: DataFrame,
    variant_logs: DataFrame,
    test: Experiment,
    *,
    where: Column | None = None,
    through: date | None = None,
) -> DataFrame:
    """First view of an exposure path by each user while the session was in a variant.

    Views before the test start cannot follow a variant log, so they are cut at the scan. ``through``
    also cuts views after the last reported day, for callers that need no later exposures. The
    variant log has few rows per session; a dominant session on the page view side is split by AQE
    and combined map-side before the second shuffle.
    """
    views = pageviews.filter(F.col("path").isin(*test.exposure_paths) & (F.col("time") >= F.lit(test.start)))
    if through is not None:
        views = views.filter(F.col("time") < F.lit(through + timedelta(days=1)))
    if where is not None:
        views = views.filter(where)
    return (
        views.select("user_id", "session_id", "time")
        .join(variant_logs, "session_id")
        .filter(F.col("time") >= F.col("first_log_time"))
        .groupBy(*USER_KEY)
        .agg(F.min("time").alias("first_exposure_time"))
    )


def _with_identity(rows: DataFrame, identities: Sequence[str]) -> DataFrame:
    """``identity``: a row for each of the identity columns that has a value, told apart by the column's name."""
    named = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in identities]
    identity = named[0] if len(named) == 1 else F.explode(F.array(*named))
    return rows.select("*", identity.alias("identity")).filter("identity is not null")


def exposed_by_identity(
    pageviews: DataFrame,
    assigned_variation: DataFrame,
    test: Experiment,
    identities: Sequence[str] = ("user_id",),
    *,
    where: Column | None = None,
    through: date | None = None,
) -> DataFrame:
    """``exposed_users`` with variants attached by other columns than the session.

    A stable ``user_id`` needs no session step: the first log of a user in a variant serves all the user's views.
    Several identities attach a view that shares any of them with an earlier log, in one pass: logs and views get a row
    per identity, and one join and one minimum serve all of them. The logs shrink map-side to one row per identity
    and variant; the join has a key of its own, so AQE may split an identity that owns much of the views, whose
    pieces are combined map-side before the second shuffle.
    """
    logs = assigned_variation.filter((F.col("testname") == test.testname) & test.window.has_time(F.col("time")))
    first_logs = _with_identity(logs, identities).groupBy("identity", *VARIANT_KEY).agg(F.min("time").alias("first_log_time"))
    views = pageviews.filter(F.col("path").isin(*test.exposure_paths) & (F.col("time") >= F.lit(test.start)))
    if through is not None:
        views = views.filter(F.col("time") < F.lit(through + timedelta(days=1)))
    if where is not None:
        views = views.filter(where)
    return (
        _with_identity(views.select(*dict.fromkeys(["user_id", "time", *identities])), identities)
        .join(first_logs, "identity")
        .filter(F.col("time") >= F.col("first_log_time"))
        .groupBy(*USER_KEY)
        .agg(F.min("time").alias("first_exposure_time"))
    )


def _report_dates(first: Column, test: Experiment, as_of: date) -> Column:
    """Dates from ``first`` to the last reported day; NULL (no rows once exploded) when there are none."""
    last = F.lit(test.last_report(as_of))
    return F.when(first <= last, F.sequence(first, last))


def experiment_dates(spark: SparkSession, test: Experiment, as_of: date) -> DataFrame:
    return spark.range(1).select(F.explode(_report_dates(F.lit(test.start), test, as_of)).alias("reporting_date"))


def user_date_pairs(exposed: DataFrame, test: Experiment, as_of: date) -> DataFrame:
    """One row per exposed user and day from exposure to the last reported day."""
    first = F.greatest(F.to_date("first_exposure_time"), F.lit(test.start))
    return exposed.withColumn("reporting_date", F.explode(_report_dates(first, test, as_of)))


def metric_event_days(metric_events: DataFrame, test: Experiment) -> DataFrame:
    """Latest event of each user, metric and day.

    An event at or after an exposure exists on a day exactly when the latest event of that day is at
    or after it, so this is all the later steps need. A user with any number of events shrinks to
    one row per metric and day, combined map-side, before any join.
    """
    return (
        metric_events.filter(test.window.has_time(F.col("metric_time")))
        .groupBy("user_id", rate_name(F.col("metric_event_name")).alias("metric_name"),
                 F.to_date("metric_time").alias("date"))
        .agg(F.max("metric_time").alias("last_metric_time"))
    )


def user_metric_events(exposed: DataFrame, event_days: DataFrame) -> DataFrame:
    """Days on which an exposed user had each metric event after the exposure, once per day."""
    return (
        exposed.join(event_days, "user_id")
        .filter(F.col("first_exposure_time") <= F.col("last_metric_time"))
        .select(*USER_KEY, "date", "metric_name")
    )


def first_conversions(exposed: DataFrame, event_days: DataFrame, metric_names: Sequence[str]) -> DataFrame:
    """Exposed users with the first day of each listed metric (array ``metrics``; NULL day if never).

    Metrics outside ``metric_names`` are ignored.
    """
    days = event_days.filter(F.col("metric_name").isin(*metric_names)).withColumnRenamed("user_id", "m_user")
    joined = exposed.join(
        days, (F.col("user_id") == F.col("m_user")) & (F.col("first_exposure_time") <= F.col("last_metric_time")), "left"
    )
    firsts = joined.groupBy(*USER_KEY, "first_exposure_time").agg(
        *[F.min(F.when(F.col("metric_name") == m, F.col("date"))).alias(f"first_{i}") for i, m in enumerate(metric_names)]
    )
    return firsts.select(
        *USER_KEY,
        "first_exposure_time",
        F.array(
            *[
                F.struct(F.lit(m).alias("metric_name"), F.col(f"first_{i}").alias("first_date"))
                for i, m in enumerate(metric_names)
            ]
        ).alias("metrics"),
    )


def user_cumulative_proportion(conversions: DataFrame, test: Experiment, as_of: date) -> DataFrame:
    """0/1 per exposed user, day and metric: had the event by that day.

    Expands users by days and metrics; the variant results below do not need it.
    """
    pairs = user_date_pairs(conversions, test, as_of).select(
        *USER_KEY, "reporting_date", F.explode("metrics").alias("m")
    )
    converted = F.coalesce(F.col("m.first_date") <= F.col("reporting_date"), F.lit(False))
    return pairs.select(
        *USER_KEY, "reporting_date", F.col("m.metric_name").alias("metric_name"), converted.cast("int").alias("metric_value")
    )


def cumulative_counts(conversions: DataFrame, test: Experiment, as_of: date) -> DataFrame:
    """Exposed users ``n`` and converted users ``x`` per variant, metric and reported day.

    Users are counted once by (exposure day, first conversion day); what remains has the size of
    variants x metrics x days, and running totals over it replace the user x day x metric expansion.
    ``flags`` is the number of 0/1 values behind the variance: views without a user id form one more
    member of the variant there, but are not a user in ``n``.
    """
    last = test.last_report(as_of)
    members = conversions.selectExpr(
        *USER_KEY, "to_date(first_exposure_time) as exposed", "explode(metrics) as m"
    ).select(*USER_KEY, "exposed", "m.*")
    by_days = members.groupBy(*VARIANT_KEY, "metric_name", "exposed", "first_date").agg(
        F.count("user_id").alias("users"), F.count("*").alias("members")
    )
    changes = by_days.selectExpr(
        *VARIANT_KEY,
        "metric_name",
        f"""inline(array(
            struct(greatest(exposed, date '{test.start}') as date, users as n, members as flags, 0L as x),
            struct(first_date as date, 0L as n, 0L as flags, members as x)))""",
    )
    daily = (
        changes.filter(F.col("date") <= F.lit(last))
        .groupBy(*VARIANT_KEY, "metric_name", "date")
        .agg(F.sum("n").alias("n"), F.sum("flags").alias("flags"), F.sum("x").alias("x"))
    )
    return running_totals(daily, ("n", "flags", "x"), last)


def running_totals(daily: DataFrame, columns: Sequence[str], last: date) -> DataFrame:
    """Running totals of ``columns`` per variant and metric, with a row for every day from the first through ``last``."""
    in_order = "(partition by testname, variation, metric_name order by date)"
    running = in_order.replace("order by date", "order by date rows between unbounded preceding and current row")
    totals = daily.selectExpr(
        *VARIANT_KEY,
        "metric_name",
        "date",
        *[f"sum({c}) over {running} as {c}" for c in columns],
        f"coalesce(date_sub(lead(date) over {in_order}, 1), date '{last}') as until",
    )
    return totals.selectExpr(
        *VARIANT_KEY, "metric_name", "explode(sequence(date, until)) as reporting_date", *columns
    )


def _is_control(test: Experiment) -> Column:
    return F.coalesce(F.col("variation") == test.control_variation, F.lit(False)).alias("is_control")


# Sample variance of x ones among the 0/1 flags; NULL for a single flag.
_VARIANCE = "if(flags > 1, double(x) * (flags - x) / (double(flags) * (flags - 1)), null) as variance"


def variant_stats(counts: DataFrame, test: Experiment) -> DataFrame:
    return counts.select(
        *VARIANT_KEY, "reporting_date", _is_control(test), "metric_name", F.col("x").alias("metric_value"),
        F.expr(_VARIANCE),
    )


def variant_n(exposed: DataFrame, test: Experiment, as_of: date) -> DataFrame:
    """Exposed users per variant as of each reported day; needs no metric events."""
    everyone = exposed.selectExpr("*", "array(struct('' as metric_name, cast(null as date) as first_date)) as metrics")
    return cumulative_counts(everyone, test, as_of).select(*VARIANT_KEY, "reporting_date", _is_control(test), "n")


def compare_with_control(counts: DataFrame, test: Experiment) -> DataFrame:
    """Results of the cumulative counts of a 0/1 metric."""
    return compare_stats(counts.select("*", F.expr(_VARIANCE)), test)


def compare_stats(stats: DataFrame, test: Experiment) -> DataFrame:
    """Each treatment beside the control of the same day and metric.

    ``stats`` has users ``n``, total ``x`` and ``variance`` per variant, metric and day. The control is picked up by a
    window over this small table. A self join would run the whole upstream plan a second time.
    """
    stats = stats.select("*", _is_control(test))
    control = "max(if(is_control, {0}, null)) over (partition by testname, reporting_date, metric_name) as {0}_con"
    paired = stats.selectExpr("*", *[control.format(c) for c in ("n", "x", "variance")]).filter(
        "not is_control and variation is not null and n_con is not null"
    )
    rates = paired.selectExpr(
        *VARIANT_KEY,
        "reporting_date",
        "metric_name",
        "n as n_tre",
        "n_con",
        "double(x) as metric_total_tre",
        "double(x_con) as metric_total_con",
        "try_divide(x, n) as metric_normalized_tre",
        "try_divide(x_con, n_con) as metric_normalized_con",
        "variance as variance_tre",
        "variance_con",
    )
    compared = rates.selectExpr(
        "*",
        "metric_normalized_tre - metric_normalized_con as diff",
        "if(metric_normalized_con > 0, metric_normalized_tre / metric_normalized_con - 1, null) as diff_pct",
    )
    return compared.withColumn("control_description", F.lit(test.control_variation)).select(*RESULT_COLUMNS)


def exposures(
    pageviews: DataFrame,
    assigned_variation: DataFrame,
    test: Experiment,
    as_of: date,
    *,
    where: Column | None = None,
    identities: Sequence[str] | None = None,
) -> DataFrame:
    """Exposed users that a report as of a day needs."""
    through = test.last_report(as_of)
    if identities is not None:
        return exposed_by_identity(pageviews, assigned_variation, test, identities, where=where, through=through)
    return exposed_users(pageviews, first_variant_logs(assigned_variation, test), test, where=where, through=through)


def ab_variant_results(
    pageviews: DataFrame,
    assigned_variation: DataFrame,
    metric_events: DataFrame,
    metric_event_names: Sequence[str],
    test: Experiment,
    as_of: date,
    *,
    where: Column | None = None,
    identities: Sequence[str] | None = None,
) -> DataFrame:
    """Cumulative results of every treatment against the control, from the logs in one plan.

    Variants attach to views by session, or by the columns ``identities`` (``exposed_by_identity``).
    """
    exposed = exposures(pageviews, assigned_variation, test, as_of, where=where, identities=identities)
    metric_names = [f"{name} Rate" for name in metric_event_names]
    conversions = first_conversions(exposed, metric_event_days(metric_events, test), metric_names)
    return compare_with_control(cumulative_counts(conversions, test, as_of), test)
