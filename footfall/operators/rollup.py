"""Traffic summaries: rows, exact distinct sessions and exact distinct users by period and segment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.dates import ALL_YEARS, DateWindow, Years, calendar_columns, reporting_year, sunday_week
from footfall.functions.rules import sql_text
from footfall.operators.classify import SEGMENTS

GRAINS = ("Daily", "Weekly", "Monthly")

# Summary name -> segments it keeps.
SUMMARIES = {
    "Device Summary": ("device_type",),
    "State Summary": ("region", "state_group"),
    "State Group Summary": ("state_group",),
    "Page Job Summary": ("page_job",),
    "Specific Page Summary": ("page_name", "page_job"),
    "Channel Summary": ("channel",),
    "Grand Total": (),
}

SUMMARY_COLUMNS = (
    "analysis", "date", "week", "month", "reporting_wk_yr", *SEGMENTS, "pv_ct", "session_ct", "user_ct",
)


@dataclass(frozen=True)
class Analysis:
    grain: str
    summary: str

    @property
    def label(self) -> str:
        return f"{self.grain} {self.summary}"


ALL_ANALYSES = tuple(Analysis(g, s) for g in GRAINS for s in SUMMARIES)


def _case(code: str, choices: dict[int, str]) -> str:
    """SQL that picks a value by code; NULL for the codes left out."""
    arms = " ".join(f"when {value} then {choice}" for value, choice in choices.items())
    return f"case {code} {arms} end" if arms else "cast(null as string)"


def summarize(
    events: DataFrame,
    window: DateWindow,
    analyses: Sequence[Analysis] = ALL_ANALYSES,
    *,
    years: Years = ALL_YEARS,
    month_years: bool = False,
    partitions: int | None = None,
    touched_only: bool = False,
) -> DataFrame:
    """Any set of the daily / weekly / monthly summaries from a single scan of the classified events.

    Daily analyses cover the window, weekly and monthly ones the whole table. Three shuffles, whatever
    the number of analyses:

    1. Each row is counted once for its session and once for its user, combined map-side to (day,
       segments, key). A key that owns a large share of all rows shrinks here to at most one row per
       day and segment, spread over all tasks.
    2. These rows are placed by the hash of the key. Every analysis is then de-duplicated inside the
       task, so the fan-out over analyses never crosses the network. There a key is known by its hash
       and its rank among the keys of that hash, which is exact and several times cheaper to group by
       than the text. Rows without a user count nothing and are dropped; rows without a session
       count only as views, so they are placed by day and segments instead. The stage keeps ``partitions`` tasks
       (default: ``spark.sql.shuffle.partitions``): AQE would merge them by their size before the
       fan-out, which multiplies rows up to 21 times.
    3. Partial counts per (analysis, period, segment values) are added up.

    ``years`` limits the reporting years of weeks. Months of different years are added up unless
    ``month_years`` is set, which shows them as ``2024-03``. ``touched_only`` limits weekly and monthly
    analyses to the weeks and months that the window touches, and the scan to their days; it needs
    periods that belong to one stretch of days: open ``years``, and ``month_years`` for months.
    """
    covered = {"Daily": window, "Weekly": None, "Monthly": None}
    grains_wanted = {a.grain for a in analyses}
    if touched_only:
        if years != ALL_YEARS or ("Monthly" in grains_wanted and not month_years):
            raise ValueError("touched periods need open years, and month_years for monthly analyses")
        covered |= {"Weekly": window.whole_weeks(), "Monthly": window.whole_months()}
    spans = [covered[g] for g in grains_wanted]
    if all(spans):
        events = events.filter(DateWindow(min(s.first for s in spans), max(s.last for s in spans)).has_date(F.col("date")))
    summaries = list(SUMMARIES)
    kept = {i: SUMMARIES[s] for i, s in enumerate(summaries) if any(a.summary == s for a in analyses)}
    segments = [c for c in SEGMENTS if any(c in columns for columns in kept.values())]
    slots = [f"slot{i}" for i in range(max(map(len, kept.values())))]

    def codes(grain: str) -> str:
        """The codes of a grain's analyses, for rows of the days that it covers."""
        none = "cast(array() as array<int>)"
        chosen = [GRAINS.index(a.grain) * 100 + summaries.index(a.summary) for a in analyses if a.grain == grain]
        if not chosen:
            return none
        listed, span = f"array({', '.join(map(str, chosen))})", covered[grain]
        return f"if(date between date '{span.first}' and date '{span.last}', {listed}, {none})" if span else listed

    partitions = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_session, of_user = ["date", *segments, "session_id"], ["date", *segments, "user_id"]
    per_key = events.groupingSets([of_session, of_user], *of_session, "user_id").agg(
        F.expr("grouping_id() as kind"), F.expr("count(*) as pv")
    )
    placed = (
        per_key.selectExpr("date", *segments, "kind = 1 as is_session", "if(kind = 1, session_id, user_id) as key", "pv")
        .filter("is_session or key is not null")
        .withColumn("key_hash", F.when(F.col("key").isNull(), F.xxhash64("date", *segments)).otherwise(F.xxhash64("key")))
        .repartition(partitions, "is_session", "key_hash")
        .selectExpr(
            "*",
            "if(key is null, 0, dense_rank() over (partition by is_session, key_hash order by key)) as key_rank",
        )
    )

    fanned = (
        placed.select(
            "date",
            *segments,
            "is_session",
            "key_hash",
            "key_rank",
            "pv",
            F.unix_date("date").alias("day_no"),
            (reporting_year(F.col("date"), years) * 100 + sunday_week(F.col("date"))).alias("week_no"),
            (F.year("date") * 100 * int(month_years) + F.month("date")).alias("month_no"),
        )
        .selectExpr("*", f"explode(concat({', '.join(map(codes, GRAINS))})) as code")
        .selectExpr(
            "code",
            "case int(code / 100) when 0 then day_no when 1 then week_no else month_no end as period",
            *[
                _case("code % 100", {i: columns[n] for i, columns in kept.items() if len(columns) > n}) + f" as {slot}"
                for n, slot in enumerate(slots)
            ],
            "is_session",
            "key_hash",
            "key_rank",
            "if(is_session, pv, 0L) as pv",
        )
    )
    group = ["code", "period", *slots]
    distinct_keys = fanned.groupBy(*group, "is_session", "key_hash", "key_rank").agg(F.expr("sum(pv) as pv"))
    counted = (
        distinct_keys.groupBy(*group)
        .agg(
            F.expr("sum(pv) as pv_ct"),
            F.expr("count_if(is_session and key_rank > 0) as session_ct"),
            F.expr("count_if(not is_session and key_rank > 0) as user_ct"),
        )
        .selectExpr("*", "code div 100 as grain", "code % 100 as summary")
    )

    names = {i: sql_text(s) for i, s in enumerate(summaries)}
    dated = counted.selectExpr("*", "if(grain = 0, date_from_unix_date(period), null) as date")
    daily = dated.select("*", *[c.alias(f"daily_{n}") for n, c in calendar_columns(F.col("date"), years).items()])
    month = "concat(lpad(period div 100, 4, '0'), '-', lpad(period % 100, 2, '0'))" if month_years else "string(period)"
    return daily.selectExpr(
        f"concat({_case('grain', {i: sql_text(g + ' ') for i, g in enumerate(GRAINS)})}, {_case('summary', names)})"
        " as analysis",
        "date",
        "case grain when 0 then daily_week when 1 then string(period % 100) end as week",
        f"case grain when 0 then daily_month when 2 then {month} end as month",
        "case grain when 0 then daily_reporting_wk_yr when 1 then string(period div 100) end as reporting_wk_yr",
        *[
            _case("summary", {i: slots[columns.index(c)] for i, columns in kept.items() if c in columns}) + f" as {c}"
            for c in SEGMENTS
        ],
        "pv_ct",
        "session_ct",
        "user_ct",
    )


def count_segments(
    events: DataFrame,
    window: DateWindow,
    analysis: str,
    count_name: str,
    extra: Sequence[str] = (),
    years: Years = ALL_YEARS,
) -> DataFrame:
    """Row count of every full combination of segments per day of the window."""
    dimensions = ["date", *SEGMENTS, *extra]
    counted = events.filter(window.has_date(F.col("date"))).groupBy(*dimensions).agg(F.count("*").alias(count_name))
    return counted.select(
        F.lit(analysis).alias("analysis"),
        "date",
        *[c.alias(n) for n, c in calendar_columns(F.col("date"), years).items()],
        *SEGMENTS,
        *extra,
        count_name,
    )


def reach_fully_segmented(events: DataFrame, window: DateWindow, years: Years = ALL_YEARS) -> DataFrame:
    """Finest page view counts; sessions and users are not additive there and stay NULL."""
    counted = count_segments(events, window, "Fully Segmented PVs", "pv_ct", years=years)
    missing = F.lit(None).cast("bigint")
    return counted.withColumns({"session_ct": missing, "user_ct": missing}).select(*SUMMARY_COLUMNS)


def convert_fully_segmented(events: DataFrame, window: DateWindow, years: Years = ALL_YEARS) -> DataFrame:
    return count_segments(events, window, "Fully Segmented Events", "event_ct", ["convert_event"], years)


def reach_overview_summary(events: DataFrame, window: DateWindow, years: Years = ALL_YEARS, **options) -> DataFrame:
    """The full reach summary: fully segmented counts and all 21 roll-ups (``options`` of ``summarize``)."""
    return reach_fully_segmented(events, window, years).unionByName(summarize(events, window, years=years, **options))
