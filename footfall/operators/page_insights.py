"""Session funnel of one page: views, engagement on the page, conversions after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import rules
from footfall.functions.dates import DateWindow
from footfall.operators.classify import label_events, rows_in_window, with_channel

PAGE_VIEW_COLUMNS = (
    "user_id", "session_id", "time", "date", "device_type", "region", "state_group", "channel", "landing_page",
)
FUNNEL_COLUMNS = (
    "session_id", "date", "pv_time", "event_type", "event_name", "event_description",
    "device_type", "region", "state_group", "channel", "landing_page",
)
EVENT_LABELS = ("event_type", "event_name", "event_description")


def page_views(
    pageviews: DataFrame,
    window: DateWindow,
    page: Column,
    *,
    state_groups: Sequence = rules.PAGE_STATE_GROUPS,
    channel_rules: Sequence = rules.CHANNEL_RULES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Classified views of one page. ``keep`` carries further columns, such as a tie-break for equal times."""
    rows = rows_in_window(pageviews, window, page).withColumns(
        {"date": F.to_date("time"), "state_group": rules.state_group("region", state_groups)}
    )
    return with_channel(rows, channel_rules).select(*PAGE_VIEW_COLUMNS, *keep)


def with_session_sequence(views: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Number the views of each session by time (``session_pv_seq``).

    A session is numbered second by second: the views of each second, counted map-side from a narrow scan, give every
    second its starting number, and rows are sorted only inside their second. A session that owns much of the traffic,
    or all views without a session id, is thus spread over as many tasks as it has seconds; what is gathered by session
    is one count for each of its seconds, which the length of the window bounds. No side is broadcast by hint: Spark
    does so while the counts are few, and a session with a single second has none.
    """
    # A key that is never NULL: views without a session id are numbered together, and a plain equality
    # lets the join reuse the placement of the window.
    unit = ["session_key", "second"]
    rows = views.selectExpr("*", "coalesce(concat('=', session_id), '') as session_key", "date_trunc('SECOND', time) as second")
    counts = rows.groupBy(*unit).agg(F.count("*").alias("views"))
    offsets = counts.selectExpr(
        *unit,
        """sum(views) over (partition by session_key order by second
            rows between unbounded preceding and 1 preceding) as offset""",
    ).filter("offset > 0")
    in_unit = Window.partitionBy(*unit).orderBy("time", *tie_break)
    numbered = rows.withColumn("seq_in_unit", F.row_number().over(in_unit))
    return numbered.join(offsets, unit, "left").selectExpr(
        *views.columns, "seq_in_unit + coalesce(offset, 0L) as session_pv_seq"
    )


def first_views(views: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """First view of each session.

    The rank filter lets Spark keep one candidate per session and task before the shuffle, so no
    session is ever gathered whole.
    """
    by_time = Window.partitionBy("session_id").orderBy("time", *tie_break)
    ranked = views.withColumn("rank", F.row_number().over(by_time)).filter("rank = 1")
    return ranked.drop("rank").withColumn("session_pv_seq", F.lit(1).cast("bigint"))


def page_engagement_events(
    logs: DataFrame, window: DateWindow, page: Column, labels: Sequence[tuple[Column, str, str, str]]
) -> DataFrame:
    """Engagement events on the page. ``labels`` rows: condition, event type, name, description."""
    as_struct = [
        (condition, F.struct(*[F.lit(v).alias(n) for n, v in zip(EVENT_LABELS, values)]))
        for condition, *values in labels
    ]
    # Without labels nothing is an event; the columns stay.
    none = [(F.lit(False), F.struct(*[F.lit(None).cast("string").alias(n) for n in EVENT_LABELS]))]
    labelled = label_events(rows_in_window(logs, window, page), as_struct or none, "label")
    return labelled.select("session_id", "time", "label.*")


def core_conversion_events(
    logs: DataFrame, window: DateWindow, labels: Sequence[tuple[Column, str]], *, where: Column | None = None
) -> DataFrame:
    """Core conversions anywhere on the site. ``labels`` rows: condition, event name."""
    none = [(F.lit(False), F.lit(None).cast("string"))]
    labelled = label_events(rows_in_window(logs, window, where), labels or none, "event_name")
    return labelled.select(
        "session_id",
        "time",
        F.lit("Core Conversion").alias("event_type"),
        "event_name",
        F.lit("N/A").alias("event_description"),
    )


def attach_events(first: DataFrame, events: DataFrame, *, after_view: bool, combined: bool = False) -> DataFrame:
    """One row per session and event; sessions without an event keep one row with NULL event columns.

    The same as ``first LEFT JOIN events``, which could split a dominant session only on the side where it has a single
    row. An inner join has no such limit: AQE splits the events of that session over many tasks. It does so only where
    both sides arrive straight from a shuffle, hence a join key of its own: the first views may come out of a window
    that is already placed by session. What matched is shuffled by session and time, and both the result and the search
    for sessions that matched nothing read this one shuffle, so each log is read once.

    ``combined`` says that the events are few per session (``latest_per_session``): a plain left join then serves.
    """
    # A key that is never NULL asks for no filter below the sessions, so that both joins share their shuffle.
    sessions = first.selectExpr(
        "session_id", "date", "time as pv_time", "device_type", "region", "state_group", "channel", "landing_page",
        "coalesce(concat('=', session_id), '') as join_key",
    )
    occurred = events.selectExpr("time as e_time", *EVENT_LABELS, "concat('=', session_id) as event_key").filter("event_key is not null")
    met = F.col("join_key") == F.col("event_key")
    if after_view:
        met = met & (F.col("pv_time") <= F.col("e_time"))
    if combined:
        return sessions.join(occurred, met, "left").select(*FUNNEL_COLUMNS)
    # The check value makes both readers need the same columns, else each would have a shuffle of its own.
    matched = sessions.join(occurred, met).select(*FUNNEL_COLUMNS, "join_key", "e_time").repartition("join_key", "e_time")
    check = F.max(F.xxhash64(*FUNNEL_COLUMNS, "e_time")).alias("check")
    had_event = matched.groupBy("join_key").agg(check).filter("check is not null").select("join_key")
    unmatched = sessions.join(had_event, "join_key", "left_anti").withColumns({c: F.lit(None).cast("string") for c in EVENT_LABELS})
    return matched.select(*FUNNEL_COLUMNS).unionByName(unmatched.select(*FUNNEL_COLUMNS))


def engagement(first: DataFrame, events: DataFrame, *, combined: bool = False) -> DataFrame:
    """Sessions of the page with every engagement event of the session, whenever it happened."""
    return attach_events(first, events, after_view=False, combined=combined)


def conversion(first: DataFrame, events: DataFrame, *, combined: bool = False) -> DataFrame:
    """Sessions of the page with every core conversion at or after the first view."""
    return attach_events(first, events, after_view=True, combined=combined)


def latest_per_session(events: DataFrame) -> DataFrame:
    """Last occurrence of each event in a session.

    A session had an event at or after its first view exactly when the last occurrence qualifies, so
    rates need no more than this; a session with any number of events shrinks map-side.
    """
    return events.groupBy("session_id", *EVENT_LABELS).agg(F.max("time").alias("time"))


def session_conversion_rate(funnel: DataFrame) -> DataFrame:
    """Share of the page's sessions that had each event at least once, per day of the first view."""
    once = funnel.select("date", "session_id", "event_type", "event_name").distinct()
    counted = once.groupingSets(
        [["date"], ["date", "event_type", "event_name"]], "date", "event_type", "event_name"
    ).agg(F.grouping_id().alias("level"), F.count_distinct("session_id").alias("event_sessions"))
    of_day = Window.partitionBy("date")
    return (
        counted.withColumn("sessions", F.max(F.when(F.col("level") > 0, F.col("event_sessions"))).over(of_day))
        .filter((F.col("level") == 0) & F.col("event_name").isNotNull())
        .select(
            "date", "event_type", "event_name", "sessions", "event_sessions",
            F.try_divide("event_sessions", "sessions").alias("conversion_rate"),
        )
    )
