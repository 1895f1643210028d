"""Classified page views and conversion events. Everything here is narrow: no row leaves its partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import rules
from footfall.functions.dates import DateWindow
from footfall.functions.urls import traffic_source, url_host

SEGMENTS = ("device_type", "region", "state_group", "page_name", "page_job", "channel")
REACH_COLUMNS = ("user_id", "session_id", "date", *SEGMENTS)
CONVERT_COLUMNS = (*REACH_COLUMNS, "convert_event")


def rows_in_window(logs: DataFrame, window: DateWindow | None, where: Column | None = None) -> DataFrame:
    """Log rows of the window that also pass the caller's audience filter (domain, staff, page ...)."""
    if window is not None:
        logs = logs.filter(window.has_time(F.col("time")))
    return logs if where is None else logs.filter(where)


def with_channel_inputs(rows: DataFrame, *, publisher: Column | None = None) -> DataFrame:
    """Prepare the columns that channel rules read: lower case, empty when missing.

    ``source`` is taken from the query unless the rows already carry it; ``referrer_host`` is added.
    Without ad metadata the publisher is empty.
    """
    inputs = {
        "source": F.col("source") if "source" in rows.columns else traffic_source(F.col("query")),
        "publisher": F.lit("") if publisher is None else publisher,
        **{c: F.col(c) for c in ("utm_medium", "utm_source", "query", "referrer")},
    }
    lowered = rows.withColumns({name: F.coalesce(F.lower(c), F.lit("")) for name, c in inputs.items()})
    return lowered.withColumn("referrer_host", url_host(F.col("referrer")))


def with_channel(rows: DataFrame, channel_rules: Sequence = rules.CHANNEL_RULES, **inputs) -> DataFrame:
    return with_channel_inputs(rows, **inputs).withColumn("channel", rules.channel(channel_rules))


def with_pages(rows: DataFrame, page_rules: Sequence = rules.PAGE_RULES) -> DataFrame:
    """Page name and page job from one pass over the page rules."""
    tested = rows.withColumns(
        {"page_domain": F.coalesce("domain", F.lit("")), "page_path": F.coalesce("path", F.lit(""))}
    )
    numbered = tested.withColumn("page_rule_no", rules.page_rule_no("page_domain", "page_path", page_rules))
    return numbered.withColumns(
        {
            "page_name": rules.page_name("page_rule_no", page_rules),
            "page_job": rules.page_job("page_rule_no", page_rules),
        }
    )


def classify_pageviews(
    pageviews: DataFrame,
    window: DateWindow | None,
    *,
    where: Column | None = None,
    page_rules: Sequence = rules.PAGE_RULES,
    state_groups: Sequence = rules.STATE_GROUPS,
    channel_rules: Sequence = rules.CHANNEL_RULES,
) -> DataFrame:
    """Page views of the window with every reporting dimension; ``window=None`` classifies all history."""
    rows = rows_in_window(pageviews, window, where).withColumns(
        {"date": F.to_date("time"), "state_group": rules.state_group("region", state_groups)}
    )
    return with_channel(with_pages(rows, page_rules), channel_rules).select(*REACH_COLUMNS)


def label_events(logs: DataFrame, labels: Sequence[tuple[Column, object]], column: str) -> DataFrame:
    """Keep the log rows that match a rule and name them after the first rule that matches.

    The filter comes from the same rules as the label, so the two cannot drift apart.
    """
    kept = logs.filter(rules.any_of(condition for condition, _ in labels))
    return kept.withColumn(column, rules.first_match(labels))


def union_logs(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of several logs (one at least) that have the same columns."""
    if not parts:
        raise ValueError("no log is given")
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def join_publishers(events: DataFrame, ads_metadata: DataFrame) -> DataFrame:
    """Attach the publisher(s) of each event's source.

    A source with several publishers yields one row per publisher. No broadcast is forced: Spark
    broadcasts the metadata while it is below ``spark.sql.autoBroadcastJoinThreshold``, otherwise the
    join shuffles and a dominant source (or the many events without one) is split by AQE, which can
    split the preserved side of a left join.
    """
    publishers = ads_metadata.select("source", "publisher").distinct()
    return events.join(publishers, "source", "left")


def classify_conversions(
    events: DataFrame,
    window: DateWindow | None,
    ads_metadata: DataFrame,
    *,
    where: Column | None = None,
    page_rules: Sequence = rules.PAGE_RULES,
    state_groups: Sequence = rules.STATE_GROUPS,
    channel_rules: Sequence = rules.CHANNEL_RULES,
) -> DataFrame:
    """Labelled conversion events (column ``convert_event``) with every reporting dimension."""
    rows = rows_in_window(events, window, where).withColumns(
        {
            "date": F.to_date("time"),
            "state_group": rules.state_group("region", state_groups),
            "source": traffic_source(F.col("query")),
        }
    )
    rows = join_publishers(with_pages(rows, page_rules), ads_metadata)
    return with_channel(rows, channel_rules, publisher=F.col("publisher")).select(*CONVERT_COLUMNS)
