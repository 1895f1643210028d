"""Columns of the input logs and schemas of the reporting tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from footfall.sources.versions import create_versioned_table

# Columns that the operators read from each log. Further columns may be present for filters.
PAGEVIEW_COLUMNS = (
    "user_id", "session_id", "time", "device_type", "region", "domain", "path", "query",
    "utm_medium", "utm_source", "referrer", "landing_page",
)
EVENT_LOG_COLUMNS = PAGEVIEW_COLUMNS[:-1]
ASSIGNED_VARIATION_COLUMNS = ("session_id", "time", "testname", "variation")
METRIC_EVENT_COLUMNS = ("user_id", "time")
ADS_METADATA_COLUMNS = ("source", "publisher")


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_TEXT, _DAY, _COUNT, _NUMBER = T.StringType(), T.DateType(), T.LongType(), T.DoubleType()
_SEGMENTS = tuple(
    (c, _TEXT) for c in ("device_type", "region", "state_group", "page_name", "page_job", "channel")
)
_CALENDAR = (("week", _TEXT), ("month", _TEXT), ("reporting_wk_yr", _TEXT))

# The columns of the reporting tables.
# Counts are 64-bit throughout: monthly page views and per-session numbers outgrow narrower types.
REACH_EVENTS = _schema(("user_id", _TEXT), ("session_id", _TEXT), ("date", _DAY), *_SEGMENTS)
REACH_SUMMARY = _schema(
    ("analysis", _TEXT), ("date", _DAY), *_CALENDAR, *_SEGMENTS,
    ("pv_ct", _COUNT), ("session_ct", _COUNT), ("user_ct", _COUNT), ("grain", _TEXT), ("period", _TEXT),
)
CONVERT_EVENTS = _schema(*((f.name, f.dataType) for f in REACH_EVENTS), ("convert_event", _TEXT))
CONVERT_SUMMARY = _schema(
    ("analysis", _TEXT), ("date", _DAY), *_CALENDAR, *_SEGMENTS, ("convert_event", _TEXT), ("event_ct", _COUNT)
)
PAGE_VIEWS = _schema(
    ("user_id", _TEXT), ("session_id", _TEXT), ("time", T.TimestampNTZType()), ("date", _DAY),
    ("device_type", _TEXT), ("region", _TEXT), ("state_group", _TEXT), ("channel", _TEXT),
    ("landing_page", _TEXT), ("session_pv_seq", _COUNT), ("page", _TEXT),
)
PAGE_FUNNEL = _schema(
    ("session_id", _TEXT), ("date", _DAY), ("pv_time", T.TimestampNTZType()), ("event_type", _TEXT),
    ("event_name", _TEXT), ("event_description", _TEXT), ("device_type", _TEXT), ("region", _TEXT),
    ("state_group", _TEXT), ("channel", _TEXT), ("landing_page", _TEXT), ("page", _TEXT),
)
PAGE_EVENTS = _schema(
    ("session_id", _TEXT), ("time", T.TimestampNTZType()), ("event_type", _TEXT), ("event_name", _TEXT),
    ("event_description", _TEXT), ("page", _TEXT), ("funnel", _TEXT), ("date", _DAY),
)
AB_RESULTS = _schema(
    ("testname", _TEXT), ("variation", _TEXT), ("control_description", _TEXT), ("reporting_date", _DAY),
    ("metric_name", _TEXT), ("n_tre", _COUNT), ("n_con", _COUNT), ("metric_total_tre", _NUMBER),
    ("metric_total_con", _NUMBER), ("metric_normalized_tre", _NUMBER), ("metric_normalized_con", _NUMBER),
    ("variance_tre", _NUMBER), ("variance_con", _NUMBER), ("diff", _NUMBER), ("diff_pct", _NUMBER),
)
AB_INFERENCE = _schema(
    *((f.name, f.dataType) for f in AB_RESULTS),
    *((c, _NUMBER) for c in (
        "standard_error", "margin_of_error", "confidence_interval_lower", "confidence_interval_upper",
        "test_statistic", "p_value", "mde_80", "mde_90", "mde_95",
    )),
)

PARTITIONS = {
    "reach_overview_events": (REACH_EVENTS, ("date",)),
    "reach_overview_summary": (REACH_SUMMARY, ("grain", "period")),
    "convert_overview_events": (CONVERT_EVENTS, ("date",)),
    "convert_overview_summary": (CONVERT_SUMMARY, ("date",)),
    "page_insights_pv": (PAGE_VIEWS, ("page", "date")),
    "page_insights_events": (PAGE_EVENTS, ("page", "funnel", "date")),
    "page_insights_engagement": (PAGE_FUNNEL, ("page", "date")),
    "page_insights_conversion": (PAGE_FUNNEL, ("page", "date")),
    "ab_variant_results": (AB_RESULTS, ("testname",)),
    "ab_variant_inference": (AB_INFERENCE, ()),
}


def create_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty managed Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitions = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{partitions}")


def create_reporting_tables(spark: SparkSession, database: str, *, versioned: bool = False) -> None:
    """``versioned`` makes the partitioned ones views over versions, whose slices change in one step."""
    for name, (schema, partition_by) in PARTITIONS.items():
        if versioned and partition_by:
            create_versioned_table(spark, f"{database}.{name}", schema, partition_by)
        else:
            create_table(spark, f"{database}.{name}", schema, partition_by)


def read_summary(spark: SparkSession, table: str) -> DataFrame:
    """A summary table as reports see it, without its storage-only columns."""
    return spark.table(table).drop("grain", "period")
