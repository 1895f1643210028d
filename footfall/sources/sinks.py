"""Writers that replace exactly the slice a run recomputes, so that re-runs are safe.

Parquet tables cannot delete rows, so a slice is a set of partitions. Partitions with new rows are
swapped by dynamic partition overwrite when the whole write job has succeeded; only then are the
partitions of the slice that received no rows dropped. A run that fails before the commit leaves the old
slice in place, and repeating a run gives the same table. Versioned tables (``versions``) change in one step instead.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.functions.dates import DateWindow
from footfall.functions.rules import sql_text
from footfall.sources import versions


def _in_table_order(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(*rows.sparkSession.table(table).columns)


def _rebalanced(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Few, evenly sized files per partition; AQE splits partitions that are too large for one task."""
    return rows.hint("rebalance", *columns)


_MODE_LOCK = threading.RLock()
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Catalog inserts read the overwrite mode from the session only.

    Jobs in threads of one session would change it for one another, so one insert runs at a time.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _after_its_plan(rows: DataFrame, written: Observation, values: Column, where: Column) -> DataFrame:
    """``rows`` that pass ``where``, of which the distinct ``values`` are observed.

    The filter follows the observation, and Spark moves none below one. A filter on the columns that a roll-up names its
    groups by would else be moved below its aggregation, to every row of the fan-out.
    """
    return rows.observe(written, F.collect_set(F.when(where, values)).alias("values")).filter(where)


def _swap_partitions(rows: DataFrame, table: str, column: str, rebalance: bool, where: Column | None = None) -> set:
    """Overwrite the partitions that ``rows`` (those that pass ``where``) fill; return the values of ``column`` that were written.

    The values are collected by the write job itself. They are partition values of one slice: days of
    a window, grains or tests.
    """
    written = Observation()
    if where is None:
        observed = rows.observe(written, F.collect_set(F.col(column)).alias("values"))
    else:
        observed = _after_its_plan(rows, written, F.col(column), where)
    if rebalance:
        observed = _rebalanced(observed, _partition_columns(rows, table))
    with _overwrite_mode(rows.sparkSession, "dynamic"):
        _in_table_order(observed, table).write.insertInto(table, overwrite=True)
    try:
        return set(written.get["values"])
    except Py4JJavaError:
        # Spark keeps no metrics of a plan that it finds to be empty. Ask the rows instead of assuming so.
        asked = rows if where is None else rows.filter(where)
        return {r[0] for r in asked.select(column).distinct().collect()}


def _partition_columns(rows: DataFrame, table: str) -> list[str]:
    return [c.name for c in rows.sparkSession.catalog.listColumns(table) if c.isPartition]


def _drop_partitions(rows: DataFrame, table: str, specs: Sequence[dict[str, object]]) -> None:
    if specs:
        listed = ", ".join(
            "PARTITION (" + ", ".join(f"`{k}` = {_literal(v)}" for k, v in spec.items()) + ")" for spec in specs
        )
        rows.sparkSession.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return sql_text(str(value))


def replace_dates(rows: DataFrame, table: str, window: DateWindow, *, rebalance: bool = True) -> None:
    """Make the window's days in ``table`` hold exactly ``rows``; other days stay.

    ``rebalance=False`` saves a shuffle when the input already arrives clustered by day.
    """
    in_window = rows.filter(window.has_date(F.col("date")))
    if versions.is_versioned(rows.sparkSession, table):
        days = {d.isoformat() for d in window.days()}
        versions.replace_slice(in_window, table, lambda spec: spec["date"] in days, rebalance=rebalance)
        return
    written = _swap_partitions(in_window, table, "date", rebalance)
    _drop_partitions(rows, table, [{"date": day} for day in window.days() if day not in written])


def _stored_partitions(rows: DataFrame, table: str, within: str = "") -> list[dict[str, str]]:
    """Partition values of a table, as text."""
    listed = rows.sparkSession.sql(f"SHOW PARTITIONS {table} {within}").collect()
    return [dict(part.split("=", 1) for part in r[0].split("/")) for r in listed]


def replace_summary(rows: DataFrame, table: str, window: DateWindow, *, touched_only: bool = False) -> None:
    """Replace the window's daily analyses and all weekly and monthly ones; older daily rows stay.

    ``touched_only`` leaves weeks and months alone that the window does not touch; ``rows`` need not hold them
    (``summarize`` of the same name).
    """
    first_word = F.substring_index("analysis", " ", 1)
    grain = F.when(first_word.isin("Weekly", "Monthly"), F.lower(first_word)).otherwise("daily")
    week = F.concat(F.coalesce("reporting_wk_yr", F.lit("")), F.lit("-W"), F.lpad("week", 2, "0"))
    period = F.when(F.col("grain") == "weekly", week).when(F.col("grain") == "monthly", F.col("month")).otherwise(F.col("date").cast("string"))
    stored = rows.withColumn("grain", grain).withColumn("period", F.coalesce(period, F.lit("none")))
    scope: dict[str, set[str] | None] = {"daily": {d.isoformat() for d in window.days()}, "weekly": None, "monthly": None}
    if touched_only:
        weeks = [(d + timedelta(days=1)).isocalendar() for d in window.days()]
        scope |= {"weekly": {f"{w.year}-W{w.week:02}" for w in weeks}, "monthly": {f"{d:%Y-%m}" for d in window.days()}}
    chosen = F.expr(" or ".join(f"grain = '{g}'" + ("" if known is None else f" and period in ({', '.join(map(sql_text, sorted(known)))})") for g, known in scope.items()))
    if versions.is_versioned(rows.sparkSession, table):
        kept = _after_its_plan(stored, Observation(), F.col("period"), chosen)
        versions.replace_slice(kept, table, lambda spec: scope[spec["grain"]] is None or spec["period"] in scope[spec["grain"]])
        return
    written = _swap_partitions(stored.withColumn("mark", F.concat_ws(" ", "grain", "period")), table, "mark", True, chosen)
    stale = [
        x for x in _stored_partitions(rows, table)
        if f"{x['grain']} {x['period']}" not in written and (scope[x["grain"]] is None or x["period"] in scope[x["grain"]])
    ]
    _drop_partitions(rows, table, stale)


def replace_test(rows: DataFrame, table: str, testname: str) -> None:
    """Replace the rows of one test; other tests stay."""
    of_test = rows.filter(F.col("testname") == testname)
    if versions.is_versioned(rows.sparkSession, table):
        versions.replace_slice(of_test, table, lambda spec: spec["testname"] == testname)
        return
    written = _swap_partitions(of_test, table, "testname", True)
    if testname not in written:
        _drop_partitions(rows, table, [{"testname": testname}])


def replace_page(rows: DataFrame, table: str, page: str) -> None:
    """Make one page's partitions of ``table`` hold exactly ``rows``; other pages stay.

    The page's days that are stored but no longer written are dropped.
    """
    if versions.is_versioned(rows.sparkSession, table):
        versions.replace_slice(rows.withColumn("page", F.lit(page)), table, lambda spec: spec["page"] == page)
        return
    keys = [c for c in _partition_columns(rows, table) if c != "page"]
    mark = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION))) for c in keys])
    marked = rows.withColumn("page", F.lit(page)).withColumn("mark", mark)
    written = _swap_partitions(marked, table, "mark", True)
    stored = _stored_partitions(rows, table, f"PARTITION (page = {sql_text(page)})")
    stale = [x for x in stored if "/".join(f"{k}={x[k]}" for k in keys) not in written]
    _drop_partitions(rows, table, [{k: None if v == NULL_PARTITION else v for k, v in x.items()} | {"page": page} for x in stale])


def replace_table(rows: DataFrame, table: str) -> None:
    """Replace everything the table holds."""
    with _overwrite_mode(rows.sparkSession, "static"):
        _in_table_order(rows, table).write.insertInto(table, overwrite=True)
