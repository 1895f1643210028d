"""Tables whose slices change in one step: versioned partitions behind a view.

The rows of ``t`` are in the table ``t_versions``, which has one more partition column, ``version``. The view ``t`` shows,
of each partition, the version that its text lists. A writer adds the new rows of a slice as a version of their own,
which nobody sees, and then replaces the view: one change in the metastore that takes out the slice's old partitions,
stale ones included, and puts in the new ones. A run that fails before leaves the old slice, one that fails after has
written the new one; a reader sees either, also while older files are still there. ``remove_old_versions`` drops later
what the view no longer lists. The filter is on partition columns only, so Spark prunes by it before any file is read.

One writer per table at a time: views are replaced whole, and appends to one table share a folder while they run. A lock
guards the threads of one process only.
"""

from __future__ import annotations

import json
import re
import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rules import sql_text

VERSION = "version"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_SWITCH_LOCK = threading.RLock()
_LISTED = re.compile(r"from_json\('((?:[^'\\]|\\.)*)', 'map<string,string>'\)", re.DOTALL)


def _versions(table: str) -> str:
    return f"{table}_versions"


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_versions(table)) if c.isPartition and c.name != VERSION]


def _slice_name(spec: Mapping[str, str], columns: Sequence[str]) -> str:
    return json.dumps([spec[c] for c in columns], separators=(",", ":"), ensure_ascii=False)


def create_versioned_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """Create an empty versioned table unless it exists. Slices are sets of its partitions."""
    if not partition_by:
        raise ValueError(f"{table} has no partition columns")
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = ", ".join(f"`{c}`" for c in (*partition_by, VERSION))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_versions(table)} ({columns}, `{VERSION}` string) USING parquet PARTITIONED BY ({parts})")
    _show(spark, table, {})


def is_versioned(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(_versions(table))


def _show(spark: SparkSession, table: str, current: Mapping[str, str]) -> None:
    """Let the view show these versions of these partitions; one change in the metastore."""
    partition_by = _partition_columns(spark, table)
    columns = [c.name for c in spark.catalog.listColumns(_versions(table)) if c.name != VERSION]
    # A slice's name is the JSON array of its partition values, as SHOW PARTITIONS tells them.
    values = ", ".join(f"coalesce(cast(`{c}` as string), '{NULL_PARTITION}')" for c in partition_by)
    listed = sql_text(json.dumps(dict(sorted(current.items())), separators=(",", ":"), ensure_ascii=False))
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} AS SELECT {', '.join(f'`{c}`' for c in columns)} FROM {_versions(table)} "
        f"WHERE `{VERSION}` = try_element_at(from_json({listed}, 'map<string,string>'), to_json(array({values})))"
    )


def current_versions(spark: SparkSession, table: str) -> dict[str, str]:
    """The version that each partition shows, by the name of the partition's slice."""
    text = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'View Text'").first()["data_type"]
    return json.loads(re.sub(r"\\(.)", r"\1", _LISTED.search(text)[1]))


def _stored(spark: SparkSession, table: str, version: str | None = None) -> list[dict[str, str]]:
    within = "" if version is None else f" PARTITION (`{VERSION}` = {sql_text(version)})"
    rows = spark.sql(f"SHOW PARTITIONS {_versions(table)}{within}").collect()
    # Values are escaped as in paths.
    return [{k: re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), v) for k, v in (x.split("=", 1) for x in r[0].split("/"))} for r in rows]


def replace_slice(rows: DataFrame, table: str, in_slice: Callable[[Mapping[str, str]], bool], *, rebalance: bool = True) -> str:
    """Make the partitions of ``table`` that ``in_slice`` accepts hold exactly ``rows``; return the new version.

    ``in_slice`` is asked about partition values as text. Rows outside of the slice are an error of the caller: they
    would replace their partitions too.
    """
    spark = rows.sparkSession
    with _SWITCH_LOCK:
        version = f"{time.time_ns():020d}"
        partition_by = _partition_columns(spark, table)
        written = rows.select(*spark.table(table).columns).withColumn(VERSION, F.lit(version))
        ordered = written.select(*spark.table(_versions(table)).columns)
        (ordered.hint("rebalance", *partition_by) if rebalance else ordered).write.insertInto(_versions(table))
        new = {_slice_name(spec, partition_by): version for spec in _stored(spark, table, version)}
        current = current_versions(spark, table)
        kept = {name: v for name, v in current.items() if not in_slice(dict(zip(partition_by, json.loads(name), strict=True)))}
        _show(spark, table, kept | new)
    return version


def remove_old_versions(spark: SparkSession, table: str, before: str | None = None) -> int:
    """Drop partitions that the view does not list, all or those of versions below ``before``; return their number.

    Readers that began before the last switch may still read them, and a writer's unfinished version is not listed
    either: run it when none is at work, or with a ``before`` that is old enough.
    """
    current, partition_by = current_versions(spark, table), _partition_columns(spark, table)
    old = [
        spec for spec in _stored(spark, table)
        if current.get(_slice_name(spec, partition_by)) != spec[VERSION] and (before is None or spec[VERSION] < before)
    ]

    def literal(value: str) -> str:
        return "null" if value == NULL_PARTITION else sql_text(value)

    if old:
        listed = ", ".join("PARTITION (" + ", ".join(f"`{k}` = {literal(v)}" for k, v in spec.items()) + ")" for spec in old)
        spark.sql(f"ALTER TABLE {_versions(table)} DROP IF EXISTS {listed}")
    return len(old)
