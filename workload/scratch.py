"""Scratch tables for queries that show a writer: kept in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from footfall.sources.tables import PARTITIONS, create_reporting_tables, create_table
from footfall.sources.versions import create_versioned_table

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session may fall back to a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="footfall-")
    return _LOCAL_FOLDERS[application]


def scratch_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str]) -> str:
    """A new, empty managed table, replacing the one of an earlier call in this application."""
    application = spark.sparkContext.applicationId
    database = "footfall_" + "".join(c if c.isalnum() else "_" for c in application)
    location = f"{shared_folder(spark)}/{database}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    table = f"{database}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_table(spark, table, schema, partition_by)
    return table


def scratch_versioned(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str]) -> str:
    """As ``scratch_table``, a versioned one."""
    table = scratch_table(spark, f"{name}_versions", schema, partition_by).removesuffix("_versions")
    spark.sql(f"DROP TABLE {table}_versions")
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    create_versioned_table(spark, table, schema, partition_by)
    return table


def scratch_reporting(spark: SparkSession, name: str) -> str:
    """A database with the reporting tables, empty, replacing the one of an earlier call in this application."""
    application = spark.sparkContext.applicationId
    database = f"footfall_{name}_" + "".join(c if c.isalnum() else "_" for c in application)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_folder(spark)}/{database}'")
    for table in PARTITIONS:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    create_reporting_tables(spark, database)
    return database
