"""Versioned tables on plain parquet, so that the input of a training run can be read again.

Rows live under ``data/snapshot_version=N``; a version exists once its row is in ``history``, which is
written last, so a failed write is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.sources.workspace import read_or_empty

VERSION = "snapshot_version"
HISTORY_SCHEMA = "version int, written_at timestamp, operation string"


def history(spark: SparkSession, path: str) -> DataFrame:
    """Versions of a table, newest first."""
    return read_or_empty(spark, f"{path}/history", HISTORY_SCHEMA).orderBy(F.desc("version"))


def latest_version(spark: SparkSession, path: str) -> int:
    newest = history(spark, path).agg(F.max("version").alias("v")).first().v
    if newest is None:
        raise ValueError(f"no snapshot at {path}")
    return newest


def write_snapshot(df: DataFrame, path: str) -> int:
    """Write all rows as the next version. One writer at a time."""
    spark = df.sparkSession
    newest = history(spark, path).agg(F.max("version").alias("v")).first().v
    version = 0 if newest is None else newest + 1
    df.write.mode("overwrite").parquet(f"{path}/data/{VERSION}={version}")
    entry = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("written_at"),
                                  F.lit("WRITE").alias("operation"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/history")
    return version


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows as of a version (default the newest); other versions' files are pruned, not read."""
    known = {r.version for r in history(spark, path).select("version").collect()}
    version = max(known, default=None) if version is None else version
    if version not in known:
        raise ValueError(f"{path} has no version {version}")
    return spark.read.parquet(f"{path}/data").filter(F.col(VERSION) == version).drop(VERSION)
