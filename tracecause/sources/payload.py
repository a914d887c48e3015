"""Rows to JSON and back, for request and response logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_payload(df: DataFrame, key: Column, name: str = "request_json") -> DataFrame:
    """``(row_key, request_json)``."""
    return df.select(key.cast("string").alias("row_key"), F.to_json(F.struct("*")).alias(name))


def from_payload(df: DataFrame, schema: T.StructType | str, name: str = "request_json") -> DataFrame:
    return df.select(F.from_json(F.col(name), schema).alias("r")).select("r.*")
