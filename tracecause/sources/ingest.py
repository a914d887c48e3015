"""CSV files to tables: read distributed with a fixed schema, clean the column names, overwrite the table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def clean_name(name: str) -> str:
    """Spaces become underscores; a question mark goes."""
    return name.replace("?", "").replace(" ", "_")


def sanitize(df: DataFrame) -> DataFrame:
    """Rename all columns in one projection; two names that become one are an error."""
    names = [clean_name(c) for c in df.columns]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"column names collide after cleaning: {sorted(twice)}")
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Without a schema Spark reads the file once more to infer one."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_table(df: DataFrame, name: str, format: str = "parquet") -> None:
    df.write.format(format).mode("overwrite").saveAsTable(name)


def ingest(spark: SparkSession, paths: Mapping[str, str], schema_name: str,
           schemas: Mapping[str, T.StructType | str] | None = None) -> dict[str, str]:
    """``{table: csv path}`` to cleaned tables in a schema; gives ``{table: full name}``."""
    ensure_schema(spark, schema_name)
    out = {}
    for table, path in paths.items():
        out[table] = f"{schema_name}.{table}"
        write_table(sanitize(read_csv(spark, path, (schemas or {}).get(table))), out[table])
    return out
