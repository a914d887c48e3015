"""What the operators of this subpackage share: Arrow maps over rows, hash folds, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracecause.sources.workspace import cut_lineage, fresh_path, shared_folder

__all__ = ["cut_lineage", "dense", "fresh_path", "fold_of", "map_rows", "map_batches", "shared_folder", "summed", "table"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(df: DataFrame, batch: Callable[[pa.RecordBatch], Iterator[dict[str, list]]], ddl: str) -> DataFrame:
    """``mapInArrow`` of a function from one batch to column dictionaries."""
    schema = arrow_schema(ddl)

    def run(batches):
        for b in batches:
            for columns in batch(b):
                yield pa.RecordBatch.from_pydict(columns, schema=schema)

    return df.mapInArrow(run, ddl)


def map_rows(df: DataFrame, make: Callable[[], Callable[[str], tuple]], keep: list[str], outputs: str) -> DataFrame:
    """Columns computed from ``text``, beside the columns ``keep`` (null text: empty).

    ``make`` runs once per task and returns the function of one text; ``outputs`` is the DDL of its result tuple.
    The result holds ``keep`` and the outputs only.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    source = df.select(*kept, F.col("text").alias("__text"))
    names = StructType.fromDDL(outputs).fieldNames()
    schema = StructType([*source.schema.fields[:-1], *StructType.fromDDL(outputs).fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)

    def run(batches):
        one = make()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                results = [one(t or "") for t in part.column(len(keep)).to_pylist()]
                columns = [part.column(i).cast(out.field(i).type) for i in range(len(keep))]
                columns += [pa.array([r[i] for r in results], type=out.field(n).type) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return source.mapInArrow(run, schema)


def dense(column: pa.Array, kind) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return np.asarray(column.flatten(), dtype=kind).reshape(len(column), -1)


def summed(df: DataFrame, add: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum over all batches of an array that ``add`` makes of each: one partial sum per task, added up by Spark."""
    def partial(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                total = add(b) if total is None else total + add(b)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int64)), pa.array(total.ravel())],
                                             names=["i", "v"])

    found = df.mapInArrow(partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    return found.sort_values("i")["v"].to_numpy(np.float64)
