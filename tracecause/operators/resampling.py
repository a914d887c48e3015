"""Sums over replicates of the rows as matrix products.

A replicate is a weight per row that follows from the row's key. A task keeps its rows where they are, makes the
replicates x rows matrix of weights for a batch, multiplies it with the batch's terms and yields one partial sum per group
when its rows are done. Rows are never copied per replicate, and what moves is a partial sum per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.functions.randomness import mixed_matrix, poisson_values, uniform_matrix
from tracecause.sources.workspace import ship

COMBINERS = 16        # tasks that add up the partial sums of all others
HELD_GROUPS = 512     # groups a task holds before it passes its sums on
MODES = ("refit", "resample", "subsample")


@dataclass(frozen=True)
class Weights:
    """Weight of each row in each replicate: Poisson(1) counts, or 0 and 1 for a subsample.

    ``md5`` weights can be reproduced by any SQL engine; ``xxhash64`` takes one hash per row and some integer steps
    per replicate.
    """

    mode: str
    replicates: int
    frac: float = 0.6
    seed: int = 0
    method: str = "md5"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} has no row weights")
        if self.replicates < 1:
            raise ValueError("at least one resample")
        if self.method not in ("md5", "xxhash64"):
            raise ValueError(f"unknown hash method {self.method!r}")

    @property
    def label(self) -> str:
        return "sample" if self.mode == "subsample" else "boot"

    def source(self, key: Column) -> Column:
        """What :meth:`matrix` needs of a row: its key as text, or one hash of it."""
        text = key.cast("string")
        return text if self.method == "md5" else F.xxhash64(text, F.lit(self.label), F.lit(str(self.seed)))

    def matrix(self, source: pa.Array) -> np.ndarray:
        """Replicates x rows."""
        if self.method == "md5":
            keys = [(k or "").encode() for k in source.to_pylist()]
            u = uniform_matrix(keys, [f":{self.label}:{r}:{self.seed}".encode() for r in range(self.replicates)])
        else:
            u = mixed_matrix(source.to_numpy(zero_copy_only=False).astype(np.int64), self.replicates)
        return (u < self.frac).astype(np.int64) if self.mode == "subsample" else poisson_values(u).astype(np.int64)


class Partial:
    """Running sums of one group: (replicates x terms), lowest values where drawn, and weight per bucket."""

    def __init__(self, replicates: int, terms: int, lows: int, buckets: int):
        self.sums = np.zeros((replicates, terms))
        self.lows = np.full((replicates, lows), np.inf)
        self.totals = np.zeros((replicates, buckets), np.int64)

    def add(self, weight: np.ndarray, terms: np.ndarray, lows: np.ndarray, bucket: np.ndarray | None) -> None:
        self.sums += weight @ terms
        for j in range(lows.shape[1]):
            self.lows[:, j] = np.minimum(self.lows[:, j], np.where(weight > 0, lows[None, :, j], np.inf).min(axis=1))
        if bucket is not None and self.totals.shape[1]:
            order = np.argsort(bucket, kind="stable")
            at, starts = np.unique(bucket[order], return_index=True)
            self.totals[:, at] += np.add.reduceat(weight[:, order], starts, axis=1)

    def merge(self, other: "Partial") -> None:
        self.sums += other.sums
        self.lows = np.minimum(self.lows, other.lows)
        self.totals += other.totals

    def pack(self) -> tuple[bytes, bytes, bytes]:
        return self.sums.tobytes(), self.lows.tobytes(), self.totals.tobytes()

    @classmethod
    def unpack(cls, replicates: int, packed) -> "Partial":
        out = cls(replicates, 0, 0, 0)
        out.sums, out.lows = (np.frombuffer(p, np.float64).reshape(replicates, -1).copy() for p in packed[:2])
        out.totals = np.frombuffer(packed[2], np.int64).reshape(replicates, -1).copy()
        return out


PACKED = pa.schema([("salt", pa.int32()), ("sums", pa.binary()), ("lows", pa.binary()), ("totals", pa.binary())])
PACKED_DDL = "salt int, sums binary, lows binary, totals binary"


def replicate_sums(rows: DataFrame, by: list[str], weights: Weights, key: Column, columns: list[str],
                   terms: Callable[[dict[str, np.ndarray]], np.ndarray], n_terms: int, lows: list[str] | None = None,
                   bucket: Column | None = None, buckets: int = 0) -> dict[tuple, Partial]:
    """Weighted sums of ``terms`` (a function from column arrays to rows x terms) per group of ``by``.

    The groups are few by construction (periods, folds); their sums come to the driver.
    """
    ship(rows.sparkSession)
    lows = lows or []
    made = rows.select(*by, weights.source(key).alias("__w"), *[F.col(c).cast("double").alias(c) for c in columns],
                       (bucket if bucket is not None else F.lit(0)).cast("int").alias("__bucket"),
                       (F.spark_partition_id() % COMBINERS).alias("__salt"))
    by_fields = [pa.field(b, t.type) for b, t in zip(by, pa_fields(made, by))]
    schema = pa.schema([*by_fields, *PACKED])
    ddl = ", ".join([f"`{b}` {made.schema[b].dataType.simpleString()}" for b in by] + [PACKED_DDL])
    replicates = weights.replicates

    def written(group, salt, part):
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*group, salt, *part.pack()), schema)], schema=schema)

    def partial(batches):
        held, salt = {}, 0
        for b in batches:
            if not b.num_rows:
                continue
            salt = b.column("__salt")[0].as_py()
            groups = list(zip(*[b.column(c).to_pylist() for c in by])) if by else [()] * b.num_rows
            for group in dict.fromkeys(groups):
                part = b.filter(pa.array([g == group for g in groups])) if by else b
                x = {c: part.column(c).to_numpy(zero_copy_only=False) for c in columns}
                if group not in held:
                    held[group] = Partial(replicates, n_terms, len(lows), buckets)
                held[group].add(weights.matrix(part.column("__w")), terms(x),
                                np.column_stack([x[c] for c in lows]) if lows else np.zeros((part.num_rows, 0)),
                                part.column("__bucket").to_numpy(zero_copy_only=False))
        for group, part in held.items():
            yield written(group, salt, part)

    def combined(batches):
        held = {}
        for b in batches:
            for r in b.to_pylist():
                group = tuple(r[c] for c in by)
                part = Partial.unpack(replicates, (r["sums"], r["lows"], r["totals"]))
                if group in held:
                    held[group].merge(part)
                else:
                    held[group] = part
        for group, part in held.items():
            yield written(group, 0, part)

    found = made.mapInArrow(partial, ddl).repartition("salt").mapInArrow(combined, ddl)
    out: dict[tuple, Partial] = {}
    for r in found.toArrow().to_pylist():
        group = tuple(r[c] for c in by)
        part = Partial.unpack(replicates, (r["sums"], r["lows"], r["totals"]))
        if group in out:
            out[group].merge(part)
        else:
            out[group] = part
    return out


def array_sums(df: DataFrame, columns: list[str], terms: Callable[[dict[str, np.ndarray]], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``terms``, a function from the columns of a batch to an array of sums of any one length.

    A task yields one partial sum, and what comes to the driver has the length of the array.
    """
    ship(df.sparkSession)

    def partial(batches):
        total = None
        for b in batches:
            if b.num_rows:
                here = terms({c: b.column(c).to_numpy(zero_copy_only=False) for c in columns}).ravel()
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), pa.array(total.astype(np.float64))],
                                             names=["i", "v"])

    found = df.select(*columns).mapInArrow(partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(found.num_rows)
    out[found.column("i").to_numpy()] = found.column("v").to_numpy()
    return out


def pa_fields(df: DataFrame, names: list[str]) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(n, to_arrow_type(df.schema[n].dataType)) for n in names]


def bootstrap_sums(df: DataFrame, key: Column, by: list[str], values: list[str], weights: Weights) -> DataFrame:
    """``(by..., replicate, n, top, value...)``: rows, largest weight and weighted sums per group and replicate.

    Null and NaN values add nothing to their sum. Any number of groups: a task passes its sums on when it holds many.
    """
    ship(df.sparkSession)
    made = df.select(*by, weights.source(key).alias("__w"), *[F.col(v).cast("double").alias(v) for v in values])
    replicates = weights.replicates
    lists = ["n", "top", *values]
    schema = pa.schema([*pa_fields(made, by), pa.field("n", pa.list_(pa.int64())), pa.field("top", pa.list_(pa.int64())),
                        *[pa.field(v, pa.list_(pa.float64())) for v in values]])
    ddl = ", ".join([f"`{b}` {made.schema[b].dataType.simpleString()}" for b in by] + ["n array<long>", "top array<long>"]
                    + [f"`{v}` array<double>" for v in values])

    def partial(batches):
        held = {}

        def flushed():
            columns = list(zip(*[(*g, n, top, *sums.T) for g, (n, top, sums) in held.items()]))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

        for b in batches:
            if not b.num_rows:
                continue
            w = weights.matrix(b.column("__w"))
            x = (np.column_stack([b.column(v).to_numpy(zero_copy_only=False).astype(float) for v in values]) if values
                 else np.zeros((b.num_rows, 0)))
            x = np.where(np.isnan(x), 0.0, x)
            groups = list(zip(*[b.column(c).to_pylist() for c in by])) if by else [()] * b.num_rows
            number = {g: i for i, g in enumerate(dict.fromkeys(groups))}
            at = np.fromiter((number[g] for g in groups), np.int64, len(groups))
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(len(number) + 1))
            for g, i in number.items():
                mine = order[ends[i]:ends[i + 1]]
                n, top, sums = held.get(g, (np.zeros(replicates, np.int64), np.zeros(replicates, np.int64),
                                            np.zeros((replicates, len(values)))))
                held[g] = n + w[:, mine].sum(axis=1), np.maximum(top, w[:, mine].max(axis=1)), sums + w[:, mine] @ x[mine]
            if len(held) > HELD_GROUPS:
                yield flushed()
                held.clear()
        if held:
            yield flushed()

    parts = made.mapInArrow(partial, ddl)
    each = parts.select(*by, F.posexplode(F.arrays_zip(*[F.col(c) for c in lists])).alias("replicate", "s"))
    return each.groupBy(*by, "replicate").agg(F.sum("s.n").alias("n"), F.max("s.top").cast("int").alias("top"),
                                              *[F.sum(F.col("s")[v]).alias(v) for v in values])
