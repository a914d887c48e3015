"""Whitening of embeddings by the weighted covariance of their distinct integer vectors.

Components become integers x = floor(scale * c) + shift. Rows with equal x are one vector with a multiplicity: the distinct
vectors are written once, and sums and the centred matrix product run over them with the multiplicity (or one) as weight.
Every distinct vector is whitened once, and the rows get the result back by a join on two 64-bit hashes of x (two different
vectors share both with a chance of 2^-128 a pair). A vector that more than one row in ``HOT`` has comes to its rows by a
broadcast, and there are fewer than ``HOT`` such vectors; the rest meet in a shuffle.

To the driver come one number per dimension and one per pair of dimensions, added up by Spark. Sums and deviations are
exact integers; the covariance is centred with the exact mean before multiplying.

Edge cases: rows whose vector is null or holds null or non-finite entries go, and so do vectors of another length than most
(of equally frequent lengths the shortest counts) and empty ones. Null and repeated ids are carried like any other. A scaled
entry beyond 2^61 either way counts as 2^61. Components whose eigenvalue is under ``FLAT`` of the largest do not
vary and are left out; so one vector, or copies of one, give no rows, and an empty table none. ``deviation`` is null where it
is beyond 64 bits; ``deviation_exact`` always holds it up to 38 digits, and is null beyond these.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage, dense, summed

HOT, FLAT, MOST_COMPONENTS = 1000, 1e-10, 32
SAFE, MOST = 1 << 62, 2.0 ** 61
EXACT = Context(prec=38)


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: int, shift: int) -> DataFrame:
    """(id, x, k1, k2): integer vectors of the rows that take part, and two hashes of each."""
    c = F.col("c")
    good = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("c"))
    good = good.where(c.isNotNull() & (F.size(c) > 0)
                      & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    usual = good.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), "d").first()
    good = good.where(F.size(c) == (usual["d"] if usual else 0))
    x = good.select("id", F.transform(c, lambda v: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), v * scale)))
                                      + F.lit(shift).cast("long")).alias("x"))
    return x.select("id", "x", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(13), "x").alias("k2"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, k1, k2, w) per distinct vector, w being its number of rows; written to the shared folder."""
    return cut_lineage(rows.groupBy("x").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.count("*").alias("w")))


def exact_sums(vectors: DataFrame, weight: Column) -> list[int]:
    """Weighted sum of every dimension."""
    def partial(batches):
        totals = None
        for b in batches:
            if not b.num_rows:
                continue
            x, w = dense(b.column(0), np.int64), b.column(1).to_numpy()
            if max(abs(int(x.min())), abs(int(x.max()))) * int(w.sum()) >= SAFE:
                x, w = x.astype(object), w.astype(object)
            here = (x * w[:, None]).sum(axis=0).astype(object)
            totals = here if totals is None else totals + here
        if totals is not None:
            yield pa.RecordBatch.from_pydict(
                {"i": range(len(totals)), "v": pa.array([Decimal(int(t)) for t in totals], pa.decimal128(38, 0))},
                pa.schema([("i", pa.int32()), ("v", pa.decimal128(38, 0))]))

    found = vectors.select("x", weight.alias("w")).mapInArrow(partial, "i int, v decimal(38,0)")
    return [int(r["v"]) for r in found.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()]


@dataclass(frozen=True)
class Whitening:
    """Mean as exact sums over ``n`` rows, components as columns, eigenvalues falling."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the exact mean: the whole part is taken off in integers, the rest as doubles."""
        return centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum of (n*x - S)^2: with x = whole + d and S = n*whole + rest it is n^2 d.d - 2 n rest.d + rest.rest."""
        whole, rest = np.array([s // self.n for s in self.sums], object), np.array([s % self.n for s in self.sums], object)
        d = x.astype(object) - whole if too_large(x, whole) else x - whole.astype(np.int64)
        top, wide = max(abs(int(d.min())), abs(int(d.max()))), d.shape[1]
        if d.dtype != object and max(top * top, top * int(rest.max())) * wide < SAFE:
            rest_now = rest.astype(np.int64)
        else:
            d, rest_now = d.astype(object), rest
        squares, crossed, own = (d * d).sum(axis=1).tolist(), (d @ rest_now).tolist(), int((rest * rest).sum())
        return [self.n ** 2 * a - 2 * self.n * b + own for a, b in zip(squares, crossed)]


def too_large(x: np.ndarray, whole: np.ndarray) -> bool:
    return max(abs(int(x.min())), abs(int(x.max()))) + max(abs(w) for w in whole) >= SAFE


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole, rest = np.array([s // n for s in sums], object), np.array([(s % n) / n for s in sums])
    d = x.astype(object) - whole if too_large(x, whole) else x - whole.astype(np.int64)
    return d.astype(np.float64) - rest


def fit(vectors: DataFrame, multiplicity: bool = True, most: int = MOST_COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors, weighted by their number of rows or, without ``multiplicity``, by one each."""
    weight = F.col("w") if multiplicity else F.lit(1).cast("long")
    n = vectors.agg(F.sum(weight)).first()[0]
    if not n:
        return None
    sums = exact_sums(vectors, weight)
    width = len(sums)

    def products(b: pa.RecordBatch) -> np.ndarray:
        d = centred(dense(b.column(0), np.int64), n, sums)
        return (d * b.column(1).to_numpy()[:, None]).T @ d

    v = summed(vectors.select("x", weight.alias("w")), products).reshape(width, width) / n
    v = (v + v.T) / 2
    values, components = np.linalg.eigh(v)
    values, components = values[::-1], components[:, ::-1]
    kept = min(most, int((values > FLAT * values[0]).sum())) if values[0] > 0 else 0
    return Whitening(n, sums, components[:, :kept], values[:kept], float(np.trace(v)))


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(k1, k2, w, z, deviation, deviation_exact) per distinct vector."""
    exact = pa.decimal128(38, 0)
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("w", pa.int64()), ("z", pa.list_(pa.float64())),
                        ("deviation", pa.int64()), ("deviation_exact", exact)])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = dense(b.column("x"), np.int64)
            far, z = model.deviations(x), model.whiten(x)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column("k1"), b.column("k2"), b.column("w"), pa.ListArray.from_arrays(ends, pa.array(z.ravel())),
                pa.array([v if v < 1 << 63 else None for v in far], pa.int64()),
                pa.array([EXACT.create_decimal(v) if v < 10 ** 38 else None for v in far], exact)], schema=schema)

    return vectors.mapInArrow(run, "k1 long, k2 long, w long, z array<double>, deviation long, deviation_exact decimal(38,0)")


def identity_error(found: DataFrame, model: Whitening, multiplicity: bool = True) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity."""
    k = len(model.values)

    def products(b: pa.RecordBatch) -> np.ndarray:
        z = np.column_stack([dense(b.column(0), np.float64), np.ones(b.num_rows)])
        return (z * b.column(1).to_numpy()[:, None]).T @ z

    weight = F.col("w") if multiplicity else F.lit(1).cast("long")
    m = summed(found.select("z", weight.alias("w")), products).reshape(k + 1, k + 1) / model.n
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def back_to_rows(rows: DataFrame, vectors: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with what was computed for their vector."""
    total = vectors.agg(F.sum("w")).first()[0]
    found = found.select("k1", "k2", "w", "z", "deviation", "deviation_exact")
    plain = rows.select("id", "k1", "k2")
    often = F.col("w") > total // HOT
    # Fewer than HOT vectors can have more than one row in HOT, whatever the size of the table.
    hot = vectors.where(often).select("k1", "k2")
    if hot.isEmpty():
        return plain.join(found, ["k1", "k2"])
    seldom = plain.join(F.broadcast(hot), ["k1", "k2"], "left_anti").join(found.where(~often), ["k1", "k2"])
    return plain.join(F.broadcast(found.where(often)), ["k1", "k2"]).unionByName(seldom)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", *, scale: int = 64, shift: int = 1_000_000,
           multiplicity: bool = True, most: int = MOST_COMPONENTS) -> DataFrame:
    """(id, n, deviation, deviation_exact, z, explained, identity_error) per row; ``z`` has one entry per component."""
    if most < 1:
        raise ValueError("at least one component is needed")
    all_rows = integer_vectors(rows, id_column, vector, scale, shift)
    vectors = distinct_vectors(all_rows)
    model = fit(vectors, multiplicity, most)
    if model is None or not len(model.values):
        empty = {"n": "long", "deviation": "long", "deviation_exact": "decimal(38,0)", "z": "array<double>",
                 "explained": "array<double>", "identity_error": "double"}
        return all_rows.where(F.lit(False)).select("id", *[F.lit(None).cast(t).alias(name) for name, t in empty.items()])
    found = whitened(vectors, model)
    error = identity_error(found, model, multiplicity)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return back_to_rows(all_rows, vectors, found).select(
        "id", F.lit(model.n).cast("long").alias("n"), "deviation", "deviation_exact", "z", share.alias("explained"),
        F.lit(error).alias("identity_error"))
