"""Drawing noise from all rows a model was fitted on.

The rows have an order, that of a key hash, and a draw is the row at position ``floor(u * n)``. With replicates a row stands
there as often as its weight says, though it is never copied: weights follow from the key and are made again where needed.

Draws whose number is a parameter bring back the rows asked for and no others. One aggregate counts rows (or weights, per
replicate) by the first bits of the hash; so each position is known to lie in a bucket and at an offset in it, and only rows
of such buckets move. Draws for the rows of a table are an equi-join on the position, or, with replicates, a map over each
bucket's rows and the requests to it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracecause.functions.permutation import with_permuted
from tracecause.functions.randomness import double_array, rank_steps, uniform_matrix
from tracecause.operators.resampling import Weights
from tracecause.sources.workspace import cut_lineage, ship

MOST_BUCKETS = 1 << 14
MOST_TOTALS = 1 << 20  # weights per bucket and replicate that a task adds up


def bucket_count(n: int, replicates: int = 1, rows: int = 1024) -> int:
    """A power of two: about ``rows`` rows to a bucket, as far as the number of totals stays bounded."""
    most = max(1, min(MOST_BUCKETS, MOST_TOTALS // replicates))
    out = 1
    while out * 2 <= most and out * rows < n:
        out *= 2
    return out


def row_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit("pool"), F.lit(str(seed))).cast("binary"))


def bucket_of(hashed: Column, buckets: int) -> Column:
    """The first bits of the hash, so that buckets follow one another in its order."""
    return F.floor(F.conv(F.substring(hashed, 1, 4), 16, 10).cast("int") / F.lit((1 << 16) // buckets)).cast("int")


class RowOrder:
    """Complete rows in the order of their hash: ``rows`` has the columns ``__k`` (key as text) and ``nodes``.

    ``totals`` holds the number of rows per bucket, or the weights per replicate and bucket.
    """

    def __init__(self, rows: DataFrame, nodes, seed: int, n: int, weights: Weights | None = None, totals: np.ndarray | None = None):
        self.rows, self.nodes, self.seed, self.weights = rows, list(nodes), seed, weights
        self.buckets = totals.shape[1] if totals is not None else bucket_count(n, rows=4)
        self._totals = totals
        self._frame: DataFrame | None = None

    def placed(self, *extra: Column) -> DataFrame:
        hashed = row_hash(F.col("__k"), self.seed)
        return self.rows.select(*extra, bucket_of(hashed, self.buckets).alias("bucket"), hashed.alias("__h"), "__k",
                                *[F.col(n).cast("double").alias(n) for n in self.nodes])

    @property
    def totals(self) -> np.ndarray:
        """Replicates (or one) x buckets."""
        if self._totals is None:
            counts = self.placed().groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).toArrow()
            self._totals = np.zeros((1, self.buckets), np.int64)
            self._totals[0, counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
        return self._totals

    def size(self, replicate: int = 0) -> int:
        return int(self.totals[replicate].sum())

    def locate(self, replicate: int, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each position, and its offset there."""
        ends = np.cumsum(self.totals[replicate])
        bucket = np.searchsorted(ends, positions, side="right")
        return bucket, positions - (ends[bucket] - self.totals[replicate][bucket])

    @property
    def frame(self) -> DataFrame:
        """``(pos, node...)`` of all rows, for joins on the position; made when first asked for."""
        if self.weights is not None:
            raise ValueError("rows of replicates have no single position")
        if self._frame is None:
            self._frame = ranked(self)
        return self._frame


class StoredRows(RowOrder):
    """Rows that were written with their positions, ``(pos, node...)``."""

    def __init__(self, frame: DataFrame, size: int):
        super().__init__(frame, [c for c in frame.columns if c != "pos"], 0, size, totals=np.array([[size]]))
        self._frame = frame


class NoiseTable:
    """The rows that mechanisms of one fit draw from: all of an order, or those of one replicate of it."""

    def __init__(self, order: RowOrder, replicate: int = 0):
        self.order, self.replicate = order, replicate
        self.nodes = order.nodes
        self.fetched: dict[int, tuple] = {}

    @property
    def size(self) -> int:
        return self.order.size(self.replicate)

    @property
    def frame(self) -> DataFrame:
        return self.order.frame

    def join(self, df: DataFrame, u: Column, value: Column, name: str) -> DataFrame:
        """``df`` with a column ``name``: ``value`` at the row that the uniform ``u`` points to."""
        at = f"{name}__at"
        found = self.frame.select(F.col("pos").alias(at), value.alias(name))
        asked = df.withColumn(f"{at}_asked", F.floor(u * float(self.size)).cast("long"))
        return asked.join(found, F.col(f"{at}_asked") == F.col(at)).drop(at, f"{at}_asked")

    def positions(self, u: np.ndarray) -> np.ndarray:
        return np.floor(u * self.size).astype(np.int64)

    def rows(self, positions: np.ndarray) -> dict[str, np.ndarray]:
        fetch([(self, positions.tolist())])
        block = np.array([self.fetched[p] for p in positions.tolist()], dtype=float).reshape(len(positions), len(self.nodes))
        return {n: block[:, i] for i, n in enumerate(self.nodes)}


def fetch(wanted: list[tuple[NoiseTable, Iterable[int]]]) -> None:
    """Bring the rows at positions of several tables in one job; the callers' numbers of draws bound them."""
    by_table: dict[int, tuple[NoiseTable, set]] = {}
    for t, p in wanted:
        by_table.setdefault(id(t), (t, set()))[1].update(p)
    new = [(t, np.array(sorted(p - t.fetched.keys()), np.int64)) for t, p in by_table.values()]
    new = [(t, p) for t, p in new if len(p)]
    by_order: dict[int, list] = {}
    for t, p in new:
        by_order.setdefault(id(t.order), []).append((t, p))
    parts, tables = None, {}
    for which, group in enumerate(by_order.values()):
        order = group[0][0].order
        tables.update({(which, t.replicate): t for t, _ in group})
        asked = [(t.replicate, p, *order.locate(t.replicate, p)) for t, p in group]
        part = (weighted_rows if order.weights else plain_rows)(order, which, asked)
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return
    found = parts.toArrow()
    columns = (found.column(c).to_pylist() for c in ("which", "replicate", "pos", "x"))
    for which, replicate, position, x in zip(*columns):
        tables[which, replicate].fetched[position] = tuple(x)


def in_buckets(order: RowOrder, asked, *extra: Column) -> DataFrame:
    """The rows of buckets in which something is asked for."""
    placed, wanted = order.placed(*extra), sorted({int(b) for _, _, bucket, _ in asked for b in np.unique(bucket)})
    if len(wanted) > order.buckets // 2:
        return placed
    return placed.where(F.expr(f"bucket IN ({', '.join(map(str, wanted))})"))


def plain_rows(order: RowOrder, which: int, asked) -> DataFrame:
    _, position, bucket, offset = asked[0]
    if isinstance(order, StoredRows):
        places = order.frame.sparkSession.createDataFrame(pa.table({"pos": position}))
        return order.frame.join(F.broadcast(places), "pos").select(
            F.lit(which).alias("which"), F.lit(0).alias("replicate"), "pos", F.array(*order.nodes).alias("x"))
    local = F.row_number().over(Window.partitionBy("bucket").orderBy("__h", "__k")) - 1
    numbered = in_buckets(order, asked).withColumn("offset", local.cast("long"))
    places = order.rows.sparkSession.createDataFrame(pa.table({"bucket": bucket.astype(np.int32), "offset": offset, "pos": position}))
    return numbered.join(F.broadcast(places), ["bucket", "offset"]).select(
        F.lit(which).alias("which"), F.lit(0).alias("replicate"), "pos", F.array(*order.nodes).alias("x"))


def weighted_rows(order: RowOrder, which: int, asked) -> DataFrame:
    """Rows at positions of replicates: in the order of a bucket the weights of each replicate add up to offsets."""
    ship(order.rows.sparkSession)
    weights, nodes = order.weights, order.nodes
    places: dict[int, list] = {}
    for replicate, position, bucket, offset in asked:
        for b in np.unique(bucket):
            here = bucket == b
            places.setdefault(int(b), []).append((replicate, offset[here], position[here]))
    schema = pa.schema([("which", pa.int32()), ("replicate", pa.int32()), ("pos", pa.int64()), ("x", pa.list_(pa.float64()))])

    def pick(batches):
        current, passed = None, None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)] if len(buckets) else []
            for start, stop in zip(cuts, cuts[1:]):
                bucket, part = int(buckets[start]), batch.slice(start, stop - start)
                if bucket != current:
                    current, passed = bucket, np.zeros(weights.replicates, np.int64)
                ends = passed[:, None] + np.cumsum(weights.matrix(part.column("__w")), axis=1)
                x = np.column_stack([part.column(n).to_numpy(zero_copy_only=False) for n in nodes])
                for replicate, offset, position in places.get(bucket, ()):
                    mine = (offset >= passed[replicate]) & (offset < ends[replicate, -1])
                    if mine.any():
                        rows = x[np.searchsorted(ends[replicate], offset[mine], side="right")]
                        count = int(mine.sum())
                        yield pa.RecordBatch.from_pydict(
                            {"which": [which] * count, "replicate": [replicate] * count, "pos": position[mine], "x": list(rows)}, schema)
                passed = ends[:, -1]

    sorted_rows = (in_buckets(order, asked, weights.source(F.col("__k")).alias("__w")).repartition("bucket")
                   .sortWithinPartitions("bucket", "__h", "__k"))
    return sorted_rows.select("bucket", "__w", *nodes).mapInArrow(pick, "which int, replicate int, pos long, x array<double>")


def replicate_draws(order: RowOrder, ids: DataFrame, mechanisms: list[dict], nodes: list[str], seed: int) -> DataFrame:
    """``(__key, replicate, node...)``: a draw of each node's noise for every key of ``ids`` and every replicate.

    ``mechanisms`` holds the mechanisms of each replicate by node. Requests meet the rows of their bucket, which are there once,
    in one map; a bucket's rows are held in memory, a share of all rows that ``bucket_count`` sets.
    """
    ship(order.rows.sparkSession)
    weights, columns = order.weights, order.nodes
    replicates = weights.replicates
    ends = np.cumsum(order.totals, axis=1)
    starts = ends - order.totals
    asked = pa.schema([("bucket", pa.int32()), ("replicate", pa.int32()), ("which", pa.int32()), ("offset", pa.int64()),
                       ("__key", pa.string())])

    def ask(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                keys = batch.column(0).slice(at, 1000).to_pylist()
                raw = [k.encode() for k in keys]
                for which, node in enumerate(nodes):
                    u = uniform_matrix(raw, [f":{node}:{r}:{seed}".encode() for r in range(replicates)])
                    position = np.floor(u * ends[:, -1:]).astype(np.int64)
                    bucket = np.stack([np.searchsorted(ends[r], position[r], side="right") for r in range(replicates)])
                    offset = position - np.take_along_axis(starts, bucket, axis=1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(bucket.ravel().astype(np.int32)), pa.array(np.repeat(np.arange(replicates, dtype=np.int32), len(keys))),
                        pa.array(np.full(bucket.size, which, np.int32)), pa.array(offset.ravel()),
                        pa.array(keys * replicates, pa.string())], schema=asked)

    bare = [{n: replace(m, noise=None) for n, m in per.items()} for per in mechanisms]
    requests = ids.mapInArrow(ask, "bucket int, replicate int, which int, offset long, __key string")
    rows = order.placed(weights.source(F.col("__k")).alias("__w")).select(
        "bucket", F.lit(-1).alias("which"), "__h", "__k", "__w", F.array(*columns).alias("x"))
    both = rows.unionByName(requests, allowMissingColumns=True)
    schema = pa.schema([("__key", pa.string()), ("replicate", pa.int32()), ("which", pa.int32()), ("noise", pa.float64())])

    def answer(batches):
        current, sources, held, ends_here, x = None, [], [], None, None
        for batch in batches:
            bucket, which = batch.column("bucket").to_numpy(), batch.column("which").to_numpy()
            cuts = np.flatnonzero((np.diff(bucket) != 0) | ((which[1:] < 0) != (which[:-1] < 0))) + 1
            cuts = [0, *cuts.tolist(), len(bucket)] if len(bucket) else []
            for start, stop in zip(cuts, cuts[1:]):
                part = batch.slice(start, stop - start)
                if bucket[start] != current:
                    current, sources, held, ends_here = int(bucket[start]), [], [], None
                if which[start] < 0:
                    sources.append(part.column("__w"))
                    held.append(np.asarray(part.column("x").flatten(), dtype=np.float64).reshape(part.num_rows, -1))
                    continue
                if ends_here is None:
                    ends_here = np.cumsum(np.concatenate([weights.matrix(s) for s in sources], axis=1), axis=1)
                    x = np.concatenate(held)
                replicate, offset = part.column("replicate").to_numpy(), part.column("offset").to_numpy()
                kind, noise = part.column("which").to_numpy(), np.empty(part.num_rows)
                for r in np.unique(replicate):
                    mine = np.flatnonzero(replicate == r)
                    row = x[np.searchsorted(ends_here[r], offset[mine], side="right")]
                    values = {c: row[:, j] for j, c in enumerate(columns)}
                    for k in np.unique(kind[mine]):
                        drawn = np.broadcast_to(bare[r][nodes[k]].drawn(values), (len(mine),))
                        noise[mine[kind[mine] == k]] = drawn[kind[mine] == k]
                yield pa.RecordBatch.from_arrays([part.column("__key"), part.column("replicate"), part.column("which"), pa.array(noise)],
                                                 schema=schema)

    dealt = both.repartition("bucket").sortWithinPartitions("bucket", "which", "__h", "__k")
    found = dealt.select("bucket", "which", "__w", "x", "replicate", "offset", "__key").mapInArrow(
        answer, "__key string, replicate int, which int, noise double")
    return found.groupBy("__key", "replicate").agg(*[F.max(F.when(F.col("which") == i, F.col("noise"))).alias(n) for i, n in enumerate(nodes)])


def permuted_draws(table: NoiseTable, df: DataFrame, values: dict[str, Column], replicate=0, seed: int = 0) -> DataFrame:
    """``df``, with a column ``__key``, and a column per entry of ``values``: noise drawn without replacement.

    A keyed permutation per node says which row each row of the table gives its noise to, so noise is sent and not looked up:
    the rows of ``df``, dealt by the first bits of their hash, and what is sent to them go through one exchange, and meet
    within their bucket at the place that the order of the hash gives a row. Where ``df`` has more rows than the table,
    every row of the table gives again, by another permutation. Keys must identify a row.
    """
    kept, n = df.columns, table.size
    order = RowOrder(df.select(F.col("__key").alias("__k")), [], table.order.seed, n)
    counts, m = order.totals[0], order.size()
    ends = np.cumsum(counts)
    sent = None
    for epoch in range(-(-m // n) if n else 0):
        part, names = table.frame.select("pos", *[v.alias(f"__v{j}") for j, v in enumerate(values.values())]), list(values)
        for j, name in enumerate(names):
            part = with_permuted(part, "pos", f"__to{j}", n, name if not epoch else f"{name}/{epoch}", replicate, seed)
        gifts = F.array(*[F.struct(F.lit(j).alias("which"), (F.col(f"__to{j}") + epoch * n).alias("to"), F.col(f"__v{j}").alias("noise"))
                          for j in range(len(names))])
        part = part.select(F.inline(gifts)).where(F.col("to") < m)
        sent = part if sent is None else sent.unionByName(part)
    if sent is None:
        return df.select("*", *[F.lit(None).cast("double").alias(name) for name in values])
    # The bucket of a position: how many buckets end at or before it.
    steps = rank_steps("bucket", order.buckets, "<= to")
    sent = sent.withColumn("__ref", double_array(ends)).selectExpr("*", *steps)
    before = F.element_at(double_array(ends - counts), F.col("bucket") + 1)
    sent = sent.select("bucket", (F.col("to") - before).cast("long").alias("offset"), "which", "noise")
    hashed = row_hash(F.col("__key"), order.seed)
    rows = df.select(bucket_of(hashed, order.buckets).alias("bucket"), hashed.alias("__h"), F.col("__key").alias("__order"),
                     F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    both = rows.unionByName(sent, allowMissingColumns=True).repartition("bucket")
    local = F.row_number().over(Window.partitionBy("bucket", F.col("which").isNull()).orderBy("__h", "__order")) - 1
    placed = both.withColumn("offset", F.when(F.col("which").isNull(), local.cast("long")).otherwise(F.col("offset")))
    met = placed.groupBy("bucket", "offset").agg(F.first("row", ignorenulls=True).alias("row"), *[
        F.max(F.when(F.col("which") == j, F.col("noise"))).alias(name) for j, name in enumerate(values)])
    return met.select("row.*", *list(values))


def ranked(order: RowOrder) -> DataFrame:
    """``(pos, node...)``: positions follow from the place in the bucket and the number of rows in the buckets before."""
    before = np.cumsum(order.totals[0]) - order.totals[0]
    starts = order.rows.sparkSession.createDataFrame(pa.table({"bucket": np.arange(order.buckets, dtype=np.int32), "start": before}))
    local = F.row_number().over(Window.partitionBy("bucket").orderBy("__h", "__k")) - 1
    numbered = order.placed().withColumn("__local", local).join(F.broadcast(starts), "bucket")
    return cut_lineage(numbered.select((F.col("start") + F.col("__local")).alias("pos"), *order.nodes))
