"""Hard negatives: rows of another label whose score lies in a window below that of a positive.

Candidates are integer vectors, sorted by label and by their place on a Hilbert curve through the ``CURVE_DIMS`` dimensions
of most variance, and written as Parquet with one block of about ``CELLS`` numbers per row group, beside a zone map of every
block: least and largest label and value of each dimension. A zone bounds every inner product with an anchor from both sides
(positive components times the upper, negative ones times the lower end). Tasks take anchors in the order of the curve, a
group at a time; for its positives and then for its windows a group reads the blocks, most promising first, whose bounds
still reach its best found so far or its window. Blocks out of reach of all anchors of a group are never opened. Nothing
else decides what is read, so the result is exact; where zones are wide, more blocks are read.

Scores are exact: products whose sums stay under 2^53 are multiplied as doubles, larger ones as Python integers. Only
columns of statistics, one number per dimension, reach the driver. Zones and blocks are read through Arrow's file systems
from the shared folder, some at a time, so that a task's memory does not depend on the number of blocks.

Edge cases: rows with a null id, label or vector, or a null or non-finite component take no part. A row meets only rows of
its own length (an empty vector scores zero with another one). Repeated ids are rows of their own: an anchor leaves out
itself only, not a row with its id. Ties go to the smaller id. Fewer positives or negatives than asked for are all
returned; anchors without positives or negatives have no rows; an empty table gives none. Scaled components beyond 1e300
count as 1e300, and scores beyond 64 bits are returned as the nearest 64-bit number, though compared exactly.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage, dense, fresh_path, summed

CURVE_DIMS, CURVE_BITS = 15, 4
CELLS, MOST_ROWS, GROUP = 1 << 17, 2048, 256
HELD_BLOCKS, HELD_FILES, ZONES = 48, 16, 1024
EXACT, LONGEST = 1 << 53, (1 << 63) - 1
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def candidates(rows: DataFrame, id_column: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, x, dim) of the rows that take part; x holds whole numbers as doubles."""
    c = F.col("c")
    good = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("long").alias("label"),
                       F.col(f"`{vector}`").cast("array<double>").alias("c"))
    good = good.where(F.col("id").isNotNull() & F.col("label").isNotNull() & c.isNotNull()
                      & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))

    def whole(v):
        scaled = F.greatest(F.lit(-1e300), F.least(F.lit(1e300), v * float(scale)))
        return F.when(F.abs(scaled) < float(EXACT), F.floor(scaled).cast("double")).otherwise(scaled)

    return good.select("id", "label", F.transform(c, whole).alias("x"), F.size("c").alias("dim"))


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits per axis (one row per point), by the published bit rotations."""
    x = [axes[:, i].astype(np.int64) for i in range(axes.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            set_here = (x[i] >> bit) & 1 == 1
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_here, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(axes), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> bit) & 1 == 1, turn ^ ((1 << bit) - 1), turn)
    place = np.zeros(len(axes), np.int64)
    for bit in range(bits - 1, -1, -1):
        for v in x:
            place = place << 1 | ((v ^ turn) >> bit) & 1
    return place


def on_curve(rows: DataFrame) -> DataFrame:
    """The rows with their place on the curve; rows of another length than most have place zero."""
    usual = rows.where("dim > 0").groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if usual is None:
        return rows.withColumn("place", F.lit(0).cast("long"))
    width = usual["dim"]

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = dense(b.column(0), np.float64).clip(-1e100, 1e100)
        return np.concatenate([[len(x)], x.sum(axis=0), (x ** 2).sum(axis=0)])

    total = summed(rows.where(F.col("dim") == width).select("x"), moments)
    mean = total[1:width + 1] / total[0]
    sd = np.sqrt(np.maximum(total[width + 1:] / total[0] - mean ** 2, 0.0))
    widest = np.argsort(-sd, kind="stable")[:CURVE_DIMS]
    low, step = (mean - 2 * sd)[widest], np.maximum(4 * sd[widest] / (1 << CURVE_BITS), 1e-300)

    def place(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            at = np.zeros(b.num_rows, np.int64)
            plain = np.flatnonzero(dims == width)
            if len(plain):
                x = dense(b.column("x").take(pa.array(plain)), np.float64)[:, widest]
                at[plain] = hilbert(np.clip((x - low) / step, 0, (1 << CURVE_BITS) - 1).astype(np.int64), CURVE_BITS)
            yield b.append_column("place", pa.array(at))

    return rows.mapInArrow(place, "id long, label long, x array<double>, dim int, place long")


def block_rows(dim: int) -> int:
    return int(min(MOST_ROWS, max(16, CELLS // max(dim, 1))))


def pack(batches):
    """Sorted rows to blocks: of one length, and full, or at least a quarter full where the label changes."""
    held: list[pa.RecordBatch] = []
    count = 0

    def block():
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        dim = rows.column("dim")[0].as_py()
        x = np.asarray(rows.column("x").combine_chunks().flatten(), dtype=np.float64).reshape(len(ids), dim)
        return pa.RecordBatch.from_pydict(
            {"dim": [dim], "label_lo": [labels.min()], "label_hi": [labels.max()], "lo": [x.min(axis=0)], "hi": [x.max(axis=0)],
             "ids": [ids], "labels": [labels], "x": [x.ravel()]}, BLOCK)

    last = None
    for b in batches:
        dims, labels = b.column("dim").to_numpy(), b.column("label").to_numpy()
        start = 0
        for i in range(b.num_rows):
            if last is not None and count and (
                    dims[i] != last[0] or count >= block_rows(last[0])
                    or labels[i] != last[1] and count >= block_rows(last[0]) // 4):
                if i > start:
                    held.append(b.slice(start, i - start))
                yield block()
                held, count, start = [], 0, i
            last = (dims[i], labels[i])
            count += 1
        if b.num_rows > start:
            held.append(b.slice(start))
    if count:
        yield block()


BLOCK = pa.schema([("dim", pa.int32()), ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("lo", pa.list_(pa.float64())),
                   ("hi", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
                   ("x", pa.list_(pa.float64()))])
BLOCK_DDL = ("dim int, label_lo long, label_hi long, lo array<double>, hi array<double>, ids array<long>, "
             "labels array<long>, x array<double>")


def write_blocks(rows: DataFrame) -> tuple[DataFrame, str, str]:
    """(blocks, their folder, folder of their zone maps): one block per row group, sorted by length, label and curve."""
    spark = rows.sparkSession
    placed = on_curve(rows)
    count = rows.count()
    parts = max(1, min(-(-count // 512), max(spark.sparkContext.defaultParallelism, -(-count // (8 * MOST_ROWS)))))
    order = ["dim", "label", "place", "id"]
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks, zones = fresh_path(spark, "blocks"), fresh_path(spark, "zones")
    ranged.mapInArrow(pack, BLOCK_DDL).write.option("parquet.block.row.count.limit", "1").parquet(blocks)
    found = spark.read.parquet(blocks).select("*", F.col("_metadata.file_name").alias("file"),
                                              F.col("_metadata.row_index").cast("int").alias("at"))
    found.select("dim", "label_lo", "label_hi", "lo", "hi", "file", "at").write.parquet(zones)
    return found, blocks, zones


def anchors_of(blocks: DataFrame, divisor: int) -> DataFrame:
    """(dim, file, at, offset, id, label, x) of the rows whose id ``divisor`` divides."""
    schema = pa.schema([("dim", pa.int32()), ("file", pa.string()), ("at", pa.int32()), ("offset", pa.int32()), ("id", pa.int64()),
                        ("label", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, dim = b.column("ids")[r].values.to_numpy(), b.column("dim")[r].as_py()
                offset = np.flatnonzero(ids % divisor == 0)
                if not len(offset):
                    continue
                x = np.asarray(b.column("x")[r].values, dtype=np.float64).reshape(len(ids), dim)[offset]
                yield pa.RecordBatch.from_pydict(
                    {"dim": [dim] * len(offset), "file": [b.column("file")[r].as_py()] * len(offset),
                     "at": [b.column("at")[r].as_py()] * len(offset), "offset": offset, "id": ids[offset],
                     "label": b.column("labels")[r].values.to_numpy()[offset], "x": list(x)}, schema)

    return blocks.select("dim", "file", "at", "ids", "labels", "x").mapInArrow(
        run, "dim int, file string, at int, offset int, id long, label long, x array<double>")


class Store:
    """Blocks and zone maps of the shared folder; the last few read are held."""

    def __init__(self, blocks: str, zones: str):
        self.system, self.blocks = fs.FileSystem.from_uri(blocks)
        self.zones = fs.FileSystem.from_uri(zones)[1]
        self.files: OrderedDict = OrderedDict()
        self.held: OrderedDict = OrderedDict()
        self.zone_files = sorted(i.path for i in self.system.get_file_info(fs.FileSelector(self.zones)) if i.path.endswith(".parquet"))
        self.opened = 0

    def keep(self, cache: OrderedDict, key, most: int, make):
        if key in cache:
            cache.move_to_end(key)
            return cache[key]
        cache[key] = make()
        while len(cache) > most:
            cache.popitem(last=False)
        return cache[key]

    def block(self, file: str, at: int):
        """(ids, labels, x) of a block: one row group of one file is read."""
        def read():
            source = self.keep(self.files, file, HELD_FILES,
                               lambda: pq.ParquetFile(self.system.open_input_file(f"{self.blocks}/{file}")))
            row = source.read_row_group(at, columns=["dim", "ids", "labels", "x"])
            if row.num_rows != 1:
                raise ValueError("a row group must hold one block")
            self.opened += 1
            ids = row.column("ids")[0].values.to_numpy()
            return ids, row.column("labels")[0].values.to_numpy(), np.asarray(
                row.column("x")[0].values, dtype=np.float64).reshape(len(ids), row.column("dim")[0].as_py())

        return self.keep(self.held, (file, at), HELD_BLOCKS, read)

    def chunks(self, dim: int):
        """Zone maps of blocks of a length, up to ``ZONES`` at a time: labels, ends, and where the blocks are."""
        for path in self.zone_files:
            with pq.ParquetFile(self.system.open_input_file(path)) as source:
                for b in source.iter_batches(batch_size=ZONES):
                    here = np.flatnonzero(b.column("dim").to_numpy() == dim)
                    if len(here):
                        b = b.take(pa.array(here))
                        yield (b.column("label_lo").to_numpy(), b.column("label_hi").to_numpy(),
                               dense(b.column("lo"), np.float64).reshape(len(here), dim),
                               dense(b.column("hi"), np.float64).reshape(len(here), dim),
                               list(zip(b.column("file").to_pylist(), b.column("at").to_pylist())))


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector within each zone."""
    plus, minus = np.maximum(a, 0.0), np.minimum(a, 0.0)
    most = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
    slack = np.where(most < EXACT, 0.0, most * (a.shape[1] + 2) * 2.0 ** -50)
    with np.errstate(over="ignore", invalid="ignore"):
        least, largest = plus @ lo.T + minus @ hi.T - slack, plus @ hi.T + minus @ lo.T + slack
    return np.where(np.isfinite(least), least, -np.inf), np.where(np.isfinite(largest), largest, np.inf)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as doubles where these are exact and as Python integers elsewhere."""
    if not a.shape[1] or np.abs(a).max() * np.abs(x).max() * a.shape[1] < EXACT:
        return a @ x.T
    big = [np.array([[int(v) for v in row] for row in m], object) for m in (a, x)]
    return big[0] @ big[1].T


def best(scores, ids, most: int):
    """The ``most`` largest scores in falling order, ties by smaller id."""
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:most]
    return [scores[i] for i in order], [ids[i] for i in order]


class Group:
    """Anchors of one length that are searched together."""

    def __init__(self, store: Store, rows: list[dict], positives: int, negatives: int, low: int, high: int):
        self.store, self.rows = store, rows
        self.x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), rows[0]["dim"])
        self.labels = np.array([r["label"] for r in rows])
        self.most, self.most_negatives, self.low, self.high = positives, negatives, low, high
        self.positives = [([], []) for _ in rows]
        self.homes = {}
        for i, r in enumerate(rows):
            self.homes.setdefault((r["file"], r["at"]), []).append((i, r["offset"]))

    def least_positive(self) -> np.ndarray:
        return np.array([s[-1] if len(s) == self.most else -np.inf for s, _ in self.positives], np.float64)

    def add_positives(self, place, need: np.ndarray) -> None:
        ids, labels, x = self.store.block(*place)
        score = products(self.x[need], x)
        fits = (labels[None, :] == self.labels[need][:, None]) & (score >= self.least_positive()[need][:, None])
        position = {a: r for r, a in enumerate(need.tolist())}
        for i, offset in self.homes.get(place, []):
            if i in position:
                fits[position[i], offset] = False
        for r in np.flatnonzero(fits.any(axis=1)):
            hit, (s, p) = np.flatnonzero(fits[r]), self.positives[need[r]]
            if score.dtype != object and len(hit) > 4 * self.most:
                hit = hit[np.lexsort((ids[hit], -score[r, hit]))[:self.most]]
            self.positives[need[r]] = best(s + [int(v) for v in score[r, hit]], p + ids[hit].tolist(), self.most)

    def find_positives(self) -> None:
        for place in self.homes:
            self.add_positives(place, np.arange(len(self.rows)))
        for label_lo, label_hi, lo, hi, places in self.store.chunks(self.x.shape[1]):
            _, largest = bounds(self.x, lo, hi)
            can = (label_lo[None, :] <= self.labels[:, None]) & (self.labels[:, None] <= label_hi[None, :])
            largest[~can] = -np.inf
            for z in np.argsort(-largest.max(axis=0), kind="stable"):
                # The bound counts as reached by an equal score, whose smaller id may win.
                need = np.flatnonzero(can[:, z] & (largest[:, z] >= self.least_positive()))
                if places[z] not in self.homes and len(need):
                    self.add_positives(places[z], need)

    def find_negatives(self) -> list[tuple]:
        windows = [[(-(-self.low * p // 100), self.high * p // 100) for p in s] for s, _ in self.positives]
        found = [[([], []) for _ in w] for w in windows]
        floor = np.array([min((w[0] for w in ws), default=np.inf) for ws in windows], np.float64)
        ceiling = np.array([max((w[1] for w in ws), default=-np.inf) for ws in windows], np.float64)

        def still(i: int) -> float:
            """Least score that could still enter one of the anchor's lists."""
            return min((s[-1] if len(s) == self.most_negatives else w[0] for w, (s, _) in zip(windows[i], found[i])), default=np.inf)

        for label_lo, label_hi, lo, hi, places in self.store.chunks(self.x.shape[1]):
            least, largest = bounds(self.x, lo, hi)
            other = (label_lo[None, :] != self.labels[:, None]) | (label_hi[None, :] != self.labels[:, None])
            for z in np.argsort(-largest.max(axis=0), kind="stable"):
                need = np.flatnonzero(other[:, z] & (largest[:, z] >= floor) & (least[:, z] <= ceiling) & (floor <= ceiling))
                if not len(need):
                    continue
                ids, labels, x = self.store.block(*places[z])
                score = products(self.x[need], x)
                fits = (labels[None, :] != self.labels[need][:, None]) & (score >= floor[need][:, None]) & (score <= ceiling[need][:, None])
                for r in np.flatnonzero(fits.any(axis=1)):
                    i, hit = int(need[r]), np.flatnonzero(fits[r])
                    s, c = score[r, hit], ids[hit]
                    for j, (low, high) in enumerate(windows[i]):
                        mine = found[i][j]
                        low = mine[0][-1] if len(mine[0]) == self.most_negatives else low
                        inside = np.flatnonzero((s >= low) & (s <= high))
                        if not len(inside):
                            continue
                        if s.dtype != object and len(inside) > 4 * self.most_negatives:
                            inside = inside[np.lexsort((c[inside], -s[inside]))[:self.most_negatives]]
                        found[i][j] = best(mine[0] + [int(v) for v in s[inside]], mine[1] + c[inside].tolist(), self.most_negatives)
                    floor[i] = still(i)
        return [(r["id"], p, k + 1, n, ps, ns) for i, r in enumerate(self.rows) for j, (ps, p) in enumerate(zip(*self.positives[i]))
                for k, (ns, n) in enumerate(zip(*found[i][j]))]

    def search(self) -> list[tuple]:
        self.find_positives()
        return self.find_negatives()


def mine(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: Column | None = None, *, scale: int = 256,
         anchors: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of the rows whose id ``anchors`` divides: for each of the first ``positives`` rows of its label the
    first ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score."""
    label = F.col("label") if label is None else label
    blocks, folder, zones = write_blocks(candidates(rows, id_column, vector, label, scale))
    # Where an anchor lives is its block and its place there, fixed once the blocks are written.
    chosen = cut_lineage(anchors_of(blocks, anchors))
    count = chosen.count()
    parts = max(1, -(-count // GROUP), min(2 * rows.sparkSession.sparkContext.defaultParallelism, count // 16))
    order = ["dim", "file", "at", "offset"]
    dealt = chosen.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = pa.schema([(name, pa.int32() if name == "rank" else pa.int64()) for name in
                        ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])

    def run(batches):
        store, group = Store(folder, zones), []

        def done():
            found = Group(store, group, positives, negatives, low, high).search()
            columns = list(zip(*found)) or [[]] * 6
            clipped = [[max(-LONGEST - 1, min(LONGEST, v)) for v in c] for c in columns]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(clipped, schema)], schema=schema)

        for b in batches:
            for row in b.to_pylist():
                if group and (len(group) == GROUP or group[0]["dim"] != row["dim"]):
                    yield done()
                    group = []
                group.append(row)
        if group:
            yield done()

    return dealt.mapInArrow(run, OUT)
