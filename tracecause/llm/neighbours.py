"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search over it.

Equal vectors are one node (the smallest id); of its members only as many of the smallest ids as a result has places can
ever be listed, and these are kept. Every vector gets one more component that gives all the same length, so that the
graph joins vectors by direction and length; searches score the original vectors.

Building: a few random-hyperplane tables give each node first neighbours; then, round by round, a node's neighbours and a
sample of those it is a neighbour of (``REVERSE``) are introduced to one another, and each keeps the best ``DEGREE``.
Rounds end when fewer than ``SETTLED`` of all entries change. Searching: every query starts from its own node (and the
longest vectors) and repeatedly asks the neighbours of its best nodes not yet asked, until the best ``BREADTH`` have all
been asked. Results are scored again in double precision.

Nodes are dealt into buckets of about ``BUCKET`` nodes by a hash of their id, for searches of about ``SEARCH_BUCKET``. A
bucket asks for a vector once however many of its nodes need it, so hubs cost one row per bucket, and a query's vector goes
to a bucket once however many of its nodes are scored.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another length
than most (the shortest of equally frequent lengths counts). Rows of one id are rows of their own: each is a candidate, each
asks if its id is asked for, and none finds itself. Null ids take no part. Ties go to the smaller id. With fewer candidates all are listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage

DEGREE, REVERSE, TABLES, LEAF, BUCKET, SEARCH_BUCKET = 30, 30, 4, 192, 256, 8192
SETTLED, BREADTH, ASK = 0.03, 192, 64
OFFERS = 5  # best offers for a node per bucket and round
PIVOTS = 16
EDGES = "u long, v long, sim float, fresh boolean"
EDGE_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("sim", pa.float32()), ("fresh", pa.bool_())])


def bucket_of(ids, buckets: int):
    return F.pmod(F.xxhash64(ids), F.lit(buckets)).cast("int")


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, x): the rows that take part, ``x`` an array of doubles of the usual length."""
    x = F.col("x")
    good = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    good = good.where(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
                      & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                      & F.exists(x, lambda c: c != 0))
    lengths = good.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return good.where(F.size(x) == (lengths["d"] if lengths else 0))


def as_nodes(rows: DataFrame, keep: int):
    """(node, members, x) per distinct vector, members being the ``keep`` smallest ids."""
    rank = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    first = rows.withColumn("rank", rank).where(F.col("rank") <= keep)
    return first.groupBy("x").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members"))


def matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width)


def packed(nodes: DataFrame, longest: float, buckets: int) -> DataFrame:
    """(bucket, node, vec): 32-bit vectors of length one, all shrunk alike; the added component is last."""
    schema = pa.schema([("node", pa.int64()), ("vec", pa.binary())])

    def run(batches):
        for b in batches:
            x = np.array(b.column(1).flatten(), dtype=np.float64).reshape(b.num_rows, -1) / longest ** 0.5
            last = np.sqrt(np.maximum(1.0 - (x ** 2).sum(axis=1), 0.0))
            vec = np.column_stack((x, last)).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"node": b.column(0), "vec": [v.tobytes() for v in vec]}, schema)

    made = nodes.select("node", "x").mapInArrow(run, "node long, vec binary")
    return made.withColumn("bucket", bucket_of("node", buckets))


def best_per(owner: np.ndarray, other: np.ndarray, sim: np.ndarray, keep: int) -> np.ndarray:
    """Indices of the ``keep`` best entries of each owner: larger similarity, then smaller id."""
    order = np.lexsort((other, -sim, owner))
    own = owner[order]
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    return order[rank < keep]


def edges_table(u, v, sim, fresh) -> pa.Table:
    return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float32()),
                                 pa.array(fresh, pa.bool_())], schema=EDGE_SCHEMA)


def first_edges(vectors: DataFrame, n: int, width: int) -> DataFrame:
    """Best neighbours within the cells of random hyperplanes; cells of more than twice ``LEAF`` are dealt by hash."""
    planes = max(1, int(np.ceil(np.log2(max(2, n / LEAF)))))

    def cells(batches):
        draw = np.random.default_rng(7).standard_normal((TABLES * planes, width)).astype(np.float32)
        for b in batches:
            vec = matrix(b.column(1), width)
            signs = (vec @ draw.T > 0).reshape(len(vec), TABLES, planes)
            cell = (signs @ (1 << np.arange(planes))) * TABLES + np.arange(TABLES)
            yield pa.RecordBatch.from_pydict({"cell": cell.T.ravel(), "node": np.tile(b.column(0).to_numpy(), TABLES),
                                              "vec": b.column(1).to_pylist() * TABLES},
                                             pa.schema([("cell", pa.int64()), ("node", pa.int64()), ("vec", pa.binary())]))

    placed = vectors.select("node", "vec").mapInArrow(cells, "cell long, node long, vec binary")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / (2 * LEAF)).cast("int").alias("parts"))
    dealt = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))

    def leaf(table: pa.Table) -> pa.Table:
        node, vec = table.column("node").to_numpy(), matrix(table.column("vec"), width)
        sim = vec @ vec.T
        np.fill_diagonal(sim, -np.inf)
        keep = min(DEGREE, len(node) - 1)
        if keep < 1:
            return EDGE_SCHEMA.empty_table()
        top = np.argpartition(-sim, keep - 1, axis=1)[:, :keep]
        return edges_table(np.repeat(node, keep), node[top].ravel(), np.take_along_axis(sim, top, 1).ravel(),
                           np.ones(len(node) * keep, bool))

    return dealt.groupBy("cell", "part").applyInArrow(leaf, EDGES)


def keep_best(edges: DataFrame, buckets: int) -> DataFrame:
    """The ``DEGREE`` best distinct edges of every node; one known before stays known."""
    def merge(table: pa.Table) -> pa.Table:
        u, v, sim = (table.column(c).to_numpy() for c in ("u", "v", "sim"))
        fresh = table.column("fresh").to_numpy(zero_copy_only=False)
        order = np.lexsort((fresh, v, u))
        u, v, sim, fresh = u[order], v[order], sim[order], fresh[order]
        one = np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])))
        u, v, sim, fresh = u[one], v[one], sim[one], fresh[one]
        at = best_per(u, v, sim, DEGREE)
        return edges_table(u[at], v[at], sim[at], fresh[at])

    return edges.groupBy(bucket_of("u", buckets).alias("bucket")).applyInArrow(merge, EDGES)


def introduce(edges: DataFrame, vectors: DataFrame, buckets: int, width: int) -> DataFrame:
    """Offers (edges) from one local join: the members around every node meet, unless both are known to it."""
    back = F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("u", "v")))
    reverse = edges.withColumn("rank", back).where(F.col("rank") <= REVERSE).select(
        F.col("v").alias("c"), F.col("u").alias("m"), "fresh")
    around = edges.select(F.col("u").alias("c"), F.col("v").alias("m"), "fresh").unionByName(reverse)
    around = around.withColumn("bucket", bucket_of("c", buckets))
    worst = edges.groupBy(F.col("u").alias("node")).agg(F.min("sim").alias("worst"), F.count("*").alias("held"))
    known = vectors.select("node", "vec").join(worst, "node", "left").withColumn(
        "worst", F.when(F.col("held") >= DEGREE, F.col("worst")).otherwise(F.lit(float("-inf"))).cast("float"))
    asked = around.select("bucket", F.col("m").alias("node")).unionByName(
        around.select("bucket", F.col("c").alias("node"))).distinct()
    told = asked.join(known.select("node", "vec", "worst"), "node").select(F.col("bucket").alias("home"), "node", "vec", "worst")

    def meet(around: pa.Table, told: pa.Table) -> pa.Table:
        node = told.column("node").to_numpy()
        order = np.argsort(node)
        node, vec = node[order], matrix(told.column("vec"), width)[order]
        worst = told.column("worst").to_numpy()[order]
        c = np.searchsorted(node, around.column("c").to_numpy())
        m = np.searchsorted(node, around.column("m").to_numpy())
        fresh = around.column("fresh").to_numpy(zero_copy_only=False)
        order = np.lexsort((~fresh, m, c))
        c, m, fresh = c[order], m[order], fresh[order]
        one = np.concatenate(([True], (c[1:] != c[:-1]) | (m[1:] != m[:-1]))) if len(c) else np.zeros(0, bool)
        c, m, fresh = c[one], m[one], fresh[one]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(c)) + 1, [len(c)]))
        xs, ys, sims, held = [], [], [], 0
        out = []

        def fold():
            x, y, s = np.concatenate(xs), np.concatenate(ys), np.concatenate(sims)
            _, one = np.unique(x * len(node) + y, return_index=True)
            x, y, s = x[one], y[one], s[one]
            at = best_per(x, y, s, OFFERS)
            out.append((x[at], y[at], s[at]))

        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            new = fresh[i:j]
            if not new.any():
                continue
            members = m[i:j]
            sim = vec[members] @ vec[members].T
            sim[~(new[:, None] | new[None, :])] = -np.inf
            sim[sim <= worst[members][:, None]] = -np.inf
            np.fill_diagonal(sim, -np.inf)
            if len(members) > OFFERS:
                cut = -np.partition(-sim, OFFERS - 1, axis=1)[:, OFFERS - 1]
                sim[sim < cut[:, None]] = -np.inf
            a, b = np.nonzero(sim > -np.inf)
            xs.append(members[a])
            ys.append(members[b])
            sims.append(sim[a, b])
            held += len(a)
            if held > 2_000_000:
                fold()
                xs, ys, sims, held = [], [], [], 0
        if held:
            fold()
        if not out:
            return EDGE_SCHEMA.empty_table()
        x, y, s = (np.concatenate(p) for p in zip(*out, strict=True))
        at = best_per(x, y, s, OFFERS)
        return edges_table(node[x[at]], node[y[at]], s[at], np.ones(len(at), bool))

    return around.groupBy("bucket").cogroup(told.groupBy("home")).applyInArrow(meet, EDGES)


def build_graph(vectors: DataFrame, n: int, width: int, buckets: int) -> DataFrame:
    """Edges (u, v, sim, fresh) of the neighbour graph of all nodes."""
    edges = cut_lineage(keep_best(first_edges(vectors, n, width), buckets))
    while True:
        offers = introduce(edges, vectors, buckets, width)
        edges = cut_lineage(keep_best(edges.withColumn("fresh", F.lit(False)).unionByName(offers), buckets))
        state = edges.agg(F.count("*").alias("n"), F.count_if("fresh").alias("fresh")).first()
        if state["fresh"] <= SETTLED * state["n"]:
            return edges


ASKED = "q long, v long, sim double, asked boolean"
ASKED_SCHEMA = pa.schema([("q", pa.int64()), ("v", pa.int64()), ("sim", pa.float64()), ("asked", pa.bool_())])


def greedy(edges: DataFrame, vectors: DataFrame, queries: DataFrame, pivots: list[int], buckets: int, width: int) -> DataFrame:
    """(q, v, sim): the best nodes that each query node met."""
    vectors = vectors.select(bucket_of("node", buckets).alias("bucket"), "node", "vec")
    links = edges.select(F.col("u").alias("node"), F.col("v").alias("next"))
    own = queries.select("q", F.col("q").alias("v"))
    starts = own.unionByName(queries.select("q", F.explode(F.array(*map(F.lit, pivots)).cast("array<long>")).alias("v"))) if pivots else own
    state = None
    to_score = starts.distinct()
    while True:
        wanted = to_score.withColumn("bucket", bucket_of("v", buckets))
        carried = wanted.select("bucket", "q").distinct().join(queries, "q")
        posts = wanted.select("bucket", "q", "v", F.lit(None).cast("binary").alias("vec")).unionByName(
            carried.select("bucket", "q", F.lit(None).cast("long").alias("v"), "vec"))

        def scored(posts: pa.Table, here: pa.Table) -> pa.Table:
            is_query = pa.compute.is_valid(posts.column("vec"))
            senders = posts.filter(is_query)
            q_ids = senders.column("q").to_numpy()
            order = np.argsort(q_ids)
            q_ids, q_vec = q_ids[order], matrix(senders.column("vec"), width)[order]
            asks = posts.filter(pa.compute.invert(is_query))
            node = here.column("node").to_numpy()
            order = np.argsort(node)
            node, vec = node[order], matrix(here.column("vec"), width)[order]
            q, v = asks.column("q").to_numpy(), asks.column("v").to_numpy()
            sim = np.empty(len(q))
            for at in range(0, len(q), 100_000):
                part = slice(at, at + 100_000)
                a, b = q_vec[np.searchsorted(q_ids, q[part])], vec[np.searchsorted(node, v[part])]
                sim[part] = np.einsum("ij,ij->i", a[:, :-1], b[:, :-1])
            return pa.Table.from_arrays([pa.array(q), pa.array(v), pa.array(sim), pa.array(np.zeros(len(q), bool))],
                                        schema=ASKED_SCHEMA)

        met = posts.groupBy("bucket").cogroup(vectors.select("bucket", "node", "vec").groupBy("bucket")).applyInArrow(scored, ASKED)

        def kept(table: pa.Table) -> pa.Table:
            q, v, sim = (table.column(c).to_numpy() for c in ("q", "v", "sim"))
            asked = table.column("asked").to_numpy(zero_copy_only=False)
            order = np.lexsort((~asked, v, q))
            q, v, sim, asked = q[order], v[order], sim[order], asked[order]
            one = np.concatenate(([True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])))
            q, v, sim, asked = q[one], v[one], sim[one], asked[one]
            at = best_per(q, v, sim, BREADTH)
            return pa.Table.from_arrays([pa.array(q[at]), pa.array(v[at]), pa.array(sim[at]), pa.array(asked[at])],
                                        schema=ASKED_SCHEMA)

        pool = met if state is None else state.unionByName(met)
        pool = cut_lineage(pool.groupBy(bucket_of("q", buckets).alias("bucket")).applyInArrow(kept, ASKED))
        order = Window.partitionBy("q").orderBy(F.desc("sim"), "v")
        front = pool.where("NOT asked").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ASK).select("q", "v")
        front = cut_lineage(front)
        if front.isEmpty():
            return pool.select("q", "v", "sim")
        state = pool.join(front.withColumn("now", F.lit(True)), ["q", "v"], "left").select(
            "q", "v", "sim", (F.col("asked") | F.coalesce("now", F.lit(False))).alias("asked"))
        to_score = front.join(links, front["v"] == links["node"]).select("q", F.col("next").alias("v")).distinct()
        to_score = to_score.join(pool.select("q", "v"), ["q", "v"], "left_anti")


def search(rows: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every row whose id is divisible by ``every``."""
    spark = rows.sparkSession
    points = cut_lineage(usable(rows, id_column, vector))
    nodes = cut_lineage(as_nodes(points, k + 1))
    norm = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)
    facts = nodes.agg(F.count("*").alias("n"), F.max(norm).alias("longest"), F.max(F.size("x")).alias("d")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not facts["n"]:
        return empty
    width, buckets = facts["d"] + 1, -(-facts["n"] // BUCKET)
    vectors = cut_lineage(packed(nodes, facts["longest"], buckets))
    edges = build_graph(vectors, facts["n"], width, buckets)
    pivots = [r["node"] for r in nodes.orderBy(F.desc(norm), "node").limit(PIVOTS).collect()]
    asking = points.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("x").alias("qx"))
    asking = asking.groupBy("query_id", "qx").agg(F.count("*").cast("int").alias("copies"))
    by_node = cut_lineage(asking.join(nodes.select("node", F.col("x").alias("qx")), "qx").select("query_id", "node", "qx", "copies"))
    queries = by_node.select(F.col("node").alias("q")).distinct().join(vectors.select(F.col("node").alias("q"), "vec"), "q")
    found = greedy(edges, vectors, queries, pivots, -(-facts["n"] // SEARCH_BUCKET), width)
    # Exact scores once per pair of vectors, then members.
    pairs = found.join(nodes.select(F.col("node").alias("v"), "members", "x"), "v")
    both = pairs.join(by_node.withColumnRenamed("node", "q"), "q")
    exact = F.aggregate(F.zip_with("qx", "x", lambda a, b: a * b), F.lit(0.0), lambda s, c: s + c)
    # Of the rows with the query's own vector one is the query.
    itself = F.when(F.col("q") == F.col("v"), F.array_position("members", F.col("query_id")) - 1).otherwise(-1)
    listed = both.select("query_id", "q", "copies", exact.alias("score"), itself.alias("itself"), F.posexplode("members").alias("at", "vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    best = listed.where(F.col("at") != F.col("itself")).withColumn("rank", rank).where(F.col("rank") <= k)
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
