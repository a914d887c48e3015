import numpy as np
import pytest
from pyspark.sql import functions as F

from tracecause.functions.randomness import (keyed_uniform_values, normal_from, normal_values, poisson_values,
                                             poisson_weight, uniform, uniform_values)
from tracecause.functions.statistics import (chi2_tail, f_tail_value, normal_bin, normal_quantile_value, normal_tail,
                                             normal_tail_value)
from tracecause.operators import frames, graph, sampling
from tracecause.operators.graph import CausalGraph
from tracecause.plans import workload
from tracecause.sources import ingest, snapshots
from tracecause.sources.payload import from_payload, to_payload
from tracecause.sources.workspace import fresh_path


def test_uniform_is_the_same_on_columns_and_arrays(spark):
    rows = spark.range(200).select("id", uniform(F.col("id"), "x", 3, 7).alias("u"),
                                   uniform(F.col("id"), "x", 3, 7, "xxhash64").alias("v")).orderBy("id").toPandas()
    np.testing.assert_array_equal(rows.u, uniform_values(200, "x", 3, 7))
    assert rows.v.between(0, 1, inclusive="left").all() and abs(rows.v.mean() - 0.5) < 0.1


def test_normal_and_poisson_draws(spark):
    u1, u2 = uniform(F.col("id"), "a"), uniform(F.col("id"), "b")
    rows = spark.range(4000).select(normal_from(u1, u2).alias("z"), poisson_weight(u1).alias("w")).toPandas()
    np.testing.assert_allclose(rows.z, normal_values(uniform_values(4000, "a"), uniform_values(4000, "b")), rtol=1e-12)
    assert abs(rows.z.mean()) < 0.05 and abs(rows.z.std() - 1) < 0.05
    assert rows.w.tolist() == poisson_values(uniform_values(4000, "a")).tolist()
    assert abs(rows.w.mean() - 1) < 0.05 and abs(rows.w.var() - 1) < 0.1


def test_tails(spark):
    row = spark.range(1).select(normal_tail(F.lit(1.959964)).alias("z"), normal_tail(F.lit(-1.0)).alias("m"),
                                chi2_tail(F.lit(18.307), F.lit(10.0)).alias("c")).first()
    assert row.z == pytest.approx(0.025, abs=1e-6) and row.m == pytest.approx(normal_tail_value(-1.0), abs=1e-6)
    assert row.c == pytest.approx(0.05, abs=1e-3)
    assert f_tail_value(3.0, 2, 1000) == pytest.approx(0.0502, abs=2e-3)
    assert normal_quantile_value(0.975) == pytest.approx(1.959964, abs=1e-5)


def test_normal_bins_are_equally_likely(spark):
    x = normal_from(uniform(F.col("id"), "a"), uniform(F.col("id"), "b")) * 3 + 5
    counts = (spark.range(8000).select(x.alias("x")).groupBy(normal_bin("x", 5.0, 3.0, 8).alias("b")).count()
              .orderBy("b").toPandas())
    assert counts.b.tolist() == list(range(8)) and counts["count"].between(880, 1120).all()


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000)
    a = sampling.sample(df.repartition(3), F.col("id"), 0.6, 1, 2).agg(F.sum("id"), F.count("*")).first()
    assert a == sampling.sample(df.coalesce(1), F.col("id"), 0.6, 1, 2).agg(F.sum("id"), F.count("*")).first()
    u = keyed_uniform_values(range(5000), "sample", 1, 2)
    assert a[1] == int((u < 0.6).sum())


@pytest.mark.parametrize("frac", [0.0, 0.37, 1.0])
def test_exact_sample_takes_the_smallest_hashes(spark, frac):
    got = sorted(r.id for r in sampling.sample_exact(spark.range(1003), F.col("id"), frac, 5, 1, small=3).collect())
    order = np.argsort(keyed_uniform_values(range(1003), "sample", 5, 1), kind="stable")
    assert got == sorted(order[:round(frac * 1003)].tolist())


def test_aggregates(spark):
    df = spark.createDataFrame([("w1", 1.0, True, "a"), ("w1", 3.0, False, "b"), ("w2", 6.0, True, "c")],
                               "week string, x double, flag boolean, name string")
    means = {r.week: (r.x, r.flag) for r in frames.group_means(df, "week").collect()}
    assert means == {"w1": (2.0, 0.5), "w2": (6.0, 1.0)}
    row = frames.change(df, F.col("week") == "w2", ["x"]).first()
    assert (row.difference, row.growth_pct, row.drop_pct) == (4.0, 200.0, -200.0)
    shares = frames.to_percent(spark.createDataFrame([("a", -1.0), ("b", 3.0)], "node string, score double"), "score")
    assert {r.node: (r.score, r.percent) for r in shares.collect()} == {"a": (-1.0, 25.0), "b": (3.0, 75.0)}
    assert [r.node for r in frames.top_causes(shares, 1).collect()] == ["b"]
    assert frames.spread(df, "x").first().sd == pytest.approx(np.std([1, 3, 6], ddof=1))
    assert [r.x for r in frames.head(df, F.desc("x"), 2).collect()] == [6.0, 3.0]
    assert frames.first_row(df, "x").first().x == 1.0
    assert [r.h for r in spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
            .select(frames.round_half_even(F.col("x")).alias("h")).collect()] == [0.0, 2.0, 2.0]


def test_percent_shares_of_zero_scores(spark):
    zero = spark.createDataFrame([("a", 0.0)], "node string, score double")
    assert frames.to_percent(zero, "score").first().percent == 0.0


def test_period_bounds_are_inclusive(spark):
    df = spark.sql("SELECT explode(sequence(date'2021-03-29', date'2021-04-02')) AS d")
    assert frames.period(df, "d", until="2021-03-31").count() == 3
    assert frames.period(df, "d", value="2021-04-01").count() == 1
    assert frames.period(df, "d", since="2021-04-01").count() == 2


def test_histogram_counts_all_rows(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"), F.lit(4.0).alias("flat"))
    rows = frames.histograms(df, ["x", "flat"], 10).toPandas()
    assert rows[rows.node == "x"].n.tolist().count(10) == 9 and rows[rows.node == "x"].n.sum() == 101
    assert rows[rows.node == "flat"].n.tolist() == [101]


def test_sanitize(spark):
    df = spark.createDataFrame([(True, 1, 2)], ["Shopping Event?", "Page Views", "Profit"])
    assert ingest.sanitize(df).columns == ["Shopping_Event", "Page_Views", "Profit"]
    with pytest.raises(ValueError, match="collide"):
        ingest.sanitize(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))


def test_ingest_makes_tables(spark):
    path, name = fresh_path(spark, "csv"), "ingest_" + fresh_path(spark, "x").rsplit("-", 1)[1]
    df = spark.createDataFrame([(1, True, 2.5)], ["Sold Units", "Shopping Event?", "Profit"])
    ingest.write_csv(df, path)
    ingest.ensure_schema(spark, name, fresh_path(spark, "schema"))
    full = ingest.ingest(spark, {"days": path}, name)["days"]
    row = spark.read.table(full).first()
    assert (row.Sold_Units, row.Shopping_Event, row.Profit) == (1, True, 2.5)
    ingest.drop_table(spark, full)
    assert not spark.catalog.tableExists(full)
    ingest.drop_table(spark, full)


def test_aligned_keys_never_multiply(spark):
    old = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 0.0)], "k int, x double")
    new = spark.createDataFrame([(1, 6.0), (1, 6.0), (2, 1.0)], "k int, x double")
    rows = {r.k: r for r in frames.aligned_change(old, new, "k", ["x"]).collect()}
    assert len(rows) == 2 and rows[1].x_growth_pct == 100.0 and rows[2].x_growth_pct is None


def test_snapshots(spark):
    path = fresh_path(spark, "snapshots")
    with pytest.raises(ValueError):
        snapshots.latest_version(spark, path)
    assert snapshots.write_snapshot(spark.range(3), path) == 0
    assert snapshots.write_snapshot(spark.range(5), path) == 1
    assert snapshots.latest_version(spark, path) == 1
    assert snapshots.read_snapshot(spark, path, 0).count() == 3 and snapshots.read_snapshot(spark, path).count() == 5
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, path, 7)
    plan = snapshots.read_snapshot(spark, path, 0)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_version" in plan


def test_payload_keeps_types(spark):
    df = spark.createDataFrame([(1, True, 2.5, "x"), (2, None, None, None)], "k bigint, b boolean, x double, s string")
    back = from_payload(to_payload(df, F.col("k")), df.schema)
    assert back.schema == df.schema and back.orderBy("k").collect() == df.orderBy("k").collect()


def test_column_graph():
    g = CausalGraph((("a", "b"), ("b", "c"), ("a", "c"), ("a", "b"), ("x", "c")))
    assert len(g.edges) == 4 and g.roots() == ("a", "x") and g.parents("c") == ("a", "b", "x")
    assert g.ancestors("b") == ("a",) and g.closure("c")[-1] == "c" and g.levels()["c"] == 2
    assert g.invert().parents("a") == ("b", "c")
    assert set(CausalGraph.from_json(g.to_json()).edges) == set(g.edges)
    with pytest.raises(ValueError, match="cycle"):
        CausalGraph((("a", "b"), ("b", "a")))
    with pytest.raises(KeyError):
        g.closure("nobody")


def test_graph_tables_match_the_column_graph(spark):
    g = CausalGraph((("a", "b"), ("b", "c"), ("a", "c"), ("x", "c"), ("c", "d"), ("x", "e")))
    edges = g.to_table(spark)
    assert {r.node: r.level for r in graph.level_table(edges).collect()} == g.levels()
    up = graph.ancestor_table(edges, spark.createDataFrame([("d",)], "node string"))
    assert {r.node for r in up.collect()} == set(g.ancestors("d"))
    assert {r.node for r in graph.root_table(edges).collect()} == set(g.roots())
    assert {(r.child, r.parent): r.n_parents for r in graph.parent_table(edges).collect()}[("c", "a")] == 3
    assert set(CausalGraph.from_table(edges).edges) == set(g.edges)
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string")
    with pytest.raises(ValueError, match="cycle"):
        graph.level_table(loop)
    assert graph.ancestor_table(loop, spark.createDataFrame([("a",)], "node string")).count() == 1


def order_tables(spark, folder, n):
    """The tables of ``supply_edges`` with ``n`` orders of two lines each, the first of which stands there twice."""
    for name, rows, schema in (
            ("nation", [(1, 0), (2, 0)], "n_nationkey int, n_regionkey int"),
            ("customer", [(c, 1) for c in range(5)], "c_custkey long, c_nationkey int"),
            ("supplier", [(s, 2) for s in range(3)] + [(3, None)], "s_suppkey long, s_nationkey int"),
            ("orders", [(o, o % 5) for o in range(n)], "o_orderkey long, o_custkey long"),
            ("lineitem", [(o, (o + i) % 3) for o in range(n) for i in (0, 0, 1)], "l_orderkey long, l_suppkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_edges_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    """A task tells the repeats of so many pairs, however few bytes they are and however many pairs there are."""
    folder = order_tables(spark, tmp_path, 2000)
    monkeypatch.setattr(workload, "IDS_A_TASK", 250, raising=False)
    edges = workload.supply_edges(spark, folder)
    rows = [len(part) for part in edges.rdd.glom().collect()]
    assert sum(rows) == edges.distinct().count() == 2 + 5 + 3 + 2000 + 4000
    assert max(rows) < 2 * 250
    degree = {(r.child, r.parent): r.n_parents for r in graph.parent_table(edges).collect()}
    assert len(degree) == 6010 and degree["order:7", "supplier:1"] == 3 and degree["supplier:0", "nation:2"] == 1


def test_nodes_read_the_edges_once(spark, tmp_path, capsys):
    path = str(tmp_path / "edges")
    spark.createDataFrame([("a", "b"), ("a", "c"), (None, "c"), ("c", None)], "parent string, child string").write.parquet(path)
    nodes = graph.node_table(spark.read.parquet(path))
    nodes.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    assert nodes.columns == ["node"] and sorted(str(r.node) for r in nodes.collect()) == ["None", "a", "b", "c"]


def test_a_few_nodes_move_no_edges(spark, monkeypatch, capsys):
    """The edges are dealt out once, for the many nodes of the middle: not for one root, nor for the last nodes."""
    rows = [("root", f"middle-{i:05d}") for i in range(3000)] + [(f"middle-{i:05d}", f"leaf-{i % 2000:05d}") for i in range(3000)]
    edges = spark.createDataFrame(rows, "parent string, child string")
    plans, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: (df.explain(), plans.append(capsys.readouterr().out), cut(df))[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        found = {r.node: r.level for r in graph.level_table(edges).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {"root": 0} | {c: 1 for p, c in rows if p == "root"} | {c: 2 for p, c in rows if p != "root"}
    assert sum("SortMergeJoin" in p and "LeftSemi" in p for p in plans) == 1


@pytest.mark.parametrize("rows", ([(None, "b"), ("a", "b")], [("a", "b"), ("a", None), ("b", None)], [("a", "b"), ("a", "b"), ("b", "c")]))
def test_levels_of_null_and_repeated_edges(spark, rows):
    """A null is a node without a level above it, and what hangs on it never opens."""
    edges = spark.createDataFrame(rows, "parent string, child string")
    if rows[0][0] is None:
        with pytest.raises(ValueError, match="cycle"):
            graph.level_table(edges)
        return
    found = {r.node: r.level for r in graph.level_table(edges).collect()}
    assert found == ({"a": 0, "b": 1, None: 0} if rows[1][1] is None else {"a": 0, "b": 1, "c": 2})


def test_gaps_are_left_out(spark):
    """Summaries of rows with a null and a NaN equal those of the rows without them."""
    rows = [("a", float(i), float(i * i % 7)) for i in range(20)]
    kind = "g string, x double, y double"
    whole = spark.createDataFrame(rows, kind)
    holed = spark.createDataFrame(rows + [("a", None, None), ("a", float("nan"), float("nan"))], kind)
    as_set = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()}
    for f in (lambda df: frames.histograms(df, ["x", "y"], 5), lambda df: frames.pairwise(df, ["x", "y"]),
              lambda df: frames.pairwise_counts(df, ["x", "y"], 4), lambda df: frames.column_means(df),
              lambda df: frames.group_means(df, "g"), lambda df: frames.spread(df, "x").drop("n_rows"),
              lambda df: frames.change(df, F.lit(True), ["x"]), lambda df: frames.aligned_change(df, df, "g", ["x"])):
        assert as_set(f(holed)) == as_set(f(whole))
