"""Known ground truth, sum properties and brute force on small fixtures."""

import json
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from graphs import SERVICE_EDGES, SHOP_EDGES, SUPPLY_EDGES
from pyspark.sql import functions as F

from tracecause.operators import (anomaly, assignment, change, evaluation, falsification, influence, intervals, mechanisms,
                                  simulation)
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import draw_values, fit, read_tree, tree_value
from tracecause.operators.shapley import coalition_plan
from tracecause.sources.registry import ModelRegistry
from tracecause.sources.workspace import fresh_path
from tracecause.streaming import scoring

SHOP, SERVICES, SUPPLY = CausalGraph(SHOP_EDGES), CausalGraph(SERVICE_EDGES), CausalGraph(SUPPLY_EDGES)
HALF = {n: "halfnorm" for n in SERVICES.roots()}


def scores(df) -> dict:
    return {r.node: r.score for r in df.collect()}


def least_squares(pdf, node, columns):
    x = np.column_stack([np.ones(len(pdf))] + columns)
    beta, *_ = np.linalg.lstsq(x, pdf[node].to_numpy(float), rcond=None)
    return beta, pdf[node] - x @ beta


# --- fitting ---


def test_linear_fit_is_least_squares(shop):
    model = fit(shop, SHOP, F.col("Date"))
    pdf = shop.toPandas().astype({"Shopping_Event": float})
    for node in ("Page_Views", "Sold_Units", "Operational_Cost"):
        m = model[node]
        beta, rest = least_squares(pdf, node, [pdf[p].to_numpy(float) for p in m.parents])
        np.testing.assert_allclose([m.intercept, *m.coef], beta, rtol=1e-7)
        assert m.noise_var == pytest.approx(rest.var(), rel=1e-7)
        drawn = m.noise.frame.select(m.drawn({c: F.col(c) for c in m.noise.nodes}).alias("e")).toPandas().e
        assert m.noise.size == 365 and np.sort(drawn) == pytest.approx(np.sort(rest), abs=1e-6)
    assert model["Profit"].noise_var == 0.0 and model["Profit"].coef == pytest.approx((-1.0, 1.0))


def test_product_terms(shop):
    model = fit(shop, SHOP, F.col("Date"), {"Revenue": "poly"}, pool=0)
    m = model["Revenue"]
    assert m.noise_var == 0.0 and not m.is_linear
    coef = dict(zip(m.terms, m.coef))
    assert coef[("Sold_Units", "Unit_Price")] == pytest.approx(1.0, abs=1e-6)
    pdf = shop.toPandas().astype({"Shopping_Event": float})
    views = fit(shop, SHOP, F.col("Date"), {"Page_Views": "poly"}, pool=0)["Page_Views"]
    a = pdf["Ad_Spend"].to_numpy()
    flag = pdf["Shopping_Event"].to_numpy()
    beta, rest = least_squares(pdf, "Page_Views", [a, flag, a * a, a * flag])
    assert views.noise_var == pytest.approx(rest.var(), rel=1e-4)


def test_rows_with_gaps_are_counted_and_left_out(spark):
    pdf = pd.DataFrame({"k": range(6), "a": [1.0, 2.0, 3.0, 4.0, None, float("nan")], "b": [2.0, 4.0, 6.0, 8.5, 1.0, 1.0]})
    rows = [tuple(None if v is None else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    rows[4] = (4, None, 1.0)
    df = spark.createDataFrame(rows, "k int, a double, b double")
    model = fit(df, CausalGraph((("a", "b"),)), F.col("k"))
    assert (model.n_rows, model.n_dropped) == (4, 2)
    assert model["b"].coef[0] == pytest.approx(np.polyfit([1, 2, 3, 4], [2, 4, 6, 8.5], 1)[0])


def test_half_normal_root(normal):
    m = fit(normal, SERVICES, F.col("request_id"), HALF, pool=0)["Order_DB"]
    x = normal.toPandas()["Order_DB"]
    assert m.params["loc"] == x.min()
    assert m.params["scale"] == pytest.approx(np.sqrt(((x - x.min()) ** 2).mean()))


def test_fit_does_not_depend_on_partitions(shop):
    a, b = (fit(d, SHOP, F.col("Date")) for d in (shop.repartition(7), shop.coalesce(1)))
    for n in SHOP.order:
        np.testing.assert_allclose([a[n].intercept, *a[n].coef], [b[n].intercept, *b[n].coef], rtol=1e-6, atol=1e-6)
        np.testing.assert_allclose(a[n].noise_values(50), b[n].noise_values(50), rtol=1e-6, atol=1e-5)


def test_a_rare_value_can_be_drawn(spark):
    """One row in 100,000 holds a value that no other does; draws come from all rows."""
    df = spark.range(100_000).select("id", F.when(F.col("id") == 77, 1000.0).otherwise(F.col("id") % 7).cast("double").alias("x"))
    model = fit(df, CausalGraph((), ("x",)), F.col("id"))
    assert model["x"].noise.size == 100_000
    table = model["x"].noise.frame
    assert table.agg(F.count_distinct("pos"), F.max("pos")).first()[:] == (100_000, 99_999)
    at = table.where("x = 1000").first().pos
    asked = spark.createDataFrame([(at / 100_000 + 1e-9,), (0.5,)], "u double")
    assert 1000.0 in [r.v for r in model["x"].noise.join(asked, F.col("u"), F.col("x"), "v").collect()]
    assert model["x"].noise.rows(np.array([at]))["x"][0] == 1000.0


def test_kinds_are_checked():
    with pytest.raises(ValueError):
        from tracecause.operators.mechanisms import default_kinds
        default_kinds(SHOP, {"Profit": "empirical"})


@pytest.mark.parametrize("partitions", [1, 3, 4, 7, 8, 12])
def test_assignment_finds_the_product(shop, partitions):
    shop = shop.repartition(partitions)
    kinds, rows = assignment.assign(shop, SHOP, F.col("Date"))
    assert kinds["Revenue"] == "poly" and kinds["Shopping_Event"] == "empirical"
    assert all(kinds[n] == "linear" for n in ("Ad_Spend", "Page_Views", "Sold_Units", "Operational_Cost", "Profit"))
    assert sum(r[3] for r in rows) == len(SHOP.nodes)
    kept, _ = assignment.assign(shop, SHOP, F.col("Date"), override_models=False, kinds={"Revenue": "linear"})
    assert kept["Revenue"] == "linear"


def test_cross_validation_by_brute_force(shop):
    errors = assignment.fold_errors(shop, SHOP, F.col("Date"), folds=4)
    pdf = shop.withColumn("fold", assignment.fold_of(F.col("Date"), 4)).toPandas().astype({"Shopping_Event": float})
    gaps = []
    for f in range(4):
        train, test = pdf[pdf.fold != f], pdf[pdf.fold == f]
        a, e = "Ad_Spend", "Shopping_Event"
        cols = lambda d: [d[a], d[e], d[a] * d[a], d[a] * d[e]]
        beta, _ = least_squares(train, "Page_Views", [c.to_numpy() for c in cols(train)])
        gaps += list(test["Page_Views"] - np.column_stack([np.ones(len(test)), *cols(test)]) @ beta)
    assert errors["Page_Views"]["poly"] == pytest.approx(np.mean(np.square(gaps)), rel=1e-3)


def test_trees(spark):
    r = np.random.default_rng(0)
    x = r.uniform(-2, 2, 1500)
    y = np.where(x > 0.5, 4.0, -1.0) + r.normal(0, 0.1, 1500)
    df = spark.createDataFrame(pd.DataFrame({"k": range(1500), "x": x, "y": y}))
    g = CausalGraph((("x", "y"),))
    kinds, _ = assignment.assign(df, g, F.col("k"), quality="better", folds=2)
    assert kinds["y"] == "gbt"
    model = fit(df, g, F.col("k"), kinds)
    assert model["y"].params["r2"] > 0.95  # split points come from 32 candidate bins
    columns = df.select(model["y"].predict_column({"x": F.col("x")}).alias("p")).toPandas().p
    np.testing.assert_allclose(columns, model["y"].predict({"x": x}), rtol=1e-12)
    strength = influence.arrow_strength(model, df, "y", key=F.col("k")).first().strength
    assert strength == pytest.approx(y.var(), rel=0.15)
    odd = anomaly.attribute_anomalies(model, df.orderBy("k").limit(2), "y", "k", 30).toPandas()
    assert len(odd) == 4 and np.isfinite(odd.score).all()
    for row in df.orderBy("k").limit(1).toPandas().to_dict("records"):
        want, _ = brute_force_attribution(model, row, "y", 30)
        assert odd[odd.k == row["k"]].set_index("node").score.to_dict() == pytest.approx(want, abs=1e-9)
    tree = read_tree("If (feature 0 <= 0.5)\n  Predict: 1.0\n Else (feature 0 > 0.5)\n  Predict: 2.0", ("x",))
    assert tree == ["x", 0.5, 1.0, 2.0] and tree_value(json.loads(json.dumps(tree)), {"x": np.array([0.0, 1.0])}).tolist() == [1, 2]


def test_trees_pass_over_cells(spark, monkeypatch):
    """Rounds of boosting see cells of rows, and the trees are those that Spark grows on the rows themselves."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    r = np.random.default_rng(3)
    a, b = r.gamma(2.0, 10.0, 3000), np.floor(r.uniform(0, 4, 3000))
    data = pd.DataFrame({"k": range(3000), "a": a, "b": b, "y": np.sin(a / 9) * (1 + b) + r.normal(0, 0.1, 3000)})
    df = spark.createDataFrame(data)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumnRenamed("y", "label"))
    plain = GBTRegressor(maxIter=20, maxDepth=4, seed=0).fit(rows)
    want = plain.transform(rows).orderBy("k").select("prediction").toPandas().prediction
    seen, grow = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, d: (seen.append(d.count()), grow(self, d))[1])
    model = fit(df, CausalGraph((("a", "y"), ("b", "y"))), F.col("k"), {"y": "gbt"}, 0)
    assert len(seen) == 1 and seen[0] <= 32 * 4
    got = model["y"].predict({"a": a, "b": b})
    np.testing.assert_allclose(got - model["y"].intercept, want, atol=1e-9)
    batches, whole = [], type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda d, *args: (batches.append(d.count()), whole(d, *args))[1])
    found = {s.parent: s.strength for s in influence.arrow_strength(model, df, "y", key=F.col("k")).collect()}
    assert len(batches) == 1 and batches[0] <= 32 * 4
    pool = influence.first_rows(df, F.col("k"), ["a", "b"], 100)
    for i, parent in enumerate(("a", "b")):
        cut = [model["y"].predict({"a": a, "b": b, parent: np.full(3000, x)}) for x in pool[:, i]]
        assert found[parent] == pytest.approx(np.var(cut, axis=0).mean(), rel=1e-9)


def test_bounds_of_columns_with_many_values(spark):
    df = spark.range(30000).select(((F.col("id") * 7919) % 30000).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("few"))
    many, few = mechanisms.tree_bounds(df, ["x", "few"])
    assert few == [0.5, 1.5] and len(many) == 31
    np.testing.assert_allclose(many, np.arange(1, 32) * 30000 / 32, atol=30000 * 0.002)


def test_columns_that_do_not_vary(spark):
    rows = [(i, 5.0, float(i % 7), 2.0 * (i % 7) + 1, 3.0) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, flat double, a double, y double, z double")
    g = CausalGraph((("flat", "y"), ("a", "y"), ("a", "z")))
    model = fit(df, g, F.col("k"))
    coef = dict(zip(model["y"].parents, model["y"].coef))
    assert coef["a"] == pytest.approx(2.0) and coef["flat"] * 5 + model["y"].intercept == pytest.approx(1.0)
    assert model["z"].coef == pytest.approx((0.0,)) and model["z"].noise_var == 0.0
    got = anomaly.attribute_anomalies(model, df, "y", "k", 50).groupBy("k").agg(F.sum("score").alias("s")).toPandas()
    assert np.isfinite(got.s).all() and len(got) == 60
    assert evaluation.independence(model, df).filter("rejected").count() == 0
    assert (anomaly.z_scores(df, "flat").toPandas().score == 0).all()


# --- evaluation ---


def test_crps_by_brute_force(shop):
    model = fit(shop, SHOP, F.col("Date"), pool=0)
    got = {(r.node, r.metric): r.value for r in evaluation.mechanism_metrics(model, shop, F.col("Date")).collect()}
    pdf = shop.toPandas().astype({"Shopping_Event": float})
    for n in ("Ad_Spend", "Sold_Units", "Shopping_Event"):
        r = pdf[n] - model[n].predict({c: pdf[c].to_numpy(float) for c in SHOP.nodes})
        gap = 0.5 * np.abs(np.subtract.outer(r.to_numpy(), r.to_numpy())).mean()
        assert got[(n, "crps")] == pytest.approx(gap / pdf[n].std(), rel=1e-9)
        if n != "Shopping_Event":
            assert got[(n, "mse")] == pytest.approx((r ** 2).mean(), rel=1e-9)


def test_crps_with_one_value_in_most_rows(spark):
    v = np.array([0.0] * 700 + list(range(300)), dtype=float)
    df = spark.createDataFrame(pd.DataFrame({"g": "x", "v": v, "k": range(1000)})).repartition(5)
    row = evaluation.mean_abs_difference(df, "g", "v", F.xxhash64("k")).first()
    assert row.half_gap == pytest.approx(0.5 * np.abs(np.subtract.outer(v, v)).mean(), rel=1e-12)


def test_non_additive_nodes_are_rejected(normal):
    model = fit(normal, SERVICES, F.col("request_id"), HALF, pool=0)
    rejected = {r.node for r in evaluation.independence(model, normal).filter("rejected").collect()}
    assert {"Product_Service", "Caching_Service"} <= rejected
    assert not {"Auth_Service", "Order_Service", "Website"} & rejected


def test_generated_rows_look_like_the_data(shop):
    model = fit(shop, SHOP, F.col("Date"), {"Revenue": "poly"})
    kl = {r.node: r.kl for r in evaluation.generated_divergence(model, shop, 3000).collect()}
    assert max(kl.values()) < 0.2
    assert {r.kl for r in evaluation.binned_kl(shop, shop, ["Profit"]).collect()} == {0.0}


def test_report_sections(shop):
    report = evaluation.evaluate(fit(shop, SHOP, F.col("Date")), shop, F.col("Date"), True, True, True, 500).toPandas()
    assert set(report.section) == {"performance", "divergence", "baseline", "invertibility", "graph"}
    assert report.value.notna().all()


def test_falsification(weeks, spark):
    true = falsification.falsify(weeks[0], SUPPLY, 20).first()
    assert not true.rejected
    wrong = CausalGraph((("received", "submitted"), ("constraint", "demand"), ("submitted", "confirmed")))
    bad = falsification.local_claims(weeks[0], wrong).filter("violated").count()
    assert bad > falsification.local_claims(weeks[0], SUPPLY).filter("violated").count()
    corr, n = falsification.correlation_matrix(weeks[0], sorted(SUPPLY.nodes))
    np.testing.assert_allclose(corr, weeks[0].toPandas()[sorted(SUPPLY.nodes)].corr().to_numpy(), atol=1e-9)
    pdf = weeks[0].toPandas()
    _, a = least_squares(pdf, "received", [pdf.confirmed])
    _, b = least_squares(pdf, "demand", [pdf.confirmed])
    at = sorted(SUPPLY.nodes).index
    got = falsification.partial_correlation(corr, at("received"), at("demand"), [at("confirmed")])
    assert got == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9) and n == 1000


def test_a_graph_without_claims_is_not_rejected(spark):
    r = np.random.default_rng(8)
    a = r.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": a + r.normal(size=200), "c": r.normal(size=200)}))
    silent = falsification.falsify(df, CausalGraph((("a", "b"),)), 20).first()
    assert silent.same_claims_share == 1.0 and not silent.informative and not silent.rejected


def test_a_wrong_graph_is_rejected(spark):
    r = np.random.default_rng(9)
    names, data = list("abcdef"), {}
    for i, n in enumerate(names):
        data[n] = (0.9 * data[names[i - 1]] if i else 0.0) + r.normal(size=3000)
    df = spark.createDataFrame(pd.DataFrame(data))
    true = falsification.falsify(df, CausalGraph(tuple(zip(names, names[1:]))), 20).first()
    odd = ["a", "d", "b", "f", "c", "e"]
    wrong = falsification.falsify(df, CausalGraph(tuple(zip(odd, odd[1:]))), 20).first()
    assert true.informative and not true.rejected
    assert wrong.n_violations > true.n_violations and wrong.p_value > true.p_value


# --- Shapley ---


def test_shapley_by_brute_force(spark):
    r = np.random.default_rng(1)
    value = r.normal(size=16)
    want = np.zeros(4)
    for order in permutations(range(4)):
        mask = 0
        for j in order:
            want[j] += (value[mask | 1 << j] - value[mask]) / 24
            mask |= 1 << j
    plan = coalition_plan("abcd")
    np.testing.assert_allclose(value @ plan.factors, want, atol=1e-12)
    table = plan.explode(spark.range(1)).select("slot", F.element_at(F.array(*[F.lit(float(v)) for v in value]),
                                                                     F.col("slot") + 1).alias("v"))
    got = scores(plan.shares(table, F.col("v")))
    np.testing.assert_allclose([got[c] for c in "abcd"], want, atol=1e-12)


def test_sampled_orderings_keep_the_sum_and_find_additive_shares(spark):
    players = [f"p{i}" for i in range(20)]
    plan = coalition_plan(players, orderings=50)
    assert not plan.is_exact and plan.size < 50 * 21
    worth = np.arange(20.0)
    value = np.array([sum(worth[j] for j in range(20) if m >> j & 1) for m in plan.masks])
    np.testing.assert_allclose(value @ plan.factors, worth, atol=1e-9)
    table = plan.explode(spark.range(1))
    total = sum((F.when(plan.has(p), F.lit(float(i))).otherwise(0.0) for i, p in enumerate(players)), F.lit(0.0))
    got = scores(plan.shares(table.withColumn("v", total), F.col("v")))
    np.testing.assert_allclose([got[p] for p in players], worth, atol=1e-9)


def test_attribution_beyond_the_exact_limit(spark):
    """A chain of many nodes: sampled orderings still share out the whole score."""
    r = np.random.default_rng(4)
    names, data = [f"n{i:02d}" for i in range(14)], {}
    for i, n in enumerate(names):
        data[n] = (0.9 * data[names[i - 1]] if i else 0.0) + r.normal(size=300)
    df = spark.createDataFrame(pd.DataFrame({"k": range(300), **data}))
    model = fit(df, CausalGraph(tuple(zip(names, names[1:]))), F.col("k"))
    got = anomaly.attribute_anomalies(model, df, names[-1], "k", 60, orderings=30).toPandas()
    pair = got.groupby("k").score.sum()
    assert len(got) == 300 * 14 and np.isfinite(got.score).all()
    full = brute_force_sum(model, names[-1], df.toPandas(), 60)
    np.testing.assert_allclose(pair.sort_index(), full, atol=1e-9)


def test_a_hundred_nodes(spark):
    """Coalitions of more players than a long has bits: exact sums, and an error that says how sure the shares are."""
    r = np.random.default_rng(5)
    names = [f"n{i:03d}" for i in range(100)]

    def rows(shift):
        data = {}
        for i, n in enumerate(names):
            data[n] = (0.9 * data[names[i - 1]] if i else shift) + shift * (i == 97) * 2 + r.normal(size=400)
        return spark.createDataFrame(pd.DataFrame({"k": range(400), **data}))

    old, new = rows(0.0), rows(1.0)
    graph = CausalGraph(tuple(zip(names, names[1:])))
    out = change.distribution_change(old, new, graph, names[-1], orderings=6, errors=True).toPandas().set_index("node")
    means = [d.agg(F.avg(names[-1])).first()[0] for d in (old, new)]
    assert len(out) == 100 and out.score.sum() == pytest.approx(means[1] - means[0], abs=1e-9)
    assert out.score.idxmax() == "n097" and out.score["n097"] == pytest.approx(2 * 0.81, abs=0.5)
    model = fit(old, graph, F.col("k"))
    some = old.orderBy("k").limit(3).persist()
    got = anomaly.attribute_anomalies(model, some, names[-1], "k", 50, orderings=8, errors=True).toPandas()
    np.testing.assert_allclose(got.groupby("k").score.sum(), brute_force_sum(model, names[-1], some.toPandas(), 50), atol=1e-9)
    assert len(got) == 300 and (got.error >= 0).all() and got.error.max() > 0


def test_errors_of_sampled_orderings_cover_the_exact_shares():
    r = np.random.default_rng(6)
    value = np.cumsum(r.normal(size=1 << 10)) * 0.1
    exact = value @ coalition_plan("abcdefghij").factors
    plan = coalition_plan("abcdefghij", orderings=400, seed=1)
    seen = value[list(plan.masks)]
    off = np.abs(seen @ plan.factors - exact) / plan.errors(seen)
    assert (off < 4).all() and (off < 2).mean() >= 0.7 and (seen @ plan.factors).sum() == pytest.approx(value[-1] - value[0])


def brute_force_sum(model, target, pdf, draws):
    ref = np.sort(draw_values(model, model.graph.closure(target), draws, "ref0", 0)[1][target])
    tie = 1e-9 * ref.std(ddof=1)
    y = draw_values(model, model.graph.closure(target), draws, 0, 0)[1][target]
    tail = lambda v: min((ref >= v - tie).sum(), (ref <= v + tie).sum())
    return [-np.log(max(np.mean([tail(v) <= tail(x) for v in y]), 1 / (draws + 1))) for x in pdf.sort_values("k")[target]]


# --- influence ---


def test_arrow_strength(shop):
    model = fit(shop, SHOP, F.col("Date"), pool=0)
    got = {r.parent: r.strength for r in influence.arrow_strength(model, shop, "Profit").collect()}
    pdf = shop.toPandas()
    assert got["Revenue"] == pytest.approx(pdf.Revenue.var(), rel=1e-6)
    assert got["Operational_Cost"] == pytest.approx(pdf.Operational_Cost.var(), rel=1e-6)
    assert got["Revenue"] > got["Operational_Cost"]


def test_arrow_strength_of_a_product_by_brute_force(shop):
    model = fit(shop, SHOP, F.col("Date"), {"Revenue": "poly"}, pool=0)
    got = {r.parent: r.strength for r in influence.arrow_strength(model, shop, "Revenue").collect()}
    pdf = shop.toPandas()
    by_row = [np.var([u * p for u in pdf.Sold_Units], ddof=1) for p in pdf.Unit_Price]
    assert got["Sold_Units"] == pytest.approx(np.mean(by_row), rel=1e-4)


def test_kl_strength_ranks_parents(shop):
    model = fit(shop, SHOP, F.col("Date"), pool=0)
    got = {r.parent: r.strength for r in influence.arrow_strength(model, shop, "Profit", "kl", F.col("Date")).collect()}
    assert set(got) == {"Revenue", "Operational_Cost"} and all(v >= 0 for v in got.values())


def test_intrinsic_influence(spark, shop):
    model = fit(shop, SHOP, F.col("Date"), pool=0)
    got = scores(influence.intrinsic(spark, model, "Profit"))
    assert max(got, key=got.get) == "Shopping_Event"
    _, effect = model.total_effects("Profit")
    assert sum(got.values()) == pytest.approx(sum(effect[n] ** 2 * model[n].noise_var for n in effect))


def test_a_rescaled_copy_has_no_influence_of_its_own(spark):
    r = np.random.default_rng(2)
    a = r.normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({"k": range(500), "a": a, "copy": 3 * a + 1, "y": 3 * a + r.normal(size=500)}))
    model = fit(df, CausalGraph((("a", "copy"), ("copy", "y"))), F.col("k"))
    for linear in (True, False):
        got = scores(influence.intrinsic(spark, model, "y", 100, linear=linear))
        assert got["copy"] == pytest.approx(0.0, abs=1e-6) and got["a"] > got["y"] > 0


def test_sampled_influence_is_near_the_closed_form(spark, weeks):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    exact, drawn = (scores(influence.intrinsic(spark, model, "received", 500, linear=x)) for x in (True, False))
    for n in exact:
        assert drawn[n] == pytest.approx(exact[n], rel=0.02)


def test_influence_through_a_product(spark):
    """y = a b + a + noise: the product's variance is shared by a and b, the straight line is a's alone."""
    r = np.random.default_rng(3)
    a, b = r.normal(size=(2, 4000))
    df = spark.createDataFrame(pd.DataFrame({"k": range(4000), "a": a, "b": b, "y": a * b + a + 0.5 * r.normal(size=4000)}))
    model = fit(df, CausalGraph((("a", "y"), ("b", "y"))), F.col("k"), {"y": "poly"})
    got = scores(influence.intrinsic(spark, model, "y", 4000))
    assert got == pytest.approx({"a": 1.5, "b": 0.5, "y": 0.25}, abs=0.15)
    assert got["y"] == pytest.approx(0.25, rel=0.1)


# --- anomalies ---


def brute_force_attribution(model, row, target, draws):
    """Definition, spelled out: score every draw of every coalition."""
    nodes = model.graph.closure(target)
    ref = np.sort(draw_values(model, nodes, draws, "ref0", 0)[1][target])
    tie = 1e-9 * ref.std(ddof=1)
    tail = lambda y: min((ref >= y - tie).sum(), (ref <= y + tie).sum())
    random, _ = draw_values(model, nodes, draws, 0, 0)
    own = {n: row[n] - model[n].predict({p: row[p] for p in model[n].parents}) for n in nodes}
    value = []
    for mask in range(2 ** len(nodes)):
        at = {}
        for j, n in enumerate(nodes):
            at[n] = model[n].predict(at) + (random[n] if mask >> j & 1 else own[n])
        y = np.broadcast_to(at[target], (draws,))
        q = np.mean([tail(v) <= tail(row[target]) for v in y]) if mask else 1.0
        value.append(-np.log(max(q, 1 / (draws + 1))))
    return dict(zip(nodes, np.array(value) @ coalition_plan(nodes).factors)), value[-1]


@pytest.mark.parametrize("linear", [True, False])
def test_attribution_by_brute_force(weeks, linear):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    rows = weeks[1].orderBy(F.desc("received"), "asin").limit(3).persist()
    got = anomaly.attribute_anomalies(model, rows, "received", "asin", 150, linear=linear).toPandas()
    for row in rows.toPandas().to_dict("records"):
        want, full = brute_force_attribution(model, row, "received", 150)
        mine = got[got["asin"] == row["asin"]].set_index("node").score
        for n, v in want.items():
            assert mine[n] == pytest.approx(v, abs=1e-9)
        assert mine.sum() == pytest.approx(full, abs=1e-9)


def test_attribution_of_a_product_model(shop, shop_new):
    model = fit(shop, SHOP, F.col("Date"), {"Revenue": "poly"})
    row = shop_new.orderBy("Date").limit(1)
    got = anomaly.attribute_anomalies(model, row, "Profit", ["Date"], 60).toPandas().set_index("node").score
    want, _ = brute_force_attribution(model, row.toPandas().astype({"Shopping_Event": float}).to_dict("records")[0],
                                      "Profit", 60)
    for n, v in want.items():
        assert got[n] == pytest.approx(v, abs=1e-9)


def test_the_slow_cache_is_found(spark, normal):
    model = fit(normal, SERVICES, F.col("request_id"), HALF)
    r = normal.toPandas().mean()
    outlier = spark.createDataFrame(pd.DataFrame([{**r, "request_id": -1, "Caching_Service": r.Caching_Service + 2,
                                                   "Product_Service": r.Product_Service + 1.6, "API": r.API + 1.6,
                                                   "www": r.www + 1.6, "Website": r.Website + 1.6}]))
    got = scores(anomaly.attribute_anomalies(model, outlier, "Website", "request_id", 1000))
    assert max(got, key=got.get) == "Caching_Service"
    out = intervals.anomaly_intervals(normal, outlier, SERVICES, "Website", F.col("request_id"), "request_id",
                                      replicates=5, kinds=HALF, draws=300).toPandas().set_index("node")
    assert out["median"].idxmax() == "Caching_Service" and (out.lo <= out["median"]).all() and (out.resamples == 5).all()


def test_anomaly_scores(shop):
    model = fit(shop, SHOP, F.col("Date"))
    ref = anomaly.reference_draws(model, "Profit", 500)
    got = anomaly.score_rows(model, shop, "Profit", ["Date"], 500).toPandas()
    for v, s in zip(got["value"], got.score):
        p = max(min((ref.values >= v - ref.tie).sum(), (ref.values <= v + ref.tie).sum()) / 500, 1 / 501)
        assert s == pytest.approx(-np.log(min(2 * p, 1.0)))
    z = anomaly.z_scores(shop, "Profit").toPandas()
    assert z.score.to_numpy() == pytest.approx(np.abs((z["value"] - z["value"].mean()) / z["value"].std()).to_numpy())


def test_incomplete_rows_get_no_attribution(weeks):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    rows = weeks[1].limit(2).withColumn("demand", F.lit(None).cast("double"))
    assert anomaly.attribute_anomalies(model, rows, "received", "asin", 50).count() == 0


# --- change ---


def test_changed_mechanisms_lead(weeks):
    old, new = weeks
    got = scores(change.distribution_change(old, new, SUPPLY, "received"))
    assert set(sorted(got, key=got.get)[-2:]) == {"demand", "confirmed"}
    a, b = (w.agg(F.avg("received")).first()[0] for w in weeks)
    assert sum(got.values()) == pytest.approx(b - a, rel=1e-9)
    drawn = scores(change.distribution_change(old, new, SUPPLY, "received", draws=4000, key=F.col("asin")))
    for n in got:
        assert drawn[n] == pytest.approx(got[n], abs=0.05 * (b - a))


def test_no_change_scores_nothing(weeks):
    old = weeks[0]
    for kw in ({}, {"summary": change.variance, "draws": 300}, {"summary": change.kl, "draws": 300},
               {"summary": change.quantile(0.9), "draws": 300}):
        got = scores(change.distribution_change(old, old, SUPPLY, "received", key=F.col("asin"), **kw))
        assert all(abs(v) < 1e-9 for v in got.values())


def test_unchanged_mechanisms_score_exactly_zero_when_tested(weeks):
    got = scores(change.distribution_change(*weeks, SUPPLY, "received", test_change=True))
    assert got["constraint"] == 0.0 and got["demand"] > 0 and got["confirmed"] > 0


@pytest.mark.parametrize("summary", [change.mean, change.variance, change.quantile(0.9), change.kl])
def test_a_changed_spread_keeps_its_share_when_tested(spark, summary):
    """Equal means, another variance at the root: the share stays, and shares add up to the whole change."""
    r = np.random.default_rng(10)
    sides = []
    for sd in (1.0, 3.0):
        x = r.normal(0, sd, 1500)
        x -= x.mean()
        sides.append(spark.createDataFrame(pd.DataFrame({"k": range(1500), "x": x, "y": x + r.normal(0, 0.5, 1500)})))
    kw = {"summary": summary, "draws": 800, "key": F.col("k")}
    graph = CausalGraph((("x", "y"),))
    free, tested = (scores(change.distribution_change(*sides, graph, "y", test_change=t, **kw)) for t in (False, True))
    assert tested["y"] == 0.0
    assert tested["x"] == pytest.approx(free["x"] + free["y"], abs=0.1 * abs(free["x"]) + 0.05)
    if summary is not change.mean:
        assert abs(tested["x"]) > 0.1


def test_gaps_count_nowhere(spark):
    """A null and a NaN row change nothing in divergences and strengths."""
    r = np.random.default_rng(11)
    x = r.normal(size=300)
    whole = pd.DataFrame({"k": range(300), "x": x, "y": 2 * x + r.normal(size=300)})
    a = spark.createDataFrame(whole)
    b = a.unionByName(spark.createDataFrame([(300, None, 1.0), (301, 1.0, float("nan"))], "k long, x double, y double"))
    g = CausalGraph((("x", "y"),))
    assert evaluation.binned_kl(a, b, ["x"]).first().kl == pytest.approx(evaluation.binned_kl(a, a.union(a.limit(0)), ["x"]).first().kl, abs=1e-2)
    for kind in ("linear", "gbt"):
        model = fit(a, g, F.col("k"), {"y": kind}, 0)
        one, two = (influence.arrow_strength(model, df, "y", key=F.col("k")).first().strength for df in (a, b))
        assert one == pytest.approx(two, rel=1e-9)
    model = fit(a, g, F.col("k"))
    one, two = (influence.arrow_strength(model, df, "y", "kl", F.col("k")).first().strength for df in (a, b))
    assert one == pytest.approx(two, rel=1e-9)


def test_a_python_difference_agrees_with_the_built_in(weeks):
    kw = {"draws": 400, "key": F.col("asin")}
    mine = scores(change.distribution_change(*weeks, SUPPLY, "received",
                                             difference=lambda x, y: np.mean(y) - np.mean(x), **kw))
    want = scores(change.distribution_change(*weeks, SUPPLY, "received", **kw))
    assert mine == pytest.approx(want, abs=1e-9)


def test_page_views_lead_the_profit_drop(shop, shop_new):
    quarter = shop.filter(F.col("Date") <= F.lit("2021-03-31").cast("date"))
    got = scores(change.distribution_change(quarter, shop_new, SHOP, "Profit", kinds={"Revenue": "poly"},
                                            key=F.col("Date"), draws=2000))
    assert min(got, key=got.get) in ("Page_Views", "Unit_Price") and got["Page_Views"] < 0


def test_relabelled_nodes_permute_the_scores(weeks):
    names = {n: f"x{i}" for i, n in enumerate(reversed(SUPPLY.order))}
    got = scores(change.distribution_change(*weeks, SUPPLY, "received"))
    moved = [w.select("asin", *[F.col(n).alias(m) for n, m in names.items()]) for w in weeks]
    again = scores(change.distribution_change(*moved, SUPPLY.relabel(names), names["received"]))
    assert {names[n]: v for n, v in got.items()} == pytest.approx(again, abs=1e-9)


def test_degraded_cache_leads_the_change(normal, degraded):
    out = intervals.change_intervals(normal, degraded, SERVICES, "Website", F.col("request_id"), "subsample", 6,
                                     kinds=HALF).toPandas().set_index("node")
    assert out["median"].idxmax() == "Caching_Service" and out.loc["Caching_Service", "lo"] > 0


def test_bootstrap_by_brute_force(weeks):
    """One replicate by hand: repeat rows by their weights, fit, compare."""
    from tracecause.functions.randomness import keyed_uniform_values, poisson_values

    got = intervals.change_replicates(*weeks, SUPPLY, "received", F.col("asin"), "refit", 3).toPandas()
    for r in range(3):
        sides = []
        for w in weeks:
            pdf = w.toPandas()
            weight = poisson_values(keyed_uniform_values(pdf["asin"], "boot", r, 0))
            sides.append(w.sparkSession.createDataFrame(pdf.loc[pdf.index.repeat(weight)]))
        want = scores(change.distribution_change(*sides, SUPPLY, "received"))
        mine = got[got.replicate == r].set_index("node").score.to_dict()
        assert mine == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_drawn_replicates_share_one_plan(weeks, spark):
    """All replicates at once give what each gives alone."""
    for mode in ("refit", "rerun"):
        got = intervals.change_replicates(*weeks, SUPPLY, "received", F.col("asin"), mode, 2, summary=change.variance,
                                          draws=200).toPandas()
        if mode == "refit":
            both = weeks[0].withColumn("side", F.lit(0)).unionByName(weeks[1].withColumn("side", F.lit(1)))
            models = intervals.replicate_models(both, SUPPLY, F.col("asin"), SUPPLY.closure("received"), mode, 2, side="side")
        for r in range(2):
            pair = ([models[(s, r)] for s in (0, 1)] if mode == "refit"
                    else change.fit_periods(*weeks, SUPPLY, "received", key=F.col("asin"), pool=1000))
            want = scores(change.change_scores(spark, *pair, "received", change.variance, 200, r))
            assert got[got.replicate == r].set_index("node").score.to_dict() == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_cheaper_hash_gives_like_intervals(weeks):
    args = (*weeks, SUPPLY, "received", F.col("asin"), "refit", 10)
    a, b = (intervals.change_intervals(*args, method=m).toPandas().set_index("node") for m in ("md5", "xxhash64"))
    assert b.loc["demand", "median"] == pytest.approx(a.loc["demand", "median"], rel=0.1)


def test_intervals_over_a_closure(weeks, spark):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    other = fit(weeks[1], SUPPLY, F.col("asin"))
    out = intervals.confidence_intervals(
        lambda r: change.change_scores(spark, model, other, "received", draws=300, replicate=r), 4).toPandas()
    assert (out["mode"] == "rerun").all() and (out.hi > out.lo).any()


# --- simulation ---


def test_draws_follow_the_model(spark, weeks):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    drawn = simulation.draw(spark, model, 3000).toPandas()
    values = draw_values(model, SUPPLY.order, 3000)[1]
    np.testing.assert_allclose(drawn.sort_values("id").received, values["received"], rtol=1e-9)
    again = simulation.draw(spark, model, 3000).repartition(3).toPandas().sort_values("id")
    np.testing.assert_array_equal(again.received, drawn.sort_values("id").received)
    assert drawn.received.mean() == pytest.approx(weeks[0].toPandas().received.mean(), rel=0.05)


def test_interventions_move_means_by_the_path_effect(degraded):
    model = fit(degraded, SERVICES, F.col("request_id"), HALF)
    shift = {"Caching_Service": lambda x: x - 1, "Shipping_Cost_Service": lambda x: x + 2}
    _, effect = model.total_effects("Website")
    want = -effect["Caching_Service"] + 2 * effect["Shipping_Cost_Service"]
    exact = simulation.intervene(model, degraded, F.col("request_id"), shift, "counterfactual")
    rows = {r.node: r for r in simulation.before_after(degraded, exact, SERVICES.order).collect()}
    assert rows["Website"].difference == pytest.approx(want, abs=1e-9)
    assert rows["Customer_DB"].difference == 0.0 and rows["Shipping_Cost_Service"].difference == pytest.approx(2.0)
    fresh = simulation.intervene(model, degraded, F.col("request_id"), shift)
    rows = {r.node: r for r in simulation.before_after(degraded, fresh, SERVICES.order).collect()}
    assert rows["Website"].difference == pytest.approx(want, abs=0.15)
    out = intervals.intervention_intervals(degraded, SERVICES, F.col("request_id"), shift, replicates=4,
                                           kinds=HALF).toPandas().set_index("node")
    assert out.loc["Website", "lo"] <= out.loc["Website", "median"] <= out.loc["Website", "hi"]
    assert out.loc["Customer_DB", "hi"] == pytest.approx(out.loc["Customer_DB", "lo"])


def test_interventional_draws(spark, weeks):
    model = fit(weeks[0], SUPPLY, F.col("asin"))
    base = simulation.draw(spark, model, 500).agg(F.avg("received")).first()[0]
    moved = simulation.interventional_samples(spark, model, 500, {"demand": lambda x: x + 1}).agg(F.avg("received")).first()[0]
    assert moved - base == pytest.approx(model.total_effects("received")[1]["demand"], rel=1e-6)


# --- models as tables, streams ---


def test_registry(spark, shop):
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    with pytest.raises(ValueError):
        registry.latest_version("shop")
    model = fit(shop, SHOP, F.col("Date"), {"Revenue": "poly"})
    assert registry.save_model("shop", model, "days", 3, {"quality": "good"}, shop.schema) == 1
    assert registry.save_model("shop", model) == 2 and registry.latest_version("shop") == 2
    registry.set_alias("shop", "champion", 2)
    registry.set_alias("shop", "CHAMPION", 1)
    assert registry.resolve("shop", "Champion") == 1
    with pytest.raises(ValueError):
        registry.set_alias("shop", "champion", 9)
    loaded = registry.load_model("shop", "champion")
    assert set(loaded.graph.edges) == set(SHOP.edges)
    for n in SHOP.nodes:
        assert loaded[n].kind == model[n].kind and loaded[n].terms == model[n].terms
        assert loaded[n].coef == pytest.approx(model[n].coef) and loaded[n].noise_values(40) == pytest.approx(model[n].noise_values(40))
    with pytest.raises(ValueError, match="missing"):
        registry.check_input("shop", 1, shop.drop("Profit"))
    with pytest.raises(ValueError, match="is string"):
        registry.check_input("shop", 1, shop.withColumn("Profit", F.col("Profit").cast("string")))


def test_stream_equals_batch_and_replays_once(spark, weeks):
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    registry.save_model("supply", fit(weeks[0], SUPPLY, F.col("asin")))
    registry.set_alias("supply", "champion", 1)
    rows = weeks[1].limit(60).withColumn("demand", F.when(F.col("asin") != "P00007", F.col("demand"))).persist()
    inbox, results, log = (fresh_path(spark, n) for n in ("inbox", "results", "log"))
    rows.repartition(3).write.parquet(inbox)
    for _ in range(2):  # the second run replays every batch under a new set of offsets
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        scoring.score_stream(source, registry, "supply", "received", "asin", results, log,
                             fresh_path(spark, "offsets"), draws=100).awaitTermination()
    got = scoring.read_results(spark, results).toPandas()
    want = scoring.score(registry, "supply", rows, "received", ["asin"], draws=100).toPandas()
    key = ["asin", "node"]
    np.testing.assert_allclose(got.sort_values(key).score.to_numpy(), want.sort_values(key).score.to_numpy(), atol=1e-12)
    logged = spark.read.parquet(log).toPandas()
    assert len(logged) == 60 and logged.row_key.is_unique and (logged.version == 1).all()
    assert logged[logged.response_json.isna()].row_key.tolist() == ["P00007"]
    assert json.loads(logged.request_json[0])["asin"] == logged.row_key[0]
