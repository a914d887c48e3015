"""Tests that see more than means and straight lines: independence, implied claims, shape of noise."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracecause.functions.statistics import chi2_tail_value, kolmogorov_tail_value, weighted_chi2_tail_value
from tracecause.operators import change, evaluation, falsification
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import Mechanism, fit

PAIR = CausalGraph((("x", "y"),))


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(next(iter(columns.values())))), **columns}))


# --- tails ---


def test_tail_values():
    r = np.random.default_rng(0)
    weights = np.array([3.0, 1.0, 0.5, 0.1])
    sample = (weights * r.normal(size=(200_000, 4)) ** 2).sum(axis=1)
    traces = tuple(float((weights ** k).sum()) for k in (1, 2, 3))
    for q in (0.5, 0.9, 0.99, 0.999):
        assert weighted_chi2_tail_value(float(np.quantile(sample, q)), traces) == pytest.approx(1 - q, rel=0.35)
    assert chi2_tail_value(3.841, 1) == pytest.approx(0.05, rel=0.1) and chi2_tail_value(0, 3) == 1.0
    assert kolmogorov_tail_value(1.358 / np.sqrt(5000), 10_000, 10_000) == pytest.approx(0.05, rel=0.05)


# --- noise and parents ---


def test_a_sine_is_seen_where_bins_see_nothing(spark):
    r = np.random.default_rng(1)
    x = r.uniform(-3, 3, 4000)
    rows = frame(spark, x=x, y=0.5 * x + 0.4 * np.sin(5 * x) + r.normal(0, 0.5, 4000))
    model = fit(rows, PAIR, F.col("id"), pool=False)
    assert evaluation.kernel_independence(model, rows).first().rejected
    spread = frame(spark, x=x, y=0.5 * x + r.normal(0, 0.2 + 0.3 * np.abs(x), 4000))
    assert evaluation.kernel_independence(fit(spread, PAIR, F.col("id"), pool=False), spread).first().rejected


def test_independent_noise_keeps_its_level(spark):
    """Ten parents and skewed noise at a time: p-values of independent columns are spread over the unit interval."""
    r = np.random.default_rng(2)
    graph = CausalGraph(tuple((f"x{i}", f"y{i}") for i in range(20)))
    columns = {}
    for i in range(20):
        columns[f"x{i}"] = r.normal(size=1500) if i % 2 else r.exponential(size=1500)
        columns[f"y{i}"] = 2 * columns[f"x{i}"] + (r.exponential(size=1500) if i % 3 else r.normal(size=1500))
    rows = frame(spark, **columns)
    out = evaluation.kernel_independence(fit(rows, graph, F.col("id"), pool=False), rows).toPandas()
    assert len(out) == 20 and not out.rejected.any() and (out.p_value < 0.1).sum() <= 6 and out.p_value.max() > 0.5


def test_kernel_statistic_by_brute_force(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=300)
    rows = frame(spark, x=x, y=x + r.normal(size=300)).repartition(5)
    model = fit(rows, PAIR, F.col("id"), pool=False)
    got = evaluation.kernel_independence(model, rows).first()
    pdf = rows.toPandas()
    f = ((pdf.y - model["y"].predict({"x": pdf.x})) / model["y"].noise_var ** 0.5).to_numpy()
    g = ((pdf.x - pdf.x.mean()) / pdf.x.std()).to_numpy()
    a, b = evaluation.noise_features(f, "y", 0), evaluation.parent_features(g, "x", 0)[:, evaluation.PARENT_SCALES.index(got.scale)::3]
    a, b = a - a.mean(axis=0), b - b.mean(axis=0)
    assert got.statistic == pytest.approx(sum((a[:, i] @ b[:, j] / 300) ** 2 for i in range(8) for j in range(4)) * 300, rel=1e-6)
    assert got.n == 300


def test_services_that_are_not_additive(normal):
    from graphs import SERVICE_EDGES

    services = CausalGraph(SERVICE_EDGES)
    model = fit(normal, services, F.col("request_id"), pool=False)
    out = evaluation.kernel_independence(model, normal)
    rejected = {r.node for r in out.filter("rejected").collect()}
    assert {"Product_Service", "Caching_Service"} <= rejected and not {"Auth_Service", "Order_Service", "Website"} & rejected


# --- implied claims ---


def chain(n, seed, square=0.0):
    r = np.random.default_rng(seed)
    a = r.normal(size=n)
    b = 0.9 * a + r.normal(size=n)
    c = 0.8 * b + square * (a ** 2 - 1) + r.normal(size=n)
    d = 0.8 * c + r.normal(size=n)
    e = 0.8 * d + r.normal(size=n)
    return {"a": a, "b": b, "c": c, "d": d, "e": e}


CHAIN = CausalGraph((("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")))


def test_a_claim_wrong_only_by_a_square(spark):
    """c also depends on the part of a squared that b does not tell; no straight line shows it."""
    rows = frame(spark, **chain(3000, 4, square=0.7))
    out = {(r.node, r.other): r for r in falsification.covariance_claims(rows, CHAIN, F.col("id")).collect()}
    assert out["c", "a"].violated and out["c", "a"].p_value < 1e-6
    right = falsification.covariance_claims(frame(spark, **chain(3000, 5)), CHAIN, F.col("id")).toPandas()
    assert right.violated.sum() <= 1 and right.p_value.min() > 0.001


def test_a_missing_square_is_rejected(spark):
    """Two graphs of the same claims by correlation: only the covariance measure tells the one that lacks an arrow."""
    r = np.random.default_rng(6)
    cause = {n: r.integers(-1, 2, 4000).astype(float) for n in "abc"}
    effect = {"y" + n: cause[n] ** 2 + 0.5 * r.normal(size=4000) for n in "abc"}
    rows = frame(spark, **cause, **effect)
    lacking = CausalGraph((("a", "ya"), ("b", "yb")), ("c", "yc"))
    full = CausalGraph((("a", "ya"), ("b", "yb"), ("c", "yc")))
    key = F.col("id")
    bad = {m: falsification.permutation_results(rows, lacking, 0, method=m, key=key)[0][3] for m in ("correlation", "covariance")}
    assert bad["covariance"] > bad["correlation"]
    assert not falsification.falsify(rows, full, 20, method="covariance", key=key).first().rejected
    wrong = CausalGraph((("a", "yb"), ("b", "yc"), ("c", "ya")))
    seen, blind = (falsification.falsify(rows, wrong, 20, method=m, key=key).first() for m in ("covariance", "correlation"))
    assert seen.rejected and seen.n_violations >= 3 and blind.n_violations < seen.n_violations


def test_covariance_measure_by_brute_force(spark):
    from tracecause.functions.randomness import keyed_uniform_values

    data = pd.DataFrame(chain(400, 7))
    rows = frame(spark, **data).repartition(3)
    got = {(r.node, r.other): r.statistic for r in falsification.covariance_claims(rows, CHAIN, F.col("id"), "linear", False, 4).collect()}
    fold = np.floor(keyed_uniform_values(range(400), "fold") * 4).astype(int)
    for x, z, given in falsification.implied_claims(CHAIN):
        held = []
        for t in (x, z):
            r = np.empty(400)
            for f in range(4):
                train = fold != f
                design = np.column_stack([np.ones(400), *[data[g] for g in given]])
                beta, *_ = np.linalg.lstsq(design[train], data[t][train], rcond=None)
                r[~train] = (data[t] - design @ beta)[~train]
            held.append(r)
        both = held[0] * held[1]
        assert got[x, z] == pytest.approx(400 * both.mean() ** 2 / both.var(), rel=1e-6, abs=1e-9)


def test_a_node_given_by_its_parents_depends_on_nothing_else(spark):
    data = chain(500, 8)
    data["f"] = data["d"] + data["e"]
    graph = CausalGraph(CHAIN.edges + (("d", "f"), ("e", "f")))
    out = falsification.covariance_claims(frame(spark, **data), graph, F.col("id")).toPandas()
    assert (out[out.node == "f"].p_value == 1.0).all()


# --- the shape of noise ---


def test_distances_by_brute_force(spark):
    r = np.random.default_rng(9)
    old, new = r.normal(size=700).round(1), r.normal(0.1, 1.2, 900).round(1)
    rows = frame(spark, x=np.concatenate([old, new]), side=np.repeat([0, 1], [700, 900])).select("side", "x").repartition(6)
    graph = CausalGraph((), ("x",))
    model = fit(rows, graph, F.col("x"), pool=False)
    d, n, m = change.shape_distances(rows, (model, model), ["x"])["x"]
    points = np.unique(np.concatenate([old, new]))
    want = max(abs((old <= p).mean() - (new <= p).mean()) for p in points)
    assert d == pytest.approx(want, abs=1e-12) and (n, m) == (700, 900)


@pytest.mark.parametrize("test", [True, "shape"])
def test_two_peaks_of_equal_variance(spark, test):
    """Mean and variance of the noise stay, its shape does not: only the shape test keeps the node's share."""
    r = np.random.default_rng(10)
    sides = []
    for two_peaks in (False, True):
        x = r.normal(size=3000)
        noise = np.where(r.random(3000) < 0.5, -0.95, 0.95) + r.normal(0, 0.31, 3000) if two_peaks else r.normal(0, 1, 3000)
        sides.append(frame(spark, x=x, y=x + (noise - noise.mean()) / noise.std()))
    out = change.distribution_change(*sides, PAIR, "y", change.quantile(0.9), key=F.col("id"), test_change=test, draws=3000)
    scores = {s.node: s.score for s in out.collect()}
    assert scores["x"] == pytest.approx(0.0, abs=1e-9)
    assert (abs(scores["y"]) > 0.03) if test == "shape" else (scores["y"] == pytest.approx(0.0, abs=1e-9))


def test_mechanism_objects_travel():
    import pickle

    assert pickle.loads(pickle.dumps(Mechanism("y", "linear", ("x",), (("x",),), (2.0,), 1.0))).predict({"x": 3.0}) == 7.0
