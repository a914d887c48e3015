"""Replicates as matrix products, against rows repeated by hand."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from graphs import SUPPLY_EDGES
from pyspark.sql import functions as F

from tracecause.functions.randomness import keyed_uniform_values, poisson_values, uniform, uniform_values
from tracecause.operators import change, intervals, sampling
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import keyed_rows, noise_table
from tracecause.operators.noise import MOST_BUCKETS, MOST_TOTALS, NoiseTable, RowOrder, bucket_count, fetch
from tracecause.operators.resampling import Weights, bootstrap_sums, replicate_sums

SUPPLY = CausalGraph(SUPPLY_EDGES)
NODES = list(SUPPLY.order)


def by_hand(pdf, weights):
    """Replicates x rows, from the text of each key."""
    if weights.method == "xxhash64":
        return None
    out = []
    for r in range(weights.replicates):
        u = keyed_uniform_values(pdf["asin"], weights.label, r, weights.seed)
        out.append((u < weights.frac).astype(int) if weights.mode == "subsample" else poisson_values(u))
    return np.array(out)


def test_draws_have_52_bits(spark):
    u = uniform_values(2000, "x")
    assert (u * 2 ** 32 % 1 != 0).mean() > 0.99 and len(np.unique(u)) == 2000
    want = int(hashlib.md5(b"7:x:0:0").hexdigest()[:13], 16) / 2 ** 52
    assert u[7] == want and spark.range(7, 8).select(uniform(F.col("id"), "x").alias("u")).first().u == want


@pytest.mark.parametrize("mode", ["refit", "subsample"])
def test_sums_are_those_of_repeated_rows(weeks, mode):
    both = weeks[0].withColumn("side", F.lit(0)).unionByName(weeks[1].withColumn("side", F.lit(1))).repartition(5)
    weights = Weights(mode, 6, seed=3)
    terms = lambda x: np.column_stack([np.ones(len(x["demand"])), x["demand"], x["demand"] * x["received"]])
    got = replicate_sums(both, ["side"], weights, F.col("asin"), ["demand", "received"], terms, 3, ["received"],
                         F.pmod(F.hash("asin"), F.lit(4)), 4)
    assert set(got) == {(0,), (1,)}
    for side, rows in enumerate(weeks):
        pdf = rows.withColumn("b", F.pmod(F.hash("asin"), F.lit(4))).toPandas()
        w = by_hand(pdf, weights)
        x = np.column_stack([np.ones(len(pdf)), pdf.demand, pdf.demand * pdf.received])
        np.testing.assert_allclose(got[(side,)].sums, w @ x, rtol=1e-10)
        for r in range(6):
            assert got[(side,)].lows[r, 0] == pdf.received[w[r] > 0].min()
            assert got[(side,)].totals[r].tolist() == [int(w[r][pdf.b == b].sum()) for b in range(4)]


def test_cheap_weights_are_poisson_and_do_not_depend_on_batches():
    weights = Weights("refit", 50, method="xxhash64")
    keys = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 4000)
    w = weights.matrix(pa.array(keys))
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert np.abs(np.corrcoef(w) - np.eye(50)).max() < 0.1
    np.testing.assert_array_equal(w[:, 100:200], weights.matrix(pa.array(keys[100:200])))


def test_wrong_modes_are_refused():
    for wrong in ({"mode": "rerun"}, {"replicates": 0}, {"method": "sha1"}):
        with pytest.raises(ValueError):
            Weights(**{"mode": "refit", "replicates": 2, **wrong})


def test_grouped_sums_agree_with_weighted_copies(spark, monkeypatch):
    monkeypatch.setattr("tracecause.operators.resampling.HELD_GROUPS", 3)
    df = spark.createDataFrame([(i, i % 13 if i % 29 else None, float(i) if i % 7 else None) for i in range(900)], "id long, g int, x double")
    got = bootstrap_sums(df, F.col("id"), ["g"], ["x"], Weights("refit", 5, seed=2)).toPandas()
    copies = sampling.bootstrap_weights(df, F.col("id"), 5, 2)
    want = copies.groupBy("g", "replicate").agg(F.sum("weight").alias("n"), F.max("weight").alias("top"),
                                                F.sum(F.col("weight") * F.col("x")).alias("x")).toPandas()
    order = ["g", "replicate"]
    a, b = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    assert len(a) == 14 * 5 and (a[["n", "top"]] == b[["n", "top"]]).all().all()
    np.testing.assert_allclose(a.x, b.x)
    assert bootstrap_sums(df.limit(0), F.col("id"), ["g"], ["x"], Weights("refit", 5)).count() == 0


def test_every_position_of_a_replicate_is_the_row_its_weight_says(weeks):
    """Positions over all rows, resolved without copies, against the list of repeated rows."""
    rows = keyed_rows(weeks[0], F.col("asin"), NODES)
    models, _ = intervals.replicate_fits(weeks[0].repartition(7), SUPPLY, F.col("asin"), NODES, "refit", 4)
    pdf = rows.toPandas()
    pdf["h"] = [hashlib.md5(f"{k}:pool:0".encode()).hexdigest() for k in pdf["__k"]]
    pdf = pdf.sort_values(["h", "__k"]).reset_index(drop=True)
    for r in (0, 3):
        w = poisson_values(keyed_uniform_values(pdf["__k"], "boot", r, 0))
        want = pdf.loc[pdf.index.repeat(w), NODES].to_numpy()
        table = models[r].noise
        assert table.size == len(want)
        got = table.rows(np.arange(table.size))
        np.testing.assert_array_equal(np.column_stack([got[n] for n in NODES]), want)


def test_positions_of_plain_rows(weeks):
    """The same for all rows, by filters on buckets, and for the table that joins use."""
    table = noise_table(weeks[0], F.col("asin"), NODES, n=1000)
    pdf = weeks[0].toPandas()
    pdf["h"] = [hashlib.md5(f"{k}:pool:0".encode()).hexdigest() for k in pdf["asin"]]
    want = pdf.sort_values(["h", "asin"])[NODES].to_numpy()
    at = np.array([0, 3, 500, 998, 999])
    np.testing.assert_array_equal(np.column_stack(list(table.rows(at).values())), want[at])
    frame = table.frame.orderBy("pos").toPandas()
    assert frame.pos.tolist() == list(range(1000))
    np.testing.assert_array_equal(frame[NODES].to_numpy(), want)


def test_buckets_stay_bounded():
    assert bucket_count(10) == 1 and bucket_count(10 ** 12) == MOST_BUCKETS
    assert bucket_count(10 ** 12, 1000) * 1000 <= MOST_TOTALS


def test_draws_of_two_orders_come_in_one_job(weeks):
    tables = [noise_table(w, F.col("asin"), NODES, n=1000) for w in weeks]
    fetch([(t, [1, 2, 3]) for t in tables])
    assert all(set(t.fetched) == {1, 2, 3} for t in tables) and tables[0].fetched[1] != tables[1].fetched[1]


def test_a_thousand_replicates_of_any_query(weeks):
    """One plan for all: the closure is called once, and its numbers are those of each refitted model."""
    calls = []

    def query(model, frame):
        calls.append(1)
        c = model["received"].coef[0]
        return frame.select("replicate", F.lit("slope").alias("node"), c.alias("score"))

    out = intervals.model_intervals(weeks[0], SUPPLY, F.col("asin"), query, replicates=1000, method="xxhash64")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    row = out.first()
    assert len(calls) == 1 and row.resamples == 1000 and "Union" not in plan
    assert row.lo < 0.8 < row.hi and row.hi - row.lo < 0.3
    some = intervals.model_intervals(weeks[0], SUPPLY, F.col("asin"), query, replicates=3).first()
    models = intervals.replicate_models(weeks[0], SUPPLY, F.col("asin"), NODES, replicates=3, pool=False)
    assert some.median == pytest.approx(np.median([models[r]["received"].coef[0] for r in range(3)]))


def test_influence_and_arrow_intervals_hold_the_point_estimates(weeks, spark):
    from tracecause.operators import influence
    from tracecause.operators.mechanisms import fit

    model = fit(weeks[0], SUPPLY, F.col("asin"), pool=False)
    point = {r.node: r.score for r in influence.intrinsic(spark, model, "received").collect()}
    for r in intervals.influence_intervals(weeks[0], SUPPLY, "received", F.col("asin"), replicates=40).collect():
        assert r.lo <= point[r.node] <= r.hi and r.lo < r.median < r.hi
    arrow = influence.arrow_strength(model, weeks[0], "submitted").collect()
    out = {(r.parent, r.child): r for r in intervals.arrow_intervals(weeks[0], SUPPLY, "submitted", F.col("asin"), replicates=40).collect()}
    assert all(out[a.parent, a.child].lo <= a.strength <= out[a.parent, a.child].hi for a in arrow) and len(out) == 2


def test_change_test_and_difference_inside_intervals(weeks):
    """Changed mechanisms keep their share in every replicate; unchanged ones mostly score exactly zero."""
    args = (*weeks, SUPPLY, "received", F.col("asin"))
    out = intervals.change_intervals(*args, replicates=12, test_change=True).toPandas().set_index("node")
    assert out.loc["demand", "lo"] > 0 and out.loc["confirmed", "lo"] > 0 and out.loc["constraint", "median"] == 0.0
    drawn = intervals.change_replicates(*args, replicates=3, draws=400).toPandas()
    python = intervals.change_replicates(*args, replicates=3, draws=400, difference=lambda x, y: y.mean() - x.mean()).toPandas()
    a, b = (d.sort_values(["replicate", "node"]).score.to_numpy() for d in (drawn, python))
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)
    divergence = intervals.change_replicates(*args, replicates=2, draws=400, summary=change.kl).toPandas()
    models = intervals.replicate_models(change.stack_sides(*weeks, NODES, F.col("asin")), SUPPLY, F.col("__key"),
                                        SUPPLY.closure("received"), replicates=2, side="side")
    for r in range(2):
        want = change.change_scores(weeks[0].sparkSession, models[(0, r)], models[(1, r)], "received", change.kl, 400, r).toPandas()
        mine = divergence[divergence.replicate == r].set_index("node").score
        np.testing.assert_allclose(mine[want.node], want.score, rtol=1e-9, atol=1e-9)


def test_anomaly_intervals_of_products(weeks):
    """Replicates whose mechanisms have products share the map over the rows, too."""
    from tracecause.operators import anomaly

    rows = weeks[1].orderBy("asin").limit(4)
    kinds = {"submitted": "poly"}
    out = intervals.anomaly_intervals(weeks[0], rows, SUPPLY, "submitted", F.col("asin"), "asin", replicates=3, draws=100, kinds=kinds)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    models = intervals.replicate_models(weeks[0], SUPPLY, F.col("asin"), SUPPLY.closure("submitted"), replicates=3, kinds=kinds)
    each = [anomaly.attribute_anomalies(models[r], rows, "submitted", "asin", 100, r).toPandas().set_index(["asin", "node"]).score
            for r in range(3)]
    for r in out.collect():
        assert r.median == pytest.approx(np.median([e[r.asin, r.node] for e in each]), abs=1e-9)


def test_intervention_intervals_by_hand(weeks):
    """The noise of every row and replicate, resolved bucket by bucket, against one replicate drawn by itself."""
    from tracecause.operators.noise import replicate_draws

    models = intervals.replicate_models(weeks[0], SUPPLY, F.col("asin"), NODES, replicates=3)
    order = models[0].noise.order
    ids = weeks[0].select(F.col("asin").alias("__key"))
    got = replicate_draws(order, ids, [models[r].mechanisms for r in range(3)], ["submitted", "received"], 0).toPandas()
    assert len(got) == 3 * 1000
    keys = weeks[0].toPandas()["asin"].tolist()
    for r in range(3):
        mine = got[got.replicate == r].set_index("__key")
        for node in ("submitted", "received"):
            table = models[r].noise
            position = table.positions(keyed_uniform_values(keys, node, r, 0))
            want = models[r][node].drawn(table.rows(position))
            np.testing.assert_allclose(mine.loc[keys, node], want, rtol=1e-9, atol=1e-9)
    assert isinstance(models[1].noise, NoiseTable) and isinstance(order, RowOrder)


# --- draws without replacement ---


def test_permutations_are_bijections_that_mix(spark):
    from tracecause.functions.permutation import permuted_values, with_permuted

    for n in (1, 2, 3, 7, 16, 17, 1000, 4097):
        x = permuted_values(np.arange(n), n, "a", 2, 5)
        assert sorted(x.tolist()) == list(range(n))
        got = with_permuted(spark.range(n).withColumn("pos", F.col("id")), "pos", "to", n, "a", 2, 5).orderBy("id").toPandas()
        assert got.to.tolist() == x.tolist() and list(got.columns) == ["id", "pos", "to"]
    a, b = (permuted_values(np.arange(4097), 4097, k) for k in "ab")
    r = [np.corrcoef(np.arange(4097), a)[0, 1], np.corrcoef(a, b)[0, 1], np.corrcoef(a[1:], a[:-1])[0, 1]]
    assert np.abs(r).max() < 0.06
    big = permuted_values(np.array([0, 2 ** 52 - 1, 2 ** 40]), 2 ** 52, "a")
    assert ((big >= 0) & (big < 2 ** 52)).all()


def test_fresh_noise_without_replacement_is_every_noise_once(weeks):
    from tracecause.operators import simulation
    from tracecause.operators.mechanisms import fit
    from tracecause.operators.noise import permuted_draws

    model = fit(weeks[0], SUPPLY, F.col("asin"))
    at = {n: F.col(n) for n in model.noise.nodes}
    keyed = weeks[0].withColumn("__key", F.col("asin"))
    got = permuted_draws(model.noise, keyed, {"a": model["received"].drawn(at), "b": model["submitted"].drawn(at)}).toPandas()
    own = model.residuals(weeks[0], ["received", "submitted"]).toPandas()
    assert len(got) == 1000 and set(got.columns) == {*keyed.columns, "a", "b"}
    np.testing.assert_allclose(np.sort(got.a), np.sort(own.received), atol=1e-9)
    np.testing.assert_allclose(np.sort(got.b), np.sort(own.submitted), atol=1e-9)
    noise = weeks[0].select("asin", *NODES).toPandas().merge(got[["asin", "a"]], on="asin")
    assert abs(np.corrcoef(noise.demand, noise.a)[0, 1]) < 0.12
    # Fewer and more rows than the model has.
    few = weeks[0].orderBy("asin").limit(37).withColumn("__key", F.col("asin"))
    assert permuted_draws(model.noise, few, {"a": F.col("received")}).where("a IS NOT NULL").count() == 37
    more = weeks[0].crossJoin(few.select(F.col("asin").alias("again")).limit(3)).withColumn("__key", F.concat("asin", "again"))
    counts = permuted_draws(model.noise, more, {"a": F.col("received")}).groupBy("a").count().toPandas()
    assert (counts["count"] == 3).all() and len(counts) == 1000
    assert permuted_draws(model.noise, few.limit(0), {"a": F.col("received")}).count() == 0
    shift = {"submitted": lambda x: x + 1}
    moved = {r: simulation.intervene(model, weeks[0], F.col("asin"), shift, replace=r).agg(F.avg("received")).first()[0] for r in (True, False)}
    assert moved[False] == pytest.approx(weeks[0].agg(F.avg("received")).first()[0] + model["confirmed"].coef[0] * model["received"].coef[0], abs=0.05)
    assert moved[True] == pytest.approx(moved[False], abs=0.1)


def test_interventions_take_one_exchange(weeks):
    from tracecause.operators import simulation
    from tracecause.operators.mechanisms import fit
    from tracecause.sources.workspace import cut_lineage

    rows = cut_lineage(weeks[0])
    model = fit(rows, SUPPLY, F.col("asin"))
    out = simulation.intervene(model, rows, F.col("asin"), {"demand": lambda x: x + 1})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
