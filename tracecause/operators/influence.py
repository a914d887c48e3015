"""What drives the variance of a target: direct arrows and intrinsic contributions of nodes."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.functions.randomness import uniform
from tracecause.functions.statistics import normal_bin
from tracecause.operators.evaluation import KL_BINS, kl_of_counts
from tracecause.operators.frames import complete
from tracecause.operators.mechanisms import (CausalModel, Mechanism, evaluate_nodes, first_rows, interval, noise_table,
                                             prefetch, splits)
from tracecause.operators.shapley import coalition_plan


def arrow_strength(model: CausalModel, df: DataFrame, target: str, measure: str = "variance",
                   key: Column | None = None, seed: int = 0, draws: int = 100) -> DataFrame:
    """``(parent, child, strength)``: how much the target changes when one arrow is cut.

    Cutting an arrow feeds the target an independent draw from the parent's marginal. ``variance`` is the
    mean rise of the target's variance given its parents. A linear or product mechanism is at most quadratic
    in a parent, so the rise follows from five moments per parent, all from one pass; trees are drawn ``draws`` times. ``kl`` is
    the divergence between the observed target and the target with the arrow cut.
    """
    df = df.filter(complete([target, *model[target].parents]))
    if measure == "variance":
        return _variance_strength(model, df, target, key, seed, draws)
    if measure == "kl":
        if key is None:
            raise ValueError("measure 'kl' draws by row key")
        return _kl_strength(model, df, target, key, seed)
    raise ValueError(f"unknown measure {measure!r}")


def _variance_strength(model: CausalModel, df: DataFrame, target: str, key: Column | None, seed: int,
                       draws: int) -> DataFrame:
    m = model[target]
    if m.kind == "gbt":
        return _drawn_strength(m, df, target, key, seed, draws)
    aggs, square = [], {}
    for j, parent in enumerate(m.parents):
        slope = F.lit(0.0)
        square[parent] = 0.0
        for term, c in zip(m.terms, m.coef):
            times = term.count(parent)
            if times == 2:
                square[parent] += c
            elif times == 1:
                other = F.lit(float(c))
                for name in term:
                    if name != parent:
                        other = other * F.col(name).cast("double")
                slope = slope + other
        p = F.col(parent).cast("double")
        aggs += [F.avg(slope).alias(f"b{j}"), F.avg(slope * slope).alias(f"bb{j}"), F.var_samp(p).alias(f"v{j}"),
                 F.covar_samp(p, p * p).alias(f"c{j}"), F.var_samp(p * p).alias(f"q{j}")]
    if not m.parents:
        return df.sparkSession.createDataFrame([], "parent string, child string, strength double")
    wide = df.agg(*aggs)
    rows = []
    for j, parent in enumerate(m.parents):
        c = F.lit(float(square[parent]))
        strength = (F.col(f"bb{j}") * F.col(f"v{j}") + 2.0 * F.col(f"b{j}") * c * F.col(f"c{j}")
                    + c * c * F.col(f"q{j}"))
        rows.append(F.struct(F.lit(parent).alias("parent"), F.lit(target).alias("child"), strength.alias("strength")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _drawn_strength(m: Mechanism, df: DataFrame, target: str, key: Column | None, seed: int,
                    draws: int) -> DataFrame:
    """Variance over draws of one parent, averaged over the rows: for mechanisms without a closed form.

    All rows meet the same draws, so rows and draws swap places: ``mean_row Var_draw(f)`` follows from sums that an Arrow
    batch computes at once, and two numbers per batch and parent leave the task. Rows on the same side of every split
    have the same values, so they fold into one cell with their number first.
    """
    if key is None:
        raise ValueError("trees need draws, and draws a row key")
    parents = list(m.parents)
    pool = first_rows(df, key, parents, draws, seed)
    trees = [(json.loads(t), c) for (t,), c in zip(m.terms, m.coef)]
    bounds = {p: sorted({t for tree, _ in trees for name, t in splits(tree) if name == p}) for p in parents}

    def batch_sums(batches):  # self-contained: workers need not import this package
        def value(tree, columns):
            if not isinstance(tree, list):
                return tree
            name, threshold, low, high = tree
            return np.where(columns[name] <= threshold, value(low, columns), value(high, columns))

        for batch in batches:
            seen = {p: np.array(bounds[p] + [np.inf])[batch[p].to_numpy().astype(int) - 1][:, None] for p in parents}
            rows = batch["n"].to_numpy()
            for i, parent in enumerate(parents):
                columns = {**seen, parent: pool[None, :, i]}
                out = sum(np.broadcast_to(value(t, columns) * c, (len(batch), len(pool))) for t, c in trees)
                yield pd.DataFrame({"parent": [parent], "total": [float((out.var(axis=1) * rows).sum())], "n": [int(rows.sum())]})

    cells = df.select(*[interval(p, bounds[p]).alias(p) for p in parents]).groupBy(*parents).agg(F.count(F.lit(1)).alias("n"))
    sums = cells.mapInPandas(batch_sums, "parent string, total double, n bigint")
    return sums.groupBy("parent").agg((F.sum("total") / F.sum("n")).alias("strength")).select(
        "parent", F.lit(target).alias("child"), "strength")


def _kl_strength(model: CausalModel, df: DataFrame, target: str, key: Column, seed: int) -> DataFrame:
    m = model[target]
    mean, sd = m.params["mean"], m.params["total_var"] ** 0.5
    seen = {p: F.col(p).cast("double") for p in m.parents}
    marginal = noise_table(df, key, m.parents, seed)
    df = df.select(key.cast("string").alias("__key"), *[F.col(c) for c in dict.fromkeys([target, *m.parents])])
    for p in m.parents:
        df = marginal.join(df, uniform(F.col("__key"), f"{p}->{target}", 0, seed), F.col(p), f"{p}__draw")
    swing = [m.predict_column({**seen, p: F.col(f"{p}__draw")}) - m.predict_column(seen) for p in m.parents]
    y = F.col(target).cast("double")
    cut = df.select(y.alias("__y"), *[(y + s).alias(f"__cut{i}") for i, s in enumerate(swing)])
    cells = [F.struct(F.lit(p).alias("parent"), F.lit(target).alias("child"), F.lit(side).alias("side"),
                      normal_bin(c, mean, sd, KL_BINS).alias("bin"))
             for i, p in enumerate(m.parents) for side, c in (("a", "__y"), ("b", f"__cut{i}"))]
    counts = (cut.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
              .groupBy("parent", "child", "side", "bin").agg(F.count(F.lit(1)).alias("n")))
    return kl_of_counts(counts, ["parent", "child"], KL_BINS, "strength")


def intrinsic(spark: SparkSession, model: CausalModel, target: str, draws: int = 500, seed: int = 0,
              linear: bool | None = None) -> DataFrame:
    """``(node, score)``: the share of the target's variance that each node adds itself.

    ``v(S) = Var(E[Y | noise of S])``. Linear models have the closed form effect^2 * Var(noise). Otherwise noise is drawn in
    ``draws`` pairs and frozen by coalition: ``v(S)`` is the covariance of Y with the target whose noise outside S comes from the
    other of the pair, one evaluation per pair and coalition. The linear part of Y, whose v(S) is known, goes through
    the same pairs as a control, so what is estimated is only the part of v(S) that no straight line gives.
    """
    nodes = model.graph.closure(target)
    if linear is None:
        linear = model.is_linear(nodes)
    if linear:
        _, effect = model.total_effects(target)
        return spark.createDataFrame([(n, float(effect[n] ** 2 * model[n].noise_var)) for n in nodes],
                                     "node string, score double")
    if draws < 2:
        raise ValueError("at least two pairs of draws")
    plan = coalition_plan(nodes, seed=seed)
    prefetch([(model, nodes, draws, label, seed) for label in ("outer", "inner")])
    fixed, varied = ({n: np.broadcast_to(model[n].noise_values(draws, label, seed), (draws,)) for n in nodes} for label in ("outer", "inner"))
    y = np.broadcast_to(evaluate_nodes(nodes, model.mechanisms, fixed)[target], (draws,))
    # The best straight line of the target in the noises, over the pairs' first halves.
    noisy = [n for n in nodes if np.ptp(fixed[n]) > 0]
    slope = dict.fromkeys(nodes, 0.0)
    if noisy:
        x = np.column_stack([(fixed[n] - fixed[n].mean()) / fixed[n].std() for n in noisy])
        found, *_ = np.linalg.lstsq(x, y - y.mean(), rcond=1e-9)
        slope |= {n: float(b / fixed[n].std()) for n, b in zip(noisy, found)}
    centre = float(y.mean())
    line = sum(slope[n] * (fixed[n] - fixed[n].mean()) for n in nodes)
    pairs = {"__y": y - centre, "__line": np.broadcast_to(line, (draws,))}
    for n in nodes:
        pairs |= {f"{n}__fix": fixed[n], f"{n}__var": varied[n], f"{n}__lf": slope[n] * (fixed[n] - fixed[n].mean()),
                  f"{n}__lv": slope[n] * (varied[n] - fixed[n].mean())}
    grid = plan.explode(spark.createDataFrame(pd.DataFrame(pairs)))
    along = F.lit(0.0)
    for n in nodes:
        values = {p: F.col(p) for p in nodes}
        grid = grid.withColumn(n, model[n].predict_column(values) + F.when(plan.has(n), F.col(f"{n}__fix")).otherwise(F.col(f"{n}__var")))
        along = along + F.when(plan.has(n), F.col(f"{n}__lf")).otherwise(F.col(f"{n}__lv"))
    grid = grid.select("slot", "coalition", "__y", "__line", (F.col(target) - centre).alias("__other"), along.alias("__along"))

    def frozen(a, b):
        """Covariance of a pair of equal laws: both means are of one number."""
        return F.avg(F.col(a) * F.col(b)) - F.pow((F.avg(a) + F.avg(b)) / 2.0, 2)

    values = grid.groupBy("slot", "coalition").agg((frozen("__y", "__other") - frozen("__line", "__along")).alias("rest"))
    known = F.lit(0.0)
    for n in nodes:
        known = known + F.when(plan.has(n), F.lit(float(slope[n] ** 2 * model[n].noise_var))).otherwise(0.0)
    return plan.shares(values.withColumn("v", F.col("rest") + known), F.col("v"))
