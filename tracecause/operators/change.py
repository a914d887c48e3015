"""Attribute the change of a target between two periods to changed mechanisms.

Mechanisms are fitted on both periods in one pass. A coalition says which nodes run on the new
mechanism; its value is the difference between the target under that mix and under the old mechanisms.
The data is read by the fits only: coalitions work on fitted numbers and a set number of draws.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracecause.functions.statistics import f_tail_value, kolmogorov_tail_value, normal_bin, normal_edges
from tracecause.operators.frames import complete
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import (CausalModel, collect_moments, default_kinds, design_terms, draw_values,
                                             fit_trees, halfnorm_params, noise_table, prefetch, solve, solve_standard,
                                             squared_error)
from tracecause.operators.shapley import CoalitionPlan, coalition_plan
from tracecause.sources.workspace import cut_lineage

Summary = Callable[[Column], Column]


def mean(x: Column) -> Column:
    return F.avg(x)


def variance(x: Column) -> Column:
    return F.var_samp(x)


def quantile(q: float) -> Summary:
    return lambda x: F.percentile(x, F.lit(q))


def custom(function) -> Summary:
    """A summary written in Python over an array of target draws, run as a grouped pandas aggregate.

    A group is the draws of one coalition, whose number is a parameter.
    """
    def call(values) -> float:
        return float(function(values.to_numpy()))

    call.__annotations__ = {"values": pd.Series, "return": float}
    return F.pandas_udf(call, "double")


def compared(function, before: Mapping[int, np.ndarray]) -> Summary:
    """A summary that compares draws with those of the same replicate in ``before``; needs a column ``replicate``."""
    def call(values, replicate) -> float:
        return float(function(before[int(replicate.iloc[0])], values.to_numpy()))

    call.__annotations__ = {"values": pd.Series, "replicate": pd.Series, "return": float}
    return lambda x: F.pandas_udf(call, "double")(x, F.col("replicate"))


KL_BINS = 16


def kl_value(before: np.ndarray, after: np.ndarray) -> float:
    """What ``kl_values`` computes, of two arrays."""
    mean_old, sd_old = float(before.mean()), float(before.std(ddof=1))
    edges = [mean_old + sd_old * e for e in normal_edges(KL_BINS)] if sd_old > 0 else [np.inf] * (KL_BINS - 1)
    old, new = (np.bincount(np.searchsorted(edges, x, side="right"), minlength=KL_BINS) + 0.5 for x in (before, after))
    new = new / new.sum()
    return float((new * np.log(new / (old / old.sum()))).sum())


def kl(x: Column) -> Column:
    """Marks the Kullback-Leibler divergence of a mix from the all-old target; see ``kl_values``."""
    raise TypeError("kl compares two samples and is handled by coalition_values")


def kl_values(mixed: DataFrame, target: str, old_draws: np.ndarray) -> DataFrame:
    """Divergence per coalition from the all-old draws on shared normal-score bins, half a count per bin added."""
    mean_old, sd_old, draws = float(old_draws.mean()), float(old_draws.std(ddof=1)), len(old_draws)
    edges = [mean_old + sd_old * e for e in normal_edges(KL_BINS)] if sd_old > 0 else [np.inf] * (KL_BINS - 1)
    before = np.bincount(np.searchsorted(edges, old_draws, side="right"), minlength=KL_BINS)
    binned = mixed.select("slot", "coalition", normal_bin(target, mean_old, sd_old, KL_BINS).alias("bin"))
    counts = binned.groupBy("slot", "coalition").agg(
        *[F.expr(f"count(*) FILTER (WHERE bin = {b}) AS b{b}") for b in range(KL_BINS)])
    total = draws + 0.5 * KL_BINS
    terms = [f"(b{b} + 0.5D) / {total!r}D * ln((b{b} + 0.5D) / {float(before[b]) + 0.5!r}D)" for b in range(KL_BINS)]
    return counts.select("slot", "coalition", F.expr(" + ".join(terms)).alias("value"))


def stack_sides(old: DataFrame, new, nodes, key: Column | None = None) -> DataFrame:
    """``(side, __key, node...)`` with side 0 for old and 1 for new rows.

    ``new`` is a table, or a predicate on ``old`` where both periods are in one: then it is read once.
    """
    cols = [key.cast("string").alias("__key")] if key is not None else []
    cols += [F.col(n).cast("double").alias(n) for n in nodes]
    if isinstance(new, Column):
        return old.select(F.when(new, 1).when(~new, 0).alias("side"), *cols).filter(F.col("side").isNotNull())
    return old.select(F.lit(0).alias("side"), *cols).unionByName(new.select(F.lit(1).alias("side"), *cols))


def fit_periods(old: DataFrame, new: DataFrame | Column, graph: CausalGraph, target: str,
                kinds: Mapping[str, str] | None = None, key: Column | None = None, pool: bool = False, seed: int = 0,
                test_change: bool | str = False, level: float = 0.05) -> tuple[CausalModel, CausalModel]:
    """Old and new model of the target and its ancestors; both periods share every pass over the data.

    With ``test_change`` a mechanism that differs significantly neither in its parameters nor in the spread of its
    noise is taken from the old model on both sides, so it scores exactly zero. ``test_change="shape"`` also compares the
    whole distribution of its noise.
    """
    nodes = list(graph.closure(target))
    kinds = {n: k for n, k in default_kinds(graph, kinds).items() if n in nodes}
    both = stack_sides(old, new, nodes, key)
    rows = both.filter(complete(nodes))
    designs = [(n, design_terms(kinds[n], graph.parents(n))) for n in nodes]
    groups, _, _ = collect_moments(both, nodes, designs, ["side"])
    models = []
    for side in (0, 1):
        if (side,) not in groups:
            raise ValueError("a period has no complete rows")
        part = rows.filter(F.col("side") == side)
        m = groups[(side,)]
        mechanisms = {n: fit_trees(part, n, graph.parents(n), seed=seed) if kinds[n] == "gbt"
                      else solve(m, n, kinds[n], graph.parents(n)) for n in nodes}
        for n, params in halfnorm_params(part, [n for n in nodes if kinds[n] == "halfnorm"]).items():
            mechanisms[n] = replace(mechanisms[n], params={**mechanisms[n].params, **params})
        table = noise_table(part, F.col("__key"), nodes, seed, int(m.n)) if pool else None
        models.append(CausalModel(graph, mechanisms, int(m.n)).with_table(table))
    if test_change:
        p = change_p_values(groups[(0,)], groups[(1,)], graph, kinds)
        if test_change == "shape":
            # The two tests of change_p_values count twice already; with a third one the smallest counts three times.
            noisy = [n for n in nodes if not (models[0][n].is_exact and not models[0][n].is_root) and kinds[n] != "gbt"]
            for n, (d, old_n, new_n) in shape_distances(rows, tuple(models), noisy).items():
                p[n] = min(1.0, 1.5 * p[n], 3.0 * kolmogorov_tail_value(d, old_n, new_n))
        kept = {n: models[0][n] for n in nodes if p[n] > level}
        models[1] = replace(models[1], mechanisms={**models[1].mechanisms, **kept})
    return models[0], models[1]


def shape_distances(rows: DataFrame, models: tuple[CausalModel, CausalModel], nodes) -> dict[str, tuple[float, int, int]]:
    """``{node: (distance, n_old, n_new)}``: largest distance between the distributions of a node's noise in both periods.

    ``rows`` are complete and have a column ``side``; the noise of a side is that of its own mechanism, of a root its value.
    Equal values fold to one row per node and side, distinct values are dealt by range, and per-partition counts say how
    many rows of each side stand before a range; so no task sees more than its range, and ties are counted at once.
    """
    cells = []
    for n in nodes:
        at = {m: F.col(m) for m in models[0].graph.order if m in rows.columns}
        noise = [m[n].drawn(at) for m in models]
        cells.append(F.struct(F.lit(n).alias("node"), F.when(F.col("side") == 0, noise[0]).otherwise(noise[1]).alias("v"), "side"))
    folded = rows.select(F.inline(F.array(*cells))).groupBy("node", "v").agg(
        F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    placed = cut_lineage(folded.repartitionByRange("node", "v").withColumn("part", F.spark_partition_id()))
    parts = placed.groupBy("node", "part").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    before, all_of = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("node")
    parts = parts.select("node", "part", *[e for s in "ab" for e in (
        F.coalesce(F.sum(f"p{s}").over(before), F.lit(0)).alias(f"before_{s}"), F.sum(f"p{s}").over(all_of).alias(f"all_{s}"))])
    upto = Window.partitionBy("node", "part").orderBy("v")
    running = placed.select("*", F.sum("a").over(upto).alias("ra"), F.sum("b").over(upto).alias("rb")).join(parts, ["node", "part"])
    share = [(F.col(f"before_{s}") + F.col(f"r{s}")) / F.col(f"all_{s}") for s in "ab"]
    found = running.groupBy("node").agg(F.max(F.abs(share[0] - share[1])).alias("d"), F.first("all_a").alias("n"), F.first("all_b").alias("m"))
    return {r.node: (r.d, r.n, r.m) for r in found.collect()}


def change_p_values(old, new, graph: CausalGraph, kinds: Mapping[str, str]) -> dict[str, float]:
    """Has a node's mechanism changed? Twice the smaller p-value of two tests on the sums of both periods.

    Chow test: do two fits beat one? Variance ratio: is the spread of the noise (of a root: of its values) another?
    """
    out = {}
    both = old + new
    for n, kind in kinds.items():
        if kind == "gbt":
            raise ValueError("the change test compares coefficients; trees have none")
        terms = design_terms(kind, graph.parents(n))
        rss = [squared_error(m, n, terms, solve_standard(m, n, terms)) * m.n for m in (old, new, both)]
        d1, d2 = len(terms) + 1, both.n - 2 * (len(terms) + 1)
        floor = 1e-9 * max(both.product((n,), (n,)) * both.scale.sd[n] ** 2, 1e-300)
        gain, left = max(rss[2] - rss[0] - rss[1], 0.0), rss[0] + rss[1]
        free = [max(m.n - d1, 1.0) for m in (old, new)]
        if left <= floor:
            out[n] = 1.0 if gain <= floor else 0.0
        else:
            chow = f_tail_value(gain / d1 / (left / max(d2, 1.0)), d1, max(d2, 1.0))
            if min(rss[0], rss[1]) <= floor:
                out[n] = 0.0  # noise on one side only
            else:
                ratio = (rss[1] / free[1]) / (rss[0] / free[0])
                spread = 2.0 * min(f_tail_value(ratio, free[1], free[0]), f_tail_value(1.0 / ratio, free[0], free[1]))
                out[n] = min(1.0, 2.0 * min(chow, spread))
    return out


def mixed_values(df: DataFrame, plan: CoalitionPlan, old: CausalModel, new: CausalModel,
                 noise: Callable[[str, int], Column]) -> DataFrame:
    """Evaluate every node from its parents, on the new mechanism where the coalition has the node."""
    for n in plan.players:
        values = {p: F.col(p) for p in plan.players}
        df = df.withColumn(n, F.when(plan.has(n), new[n].predict_column(values) + noise(n, 1))
                           .otherwise(old[n].predict_column(values) + noise(n, 0)))
    return df


def drawn_noise(spark: SparkSession, pairs: Mapping, nodes, draws: int, seed: int) -> DataFrame:
    """``(replicate, draw, node__side...)`` for ``{replicate: (old, new)}``: as many rows as draws were asked for.

    Both sides use the same uniforms. The rows behind the draws come in one job.
    """
    prefetch([(m, nodes, draws, r, seed) for r, pair in pairs.items() for m in pair])
    parts = [pd.DataFrame({"replicate": r, "draw": np.arange(draws), **{
        f"{n}__{side}": np.broadcast_to(m[n].noise_values(draws, r, seed), (draws,)) for side, m in enumerate(pair) for n in nodes}})
        for r, pair in pairs.items()]
    return spark.createDataFrame(pd.concat(parts, ignore_index=True))


def coalition_values(spark: SparkSession, plan: CoalitionPlan, old: CausalModel, new: CausalModel, target: str,
                     summary: Summary, draws: int, replicate=0, seed: int = 0, pairs: Mapping | None = None) -> DataFrame:
    """``(slot, coalition, value)``: the summary of the target under each mix of mechanisms.

    With ``pairs``, models by replicate whose numbers ``old`` and ``new`` look up by a column ``replicate``, all of them
    are drawn in one plan and that column leads the result.
    """
    if draws == 0:
        base = plan.explode(spark.range(1).select(F.lit(0.0).alias("__zero")))
        means = {0: old, 1: new}
        mixed = mixed_values(base, plan, old, new, lambda n, side: F.lit(means[side][n].noise_mean))
        return mixed.select("slot", "coalition", F.col(target).alias("value"))
    if pairs is not None and summary is kl:
        raise ValueError("kl is placed by one old model; stack its replicates with confidence_intervals")
    by = [] if pairs is None else ["replicate"]
    base = drawn_noise(spark, {replicate: (old, new)} if pairs is None else pairs, plan.players, draws, seed)
    mixed = mixed_values(plan.explode(base), plan, old, new, lambda n, side: F.col(f"{n}__{side}"))
    if summary is kl:
        y = draw_values(old, plan.players, draws, replicate, seed)[1][target]
        return kl_values(mixed, target, y)
    return mixed.groupBy(*by, "slot", "coalition").agg(summary(F.col(target)).alias("value"))


def change_scores(spark: SparkSession, old: CausalModel, new: CausalModel, target: str, summary: Summary = mean,
                  draws: int | None = None, replicate=0, seed: int = 0, orderings: int | None = None,
                  errors: bool = False) -> DataFrame:
    """Shapley shares of the change from two fitted models; with ``errors`` the standard error of sampled orderings beside them.

    Means of linear mechanisms are propagated exactly (``draws=0``, the default for them). Anything else
    is drawn; old and new noise use the same uniforms, so an unchanged mechanism scores zero.
    """
    nodes = old.graph.closure(target)
    linear = summary is mean and old.is_linear(nodes) and new.is_linear(nodes)
    draws = (0 if linear else 2000) if draws is None else draws
    if draws == 0 and not linear:
        raise ValueError("only means of linear mechanisms have a closed form")
    plan = coalition_plan(nodes, orderings, seed)
    values = coalition_values(spark, plan, old, new, target, summary, draws, replicate, seed)
    return plan.shares_with_errors(values, F.col("value")) if errors else plan.shares(values, F.col("value"))


def distribution_change(old: DataFrame, new: DataFrame | Column, graph: CausalGraph, target: str, summary: Summary = mean,
                        draws: int | None = None, kinds: Mapping[str, str] | None = None, key: Column | None = None,
                        seed: int = 0, test_change: bool | str = False, level: float = 0.05,
                        difference=None, orderings: int | None = None, errors: bool = False) -> DataFrame:
    """Long ``(node, score)``: how much of the target's change, new minus old, each mechanism explains.

    ``new`` is a table, or a predicate that marks the new rows of ``old`` where one table holds both periods.
    ``summary`` is one of this module's or any function from a Column to an aggregate Column; ``difference``
    is a Python function of two samples, old and new, for measures with no Column form.
    """
    nodes = graph.closure(target)
    kinds = default_kinds(graph, kinds)
    closed = (summary is mean and difference is None and draws in (None, 0)
              and all(kinds[n] not in ("poly", "gbt") for n in nodes))
    if not closed and key is None:
        raise ValueError("drawing noise needs a row key")
    models = fit_periods(old, new, graph, target, kinds, key, not closed, seed, test_change, level)
    if difference is not None:
        draws = draws or 2000
        before = draw_values(models[0], nodes, draws, 0, seed)[1][target]
        summary = custom(lambda after: difference(before, after))
    return change_scores(old.sparkSession, *models, target, summary, draws, 0, seed, orderings, errors)
