"""Confidence intervals: one ``replicate`` column instead of a loop over fits.

Resampling is a weight per row and replicate that depends on the row key. All replicates are fitted from one matrix product
per task (:mod:`tracecause.operators.resampling`); their coefficients then sit in array literals indexed by the replicate,
so a query itself is planned once. Rows are never copied: what a replicate draws is resolved by weights made again where
the rows are.

Modes: ``refit`` and ``resample`` draw rows with replacement (Poisson weights) and fit again, ``subsample``
keeps a share of the rows, ``rerun`` keeps the model and draws new noise. Widths differ between modes, so
each result names its mode.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.functions.randomness import double_array
from tracecause.operators.anomaly import REFERENCE_DRAWS, case_intervals, case_of, general_function, share_function
from tracecause.operators.change import (Summary, change_p_values, coalition_values, compared, fit_periods, kl, kl_value, mean,
                                         mixed_values, stack_sides)
from tracecause.operators.frames import complete
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import (CausalModel, Mechanism, Moments, Scale, Term, default_kinds, design_terms, draw_values,
                                             needed_products, prefetch, profile, solve)
from tracecause.operators.noise import NoiseTable, RowOrder, bucket_count, bucket_of, replicate_draws, row_hash
from tracecause.operators.resampling import Weights, replicate_sums
from tracecause.operators.shapley import coalition_plan
from tracecause.operators.simulation import moved_nodes, with_moves
from tracecause.sources.workspace import ship

RESAMPLES = 20


def interval_table(scores: DataFrame, by, mode: str, level: float = 0.95, score: str = "score") -> DataFrame:
    """``(by..., median, lo, hi, mode, resamples)``; a group holds one number per replicate."""
    tail = (1.0 - level) / 2.0
    cut = F.percentile(F.col(score), F.array(F.lit(tail), F.lit(0.5), F.lit(1.0 - tail)))
    out = scores.groupBy(*by).agg(cut.alias("q"), F.count(F.lit(1)).cast("int").alias("resamples"))
    return out.select(*by, F.col("q")[1].alias("median"), F.col("q")[0].alias("lo"), F.col("q")[2].alias("hi"),
                      F.lit(mode).alias("mode"), "resamples")


def confidence_intervals(query: Callable[[int], DataFrame], replicates: int = RESAMPLES, by=("node",),
                         level: float = 0.95, mode: str = "rerun", score: str = "score") -> DataFrame:
    """Intervals over any query that takes the replicate number; its results are stacked into one plan."""
    parts = [query(r) for r in range(replicates)]
    return interval_table(reduce(DataFrame.unionByName, parts), list(by), mode, level, score)


def product_terms(products: list[Term], scale: Scale) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    """Columns as they are to products of standardised columns, rows x products."""
    names = sorted({n for p in products for n in p})

    def terms(x: dict[str, np.ndarray]) -> np.ndarray:
        z = {n: (x[n] - scale.mean[n]) / scale.sd[n] for n in names}
        out = np.ones((len(next(iter(x.values()))), len(products)))
        for j, p in enumerate(products):
            for n in p:
                out[:, j] *= z[n]
        return out

    return terms


def replicate_fits(df: DataFrame, graph: CausalGraph, key: Column, nodes, mode: str = "refit", replicates: int = RESAMPLES,
                   frac: float = 0.6, kinds: Mapping[str, str] | None = None, side: str | None = None, pool: bool = True,
                   seed: int = 0, method: str = "md5") -> tuple[dict, dict[tuple, Moments]]:
    """Models as :func:`replicate_models` returns them, and the sums behind them."""
    nodes = list(nodes)
    kinds = {n: k for n, k in default_kinds(graph, kinds).items() if n in nodes}
    if "gbt" in kinds.values():
        raise ValueError("trees are not fitted from sums; use confidence_intervals over a query that fits them")
    weights = Weights(mode, replicates, frac, seed, method)
    by = [side] if side else []
    rows = df.filter(complete(nodes)).select(*by, key.cast("string").alias("__k"),
                                             *[F.col(n).cast("double").alias(n) for n in nodes])
    scale, n_ok, _ = profile(rows, nodes)
    products = needed_products([(n, design_terms(kinds[n], graph.parents(n))) for n in nodes])
    half = [n for n in nodes if kinds[n] == "halfnorm"]
    buckets = bucket_count(n_ok, replicates) if pool else 0
    bucket = bucket_of(row_hash(F.col("__k"), seed), buckets) if pool else None
    sums = replicate_sums(rows, by, weights, F.col("__k"), nodes, product_terms(products, scale), len(products), half, bucket, buckets)
    models, moments = {}, {}
    for group, part in sums.items():
        mine = rows.filter(F.col(side) == group[0]).drop(side) if side else rows
        order = RowOrder(mine, nodes, seed, n_ok, weights, part.totals) if pool else None
        for r in range(replicates):
            m = Moments(scale, dict(zip(products, part.sums[r].tolist())))
            if m.n < 2:
                raise ValueError("too few rows to resample")
            found = {n: solve(m, n, kinds[n], graph.parents(n)) for n in nodes}
            for j, n in enumerate(half):
                low = float(part.lows[r, j])
                size = float(np.sqrt(max(found[n].noise_var * (m.n - 1) / m.n, 0.0) + (found[n].noise_mean - low) ** 2))
                found[n] = replace(found[n], params={**found[n].params, "loc": low, "scale": size,
                                                     "noise_mean": low + size * float(np.sqrt(2 / np.pi)),
                                                     "noise_var": size ** 2 * (1 - 2 / np.pi)})
            table = NoiseTable(order, r) if pool else None
            name = (*group, r) if side else r
            models[name] = CausalModel(graph, found, int(m.n)).with_table(table)
            moments[(*group, r)] = m
    return models, moments


def replicate_models(df: DataFrame, graph: CausalGraph, key: Column, nodes, mode: str = "refit",
                     replicates: int = RESAMPLES, frac: float = 0.6, kinds: Mapping[str, str] | None = None,
                     side: str | None = None, pool: bool = True, seed: int = 0, method: str = "md5") -> dict:
    """``{replicate: model}``, or ``{(side, replicate): model}``, from one weighted pass over the rows.

    A row costs one hash per replicate, or one in all with ``method="xxhash64"``.

    Half-normal roots are given by their first two weighted moments and the observed minimum.
    """
    return replicate_fits(df, graph, key, nodes, mode, replicates, frac, kinds, side, pool, seed, method)[0]


LOOKED_UP = ("noise_mean", "noise_var", "total_var", "mean", "loc", "scale")


def indexed_model(models: Sequence[CausalModel], nodes, index: Column) -> CausalModel:
    """One model whose numbers are looked up by ``index``: many fits in a single plan."""
    def lookup(values) -> Column:
        return F.element_at(double_array(values), (index + 1).cast("int"))

    out = {}
    for n in nodes:
        each = [m[n] for m in models]
        params = {name: lookup([m.params[name] for m in each]) for name in LOOKED_UP if all(name in m.params for m in each)}
        params["exact"] = float(all(m.is_exact for m in each))
        out[n] = Mechanism(n, each[0].kind, each[0].parents, each[0].terms,
                           tuple(lookup([m.coef[i] for m in each]) for i in range(len(each[0].coef))),
                           lookup([m.intercept for m in each]), each[0].noise, params)
    return CausalModel(models[0].graph, out)


def model_intervals(df: DataFrame, graph: CausalGraph, key: Column, query: Callable[[CausalModel, DataFrame], DataFrame],
                    mode: str = "refit", replicates: int = RESAMPLES, by=("node",), level: float = 0.95, frac: float = 0.6,
                    kinds: Mapping[str, str] | None = None, nodes=None, score: str = "score", seed: int = 0,
                    method: str = "md5") -> DataFrame:
    """Intervals of any query of a fitted model, the model being fitted anew for every replicate.

    ``query(model, frame)`` gets one model for all replicates: its numbers (coefficients, intercepts, moments of noise and of
    nodes) are Columns looked up by the column ``replicate`` of ``frame``, which has a row per replicate. It returns
    ``(replicate, by..., score)``, and is planned once however many replicates there are.
    """
    nodes = list(nodes or graph.order)
    models = replicate_models(df, graph, key, nodes, mode, replicates, frac, kinds, None, False, seed, method)
    model = indexed_model([models[r] for r in range(replicates)], nodes, F.col("replicate"))
    frame = df.sparkSession.range(replicates).select(F.col("id").cast("int").alias("replicate"))
    return interval_table(query(model, frame), list(by), mode, level, score)


def influence_intervals(df: DataFrame, graph: CausalGraph, target: str, key: Column, **options) -> DataFrame:
    """Intervals of intrinsic influence on a target whose ancestors are linear."""
    nodes = graph.closure(target)

    def query(model: CausalModel, frame: DataFrame) -> DataFrame:
        _, effect = model.total_effects(target)
        scores = [F.struct(F.lit(n).alias("node"), (effect[n] * effect[n] * model[n].noise_var).alias("score")) for n in nodes]
        return frame.select("replicate", F.inline(F.array(*scores)))

    return model_intervals(df, graph, key, query, nodes=nodes, **options)


def arrow_intervals(df: DataFrame, graph: CausalGraph, target: str, key: Column, **options) -> DataFrame:
    """Intervals of the strength of the arrows into a linear target."""
    def query(model: CausalModel, frame: DataFrame) -> DataFrame:
        m = model[target]
        if not m.is_linear:
            raise ValueError("intervals of arrow strengths are those of linear mechanisms")
        arrows = [F.struct(F.lit(term[0]).alias("parent"), F.lit(target).alias("child"),
                           (c * c * model[term[0]].params["total_var"]).alias("score")) for term, c in zip(m.terms, m.coef)]
        return frame.select("replicate", F.inline(F.array(*arrows)))

    return model_intervals(df, graph, key, query, by=("parent", "child"), nodes=graph.closure(target), **options)


def change_intervals(old: DataFrame, new: DataFrame | Column, graph: CausalGraph, target: str, key: Column,
                     mode: str = "refit", replicates: int = RESAMPLES, level: float = 0.95, frac: float = 0.6,
                     summary: Summary = mean, draws: int | None = None, kinds: Mapping[str, str] | None = None,
                     pool: bool = True, seed: int = 0, method: str = "md5", test_change: bool = False,
                     test_level: float = 0.05, difference=None) -> DataFrame:
    """Intervals of :func:`tracecause.operators.change.distribution_change`, with its change test and its differences."""
    return interval_table(change_replicates(old, new, graph, target, key, mode, replicates, frac, summary, draws, kinds, pool,
                                            seed, method, test_change, test_level, difference), ["node"], mode, level)


def change_replicates(old: DataFrame, new: DataFrame | Column, graph: CausalGraph, target: str, key: Column,
                      mode: str = "refit", replicates: int = RESAMPLES, frac: float = 0.6, summary: Summary = mean,
                      draws: int | None = None, kinds: Mapping[str, str] | None = None, pool: bool = True,
                      seed: int = 0, method: str = "md5", test_change: bool = False, test_level: float = 0.05,
                      difference=None) -> DataFrame:
    """``(replicate, node, score)``: all replicates in one plan.

    With ``test_change`` every replicate tests for itself which mechanisms changed. ``difference`` compares, within a
    replicate, the target's draws under the old mechanisms with those under a mix.
    """
    spark = old.sparkSession
    nodes = graph.closure(target)
    all_kinds = {n: k for n, k in default_kinds(graph, kinds).items() if n in nodes}
    linear = summary is mean and difference is None and all(k not in ("poly", "gbt") for k in all_kinds.values())
    index = F.col("replicate")
    plan = coalition_plan(nodes, seed=seed)
    closed = linear and draws in (None, 0) and mode != "rerun"
    draws = draws or 2000
    if mode == "rerun":
        pair = fit_periods(old, new, graph, target, kinds, key, pool, seed, test_change, test_level)
        pairs = dict.fromkeys(range(replicates), pair)
        sides = pair
    else:
        models, sums = replicate_fits(stack_sides(old, new, nodes, key), graph, F.col("__key"), nodes, mode, replicates, frac, kinds,
                                      "side", pool and not closed, seed, method)
        if test_change:
            for r in range(replicates):
                p = change_p_values(sums[(0, r)], sums[(1, r)], graph, all_kinds)
                kept = {n: models[(0, r)][n] for n in nodes if p[n] > test_level}
                models[(1, r)] = replace(models[(1, r)], mechanisms={**models[(1, r)].mechanisms, **kept})
        pairs = {r: (models[(0, r)], models[(1, r)]) for r in range(replicates)}
        sides = [indexed_model([pairs[r][s] for r in range(replicates)], nodes, index) for s in (0, 1)]
    if closed:
        base = plan.explode(spark.range(replicates).select(F.col("id").cast("int").alias("replicate")))
        mixed = mixed_values(base, plan, *sides, lambda n, s: sides[s][n].noise_mean if sides[s][n].is_root else F.lit(0.0))
        return plan.shares(mixed, F.col(target), ["replicate"])
    if summary is kl or difference is not None:
        ship(spark)  # the workers compare
        prefetch([(pair[0], nodes, draws, r, seed) for r, pair in pairs.items()])
        before = {r: np.broadcast_to(draw_values(pair[0], nodes, draws, r, seed)[1][target], (draws,)) for r, pair in pairs.items()}
        summary = compared(difference or kl_value, before)
    drawn = coalition_values(spark, plan, *sides, target, summary, draws, 0, seed, pairs)
    return plan.shares(drawn, F.col("value"), ["replicate"])


def anomaly_models(train: DataFrame, graph: CausalGraph, target: str, key: Column, mode: str, replicates: int,
                   frac: float, kinds, pool: bool, seed: int, model: CausalModel | None, method: str) -> dict:
    if mode == "rerun":
        if model is None:
            raise ValueError("mode 'rerun' needs the fitted model")
        return dict.fromkeys(range(replicates), model)
    return replicate_models(train, graph, key, graph.closure(target), mode, replicates, frac, kinds, None, pool, seed,
                            method)


def anomaly_intervals(train: DataFrame, rows: DataFrame, graph: CausalGraph, target: str, key: Column, keep,
                      mode: str = "refit", replicates: int = RESAMPLES, level: float = 0.95, frac: float = 0.6,
                      draws: int = REFERENCE_DRAWS, kinds: Mapping[str, str] | None = None, pool: bool = True,
                      seed: int = 0, model: CausalModel | None = None, method: str = "md5") -> DataFrame:
    """``(keep..., node, median, lo, hi, mode, resamples)`` of each row's attribution under refitted models.

    One map over the rows scores them under all models, whatever their mechanisms.
    """
    nodes = graph.closure(target)
    keep = [keep] if isinstance(keep, str) else list(keep)
    models = anomaly_models(train, graph, target, key, mode, replicates, frac, kinds, pool, seed, model, method)
    linear = all(m.is_linear(nodes) for m in models.values())
    plan = coalition_plan(nodes, seed=seed)
    prefetch([(m, nodes, draws, label, seed) for r, m in models.items() for label in (r, f"ref{r}")])
    cases = {r: case_of(m, target, plan, draws, r, seed, linear) for r, m in models.items()}
    clean = rows.filter(complete(nodes)).select(*keep, *[F.col(n).cast("double").alias(n) for n in nodes
                                                         if n not in keep])
    return case_intervals(clean, cases, keep, nodes, level, share_function() if linear else general_function()).select(
        "*", F.lit(mode).alias("mode"), F.lit(replicates).alias("resamples"))


def intervention_intervals(df: DataFrame, graph: CausalGraph, key: Column, interventions, mode: str = "refit",
                           replicates: int = RESAMPLES, level: float = 0.95, frac: float = 0.6,
                           kinds: Mapping[str, str] | None = None, pool: bool = True, seed: int = 0) -> DataFrame:
    """Interval of every node's mean under soft interventions, models refitted per replicate.

    The noise of all rows and replicates is resolved in one map over the buckets of the rows; keys must identify a row.
    """
    nodes = graph.order
    found = replicate_models(df, graph, key, nodes, mode, replicates, frac, kinds, None, pool, seed)
    models = [found[r] for r in range(replicates)]
    rows = df.filter(complete(nodes)).withColumn("__key", key.cast("string"))
    model = indexed_model(models, nodes, F.col("replicate"))
    fresh = moved_nodes(model, interventions)
    drawn = [n for n in fresh if model[n].is_drawn]
    if drawn:
        draws = replicate_draws(models[0].noise.order, rows.select("__key"), [m.mechanisms for m in models], drawn, seed)
        copies = rows.join(draws.select("__key", "replicate", *[F.col(n).alias(f"{n}__draw") for n in drawn]), "__key")
    else:
        copies = rows.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    rest = [n for n in fresh if n not in drawn]
    copies = model.with_draws(copies, F.col("__key"), rest, F.col("replicate"), seed)
    moved = with_moves(model, copies, interventions, "fresh")
    means = (moved.groupBy("replicate").agg(*[F.avg(n).alias(n) for n in nodes])
             .unpivot(["replicate"], list(nodes), "node", "score"))
    return interval_table(means, ["node"], mode, level)
