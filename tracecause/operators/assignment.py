"""Choose a mechanism family per node by cross-validation.

Folds are drawn by key hash and their sums come from one pass; training on the other folds is adding
their sums, and the held-out error follows from the held-out sums. No fold is ever read again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.functions.randomness import uniform
from tracecause.operators.frames import complete
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import (NOISE_FLOOR, Moments, default_kinds, design_terms, fit_trees, moments,
                                             needed_products, profile, solve_standard, squared_error)

CANDIDATES = ("mean", "linear", "poly")
QUALITIES = {"simple": ("mean", "linear"), "good": CANDIDATES, "better": CANDIDATES + ("gbt",)}
GAIN = 0.05  # a richer family must lower the held-out error by more than this share
SUMMARY_SCHEMA = "node string, candidate string, cv_mse double, chosen boolean"


def fold_of(key: Column, folds: int, seed: int = 0, method: str = "md5") -> Column:
    return F.floor(uniform(key, "fold", 0, seed, method) * folds).cast("int")


def fold_errors(df: DataFrame, graph: CausalGraph, key: Column, candidates=CANDIDATES, folds: int = 5, seed: int = 0,
                nodes=None) -> dict[str, dict[str, float]]:
    """Held-out mean squared error per non-root node and candidate family.

    An error below ``NOISE_FLOOR`` of the node's variance is the rounding of sums and counts as 0. Trees are the one
    family that has to be trained fold by fold.
    """
    nodes = list(nodes or graph.order)
    inner = [n for n in nodes if graph.parents(n)]
    rows = df.filter(complete(nodes))
    scale, _, _ = profile(df, nodes)
    designs = [(n, design_terms(c, graph.parents(n))) for n in inner for c in candidates]
    tagged = rows.withColumn("__fold", fold_of(key, folds, seed))
    parts: dict[tuple, Moments] = moments(tagged, scale, needed_products(designs), ["__fold"])
    if len(parts) < 2:
        raise ValueError("too few rows for cross-validation")
    total = None
    for part in parts.values():
        total = part if total is None else total + part
    errors: dict[str, dict[str, float]] = {}
    for n in inner:
        errors[n] = {}
        floor = NOISE_FLOOR * total.var(n)
        for c in candidates:
            if c == "gbt":
                held = tree_error(tagged, n, graph.parents(n), sorted(f for (f,) in parts), seed)
                errors[n][c] = held if held > floor else 0.0
                continue
            terms = design_terms(c, graph.parents(n))
            held = sum(squared_error(part, n, terms, solve_standard(total - part, n, terms)) * part.n
                       for part in parts.values())
            errors[n][c] = held / total.n if held / total.n > floor else 0.0
    return errors


def tree_error(tagged: DataFrame, node: str, parents, folds, seed: int) -> float:
    total = rows = 0.0
    for fold in folds:
        m = fit_trees(tagged.filter(F.col("__fold") != fold), node, parents, seed=seed)
        gap = F.col(node).cast("double") - m.predict_column({p: F.col(p).cast("double") for p in parents})
        row = (tagged.filter(F.col("__fold") == fold).select(gap.alias("g"))
               .agg(F.sum(F.col("g") * F.col("g")).alias("s"), F.count(F.lit(1)).alias("n")).first())
        total, rows = total + row.s, rows + row.n
    return total / rows


def choose(errors: Mapping[str, float], candidates=CANDIDATES) -> str:
    """Linear unless a richer family is clearly better than the best so far; equal errors go to the simpler one."""
    best = "linear"
    for richer in ("poly", "gbt"):
        if richer in candidates and errors[richer] < errors[best] * (1.0 - GAIN):
            best = richer
    return best


def assign(df: DataFrame, graph: CausalGraph, key: Column, override_models: bool = True,
           kinds: Mapping[str, str] | None = None, quality: str = "good", folds: int = 5, seed: int = 0,
           nodes=None) -> tuple[dict[str, str], list[tuple]]:
    """``(kinds, summary rows)``. With ``override_models=False`` kinds set by hand are kept.

    ``quality="simple"`` takes linear mechanisms without looking; ``"good"`` also tries products of parents
    and ``"better"`` boosted trees, which cost a training run per fold.
    """
    candidates = QUALITIES[quality]
    nodes = list(nodes or graph.order)
    chosen = {n: k for n, k in default_kinds(graph).items() if n in nodes}
    summary = []
    errors = fold_errors(df, graph, key, candidates, folds, seed, nodes)
    for n in nodes:
        kept = None if override_models else (kinds or {}).get(n)
        if n in errors:
            chosen[n] = kept or choose(errors[n], candidates)
            summary += [(n, c, float(errors[n][c]), c == chosen[n]) for c in candidates]
        else:
            chosen[n] = kept or "empirical"
            summary.append((n, chosen[n], None, True))
    return chosen, summary


def summary_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)
