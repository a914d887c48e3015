"""Draws from a fitted model and soft interventions: noise comes by one exchange (interventions) or a join per node, and each
node is one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.operators.frames import column_means
from tracecause.operators.mechanisms import CausalModel
from tracecause.operators.noise import permuted_draws


def draw(spark: SparkSession, model: CausalModel, n: int, replicate=0, seed: int = 0, method: str = "md5",
         nodes=None) -> DataFrame:
    """``n`` rows ``(id, node...)`` from the joint distribution, parents before children."""
    nodes = nodes or model.graph.order
    df = model.with_draws(spark.range(n), F.col("id"), nodes, replicate, seed, method)
    for node in nodes:
        values = {p: F.col(p) for p in model[node].parents}
        df = df.withColumn(node, model[node].predict_column(values) + F.col(f"{node}__draw"))
    return df.drop(*[f"{node}__draw" for node in nodes])


def intervene(model: CausalModel, df: DataFrame, key: Column, interventions: Mapping[str, Callable[[Column], Column]],
              mode: str = "fresh", replicate=0, seed: int = 0, method: str = "md5", replace: bool = False) -> DataFrame:
    """Observed rows under soft interventions; an intervention is a function from Column to Column.

    Nodes that are neither touched nor downstream keep their values. A touched root becomes
    ``f(observed)``; a touched non-root ``f(redraw given its parents)``; descendants are recomputed. With
    ``mode="counterfactual"`` every row keeps its abducted noise, with ``"fresh"`` noise is drawn anew: by a permutation
    of the rows per node, so without replacement and with one exchange for all nodes, or with ``replace`` by a join per node.
    """
    if mode not in ("fresh", "counterfactual"):
        raise ValueError(f"unknown mode {mode!r}")
    unknown = set(interventions) - set(model.graph.nodes)
    if unknown:
        raise KeyError(f"not in the graph: {sorted(unknown)}")
    df = df.withColumn("__key", key.cast("string"))
    fresh = moved_nodes(model, interventions) if mode == "fresh" else []
    from_rows = [n for n in fresh if model[n].is_drawn]
    if from_rows and not replace:
        at = {n: F.col(n) for n in model.noise.nodes}
        df = permuted_draws(model.noise, df, {f"{n}__draw": model[n].drawn(at) for n in from_rows}, replicate, seed)
        fresh = [n for n in fresh if n not in from_rows]
    return with_moves(model, model.with_draws(df, F.col("__key"), fresh, replicate, seed, method), interventions, mode)


def touched(graph, interventions) -> set[str]:
    return {n for t in interventions for n in graph.descendants(t)} | set(interventions)


def moved_nodes(model: CausalModel, interventions) -> list[str]:
    """The nodes whose noise fresh interventions draw anew."""
    moved = touched(model.graph, interventions)
    return [n for n in model.graph.order if n in moved and not (n in interventions and model[n].is_root)]


def with_moves(model: CausalModel, df: DataFrame, interventions: Mapping[str, Callable[[Column], Column]], mode: str) -> DataFrame:
    """Rows with a column ``__key``, and ``<node>__draw`` where noise is fresh, under interventions: one projection per node."""
    graph, order = model.graph, model.graph.order
    moved = touched(graph, interventions)
    df = df.select("*", *[F.col(n).cast("double").alias(f"{n}__obs") for n in order])
    for n in order:
        observed = F.col(f"{n}__obs")
        if n not in moved:
            value = observed
        elif n in interventions and model[n].is_root:
            value = interventions[n](observed)
        else:
            now = {p: F.col(p) for p in model[n].parents}
            seen = {p: F.col(f"{p}__obs") for p in model[n].parents}
            if mode == "counterfactual":
                noise = observed - model[n].predict_column(seen)
            else:
                noise = F.col(f"{n}__draw")
            value = model[n].predict_column(now) + noise
            if n in interventions:
                value = interventions[n](value)
        df = df.withColumn(n, value)
    return df.drop("__key", *[f"{n}__obs" for n in order], *[f"{n}__draw" for n in order])


def interventional_samples(spark: SparkSession, model: CausalModel, n: int,
                           interventions: Mapping[str, Callable[[Column], Column]], replicate=0,
                           seed: int = 0) -> DataFrame:
    """Soft interventions on rows drawn from the model, for when there is no data to start from."""
    order = model.graph.order
    df = model.with_draws(spark.range(n), F.col("id"), order, replicate, seed)
    for node in order:
        values = {p: F.col(p) for p in model[node].parents}
        value = model[node].predict_column(values) + F.col(f"{node}__draw")
        df = df.withColumn(node, interventions[node](value) if node in interventions else value)
    return df.drop(*[f"{node}__draw" for node in order])


def before_after(before: DataFrame, after: DataFrame, nodes) -> DataFrame:
    """Mean of every node before and after, ``(node, mean_before, mean_after, difference)``."""
    nodes = list(nodes)
    left = column_means(before, nodes).withColumnRenamed("mean", "mean_before")
    right = column_means(after, nodes).withColumnRenamed("mean", "mean_after")
    both = left.join(right, "node")
    return both.withColumn("difference", F.col("mean_after") - F.col("mean_before"))
