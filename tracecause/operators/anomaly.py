"""Anomaly scores and their attribution to upstream nodes, row by row.

For an observed target y the score is ``g(y) = -ln(2 * min(P(Y >= y), P(Y <= y)))`` against draws from
the model. A coalition S replaces the noise of its nodes by random draws and keeps the abducted noise of
the others; ``q(S)`` is the share of draws at least as anomalous as y and ``v(S) = -ln q(S)``. Shares
are Shapley values of v, so they sum to ``v(all)`` for every row.

``g(Y_S) >= g(y)`` holds exactly when Y_S lies outside an interval that y fixes, so no draw is ever
scored: the two ends come from the sorted reference draws.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecause.functions.randomness import double_array, rank_steps
from tracecause.operators.frames import complete
from tracecause.operators.mechanisms import CausalModel, draw_values, prefetch
from tracecause.operators.shapley import CoalitionPlan, coalition_plan, unpivot_players

REFERENCE_DRAWS = 1000
TIE = 1e-9  # values closer than this share of the target's spread count as equal


@dataclass(frozen=True)
class Reference:
    """Sorted model draws of the target, and the distance below which two values tie."""

    values: np.ndarray
    tie: float

    @property
    def size(self) -> int:
        return len(self.values)

    @property
    def floor(self) -> float:
        return 1.0 / (self.size + 1)


def reference_draws(model: CausalModel, target: str, draws: int = REFERENCE_DRAWS, replicate=0,
                    seed: int = 0) -> Reference:
    if draws < 1:
        raise ValueError("at least one draw")
    _, values = draw_values(model, model.graph.closure(target), draws, f"ref{replicate}", seed)
    y = np.sort(np.broadcast_to(values[target], (draws,)))
    return Reference(y, TIE * float(y.std(ddof=1) if draws > 1 else 0.0))


def with_tail(df: DataFrame, y: Column, ref: Reference, name: str = "__tail") -> DataFrame:
    """Add ``min(#draws >= y, #draws <= y)``, ties counted on both sides."""
    kept = df.columns
    steps = rank_steps("__below", ref.size, f"< __y - {ref.tie!r}D") + rank_steps("__upto", ref.size,
                                                                                 f"<= __y + {ref.tie!r}D")
    found = df.select("*", y.alias("__y"), double_array(ref.values).alias("__ref")).selectExpr("*", *steps)
    return found.select(*kept, F.least(ref.size - F.col("__below"), F.col("__upto")).alias(name))


def quantile_score(tail: Column, ref: Reference) -> Column:
    """Negative log-probability of a value at least as extreme; it cannot see below one draw."""
    p = F.greatest(tail / float(ref.size), F.lit(ref.floor))
    return -F.log(F.least(2.0 * p, F.lit(1.0)))


def score_rows(model: CausalModel, df: DataFrame, target: str, keep=(), draws: int = REFERENCE_DRAWS,
               seed: int = 0) -> DataFrame:
    """Quantile score of every row: a map over the data, no join and no shuffle."""
    ref = reference_draws(model, target, draws, 0, seed)
    y = F.col(target).cast("double")
    tagged = with_tail(df.filter(complete([target])), y, ref)
    return tagged.select(*keep, y.alias("value"), quantile_score(F.col("__tail"), ref).alias("score"))


def z_scores(df: DataFrame, target: str, keep=(), mean: float | None = None, sd: float | None = None,
             model: CausalModel | None = None, draws: int = REFERENCE_DRAWS, seed: int = 0) -> DataFrame:
    """Distance from the expected value in standard deviations.

    The expectation comes from the model when one is given, else from the rows themselves.
    """
    y = F.col(target).cast("double")
    if model is not None:
        ref = reference_draws(model, target, draws, 0, seed)
        mean, sd = float(ref.values.mean()), float(ref.values.std(ddof=1))
    if mean is None or sd is None:
        row = df.filter(complete([target])).agg(F.avg(y).alias("m"), F.stddev_samp(y).alias("s")).first()
        mean, sd = row.m, row.s
    score = F.abs(y - F.lit(mean)) / F.lit(sd) if sd else F.lit(0.0)
    return df.filter(complete([target])).select(*keep, y.alias("value"), score.alias("score"))


# --- attribution ---------------------------------------------------------------------------------


def linear_case(model: CausalModel, target: str, ref: Reference, plan: CoalitionPlan, draws: int, replicate=0,
                seed: int = 0) -> dict:
    """What a task needs to attribute rows of an all-linear model: plain arrays of set size."""
    nodes = plan.players
    at = {n: j for j, n in enumerate(nodes)}
    constant, effects = model.total_effects(target)
    noise, _ = draw_values(model, nodes, draws, replicate, seed)
    weight = np.array([effects[n] for n in nodes])
    abduct = np.eye(len(nodes))  # row values to noise: x - sum(coef * parents) - intercept
    for n in nodes:
        for (parent,), c in zip(model[n].terms, model[n].coef):
            abduct[at[parent], at[n]] -= c
    return {"constant": constant, "effects": weight, "reference": ref.values, "tie": ref.tie, "abduct": abduct,
            "intercepts": np.array([model[n].intercept for n in nodes]),
            "weighted": np.column_stack([np.broadcast_to(noise[n], (draws,)) for n in nodes]) * weight,
            "inside": plan.inside(), "batches": plan.batches,
            "factors": plan.factors, "draws": draws}


def share_function():
    """The scoring of one Arrow batch, as a function that carries no import of this package to the workers.

    The draws of each coalition are summed and sorted once; a row then costs two binary searches per
    coalition and not one test per draw.
    """
    def prepare(case):
        return np.sort(case["inside"].astype(float) @ case["weighted"].T, axis=1)

    def shares(case, sums, x, errors=False):
        """Rows x nodes from observed values, the target being the last node; with ``errors`` twice as many columns."""
        y, noise = x[:, -1], x @ case["abduct"] - case["intercepts"]
        reference, tie, inside = case["reference"], case["tie"], case["inside"]
        m, draws = len(reference), sums.shape[1]
        tail = np.minimum(m - np.searchsorted(reference, y - tie, side="left"),
                          np.searchsorted(reference, y + tie, side="right"))
        low = reference[np.minimum(tail, m - 1)] - tie
        high = reference[np.maximum(m - tail - 1, 0)] + tie
        fixed = noise * case["effects"]
        out = np.zeros((len(y), noise.shape[1]))
        parts = np.zeros((len(case["batches"]), *out.shape)) if errors else None
        for s in range(len(inside)):
            if not inside[s].any():
                continue  # nothing random: as anomalous as observed, value 0
            base = case["constant"] + fixed[:, ~inside[s]].sum(axis=1)
            hits = (np.searchsorted(sums[s], low - base, side="left")
                    + draws - np.searchsorted(sums[s], high - base, side="right"))
            q = np.where(tail >= m, 1.0, np.clip(hits / draws, 1.0 / (draws + 1), 1.0))
            out -= np.log(q)[:, None] * case["factors"][s]
            if errors:
                parts -= np.log(q)[None, :, None] * case["batches"][:, None, s, :]
        return np.column_stack([out, parts.std(axis=0, ddof=1) / np.sqrt(len(parts))]) if errors else out

    return prepare, shares


PREPARED = 1 << 28  # bytes of sorted sums that a task keeps from batch to batch


def case_intervals(df: DataFrame, cases: Mapping[int, dict], keep, nodes, level: float, function) -> DataFrame:
    """``(keep..., node, median, lo, hi)`` over several fits of the same graph; ``function`` is one of this module's pairs.

    A batch meets one fit after the other and gives quantiles over them, so neither copies of rows nor
    scores per replicate ever leave the task. What a fit needs is prepared once per task, or once per batch where that of
    all fits is larger than ``PREPARED``.
    """
    keep, nodes = list(keep), list(nodes)
    fields = [T.StructField("node", T.StringType())] + [T.StructField(n, T.DoubleType()) for n in ("median", "lo", "hi")]
    schema = T.StructType([df.schema[k] for k in keep] + fields)
    prepare, shares = function
    points = [0.5, (1.0 - level) / 2.0, 1.0 - (1.0 - level) / 2.0]
    order = [cases[r] for r in sorted(cases)]
    held = sum(c["inside"].shape[0] * c["draws"] * 8 for c in order) <= PREPARED

    def attribute(batches):
        ready = None
        for batch in batches:
            if held and ready is None:
                ready = [prepare(c) for c in order]
            x = batch[nodes].to_numpy(float)
            each = [shares(c, ready[i] if held else prepare(c), x) for i, c in enumerate(order)]
            found = np.quantile(np.stack(each), points, axis=0)
            for j, n in enumerate(nodes):
                out = batch[keep].reset_index(drop=True)
                out["node"] = n
                for i, name in enumerate(("median", "lo", "hi")):
                    out[name] = found[i, :, j]
                yield out

    return df.select(*keep, *[F.col(n) for n in nodes if n not in keep]).mapInPandas(attribute, schema)


CELLS = 1 << 21  # numbers per node that a task evaluates at a time


def general_case(model: CausalModel, target: str, ref: Reference, plan: CoalitionPlan, draws: int, replicate=0,
                 seed: int = 0) -> dict:
    """What a task needs to attribute rows of any model: mechanisms as plain lists, and the draws."""
    nodes = list(plan.players)
    drawn, _ = draw_values(model, nodes, draws, replicate, seed)
    trees = {n: [(json.loads(t), c) for (t,), c in zip(model[n].terms, model[n].coef)] for n in nodes if model[n].kind == "gbt"}
    return {"nodes": nodes, "target": target, "draws": draws, "reference": ref.values, "tie": ref.tie, "factors": plan.factors,
            "random": {n: np.array(np.broadcast_to(drawn[n], (draws,))) for n in nodes}, "trees": trees,
            "sums": {n: (model[n].intercept, [] if n in trees else list(zip(model[n].terms, model[n].coef))) for n in nodes},
            "inside": plan.inside(), "batches": plan.batches}


def general_function():
    """The pair of :func:`share_function` for any mechanisms: each coalition is evaluated on an array of rows x draws."""
    def prepare(case):
        return None

    def tree(t, at):
        if not isinstance(t, list):
            return t
        name, threshold, low, high = t
        return np.where(at[name] <= threshold, tree(low, at), tree(high, at))

    def predict(case, n, at):
        out = case["sums"][n][0]
        for term, c in case["sums"][n][1]:
            piece = at[term[0]]
            for name in term[1:]:
                piece = piece * at[name]
            out = out + piece * c
        for t, c in case["trees"].get(n, ()):
            out = out + tree(t, at) * c
        return out

    def some(case, x, errors):
        nodes, draws, reference, tie = case["nodes"], case["draws"], case["reference"], case["tie"]
        seen = {n: x[:, j][:, None] for j, n in enumerate(nodes)}
        own = {n: seen[n] - predict(case, n, seen) for n in nodes}
        y, m = seen[case["target"]], len(reference)
        tail = np.minimum(m - np.searchsorted(reference, y - tie, side="left"), np.searchsorted(reference, y + tie, side="right"))
        low = reference[np.minimum(tail, m - 1)] - tie
        high = reference[np.maximum(m - tail - 1, 0)] + tie
        out = np.zeros((len(x), len(nodes)))
        parts = np.zeros((len(case["batches"]), *out.shape)) if errors else None
        for s, chosen in enumerate(case["inside"]):
            if not chosen.any():
                continue
            at = {}
            for n, is_random in zip(nodes, chosen):
                at[n] = predict(case, n, at) + (case["random"][n][None, :] if is_random else own[n])
            mixed = np.broadcast_to(at[case["target"]], (len(x), draws))
            q = np.clip(((tail >= m) | (mixed < low) | (mixed > high)).mean(axis=1), 1.0 / (draws + 1), 1.0)
            out -= np.log(q)[:, None] * case["factors"][s]
            if errors:
                parts -= np.log(q)[None, :, None] * case["batches"][:, None, s, :]
        return np.column_stack([out, parts.std(axis=0, ddof=1) / np.sqrt(len(parts))]) if errors else out

    step = CELLS

    def shares(case, ready, x, errors=False):
        size = max(1, step // case["draws"])
        wide = len(case["nodes"]) * (1 + errors)
        return np.concatenate([some(case, x[i:i + size], errors) for i in range(0, len(x), size)] or [np.zeros((0, wide))])

    return prepare, shares


def case_scores(df: DataFrame, case: dict, keep, nodes, function, errors: bool = False) -> DataFrame:
    """``(keep..., __p0..)``, with ``errors`` also ``__e0..``: attribute rows Arrow batch by Arrow batch; the rows never move and
    keys need not be unique."""
    names = [f"__p{j}" for j in range(len(nodes))] + [f"__e{j}" for j in range(len(nodes)) if errors]
    keep, nodes = list(keep), list(nodes)
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField(n, T.DoubleType()) for n in names])
    prepare, shares = function

    def attribute(batches):
        ready, fresh = None, True
        for batch in batches:
            if fresh:
                ready, fresh = prepare(case), False
            found = pd.DataFrame(shares(case, ready, batch[nodes].to_numpy(float), errors), columns=names)
            yield pd.concat([batch[keep].reset_index(drop=True), found], axis=1)

    return df.select(*keep, *[F.col(n) for n in nodes if n not in keep]).mapInPandas(attribute, schema)


def case_of(model: CausalModel, target: str, plan: CoalitionPlan, draws: int, replicate, seed: int, linear: bool) -> dict:
    ref = reference_draws(model, target, draws, replicate, seed)
    return (linear_case if linear else general_case)(model, target, ref, plan, draws, replicate, seed)


def attribute_wide(model: CausalModel, rows: DataFrame, target: str, keep, draws: int = REFERENCE_DRAWS,
                   replicate=0, seed: int = 0, orderings: int | None = None, linear: bool | None = None, errors: bool = False):
    """``(DataFrame keep + __p0.., nodes)``: the shares of each row side by side."""
    nodes = model.graph.closure(target)
    keep = [keep] if isinstance(keep, str) else list(keep)
    plan = coalition_plan(nodes, orderings, seed)
    clean = rows.filter(complete(nodes)).select(*keep, *[F.col(n).cast("double").alias(n) for n in nodes
                                                            if n not in keep])
    if linear is None:
        linear = model.is_linear(nodes)
    prefetch([(model, nodes, draws, label, seed) for label in (replicate, f"ref{replicate}")])
    case = case_of(model, target, plan, draws, replicate, seed, linear)
    if errors and plan.batches is None:
        raise ValueError("exact shares have no error; ask for orderings")
    return case_scores(clean, case, keep, nodes, share_function() if linear else general_function(), errors), nodes


def attribute_anomalies(model: CausalModel, rows: DataFrame, target: str, keep, draws: int = REFERENCE_DRAWS,
                        replicate=0, seed: int = 0, orderings: int | None = None, linear: bool | None = None,
                        errors: bool = False) -> DataFrame:
    """Long ``(keep..., node, score)``; positive where a node made the row more anomalous.

    ``keep`` must identify a row. With ``errors``, for sampled orderings, there is a standard error beside each score.
    """
    wide, nodes = attribute_wide(model, rows, target, keep, draws, replicate, seed, orderings, linear, errors)
    return unpivot_players(wide, nodes, [keep] if isinstance(keep, str) else list(keep), errors)
