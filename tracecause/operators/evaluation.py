"""How well a fitted model describes data: fit metrics, noise independence, generated against observed."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracecause.functions.randomness import normal_values, uniform_values
from tracecause.functions.statistics import chi2_tail, normal_bin, weighted_chi2_tail_value
from tracecause.operators.assignment import fold_errors
from tracecause.operators.falsification import falsify
from tracecause.operators.frames import complete, number
from tracecause.operators.mechanisms import CausalModel
from tracecause.operators.resampling import array_sums
from tracecause.operators.simulation import draw

KL_BINS = 16
INDEPENDENCE_BINS = 6  # chi-square needs filled cells; some hundred rows fill 36
ROW_BITS = 33  # monotonically_increasing_id: partition above, position in the partition below


def kl_of_counts(counts: DataFrame, by, bins: int, name: str = "kl") -> DataFrame:
    """Divergence of side ``a`` from side ``b`` from ``(by..., side, bin, n)``, half a count added per bin."""
    wide = counts.groupBy(*by).agg(*[
        F.expr(f"coalesce(sum(n) FILTER (WHERE side = '{side}' AND bin = {i}), 0) AS {side}{i}")
        for side in "ab" for i in range(bins)])
    total = {side: "(" + " + ".join(f"{side}{i}" for i in range(bins)) + f" + {0.5 * bins}D)" for side in "ab"}
    terms = [f"(a{i} + 0.5D) / {total['a']} * ln(((a{i} + 0.5D) / {total['a']}) / ((b{i} + 0.5D) / {total['b']}))"
             for i in range(bins)]
    return wide.select(*by, F.expr(" + ".join(terms)).alias(name))


def binned_kl(a: DataFrame, b: DataFrame, columns, bins: int = KL_BINS) -> DataFrame:
    """``(node, kl)`` per column on bins placed by the moments of ``a``: two scans, ``bins`` rows shuffled.

    Nulls and NaNs count in no bin.
    """
    row = a.agg(*[e for i, c in enumerate(columns) for e in (
        F.avg(number(c)).alias(f"m{i}"), F.stddev_samp(number(c)).alias(f"s{i}"))]).first()
    sides = []
    for side, df in (("a", a), ("b", b)):
        cells = F.array(*[F.struct(F.lit(c).alias("node"), F.lit(side).alias("side"),
                                   F.when(F.col(c).isNotNull(), normal_bin(c, row[f"m{i}"], row[f"s{i}"] or 0.0, bins)).alias("bin"))
                          for i, c in enumerate(columns)])
        cells = F.filter(cells, lambda c: c["bin"].isNotNull())
        sides.append(df.select([number(c).alias(c) for c in columns]).select(F.explode(cells).alias("c")).select("c.*"))
    counts = sides[0].union(sides[1]).groupBy("node", "side", "bin").agg(F.count(F.lit(1)).alias("n"))
    return kl_of_counts(counts, ["node"], bins)


def generated_divergence(model: CausalModel, df: DataFrame, draws: int = 10_000, seed: int = 0,
                         nodes=None) -> DataFrame:
    """Does the model reproduce the data? Divergence of each observed column from generated rows."""
    nodes = list(nodes or model.graph.order)
    return binned_kl(df.filter(complete(nodes)), draw(df.sparkSession, model, draws, "check", seed), nodes)


def residual_rows(model: CausalModel, df: DataFrame, nodes, key: Column | None = None) -> DataFrame:
    """Long ``(node, x, r)``: value and residual; for a root the residual is the value."""
    at = {n: F.col(n).cast("double") for n in model.graph.order if n in df.columns}
    cells = [F.struct(F.lit(n).alias("node"), at[n].alias("x"),
                      (at[n] - (model[n].predict_column(at))).alias("r")) for n in nodes]
    keep = [key.cast("string").alias("key")] if key is not None else []
    return (df.filter(complete(nodes)).select(*keep, F.explode(F.array(*cells)).alias("c"))
            .select(*[F.col("key")] * bool(keep), "c.*"))


def mean_abs_difference(df: DataFrame, group: str, value: str, tie: Column) -> DataFrame:
    """``(group, half_gap, n)`` with ``half_gap`` = half the mean of ``|r_i - r_j|`` over all pairs.

    The sum over pairs is a sum over ranks. Rows are range-partitioned by value, ties spread by ``tie``,
    so equal values never pile up in one task; the position inside the sorted partition comes with
    the row. Ranks become global through per-partition counts, one row per partition and group.
    """
    place = (df.select(F.col(group).alias("g"), F.col(value).alias("v"), tie.alias("t"))
             .repartitionByRange("g", "v", "t").sortWithinPartitions("g", "v", "t")
             .withColumn("pos", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("pos"), ROW_BITS)
    local = F.col("pos").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).cast("double")
    parts = (place.withColumn("part", part).withColumn("local", local).groupBy("g", "part")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("local")).alias("ls"),
                  F.min("local").alias("first")))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("part")) - F.col("n")
    total = F.sum("n").over(Window.partitionBy("g"))
    ranked = parts.select("g", "n", "s", "ls", "first", before.alias("before"), total.alias("total"))
    rank_sum = F.col("ls") + (F.col("before") - F.col("first") + 1) * F.col("s")
    gap = F.sum(2.0 * rank_sum - (F.col("total") + 1) * F.col("s"))
    return (ranked.groupBy(F.col("g").alias(group), "total")
            .agg(gap.alias("gap"))
            .select(group, (F.col("gap") / (F.col("total").cast("double") * F.col("total"))).alias("half_gap"),
                    F.col("total").alias("n")))


def mechanism_metrics(model: CausalModel, df: DataFrame, key: Column, nodes=None) -> DataFrame:
    """Long ``(node, metric, value)``: ``mse`` and ``r2`` of non-roots, ``crps`` over the spread of all nodes.

    CRPS of an additive-noise model on its own rows is half the mean absolute difference of residuals.
    """
    nodes = list(nodes or model.graph.order)
    long = residual_rows(model, df, nodes, key)
    centre = F.array(*[F.lit(float(model[n].params["mean"])) for n in nodes])
    order = F.array(*[F.lit(n) for n in nodes])
    mid = F.element_at(centre, F.array_position(order, F.col("node")).cast("int"))
    sums = long.groupBy("node").agg(F.avg(F.col("r") * F.col("r")).alias("mse"), F.var_pop("x").alias("v"),
                                    F.stddev_samp("x").alias("sd"))
    roots = [n for n in nodes if model[n].is_root]
    shifted = long.select("node", "key", F.when(F.col("node").isin(roots), F.col("r") - mid)
                          .otherwise(F.col("r")).alias("r"))
    spread = mean_abs_difference(shifted, "node", "r", F.xxhash64("key"))
    both = sums.join(spread, "node")
    is_root = F.col("node").isin(roots)
    metrics = F.array(
        F.struct(F.lit("mse").alias("metric"), F.when(~is_root, F.col("mse")).alias("value")),
        F.struct(F.lit("r2").alias("metric"),
                 F.when(~is_root & (F.col("v") > 0), 1.0 - F.col("mse") / F.col("v")).alias("value")),
        F.struct(F.lit("crps").alias("metric"),
                 F.when(F.col("sd") > 0, F.col("half_gap") / F.col("sd")).otherwise(0.0).alias("value")))
    return (both.select("node", F.explode(metrics).alias("m")).select("node", "m.metric", "m.value")
            .filter(F.col("value").isNotNull()))


def independence(model: CausalModel, df: DataFrame, nodes=None, bins: int = INDEPENDENCE_BINS,
                 level: float = 0.05) -> DataFrame:
    """Is a node's noise independent of each parent? ``(node, parent, n, g, dof, p_value, p_adjusted, rejected)``.

    Residual and parent are put into ``bins`` bins placed by their moments; the G statistic of the table of counts is compared with chi-square and p-values are adjusted for the number of pairs (Bonferroni). Rows fold
    to at most ``bins^2`` counts per pair before the shuffle.
    """
    nodes = [n for n in (nodes or model.graph.order) if not model[n].is_root]
    use = [n for n in model.graph.order if n in df.columns]
    at = {n: F.col(n).cast("double") for n in use}
    rows = df.filter(complete(use)).select(
        *[at[n].alias(n) for n in use], *[(at[n] - model[n].predict_column(at)).alias(f"__r_{n}") for n in nodes])
    cells, pairs = [], 0
    for n in nodes:
        r = normal_bin(f"__r_{n}", 0.0, model[n].params["noise_var"] ** 0.5, bins)
        for p in model[n].parents:
            pairs += 1
            x = normal_bin(p, model[p].params["mean"], model[p].params["total_var"] ** 0.5, bins)
            cells.append(F.struct(F.lit(n).alias("node"), F.lit(p).alias("parent"), r.alias("r"), x.alias("x")))
    if not cells:
        raise ValueError("no node with parents to test")
    counts = (rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
              .groupBy("node", "parent", "r", "x").agg(F.count(F.lit(1)).alias("o")))
    pair = Window.partitionBy("node", "parent")  # at most bins^2 rows each
    sized = counts.select("*", F.sum("o").over(pair).alias("n"),
                          F.sum("o").over(Window.partitionBy("node", "parent", "r")).alias("nr"),
                          F.sum("o").over(Window.partitionBy("node", "parent", "x")).alias("nx"))
    o = F.col("o").cast("double")
    stats = sized.groupBy("node", "parent", "n").agg(
        (2.0 * F.sum(o * F.log(o * F.col("n") / (F.col("nr").cast("double") * F.col("nx"))))).alias("g"),
        ((F.count_distinct("r") - 1) * (F.count_distinct("x") - 1)).alias("dof"))
    p = chi2_tail(F.greatest(F.col("g"), F.lit(0.0)), F.col("dof").cast("double"))
    out = stats.withColumn("p_value", p)
    adjusted = F.least(F.col("p_value") * float(pairs), F.lit(1.0))
    return out.withColumn("p_adjusted", adjusted).withColumn("rejected", F.col("p_adjusted") < level)


NOISE_WAVES, NOISE_SCALES = 6, (1.0, 2.0)
PARENT_WAVES, PARENT_SCALES = 4, (1.0, 3.0, 9.0)  # waves per scale


def fourier(label: str, features: int, scales, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of ``cos(w x + b)`` for a standardised column; scales take turns."""
    w = normal_values(uniform_values(features, f"{label}#1", 0, seed), uniform_values(features, f"{label}#2", 0, seed))
    scale = np.array([scales[i % len(scales)] for i in range(features)])
    return w * scale, 2.0 * np.pi * uniform_values(features, f"{label}#3", 0, seed)


def noise_features(r: np.ndarray, node: str, seed: int) -> np.ndarray:
    w, b = fourier(f"noise:{node}", NOISE_WAVES, NOISE_SCALES, seed)
    return np.column_stack([r, 0.5 * r * r, np.cos(r[:, None] * w + b)])


def parent_features(x: np.ndarray, parent: str, seed: int) -> np.ndarray:
    w, b = fourier(f"parent:{parent}", PARENT_WAVES * len(PARENT_SCALES), PARENT_SCALES, seed)
    return np.cos(x[:, None] * w + b)


def kernel_independence(model: CausalModel, df: DataFrame, nodes=None, level: float = 0.05, seed: int = 0) -> DataFrame:
    """Is a node's noise independent of each parent? ``(node, parent, n, scale, statistic, p_value, p_adjusted, rejected)``.

    Random Fourier features approximate a kernel test, so dependence shows that coarse bins miss: the statistic is n times the
    sum of squared covariances between features of the noise (its value, its square, waves) and waves of the parent. Waves of
    each scale are a test of their own, and the smallest p-value counts as often as there are scales. Under independence the
    statistic is a weighted sum of chi-squares whose weights belong to the covariance of the products of centred features;
    three moments of it give the p-value. Two passes, for means and for products; a task yields one partial sum.
    """
    nodes = [n for n in (nodes or model.graph.order) if not model[n].is_root]
    pairs = [(n, p) for n in nodes for p in model[n].parents if not model[n].is_exact]
    if not pairs:
        raise ValueError("no node with parents and noise to test")
    use = [n for n in model.graph.order if n in df.columns]
    rows = df.filter(complete(use)).select(*[F.col(n).cast("double").alias(n) for n in use])
    bare = {n: replace(model[n], noise=None) for n in use}
    size_r, size_x, scales = 2 + NOISE_WAVES, PARENT_WAVES * len(PARENT_SCALES), len(PARENT_SCALES)

    def features(x, n, p):
        r = (x[n] - bare[n].predict(x)) / max(bare[n].params["noise_var"], 1e-300) ** 0.5
        parent = (x[p] - bare[p].params["mean"]) / max(bare[p].params["total_var"], 1e-300) ** 0.5
        return np.column_stack([noise_features(r, n, seed), parent_features(parent, p, seed)])

    sums = array_sums(rows, use, lambda x: np.concatenate([[len(x[use[0]])], *[features(x, n, p).sum(axis=0) for n, p in pairs]]))
    count = sums[0]
    centre = (sums[1:] / count).reshape(len(pairs), size_r + size_x)
    terms = size_r * PARENT_WAVES

    def products(x):
        out = []
        for (n, p), c in zip(pairs, centre):
            f = features(x, n, p) - c
            for k in range(scales):
                z = (f[:, :size_r, None] * f[:, None, size_r + k::scales]).reshape(len(f), -1)
                out += [z.sum(axis=0), (z.T @ z).ravel()]
        return np.concatenate(out)

    each = array_sums(rows, use, products).reshape(len(pairs), scales, terms + terms * terms) / count
    out = []
    for (n, p), parts in zip(pairs, each):
        tested = []
        for scale, s in zip(PARENT_SCALES, parts):
            mean = s[:terms]
            spread = s[terms:].reshape(terms, terms) - np.outer(mean, mean)
            square = spread @ spread
            statistic = float(count * (mean ** 2).sum())
            traces = (float(np.trace(spread)), float(np.trace(square)), float((square * spread).sum()))
            tested.append((weighted_chi2_tail_value(statistic, traces), scale, statistic))
        value, scale, statistic = min(tested)
        value = min(1.0, value * scales)
        adjusted = min(1.0, value * len(pairs))
        out.append((n, p, int(count), scale, statistic, value, adjusted, adjusted < level))
    return df.sparkSession.createDataFrame(out, "node string, parent string, n long, scale double, statistic double, p_value double, "
                                                "p_adjusted double, rejected boolean")


def evaluate(model: CausalModel, df: DataFrame, key: Column, compare_mechanism_baselines: bool = False,
             evaluate_invertibility_assumptions: bool = True, falsify_graph: bool = True, draws: int = 10_000,
             n_permutations: int = 20, folds: int = 5, seed: int = 0) -> DataFrame:
    """Long report ``(section, node, metric, value)``.

    ``performance`` of each mechanism, ``divergence`` of generated from observed columns, and as asked for
    ``baseline`` (held-out error of simpler and richer families), ``invertibility`` (adjusted p-value per
    parent) and ``graph`` (falsification).
    """
    spark = df.sparkSession
    report = [mechanism_metrics(model, df, key).select(F.lit("performance").alias("section"), "node", "metric", "value"),
              generated_divergence(model, df, draws, seed).select(F.lit("divergence").alias("section"), "node",
                                                                  F.lit("kl").alias("metric"), F.col("kl").alias("value"))]
    if compare_mechanism_baselines:
        errors = fold_errors(df, model.graph, key, folds=folds, seed=seed)
        rows = [("baseline", n, f"cv_mse:{c}", float(v)) for n, each in errors.items() for c, v in each.items()]
        report.append(spark.createDataFrame(rows, "section string, node string, metric string, value double"))
    if evaluate_invertibility_assumptions:
        report.append(independence(model, df).select(
            F.lit("invertibility").alias("section"), "node", F.concat(F.lit("p:"), "parent").alias("metric"),
            F.col("p_adjusted").alias("value")))
    if falsify_graph:
        verdict = falsify(df, model.graph, n_permutations, seed=seed)
        report.append(verdict.select(
            F.lit("graph").alias("section"), F.lit("*").alias("node"), F.expr(
                "stack(3, 'n_violations', cast(n_violations as double), 'p_value', p_value, "
                "'same_claims_share', same_claims_share) as (metric, value)")))
    out = report[0]
    for part in report[1:]:
        out = out.unionByName(part)
    return out
