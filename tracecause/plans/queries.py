"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.functions.statistics import significant
from tracecause.operators import (anomaly, assignment, change, evaluation, falsification, frames, graph, influence,
                                  intervals, resampling, sampling, simulation)
from tracecause.operators.mechanisms import CausalModel, fit
from tracecause.plans.workload import (DAILY_GRAPH, ORDER_GRAPH, SPLIT, daily, order_facts, supply_edges, table)
from tracecause.sources import ingest, snapshots
from tracecause.sources.payload import from_payload, to_payload
from tracecause.sources.registry import ModelRegistry
from tracecause.sources.workspace import cut_lineage, fresh_path
from tracecause.streaming.scoring import read_results, score, score_stream

TARGET = "net"
DRAWS = 400
REPLICATES = 20
DAILY_NODES = ["peak", "n_orders", "n_lines", "qty", "gross", "disc", "net"]
ORDER_NODES = ["n_lines", "qty", "gross", "disc", "net"]


def day() -> Column:
    return F.col("d")


def tidy(x, zero: float = 1e-6, digits: int = 7) -> Column:
    """Seven significant digits, and zero for what is only the rounding of sums."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(F.abs(x) < zero, F.lit(0.0)).when(x.isNotNull(), significant(x, digits))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table, written to the shared folder: most queries pass over it more than once."""
    return cut_lineage(daily(spark, sf_dir))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(order_facts(spark, sf_dir))


def is_new() -> Column:
    return day() > F.lit(SPLIT).cast("date")


def old_new(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(SPLIT).cast("date")
    return df.filter(day() <= cut), df.filter(day() > cut)


def day_model(df: DataFrame, pool: bool = True) -> CausalModel:
    return fit(df, DAILY_GRAPH, day(), pool=pool)


# --- frames ---


def daily_frame(spark, sf_dir):
    money = [F.round(c, 2).alias(c) for c in ("qty", "gross")] + [F.round(c, 4).alias(c) for c in ("disc", "net")]
    return daily(spark, sf_dir).select("d", F.col("peak").cast("int").alias("peak"), "n_orders",
                                       F.col("n_lines").cast("bigint").alias("n_lines"), *money)


def order_frame(spark, sf_dir):
    money = [F.round(c, 2).alias(c) for c in ("qty", "gross")] + [F.round(c, 4).alias(c) for c in ("disc", "net")]
    return order_facts(spark, sf_dir).select("o_orderkey", "d", "n_lines", *money)


def csv_names(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_mktsegment").alias("Market Segment"),
        F.col("c_acctbal").alias("Account Balance?"), F.col("c_nationkey").alias("Nation Key"))


def sanitized_columns(spark, sf_dir):
    return ingest.sanitize(csv_names(spark, sf_dir))


def csv_roundtrip(spark, sf_dir):
    source = csv_names(spark, sf_dir)
    path = fresh_path(spark, "csv")
    ingest.write_csv(source, path)
    name = "tracecause_" + path.rsplit("-", 1)[1]
    ingest.ensure_schema(spark, name, fresh_path(spark, "schema"))
    tables = ingest.ingest(spark, {"customers": path}, name, {"customers": source.schema})
    return spark.read.table(tables["customers"])


def snapshot_as_of(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = fresh_path(spark, "snapshots")
    first = snapshots.write_snapshot(orders.filter(F.col("o_orderstatus") == "F"), path)
    snapshots.write_snapshot(orders, path)
    old = snapshots.read_snapshot(spark, path, first)
    newest = snapshots.latest_version(spark, path)
    return old.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(newest).alias("latest_version"))


def model_latest_alias(spark, sf_dir):
    df = days(spark, sf_dir)
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    fitted = fit(df, DAILY_GRAPH, day())
    for alias in ("candidate", "champion"):
        version = registry.save_model("shop", fitted, "daily", 0, {"quality": "good"}, df.schema)
        registry.set_alias("shop", alias, version)
    registry.set_alias("shop", "candidate", 2)
    rows = registry.load_model("shop", alias="Champion").to_table(spark)
    versions = sum(registry.resolve("shop", a) for a in ("CANDIDATE", "champion"))
    return rows.select("node", "kind", F.lit(registry.latest_version("shop")).alias("latest"),
                       F.lit(versions).alias("alias_versions"), F.concat_ws(",", "parents").alias("parents"),
                       tidy(F.coalesce(F.try_element_at("coef", F.lit(1)), F.lit(0.0))).alias("first_coef"),
                       F.col("params")["n"].cast("bigint").alias("n_rows"))


def payload_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                 "o_orderpriority")
    return from_payload(to_payload(rows, F.col("o_orderkey")), rows.schema)


def period_filter(spark, sf_dir):
    rows = frames.period(order_facts(spark, sf_dir).select("o_orderkey", "d", "gross"), "d", until=SPLIT)
    return frames.label(rows, "week", "w1").select("o_orderkey", "d", F.round("gross", 2).alias("gross"), "week")


def event_overlay(spark, sf_dir):
    out = frames.event_overlay(days(spark, sf_dir), "d", "peak", TARGET)
    return out.select("d", *[F.round(c, 4).alias(c) for c in (TARGET, "low", "high")], "n_rows")


def net_series(spark, sf_dir):
    return frames.series(daily(spark, sf_dir).select("d", F.round(TARGET, 4).alias(TARGET)), "d", TARGET)


def period_aligned_change(spark, sf_dir):
    df = days(spark, sf_dir).select(F.year("d").alias("y"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
                                    "n_lines", TARGET)
    out = frames.aligned_change(frames.period(df, "y", 1996), frames.period(df, "y", 1997), ["month", "day"],
                                ["n_lines", TARGET])
    return out.select("month", "day", *[tidy(c, digits=11).alias(c) for c in (
        "n_lines_growth_pct", "n_lines_drop_pct", "net_growth_pct", "net_drop_pct")])


# --- graph ---


def parents_of(spark, sf_dir):
    return graph.parent_table(supply_edges(spark, sf_dir))


def roots_of(spark, sf_dir):
    return graph.root_table(supply_edges(spark, sf_dir))


def edge_list(spark, sf_dir):
    """Distinct edges out of any table: who supplied which part."""
    return graph.edge_table(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


def node_list(spark, sf_dir):
    return graph.node_table(supply_edges(spark, sf_dir))


def invert_edges(spark, sf_dir):
    return graph.invert_table(supply_edges(spark, sf_dir))


def upstream(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("node"))
    return graph.ancestor_table(supply_edges(spark, sf_dir), urgent)


def topo_level(spark, sf_dir):
    return graph.level_table(supply_edges(spark, sf_dir))


# --- aggregates ---


def group_means(spark, sf_dir):
    df = days(spark, sf_dir).withColumn("week", F.when(day() <= F.lit(SPLIT).cast("date"), "w1").otherwise("w2"))
    out = frames.group_means(df, "week")
    return out.select("week", *[tidy(c).alias(c) for c in DAILY_NODES])


def column_means(spark, sf_dir):
    return frames.column_means(facts(spark, sf_dir), ORDER_NODES).select("node", tidy("mean").alias("mean"))


def target_spread(spark, sf_dir):
    return frames.spread(facts(spark, sf_dir), TARGET).select(
        *[tidy(c).alias(c) for c in ("sd", "low", "high", "mean")], "n_rows")


def histograms(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    out = frames.histograms(rows, ["l_quantity", "l_extendedprice"], 16)
    return out.select("node", "bin", tidy("low", digits=12).alias("low"), tidy("high", digits=12).alias("high"), "n")


def pairwise_corr(spark, sf_dir):
    return frames.pairwise(facts(spark, sf_dir), ORDER_NODES).select("left_node", "right_node",
                                                                     tidy("corr").alias("corr"))


def pairwise_counts(spark, sf_dir):
    return frames.pairwise_counts(facts(spark, sf_dir), ["n_lines", "qty", "gross"], 8)


def percent_change(spark, sf_dir):
    out = frames.change(days(spark, sf_dir), is_new(), DAILY_NODES)
    return out.select("node", *[tidy(c).alias(c) for c in ("mean_old", "mean_new", "growth_pct", "drop_pct")])


def mean_difference(spark, sf_dir):
    out = frames.change(order_facts(spark, sf_dir), is_new(), ORDER_NODES)
    return out.select("node", tidy("difference").alias("difference"))


def percent_share(spark, sf_dir):
    df = days(spark, sf_dir)
    shares = frames.to_percent(influence.intrinsic(spark, day_model(df, 0), TARGET), "score")
    return shares.select("node", tidy("score").alias("score"), tidy("percent").alias("percent"))


def root_cause_topk(spark, sf_dir):
    scores = attribute_anomalies(spark, sf_dir)
    return frames.top_causes(scores, 2, ["d"]).select("d", "node", "score", "rank")


def head_rows(spark, sf_dir):
    return frames.head(order_facts(spark, sf_dir), [F.desc("n_lines"), "o_orderkey"]).select(
        "o_orderkey", "n_lines", F.round("gross", 2).alias("gross"))


def first_day(spark, sf_dir):
    """The earliest day, and how far its target lies from the mean of all days."""
    df = days(spark, sf_dir)
    mean = df.agg(F.avg(TARGET)).first()[0]
    return frames.first_row(df, "d").select("d", tidy(F.col(TARGET) - mean).alias("from_mean"))


def stack_periods(spark, sf_dir):
    df = order_facts(spark, sf_dir).select("o_orderkey", "d", "n_lines")
    return frames.stack(*[frames.label(x, "week", w) for x, w in zip(old_new(df), ("w1", "w2"))])


def round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", frames.round_half_even(F.col("l_quantity") / 2).alias("half"),
        F.greatest(F.col("l_discount"), F.col("l_tax")).alias("larger"))


# --- randomness ---


def hash_sample(spark, sf_dir):
    return sampling.sample(table(spark, sf_dir, "events"), F.col("event_id"), 0.6, 1, 10).select(
        "event_id", "event_type", "value")


def hash_sample_exact(spark, sf_dir):
    return sampling.sample_exact(table(spark, sf_dir, "events"), F.col("event_id"), 0.6, 2, 10).select(
        "event_id", "event_type")


def poisson_weights(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sums = resampling.bootstrap_sums(rows, F.col("event_id"), ["event_type"], ["value"], resampling.Weights("refit", 4, seed=10))
    return sums.select("event_type", "replicate", "n", tidy("value", digits=12).alias("total"), "top")


# --- mechanisms ---


def mechanism_rows(spark, model: CausalModel) -> DataFrame:
    """``(node, term, value)``: intercepts (term empty) and coefficients."""
    rows = [(n, "*".join(t), float(c)) for n in model.graph.order for t, c in zip(model[n].terms, model[n].coef)]
    rows += [(n, "", float(model[n].intercept)) for n in model.graph.order if not model[n].is_root]
    return spark.createDataFrame(rows, "node string, term string, value double")


def fit_linear(spark, sf_dir):
    fitted = fit(facts(spark, sf_dir), ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    return mechanism_rows(spark, fitted).select("node", "term", tidy("value", 1e-4).alias("value"))


def fit_linear_daily(spark, sf_dir):
    return mechanism_rows(spark, day_model(days(spark, sf_dir), 0)).select(
        "node", "term", tidy("value", 1e-4, 6).alias("value"))


def fit_halfnormal(spark, sf_dir):
    fitted = fit(facts(spark, sf_dir), ORDER_GRAPH, F.col("o_orderkey"), {"n_lines": "halfnorm"}, 0,
                 nodes=["n_lines"])
    p = fitted["n_lines"].params
    return spark.createDataFrame([("n_lines", p["loc"], p["scale"])], "node string, loc double, scale double").select(
        "node", tidy("loc").alias("loc"), tidy("scale").alias("scale"))


def empirical_noise(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    noise = fitted.residuals(df, ORDER_NODES, ["o_orderkey"])
    return noise.select("o_orderkey", *[tidy(c, 1e-4, 6).alias(c) for c in ORDER_NODES])


def noise_pool(spark, sf_dir):
    df = days(spark, sf_dir)
    fitted = day_model(df)
    nodes, table = DAILY_NODES, fitted.noise
    at = {n: F.col(n) for n in table.nodes}
    wide = table.frame.select("pos", *[fitted[n].drawn(at).alias(n) for n in nodes])
    return wide.unpivot("pos", nodes, "node", "noise").select("node", "pos", tidy("noise", 1e-4, 6).alias("noise"))


def auto_assign(spark, sf_dir):
    df = days(spark, sf_dir)
    _, rows = assignment.assign(df, DAILY_GRAPH, day(), quality="good")
    return assignment.summary_table(spark, rows).select("node", "candidate", tidy("cv_mse", digits=6).alias("cv_mse"),
                                                        "chosen")


def auto_assign_products(spark, sf_dir):
    _, rows = assignment.assign(facts(spark, sf_dir), ORDER_GRAPH, F.col("o_orderkey"))
    return assignment.summary_table(spark, rows).select("node", "candidate", tidy("cv_mse", digits=6).alias("cv_mse"),
                                                        "chosen")


def mechanism_metrics(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    out = evaluation.mechanism_metrics(fitted, df, F.col("o_orderkey"))
    return out.select("node", "metric", tidy("value", digits=6).alias("value"))


def noise_independence(spark, sf_dir):
    df = days(spark, sf_dir)
    out = evaluation.independence(day_model(df, 0), df)
    return out.select("node", "parent", "n", tidy("g", digits=6).alias("g"), F.col("dof").cast("bigint").alias("dof"),
                      "rejected")


def independence_kernel(spark, sf_dir):
    df = days(spark, sf_dir)
    out = evaluation.kernel_independence(day_model(df, 0), df)
    return out.select("node", "parent", "n", "scale", tidy("statistic", digits=5).alias("statistic"), "rejected")


def period_divergence(spark, sf_dir):
    old, new = old_new(days(spark, sf_dir))
    out = evaluation.binned_kl(old, new, DAILY_NODES)
    return out.select("node", tidy("kl", digits=6).alias("kl"))


def fit_divergence(spark, sf_dir):
    df = days(spark, sf_dir)
    nodes = ["peak", "n_orders", "n_lines", "qty", "gross", "disc", "net"]
    out = evaluation.generated_divergence(day_model(df), df, 5000, nodes=nodes)
    return out.select("node", tidy("kl", digits=6).alias("kl"))


def evaluate_model(spark, sf_dir):
    """The whole report but for the permutation test, which has a query of its own."""
    df = days(spark, sf_dir)
    out = evaluation.evaluate(day_model(df), df, day(), True, True, False)
    return out.select("section", "node", "metric", tidy("value", 1e-5, 5).alias("value"))


def arrow_strength_trees(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), {TARGET: "gbt"}, 0)
    return influence.arrow_strength(fitted, df, TARGET, key=F.col("o_orderkey"))


def dag_local_tests(spark, sf_dir):
    out = falsification.local_claims(days(spark, sf_dir), DAILY_GRAPH)
    return out.select("node", "other", "given", tidy("partial_corr", 1e-7, 5).alias("partial_corr"), "violated")


def dag_covariance_tests(spark, sf_dir):
    out = falsification.covariance_claims(days(spark, sf_dir), DAILY_GRAPH, day(), "linear", False)
    return out.select("node", "other", "given", tidy("statistic", 1e-7, 5).alias("statistic"), "violated")


def dag_falsify_covariance(spark, sf_dir):
    """The verdict by held-out residuals of product mechanisms, of the nodes and of their squares."""
    return falsification.falsify(facts(spark, sf_dir), ORDER_GRAPH, 20, method="covariance", key=F.col("o_orderkey"))


def dag_permutations(spark, sf_dir):
    return falsification.permutations(facts(spark, sf_dir), ORDER_GRAPH, 20)


def dag_falsify(spark, sf_dir):
    return falsification.falsify(facts(spark, sf_dir), ORDER_GRAPH, 20)


# --- causal queries ---


def draw_samples(spark, sf_dir):
    df = days(spark, sf_dir)
    out = simulation.draw(spark, day_model(df), df.count())
    return out.select("id", *[tidy(c, 1e-4, 6).alias(c) for c in DAILY_NODES])


def arrow_strength(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    return influence.arrow_strength(fitted, df, TARGET).select("parent", "child", tidy("strength").alias("strength"))


def arrow_strength_kl(spark, sf_dir):
    df = days(spark, sf_dir)
    out = influence.arrow_strength(day_model(df, 0), df, TARGET, "kl", day())
    return out.select("parent", "child", tidy("strength", digits=6).alias("strength"))


def intrinsic_influence(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    return influence.intrinsic(spark, fitted, TARGET).select("node", tidy("score", digits=6).alias("score"))


def intrinsic_sampled(spark, sf_dir):
    df = days(spark, sf_dir)
    return influence.intrinsic(spark, day_model(df), TARGET, draws=500, linear=False).select(
        "node", tidy("score", 1e-3, 5).alias("score"))


def anomaly_score(spark, sf_dir):
    df = days(spark, sf_dir)
    out = anomaly.score_rows(day_model(df), df, TARGET, ["d"], DRAWS)
    return out.select("d", tidy("score").alias("score"))


def z_score(spark, sf_dir):
    return anomaly.z_scores(facts(spark, sf_dir), TARGET, ["o_orderkey"]).select("o_orderkey",
                                                                                tidy("score").alias("score"))


def attribute_anomalies(spark, sf_dir):
    df = days(spark, sf_dir)
    out = anomaly.attribute_anomalies(day_model(df), df, TARGET, ["d"], DRAWS)
    return out.select("d", "node", tidy("score").alias("score"))


def attribute_orders(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), nodes=ORDER_GRAPH.closure(TARGET))
    out = anomaly.attribute_anomalies(fitted, df, TARGET, ["o_orderkey"], 200)
    return out.select("o_orderkey", "node", tidy("score").alias("score"))


def attribute_products(spark, sf_dir):
    """As ``attribute_orders`` with a product mechanism at the target, which takes the way without closed forms."""
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), {TARGET: "poly"})
    out = anomaly.attribute_anomalies(fitted, df, TARGET, ["o_orderkey"], 200)
    return out.select("o_orderkey", "node", tidy("score").alias("score"))


def distribution_change_products(spark, sf_dir):
    old, new = old_new(facts(spark, sf_dir))
    out = change.distribution_change(old, new, ORDER_GRAPH, TARGET, draws=2000, kinds={TARGET: "poly"}, key=F.col("o_orderkey"))
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change(spark, sf_dir):
    out = change.distribution_change(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET)
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change_orders(spark, sf_dir):
    out = change.distribution_change(facts(spark, sf_dir), is_new(), ORDER_GRAPH, TARGET)
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change_tested(spark, sf_dir):
    out = change.distribution_change(facts(spark, sf_dir), is_new(), ORDER_GRAPH, TARGET, test_change=True)
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change_tested_shape(spark, sf_dir):
    """As ``distribution_change_tested``, the whole distribution of each noise being compared, too."""
    out = change.distribution_change(facts(spark, sf_dir), is_new(), ORDER_GRAPH, TARGET, test_change="shape")
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change_variance(spark, sf_dir):
    out = change.distribution_change(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, change.variance, 2000, key=day())
    return out.select("node", tidy("score", 10.0, 5).alias("score"))


def distribution_change_python(spark, sf_dir):
    """The difference of means as a Python function of two samples."""
    out = change.distribution_change(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, draws=2000, key=day(),
                                     difference=lambda x, y: y.mean() - x.mean())
    return out.select("node", tidy("score", 1e-3, 6).alias("score"))


def distribution_change_kl(spark, sf_dir):
    out = change.distribution_change(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, change.kl, 2000, key=day())
    return out.select("node", tidy("score", 1e-6, 5).alias("score"))


def bootstrap_refit(spark, sf_dir):
    out = intervals.change_intervals(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, day(), "refit", REPLICATES)
    return interval_columns(out)


def interval_columns(out: DataFrame) -> DataFrame:
    return out.select("node", *[tidy(c, 1e-3, 5).alias(c) for c in ("median", "lo", "hi")], "mode", "resamples")


def bootstrap_resample(spark, sf_dir):
    out = intervals.change_intervals(facts(spark, sf_dir), is_new(), ORDER_GRAPH, TARGET, F.col("o_orderkey"), "resample", 10)
    return interval_columns(out)


def subsample_interval(spark, sf_dir):
    out = intervals.change_intervals(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, day(), "subsample", 10, frac=0.6)
    return interval_columns(out)


def rerun_interval(spark, sf_dir):
    out = intervals.change_intervals(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, day(), "rerun", 5, draws=2000)
    return interval_columns(out)


def change_interval_tested(spark, sf_dir):
    """Every replicate tests for itself which mechanisms changed."""
    out = intervals.change_intervals(facts(spark, sf_dir), is_new(), ORDER_GRAPH, TARGET, F.col("o_orderkey"), "resample", 10,
                                     test_change=True)
    return interval_columns(out)


def change_interval_python(spark, sf_dir):
    """As ``rerun_interval``, the difference of means being a Python function of two samples."""
    out = intervals.change_intervals(days(spark, sf_dir), is_new(), DAILY_GRAPH, TARGET, day(), "rerun", 5, draws=2000,
                                     difference=lambda x, y: y.mean() - x.mean())
    return interval_columns(out)


def influence_interval(spark, sf_dir):
    out = intervals.influence_intervals(days(spark, sf_dir), DAILY_GRAPH, TARGET, day(), mode="refit", replicates=REPLICATES)
    return interval_columns(out)


def arrow_interval(spark, sf_dir):
    out = intervals.arrow_intervals(facts(spark, sf_dir), ORDER_GRAPH, TARGET, F.col("o_orderkey"), mode="refit", replicates=10)
    return out.select("parent", "child", *[tidy(c, 1e-3, 5).alias(c) for c in ("median", "lo", "hi")], "mode", "resamples")


def anomaly_interval(spark, sf_dir):
    """Every day's attribution with its interval: models refitted on resampled days."""
    df = days(spark, sf_dir)
    out = intervals.anomaly_intervals(df, df, DAILY_GRAPH, TARGET, day(), ["d"], "refit", 10, draws=200)
    return out.select("d", "node", *[tidy(c, 1e-5, 6).alias(c) for c in ("median", "lo", "hi")], "mode", "resamples")


SHIFTS = {"n_lines": lambda x: x - 1, "disc": lambda x: x * 2}


def intervene(spark, sf_dir):
    df = days(spark, sf_dir)
    out = simulation.intervene(day_model(df), df, day(), SHIFTS)
    return out.select("d", *[tidy(c, 1e-4, 9).alias(c) for c in ("n_orders", "n_lines", "gross", "disc", "net")])


def intervene_counterfactual(spark, sf_dir):
    df = facts(spark, sf_dir)
    fitted = fit(df, ORDER_GRAPH, F.col("o_orderkey"), pool=0)
    out = simulation.intervene(fitted, df, F.col("o_orderkey"), {"n_lines": lambda x: x + 1}, "counterfactual")
    return out.select("o_orderkey", *[tidy(c, 1e-4, 6).alias(c) for c in ORDER_NODES])


def interventional_draws(spark, sf_dir):
    """Rows of the model under interventions, without data to start from."""
    df = days(spark, sf_dir)
    out = simulation.interventional_samples(spark, day_model(df), df.count(), SHIFTS)
    return out.select("id", *[tidy(c, 1e-4, 6).alias(c) for c in ("n_orders", "n_lines", "gross", "disc", "net")])


def before_after(spark, sf_dir):
    df = days(spark, sf_dir)
    after = simulation.intervene(day_model(df), df, day(), SHIFTS)
    out = simulation.before_after(df.select([F.col(n).cast("double").alias(n) for n in DAILY_NODES]), after,
                                  DAILY_NODES)
    return out.select("node", *[tidy(c, 1e-4, 6).alias(c) for c in ("mean_before", "mean_after", "difference")])


def intervention_interval(spark, sf_dir):
    df = days(spark, sf_dir)
    out = intervals.intervention_intervals(df, DAILY_GRAPH, day(), SHIFTS, "refit", 10)
    return interval_columns(out)


def stored_model(spark, sf_dir, df: DataFrame) -> ModelRegistry:
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    version = registry.save_model("shop", day_model(df), "daily", 0, {}, df.schema)
    registry.set_alias("shop", "champion", version)
    return registry


def batch_scores(spark, sf_dir):
    df = days(spark, sf_dir)
    out = score(stored_model(spark, sf_dir, df), "shop", df, TARGET, ["d"], "Champion", DRAWS)
    return out.select("d", "node", tidy("score").alias("score"))


def stream_scores(spark, sf_dir):
    df = days(spark, sf_dir)
    inbox = fresh_path(spark, "inbox")
    df.repartition(4, "d").write.parquet(inbox)
    registry = stored_model(spark, sf_dir, df)
    results, log = fresh_path(spark, "scores"), fresh_path(spark, "log")
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    query = score_stream(source, registry, "shop", TARGET, ["d"], results, log, fresh_path(spark, "offsets"),
                         draws=DRAWS)
    query.awaitTermination()
    logged = spark.read.parquet(log).select(F.col("row_key").cast("date").alias("d"),
                                            F.col("response_json").isNotNull().alias("answered"))
    return read_results(spark, results).join(logged, "d").select("d", "node", tidy("score").alias("score"), "answered")


QUERIES = [
    daily_frame, order_frame, sanitized_columns, csv_roundtrip, snapshot_as_of, model_latest_alias, payload_roundtrip,
    period_filter, event_overlay, net_series, period_aligned_change, parents_of, roots_of, node_list, invert_edges,
    upstream, topo_level, group_means, column_means, target_spread, histograms, pairwise_corr, pairwise_counts,
    percent_change, mean_difference, percent_share, root_cause_topk, head_rows, first_day, edge_list,
    stack_periods, round_half_even,
    hash_sample, hash_sample_exact, poisson_weights, fit_linear, fit_linear_daily, fit_halfnormal, empirical_noise,
    attribute_products, distribution_change_products, noise_pool, auto_assign, auto_assign_products, mechanism_metrics, noise_independence, period_divergence,
    fit_divergence, evaluate_model, arrow_strength_trees, dag_local_tests, dag_permutations, dag_falsify, draw_samples, arrow_strength, arrow_strength_kl,
    intrinsic_influence, intrinsic_sampled, anomaly_score, z_score, attribute_anomalies, attribute_orders,
    distribution_change, distribution_change_orders, distribution_change_tested, distribution_change_variance,
    distribution_change_python, distribution_change_kl, interventional_draws, bootstrap_refit, bootstrap_resample, subsample_interval, rerun_interval, anomaly_interval,
    independence_kernel, dag_covariance_tests, dag_falsify_covariance, distribution_change_tested_shape,
    change_interval_tested, change_interval_python, influence_interval, arrow_interval,
    intervene, intervene_counterfactual, before_after, intervention_interval, batch_scores, stream_scores,
]
