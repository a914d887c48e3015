"""Filters, joins, summaries and rankings of observation tables.

An observation table has one row per unit and one numeric column per graph node. Row keys are named
columns; nothing here relies on a row position.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_DELIMITER = "|"


def row_key(*key_cols: str) -> Column:
    """One string key out of the key columns."""
    return F.concat_ws(KEY_DELIMITER, *[F.col(c).cast("string") for c in key_cols])


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def complete(nodes) -> Column:
    """True where no node is null or NaN."""
    test = F.lit(True)
    for n in nodes:
        test = test & F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double"))
    return test


def number(name: str) -> Column:
    """A column as double, null where it is NaN; aggregates then leave the gap out."""
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def node_frame(df: DataFrame, nodes, keep=()) -> DataFrame:
    """The columns a causal query needs and no others: ``keep`` as is, nodes as doubles.

    Rows with a null or NaN in a node are left out; ``fit`` reports how many there were.
    """
    return df.filter(complete(nodes)).select(*keep, *[F.col(n).cast("double").alias(n) for n in nodes])


def period(df: DataFrame, column: str, value=None, since=None, until=None) -> DataFrame:
    """Rows of a period: equal to ``value``, or from ``since`` up to and including ``until``."""
    kind = df.schema[column].dataType
    if value is not None:
        df = df.filter(F.col(column) == F.lit(value).cast(kind))
    if since is not None:
        df = df.filter(F.col(column) >= F.lit(since).cast(kind))
    if until is not None:
        df = df.filter(F.col(column) <= F.lit(until).cast(kind))
    return df


def label(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, duplicates kept, columns matched by name."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def series(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.select(key, target).orderBy(key)


def event_overlay(df: DataFrame, key: str, flag: str, target: str) -> DataFrame:
    """Keys of the rows where the flag holds, beside the bounds of the whole series."""
    bounds = df.agg(F.min(number(target)).alias("low"), F.max(number(target)).alias("high"), F.count(F.lit(1)).alias("n_rows")).first()
    return df.filter(F.col(flag).cast("boolean")).select(
        F.col(key), F.col(target), F.lit(bounds.low).alias("low"), F.lit(bounds.high).alias("high"),
        F.lit(bounds.n_rows).cast("bigint").alias("n_rows"))


def aligned_change(old: DataFrame, new: DataFrame, on, columns) -> DataFrame:
    """Pair two periods on real keys and give growth and drop in percent.

    A key that comes more than once stands for its mean, so the join never multiplies rows; it reuses the
    partitioning of that fold.
    """
    on = [on] if isinstance(on, str) else list(on)
    left = old.groupBy(*on).agg(*[F.avg(number(c)).alias(f"{c}_old") for c in columns])
    right = new.groupBy(*on).agg(*[F.avg(number(c)).alias(f"{c}_new") for c in columns])
    both = left.join(right, on, "inner")
    for c in columns:
        both = (both.withColumn(f"{c}_growth_pct", growth_pct(F.col(f"{c}_old"), F.col(f"{c}_new")))
                .withColumn(f"{c}_drop_pct", drop_pct(F.col(f"{c}_old"), F.col(f"{c}_new"))))
    return both


def growth_pct(old: Column, new: Column) -> Column:
    """Null where the old value is zero."""
    return (F.try_divide(new, old) - 1.0) * 100.0


def drop_pct(old: Column, new: Column) -> Column:
    return (1.0 - F.try_divide(new, old)) * 100.0


def group_means(df: DataFrame, by: str, exclude=()) -> DataFrame:
    """Mean of every numeric column per group; other columns are skipped."""
    return df.groupBy(by).agg(*[F.avg(number(c)).alias(c)
                                for c in numeric_columns(df, {by, *exclude})])


def column_means(df: DataFrame, columns=None) -> DataFrame:
    """Long ``(node, mean)``: one pass for all columns, then one row turned on its side."""
    columns = columns or numeric_columns(df)
    wide = df.agg(*[F.avg(number(c)).alias(c) for c in columns])
    return wide.unpivot([], columns, "node", "mean")


def spread(df: DataFrame, target: str) -> DataFrame:
    x = number(target)
    return df.agg(F.stddev_samp(x).alias("sd"), F.min(x).alias("low"), F.max(x).alias("high"),
                  F.avg(x).alias("mean"), F.count(F.lit(1)).alias("n_rows"))


def change(old_new: DataFrame, is_new: Column, columns) -> DataFrame:
    """Means of both periods and their differences, all columns in one pass over the stacked rows."""
    aggs = []
    for i, c in enumerate(columns):
        x = number(c)
        aggs += [F.avg(F.when(~is_new, x)).alias(f"__{i}o"), F.avg(F.when(is_new, x)).alias(f"__{i}n")]
    wide = old_new.agg(*aggs)
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("node"), F.col(f"__{i}o").alias("mean_old"), F.col(f"__{i}n").alias("mean_new"))
                                          for i, c in enumerate(columns)])))
    return (long.withColumn("difference", F.col("mean_new") - F.col("mean_old"))
            .withColumn("growth_pct", growth_pct(F.col("mean_old"), F.col("mean_new")))
            .withColumn("drop_pct", drop_pct(F.col("mean_old"), F.col("mean_new"))))


def histograms(df: DataFrame, columns, bins: int = 20) -> DataFrame:
    """Equal-width counts per column, ``(node, bin, low, high, n)``.

    One pass for the bounds, one for the counts; rows collapse to at most ``bins`` per column before
    the shuffle.
    """
    bounds = df.agg(*[e for i, c in enumerate(columns) for e in (F.min(number(c)).alias(f"__{i}lo"), F.max(number(c)).alias(f"__{i}hi"))])
    bounds = bounds.select(F.inline(F.array(*[F.struct(F.lit(c).alias("node"), F.col(f"__{i}lo").alias("lo"), F.col(f"__{i}hi").alias("hi"))
                                              for i, c in enumerate(columns)])))
    long = df.select(*[number(c).alias(c) for c in columns]).unpivot([], list(columns), "node", "x")
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (long.dropna().join(F.broadcast(bounds), "node")  # bounds has one row per column
            .groupBy("node", "lo", "hi", slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("node", "bin", (F.col("lo") + F.col("bin") * width).alias("low"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), "n"))


def pairwise(df: DataFrame, columns) -> DataFrame:
    """Correlation of every pair of columns from one pass, long ``(left, right, corr)``.

    A row counts for a pair if both values are there.
    """
    pairs = list(combinations(sorted(columns), 2))
    wide = df.agg(*[F.corr(number(a), number(b)).alias(f"p{i}")
                    for i, (a, b) in enumerate(pairs)])
    rows = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {rows}) as (left_node, right_node, corr)")


def pairwise_counts(df: DataFrame, columns, bins: int = 8) -> DataFrame:
    """Two-dimensional counts of every pair of columns: the data behind a scatter matrix. Complete rows only."""
    columns = sorted(columns)
    df = df.filter(complete(columns))
    lows = df.agg(*[e for c in columns for e in (F.min(F.col(c).cast("double")).alias(f"{c}__lo"),
                                                 F.max(F.col(c).cast("double")).alias(f"{c}__hi"))]).first()
    slots = {}
    for c in columns:
        low, high = lows[f"{c}__lo"], lows[f"{c}__hi"]
        step = ((high - low) / bins) if high is not None else 0.0
        x = F.col(c).cast("double")
        slots[c] = (F.least(F.floor((x - low) / step), F.lit(bins - 1)) if step > 0 else F.lit(0)).cast("int")
    cells = F.array(*[F.struct(F.lit(a).alias("left_node"), F.lit(b).alias("right_node"),
                               slots[a].alias("left_bin"), slots[b].alias("right_bin"))
                      for a, b in combinations(columns, 2)])
    return (df.select(F.explode(cells).alias("c")).select("c.*")
            .groupBy("left_node", "right_node", "left_bin", "right_bin").agg(F.count(F.lit(1)).alias("n")))


def to_percent(scores: DataFrame, score: str, by=()) -> DataFrame:
    """Absolute share of the total in percent, beside the signed score.

    Scores come with one row per node and result key, so a window holds no more rows than the graph
    has nodes.
    """
    size = F.abs(F.col(score))
    total = F.sum(size).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))
    return scores.withColumn("percent", F.when(total > 0, size / total * 100.0).otherwise(0.0))


def head(df: DataFrame, order, n: int = 5) -> DataFrame:
    return df.orderBy(*([order] if isinstance(order, (str, Column)) else order)).limit(n)


def first_row(df: DataFrame, order) -> DataFrame:
    return head(df, order, 1)


def top_causes(scores: DataFrame, k: int, by=(), score: str = "score", node: str = "node") -> DataFrame:
    """The k highest scores per result key, ties by name."""
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    rank = F.row_number().over(window.orderBy(F.desc(score), F.asc(node)))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def round_half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)
