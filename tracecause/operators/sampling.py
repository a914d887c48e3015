"""Row samples and bootstrap weights that depend on the row key alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.functions.randomness import poisson_weight, uniform


def sample(df: DataFrame, key: Column, frac: float, replicate=0, seed: int = 0, method: str = "md5") -> DataFrame:
    """Keep each row with probability ``frac``: a filter, so no shuffle and no exact row count."""
    return df.filter(uniform(key, "sample", replicate, seed, method) < frac)


def sample_exact(df: DataFrame, key: Column, frac: float, replicate=0, seed: int = 0, method: str = "md5",
                 small: int = 100_000) -> DataFrame:
    """Exactly ``round(frac * n)`` rows, those with the smallest hash; keys must be unique.

    The cut-off hash is found by counting: a histogram of hash values shows the slice in which the last
    row falls, and that slice is cut finer until it is small. Only the rows of the last slice are ranked,
    so there is no global sort and no global window.
    """
    slices = 4096
    tagged = df.withColumn("__u", uniform(key, "sample", replicate, seed, method))
    low, width, before, want = 0.0, 1.0, 0, None
    while True:
        inside = tagged.filter((F.col("__u") >= low) & (F.col("__u") < low + width))
        counts = (inside.groupBy(F.floor((F.col("__u") - low) / width * slices).cast("int").alias("slice"))
                  .agg(F.count(F.lit(1)).alias("n")).orderBy("slice").collect())  # at most 4096 rows
        if want is None:
            want = round(frac * sum(r.n for r in counts))
        last = None
        for r in counts:
            if before + r.n > want:
                last = r
                break
            before += r.n
        if last is None:  # every row of this slice is wanted
            return tagged.filter(F.col("__u") < low + width).drop("__u")
        low, width = low + last.slice * width / slices, width / slices
        if last.n <= small or width < 2.0 ** -50:
            break
    rest = (tagged.filter((F.col("__u") >= low) & (F.col("__u") < low + width))
            .orderBy("__u", key).limit(want - before))
    return tagged.filter(F.col("__u") < low).unionByName(rest).drop("__u")


def bootstrap_weights(df: DataFrame, key: Column, replicates: int, seed: int = 0,
                      method: str = "md5") -> DataFrame:
    """One copy of each row per replicate with a Poisson(1) weight.

    The copies are meant to go straight into a grouped aggregate, whose map side folds them up again.
    """
    copies = df.withColumn("__key", key).withColumn(
        "replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    return copies.withColumn("weight", poisson_weight(uniform(F.col("__key"), "boot", F.col("replicate"), seed,
                                                              method))).drop("__key")


def subsample_weights(df: DataFrame, key: Column, frac: float, replicates: int, seed: int = 0,
                      method: str = "md5") -> DataFrame:
    """Weights 0 and 1 that keep a share of the rows, drawn anew per replicate."""
    copies = df.withColumn("__key", key).withColumn(
        "replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    kept = uniform(F.col("__key"), "sample", F.col("replicate"), seed, method) < frac
    return copies.withColumn("weight", kept.cast("int")).drop("__key")
