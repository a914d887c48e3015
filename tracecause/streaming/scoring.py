"""Score arriving rows and log requests and responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracecause.operators.anomaly import REFERENCE_DRAWS, attribute_anomalies, attribute_wide
from tracecause.operators.frames import complete, row_key
from tracecause.operators.mechanisms import CausalModel
from tracecause.operators.shapley import unpivot_players
from tracecause.sources.registry import ModelRegistry


def score(registry: ModelRegistry, model: str, df: DataFrame, target: str, keep, alias: str = "champion",
          draws: int = REFERENCE_DRAWS, seed: int = 0) -> DataFrame:
    """Attributions of the rows of ``df`` under a registered model."""
    version = registry.resolve(model, alias)
    registry.check_input(model, version, df)
    return attribute_anomalies(registry.load_model(model, version=version), df, target, keep, draws, seed=seed)


def score_batch(batch: DataFrame, fitted: CausalModel, target: str, keep, draws: int, seed: int) -> DataFrame:
    """One row per request: its keys, its JSON and the shares of all nodes side by side.

    The request travels with its scores, so no join brings them together again.
    """
    rows = batch.withColumn("request_json", F.to_json(F.struct("*")))
    return attribute_wide(fitted, rows, target, [*keep, "request_json"], draws, seed=seed)[0]


def log_rows(batch: DataFrame, wide: DataFrame, model: str, version: int, keep, nodes) -> DataFrame:
    """``(ts, row_key, model, version, request_json, response_json)`` per request.

    Rows too incomplete to score are logged without a response.
    """
    answered = wide.select(row_key(*keep).alias("row_key"), "request_json",
                           F.to_json(F.struct(*[F.col(f"__p{j}").alias(n) for j, n in enumerate(nodes)]))
                           .alias("response_json"))
    refused = batch.filter(~complete(nodes)).select(
        row_key(*keep).alias("row_key"), F.to_json(F.struct("*")).alias("request_json"),
        F.lit(None).cast("string").alias("response_json"))
    return answered.unionByName(refused).select(
        F.current_timestamp().alias("ts"), "row_key", F.lit(model).alias("model"), F.lit(version).alias("version"),
        "request_json", "response_json")


def score_stream(source: DataFrame, registry: ModelRegistry, model: str, target: str, keep, results: str, log: str,
                 checkpoint: str, alias: str = "champion", draws: int = REFERENCE_DRAWS, seed: int = 0,
                 available_now: bool = True) -> StreamingQuery:
    """Start scoring a stream; results and log go to ``batch_id`` partitions of two parquet folders.

    The alias is resolved once per batch, so all rows of a batch meet the same model. A replayed batch
    overwrites its own partition: nothing is scored or logged twice.
    """
    keep = [keep] if isinstance(keep, str) else list(keep)

    loaded: dict[int, CausalModel] = {}

    def handle(batch: DataFrame, batch_id: int) -> None:
        version = registry.resolve(model, alias)
        if version not in loaded:  # versions never change, so one load each is enough
            loaded.clear()
            loaded[version] = registry.load_model(model, version=version)
        fitted = loaded[version]
        nodes = fitted.graph.closure(target)
        rows = batch.persist()
        wide = score_batch(rows, fitted, target, keep, draws, seed).persist()
        try:
            scores = unpivot_players(wide, nodes, keep).withColumn("version", F.lit(version))
            scores.write.mode("overwrite").parquet(f"{results}/batch_id={batch_id}")
            log_rows(rows, wide, model, version, keep, nodes).write.mode("overwrite").parquet(
                f"{log}/batch_id={batch_id}")
        finally:
            wide.unpersist()
            rows.unpersist()

    writer = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_results(spark: SparkSession, results: str) -> DataFrame:
    return spark.read.parquet(results).drop("batch_id")
