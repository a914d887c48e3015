"""Fitted models as tables: versions, aliases, schemas and training runs.

All tables are append-only parquet under one path. A version exists once its ``runs`` row does.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import MECHANISM_SCHEMA, CausalModel
from tracecause.operators.noise import NoiseTable, StoredRows
from tracecause.sources.workspace import read_or_empty

SCHEMAS = {
    "edges": "model string, version int, parent string, child string",
    "mechanisms": "model string, version int, " + MECHANISM_SCHEMA,
    "aliases": "model string, alias string, version int, assigned_at timestamp, step int",
    "runs": "model string, version int, source_table string, source_version int, n_rows bigint, n_dropped bigint, "
            "graph_json string, input_schema string, output_schema string, params map<string,string>",
}


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{name}", SCHEMAS[name])

    def _append(self, name: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def versions(self) -> DataFrame:
        """``(model, version)`` with the newest integer version per model."""
        return self.table("runs").groupBy("model").agg(F.max("version").alias("version"))

    def latest_version(self, model: str) -> int:
        row = self.versions().filter(F.col("model") == model).first()
        if row is None:
            raise ValueError(f"no version of model {model!r}")
        return row.version

    def save_model(self, name: str, model: CausalModel, source_table: str = "", source_version: int = -1,
                   params: Mapping[str, str] | None = None, input_schema: T.StructType | None = None,
                   output_schema: T.StructType | None = None) -> int:
        """Append a model under the next version; one writer per model at a time."""
        row = self.versions().filter(F.col("model") == name).first()
        version = 1 if row is None else row.version + 1
        self._append("edges", [(name, version, p, c) for p, c in model.graph.edges] or [(name, version, None, None)])
        self._append("mechanisms", [(name, version, *r) for r in model.to_rows()])
        if model.noise is not None:
            model.noise.frame.write.mode("overwrite").parquet(self.noise_path(name, version))
        self._append("runs", [(name, version, source_table, source_version, model.n_rows, model.n_dropped,
                               model.graph.to_json(), input_schema.json() if input_schema else None,
                               output_schema.json() if output_schema else None,
                               {k: str(v) for k, v in (params or {}).items()})])
        return version

    def noise_path(self, model: str, version: int) -> str:
        return f"{self.path}/noise/model={model}/version={version}"

    def set_alias(self, model: str, alias: str, version: int) -> None:
        known = self.table("runs").filter((F.col("model") == model) & (F.col("version") == version))
        if known.isEmpty():
            raise ValueError(f"model {model!r} has no version {version}")
        step = self.table("aliases").agg(F.max("step").alias("s")).first().s
        row = self.spark.range(1).select(
            F.lit(model).alias("model"), F.lit(alias.lower()).alias("alias"), F.lit(version).alias("version"),
            F.current_timestamp().alias("assigned_at"), F.lit((step or 0) + 1).alias("step"))
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/aliases")

    def aliases(self) -> DataFrame:
        """``(model, alias, version)``: the newest assignment of each alias, case ignored."""
        return (self.table("aliases").groupBy("model", F.lower("alias").alias("alias"))
                .agg(F.max_by("version", "step").alias("version")))

    def resolve(self, model: str, alias: str) -> int:
        row = self.aliases().filter((F.col("model") == model) & (F.col("alias") == alias.lower())).first()
        if row is None:
            raise ValueError(f"model {model!r} has no alias {alias!r}")
        return row.version

    def load_model(self, model: str, alias: str | None = None, version: int | None = None) -> CausalModel:
        if version is None:
            version = self.resolve(model, alias) if alias else self.latest_version(model)
        mine = (F.col("model") == model) & (F.col("version") == version)
        run = self.table("runs").filter(mine).first()
        if run is None:
            raise ValueError(f"model {model!r} has no version {version}")
        rows = self.table("mechanisms").filter(mine).collect()
        found = CausalModel.from_rows(CausalGraph.from_json(run.graph_json), rows, run.n_rows, run.n_dropped)
        schema = ", ".join(["pos bigint"] + [f"`{r.node.replace('`', '``')}` double" for r in rows])
        noise = read_or_empty(self.spark, self.noise_path(model, version), schema)
        size = noise.count()
        return found.with_table(NoiseTable(StoredRows(noise, size))) if size else found

    def check_input(self, model: str, version: int, df: DataFrame) -> None:
        """Raise where a scoring table lacks a column of the training schema or has another type."""
        run = self.table("runs").filter((F.col("model") == model) & (F.col("version") == version)).first()
        if run is None or run.input_schema is None:
            return
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in T.StructType.fromJson(json.loads(run.input_schema)).fields:
            if f.name not in have:
                raise ValueError(f"column {f.name!r} is missing")
            if have[f.name] != f.dataType:
                raise ValueError(f"column {f.name!r} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
