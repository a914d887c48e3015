"""The shared folder that checkpoints and intermediate tables go to."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Only a local session may fall back to its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tracecause-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet rows at a path, none if nothing was written there yet; any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and go on from the file.

    A lost executor costs a read, and the next join knows how large the rows are.
    """
    path = fresh_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, as ``--py-files`` would.

    Operators whose maps use functions of the package call it; so do callers of the functions of a subpackage.
    """
    context = spark.sparkContext
    if getattr(context, "_tracecause_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(package):
            for path in (os.path.join(folder, name) for name in names if name.endswith(".py")):
                z.write(path, os.path.relpath(path, os.path.dirname(package)))
    archive = fresh_path(spark, "package") + ".zip"
    store, place = fs.FileSystem.from_uri(archive)
    store.create_dir(os.path.dirname(place), recursive=True)
    with store.open_output_stream(place, compression=None) as out:
        out.write(packed.getvalue())
    context.addPyFile(archive)
    context._tracecause_sent = True
