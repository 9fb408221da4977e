"""Session defaults for local runs, tests and the bench; a cluster brings its own session."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


_local: dict[str, str] = {}


def session(name: str = "agrolith") -> SparkSession:
    """The session of a job. Its master comes from spark-submit or the environment; one without any runs locally."""
    if "spark.master" in dict(SparkConf().getAll()) or os.environ.get("SPARK_REMOTE") or SparkSession.getActiveSession():
        return _settings(SparkSession.builder.appName(name)).getOrCreate()
    return local_session(name=name)


def _settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """What the engine assumes: UTC, AQE, Arrow."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def local_session(cpus: int | None = None, partitions: int | None = None, name: str = "agrolith") -> SparkSession:
    """A ``local[n]`` session, for tests and the bench."""
    n = cpus or os.cpu_count() or 4
    return (
        _settings(SparkSession.builder.master(f"local[{n}]").appName(name))
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.driver.memory", os.environ.get("AGROLITH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a local one in local mode (tests), an error on a cluster."""
    ship(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="agrolith-")
    return _local[app]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: what several results read is made once, and lost executors cost no more than their tasks."""
    path = f"{shared_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster gets it by ``--py-files`` or an image; this serves sessions started from another folder.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
