"""Uploads told apart by content, stored results, and the registry of loggers."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.session import written

LOG = "fingerprint string, name string, bytes long, uploaded timestamp_ntz, path string"
RESULTS = "run string, label string, memo string, created timestamp_ntz, tables long"


def fingerprint(content: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the content."""
    return F.substring(F.sha2(content.cast("binary"), 256), 1, 16)


def uploads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files by content, without what they hold."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(fingerprint(F.col("content")).alias("fingerprint"), F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("length").alias("bytes"), "path")


def first_of_each(files: DataFrame, order: str) -> DataFrame:
    """One file for each content, the first by ``order``, and how many there were."""
    rest = [c for c in files.columns if c != "fingerprint"]
    out = files.groupBy("fingerprint").agg(F.min_by(F.struct(*rest), F.struct(order)).alias("_f"), F.count(F.lit(1)).alias("copies"))
    return out.select("fingerprint", *[F.col(f"_f.{c}").alias(c) for c in rest], "copies")


def unknown(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files whose content the log does not have."""
    return files.join(log.select("fingerprint").distinct(), "fingerprint", "left_anti")


def save_uploads(spark: SparkSession, paths: list[str], log_path: str, now: datetime) -> DataFrame:
    """Log new contents; returns them. Copies of known contents are passed over."""
    at = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    known = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    log = spark.read.schema(LOG).parquet(log_path) if known else spark.createDataFrame([], LOG)
    new = unknown(first_of_each(uploads(spark, paths), "path"), log).drop("copies").withColumn("uploaded", F.lit(now).cast("timestamp_ntz"))
    new.select("fingerprint", "name", "bytes", "uploaded", "path").write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path).where(F.col("uploaded") == F.lit(now).cast("timestamp_ntz"))


KEPT = "digest string, name string, bytes long, uploaded timestamp_ntz, path string, load long"


def _log(spark: SparkSession, root: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/log")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], KEPT)
    return spark.read.schema(KEPT).parquet(f"{root}/log")


def keep(spark: SparkSession, paths: list[str], root: str, now: datetime) -> DataFrame:
    """Copy files whose content is new into the store at ``root``; returns the log's rows of them (``KEPT``).

    Tasks read the files and write each content under its SHA-256 (``objects/digest=...``), from where it is never changed:
    a run that was cut short is repeated and writes the same bytes in the same place. A content counts as kept once the log
    has it, which is written last. The uploads of one call are one load; loads are numbered in order.
    """
    files = spark.read.format("binaryFile").load(paths)
    found = files.select(F.sha2("content", 256).alias("digest"), F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("length").alias("bytes"), F.col("path").cast("string").alias("path"))
    log = _log(spark, root)
    rest = ["name", "bytes", "path"]
    first = found.groupBy("digest").agg(F.min_by(F.struct(*rest), "path").alias("f")).select("digest", *[F.col(f"f.{c}").alias(c) for c in rest])
    load = (log.agg(F.max("load")).first()[0] or 0) + 1
    new = written(first.join(log.select("digest"), "digest", "left_anti").withColumns({"uploaded": F.lit(now).cast("timestamp_ntz"), "load": F.lit(load).cast("long")}), "uploads")
    if new.isEmpty():
        return new.select(*[c.split()[0] for c in KEPT.split(", ")])
    objects = files.join(new.select("path", "digest"), "path").select("content", "digest")
    objects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("digest").parquet(f"{root}/objects")
    new.select(*[c.split()[0] for c in KEPT.split(", ")]).write.mode("append").parquet(f"{root}/log")
    return new.select(*[c.split()[0] for c in KEPT.split(", ")])


def stored(spark: SparkSession, root: str, loads: list[int] | None = None) -> DataFrame:
    """``path, content, load`` of what the store keeps (of some loads), by the names that the files had; contents of which the bytes changed raise."""
    log = _log(spark, root).groupBy("digest").agg(F.min_by("name", "load").alias("name"), F.min("load").alias("load"))
    log = log if loads is None else log.where(F.col("load").isin(loads))
    objects = spark.read.schema("content binary, digest string").parquet(f"{root}/objects")
    same = F.when(F.sha2("content", 256) != F.col("digest"), F.raise_error(F.concat(F.lit("changed in the store: "), "digest")).cast("binary")).otherwise(F.col("content"))
    return objects.join(log, "digest").select(F.concat_ws("/", "digest", "name").alias("path"), same.alias("content"), "load")


def save_result(tables: dict[str, DataFrame], root: str, label: str, now: datetime, memo: str = "", kind: str = "parquet") -> str:
    """Write each table under a folder of its own run, as Parquet or csv, and note the run in the index; a run of the same second and label gets a number."""
    spark = next(iter(tables.values())).sparkSession
    first = run = f"{now:%Y%m%d-%H%M%S}-{label}"
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs, n = at.getFileSystem(spark._jsc.hadoopConfiguration()), 1
    while not fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(root)) or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/run={run}")):
        n += 1
        run = f"{first}({n})"
    for name, df in tables.items():
        df.write.mode("errorifexists").format(kind).options(**({"header": True} if kind == "csv" else {})).save(f"{root}/run={run}/{name}")
    spark.createDataFrame([(run, label, memo, now, len(tables))], RESULTS).write.mode("append").parquet(f"{root}/index")
    return run


def results(spark: SparkSession, root: str) -> DataFrame:
    """Runs, the newest first."""
    return spark.read.parquet(f"{root}/index").orderBy(F.desc("created"), F.desc("run"))


def load_registry(path: str | Path) -> dict:
    import yaml

    p = Path(path)
    return {"loggers": {}} if not p.exists() else yaml.safe_load(p.read_text(encoding="utf-8")) or {"loggers": {}}


def save_registry(registry: dict, path: str | Path) -> None:
    import yaml

    Path(path).write_text(yaml.safe_dump(registry, allow_unicode=True, sort_keys=True), encoding="utf-8")


def set_zone(registry: dict, serial: str, zone: str) -> dict:
    registry.setdefault("loggers", {}).setdefault(str(serial), {})["zone"] = zone
    return registry


def touch(registry: dict, seen: DataFrame, keep: int = 5) -> dict:
    """Note each logger's period and files. ``seen``: ``serial, model, file, first, last``, a row for each file."""
    stats = seen.groupBy("serial").agg(F.max("model").alias("model"), F.min("first").alias("first"), F.max("last").alias("last"), F.slice(F.reverse(F.array_sort(F.collect_set("file"))), 1, keep).alias("recent"), F.count_distinct("file").alias("files"))
    for r in stats.collect():  # a row for each logger
        own = registry.setdefault("loggers", {}).setdefault(str(r.serial), {"zone": "", "files": 0})
        stretch = [own.get("first_seen"), own.get("last_seen")]
        own["model"] = r.model or own.get("model", "")
        own["first_seen"] = min(x for x in (stretch[0], str(r["first"])) if x)
        own["last_seen"] = max(x for x in (stretch[1], str(r["last"])) if x)
        own["files"] = int(own.get("files") or 0) + r.files
        own["recent_files"] = (list(r.recent) + [f for f in own.get("recent_files", []) if f not in r.recent])[:keep]
    return registry


def registry_table(spark: SparkSession, registry: dict) -> DataFrame:
    rows = [(str(k), v.get("zone", ""), v.get("model", ""), str(v.get("first_seen", "")), str(v.get("last_seen", "")), int(v.get("files") or 0)) for k, v in (registry.get("loggers") or {}).items()]
    return spark.createDataFrame(rows, "serial string, zone string, model string, first_seen string, last_seen string, files int").orderBy("zone", "serial")
