"""The archive of readings: zones, collisions, upsert, summaries, guarded replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.operators.grid import interval_minutes, on_grid, snapped

KEYS = ["zone", "ts", "channel"]


def zone_of(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Readings with their logger's zone; a logger without a name is its own zone."""
    named = registry.select("serial", F.nullif(F.trim("zone"), F.lit("")).alias("_zone"))
    return readings.join(named, "serial", "left").withColumn("zone", F.coalesce("_zone", "serial")).drop("_zone")


def renamed_collisions(readings: DataFrame) -> DataFrame:
    """Channels of one name that several loggers of a zone bring: the first keeps it, later ones are numbered on.

    The order of loggers is that of their first load; numbers go on after the highest of the zone. The rename table has
    a row for each zone, logger and channel.
    """
    known = readings.groupBy("zone", "base_var", "channel", "rep", "serial").agg(F.min("load_ord").alias("_ord"))
    by_name = W.partitionBy("zone", "channel").orderBy("_ord", "serial")
    known = known.withColumn("_n", F.row_number().over(by_name))
    base = W.partitionBy("zone", "base_var")
    known = known.withColumn("_top", F.greatest(F.max("rep").over(base), F.lit(1)))
    late = known.where("_n > 1").withColumn("_k", F.row_number().over(base.orderBy("_ord", "serial", "rep")))
    number = F.col("_top") + F.col("_k")
    table = late.select("zone", "serial", "channel", F.concat_ws("__rep", "base_var", number.cast("string")).alias("_to"), number.cast("int").alias("_rep"))
    out = readings.join(table, ["zone", "serial", "channel"], "left")
    return out.withColumns({"channel": F.coalesce("_to", "channel"), "rep": F.coalesce("_rep", "rep")}).select(*readings.columns)


def upsert(readings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One reading for each key: the first value by ``load_ord`` that is not null.

    A newer load has the lower ``load_ord``, so it wins where it has a value, and older loads fill its gaps.
    Combined before the shuffle.
    """
    keys = keys or KEYS
    order = F.struct("load_ord", "serial")
    has = F.col("value").isNotNull()
    agg = [F.min_by("value", F.when(has, order)).alias("value"), F.min_by("serial", F.when(has, order)).alias("_serial"), F.min("serial").alias("_any")]
    return readings.where(F.col("ts").isNotNull()).groupBy(*keys).agg(*agg).select(*keys, F.coalesce("_serial", "_any").alias("serial"), "value")


def serials(readings: DataFrame, keys: list[str]) -> DataFrame:
    """The loggers behind each key, sorted, joined by ``+``; joined names are taken apart first."""
    parts = F.flatten(F.collect_set(F.split(F.col("serial").cast("string"), r"\+")))
    return readings.groupBy(*keys).agg(F.array_join(F.array_sort(F.array_distinct(parts)), "+").alias("serial"))


def summary(readings: DataFrame, minutes: float | None = None) -> DataFrame:
    """Each zone's period, times, grid, missing slots and variables."""
    times = readings.select("zone", "ts").distinct()
    ends = times.groupBy("zone").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("rows"))
    out = ends.withColumn("interval_minutes", F.lit(float(minutes))) if minutes else ends.join(interval_minutes(readings, ["zone"]), "zone")
    seen = readings.where("value is not null").groupBy("zone").agg(F.array_join(F.array_sort(F.collect_set("base_var")), ",").alias("variables"))
    us = F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    slots = F.floor(us / (F.col("interval_minutes") * 60_000_000)).cast("long") + 1
    out = out.withColumns({"span_days": F.floor(us / 86_400_000_000).cast("long") + 1, "grid_rows": slots})
    out = out.withColumn("missing", F.col("grid_rows") - F.col("rows")).withColumn("missing_ratio", F.bround(F.col("missing") / F.col("grid_rows"), 4))
    return out.join(seen, "zone", "left").select("zone", "start", "end", "span_days", "rows", "interval_minutes", "grid_rows", "missing", "missing_ratio", "variables")


def daily_counts(readings: DataFrame, keys: list[str]) -> DataFrame:
    return readings.groupBy(*keys, F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("records"))


def cleaned(readings: DataFrame, specs: DataFrame, seconds: int) -> DataFrame:
    """Out-of-range values gone, every channel on the full grid."""
    from agrolith.operators.clean import masked

    return on_grid(masked(readings, specs), ["zone", "channel", "base_var", "rep"], seconds)


def build(spark: SparkSession, batches: list[DataFrame], master: DataFrame | None, registry: DataFrame, seconds: int) -> DataFrame:
    """The new master of ``batches``, newest first, and the old master, which only fills what they leave."""
    loads = [zone_of(snapped(b, seconds), registry).withColumn("load_ord", F.lit(i).cast("long")) for i, b in enumerate(batches)]
    if master is not None:
        loads.append(master.withColumn("load_ord", F.lit(len(loads)).cast("long")))
    cols = ["zone", "serial", "ts", "channel", "base_var", "rep", "value", "load_ord"]
    every = loads[0].select(*cols)
    for x in loads[1:]:
        every = every.unionByName(x.select(*cols))
    return upsert(renamed_collisions(every), ["zone", "ts", "channel", "base_var", "rep"])


SCHEMA = "ts timestamp_ntz, channel string, base_var string, rep int, serial string, value double, zone string"


def _paths(spark: SparkSession, *names: str):
    found = [spark._jvm.org.apache.hadoop.fs.Path(n) for n in names]
    return found[0].getFileSystem(spark._jsc.hadoopConfiguration()), found


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The master at ``path``, None where there is none; one that cannot be read raises.

    Zones are texts, however they look. A replacement that was cut short is first brought to its end or undone.
    """
    fs, (here, old) = _paths(spark, path, f"{path}.before")
    if not fs.exists(here) and fs.exists(old):
        _moved(fs, old, here)
    return spark.read.schema(SCHEMA).parquet(path) if fs.exists(here) else None


def _moved(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def shrunk(before: DataFrame, after: DataFrame) -> DataFrame:
    """Loggers of the old master of which the new one has fewer readings, or a shorter period."""

    def each(df: DataFrame, p: str) -> DataFrame:
        own = df.select(F.explode(F.split(F.col("serial").cast("string"), r"\+")).alias("serial"), "zone", "channel", "ts", "value")
        return own.groupBy("serial").agg(F.count("value").alias(f"{p}n"), F.min("ts").alias(f"{p}from"), F.max("ts").alias(f"{p}to"))

    both = each(before, "old_").join(each(after, "new_"), "serial", "left")
    return both.where("new_n is null or new_n < old_n or new_from > old_from or new_to < old_to")


def replace_guarded(spark: SparkSession, master: DataFrame, path: str, staging: str) -> None:
    """Write to ``staging`` and put it in the old master's place, unless a logger would vanish or shrink.

    Rows are dealt by ranges of zone and time, so a large zone is no single task. The old table stays under
    ``<path>.before`` until the new one is in place; ``read`` takes it back if the move between was cut short.
    """
    before = read(spark, path)
    cols = SCHEMA.split(", ")
    typed = master.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in cols])
    typed.repartitionByRange("zone", "ts").sortWithinPartitions("zone", "channel", "ts").write.mode("overwrite").partitionBy("zone").parquet(staging)
    fs, (here, new, old) = _paths(spark, path, staging, f"{path}.before")
    if before is not None:
        lost = [r.serial for r in shrunk(before, spark.read.schema(SCHEMA).parquet(staging)).limit(20).collect()]
        if lost:
            raise ValueError(f"refused: the new archive lacks loggers or readings of them: {lost}")
        fs.delete(old, True)
        _moved(fs, here, old)
    _moved(fs, new, here)
    fs.delete(old, True)
