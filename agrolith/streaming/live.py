"""The engine on streams: days with watermarks, upserts into the archive, alerts with a cool-down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agrolith.operators.archive import upsert


def read(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(path)


def daily(readings: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Number, mean, least and most of each zone, channel and day; a day closes ``lateness`` after its end."""
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    days = timed.groupBy("zone", "channel", F.window("ts", "1 day").alias("w")).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    return days.select("zone", "channel", F.to_date("w.start").alias("date"), "n", "mean", "min", "max")


def cooled(alerts: DataFrame, hours: int = 12) -> DataFrame:
    """Alerts (``key``, ``detected_at``) once within the cool-down; state lasts no longer than that."""
    return alerts.withWatermark("detected_at", f"{hours} hours").dropDuplicatesWithinWatermark(["key"])


def offline(readings: DataFrame, minutes: int = 120) -> DataFrame:
    """Sessions of each zone: one ends when nothing came for ``minutes``, so each closed session is a loss of contact."""
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{minutes} minutes")
    s = timed.groupBy("zone", F.session_window("ts", f"{minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("records"), F.max("ts").alias("last_seen"))
    return s.select("zone", "last_seen", "records", F.col("w.end").alias("lost_at"))


ARCHIVE = "ts timestamp_ntz, channel string, serial string, value double, epoch long, zone string, date date"


def archived(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The archive that ``upserted`` keeps: each zone's day as its latest batch wrote it (of batches ``before``)."""
    rows = spark.read.schema(ARCHIVE).parquet(path)
    rows = rows if before is None else rows.where(F.col("epoch") < before)
    latest = rows.groupBy("zone", "date").agg(F.max("epoch").alias("epoch"))
    return rows.join(latest, ["zone", "date", "epoch"], "left_semi").drop("epoch")


def upserted(readings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each batch into the archive under ``path``: newer readings win, older ones fill gaps.

    A batch reads and writes the days of zones that it has readings of, and no others; it writes them beside the older ones and
    ``archived`` takes the latest. So a batch that runs twice gives the same table, and one cut short leaves the table as it was.
    """
    spark, cols = readings.sparkSession, ["zone", "date", "ts", "channel", "serial", "value"]
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)  # an archive without days yet can be read

    def put(batch: DataFrame, epoch: int) -> None:
        new = batch.where("ts is not null and zone is not null").withColumn("date", F.to_date("ts")).select(*cols)
        old = archived(batch.sparkSession, path, epoch).join(new.select("zone", "date").distinct(), ["zone", "date"], "left_semi").select(*cols)
        both = new.withColumn("load_ord", F.lit(0).cast("long")).unionByName(old.withColumn("load_ord", F.lit(1).cast("long")))
        days = upsert(both, ["zone", "date", "ts", "channel"]).repartition("zone", "date")  # a logger's day is a small group
        days.write.mode("overwrite").partitionBy("zone", "date").parquet(f"{path}/epoch={epoch}")

    return readings.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that a stream has so far, as a table in memory; for tests and small results."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def kept(days: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All days that a stream has so far, open ones too, as a table under ``path``: of each zone, channel and day the latest update."""
    spark, values = days.sparkSession, ["n", "mean", "min", "max"]
    spark.createDataFrame([], days.schema).write.mode("overwrite").parquet(f"{path}/epoch=-1")

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    days.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    latest = spark.read.parquet(path).groupBy("zone", "channel", "date").agg(F.max_by(F.struct(*values), "epoch").alias("v"))
    return latest.select("zone", "channel", "date", *[F.col(f"v.{c}").alias(c) for c in values])
