"""How the test tables stand in for logger data: events as sensor readings, order lines and orders as a second clock.

A zone is ``user_id % 4``; event types play variables; a reading is the last event of its hour, in whole units, so
that sums are exact in any order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith import config

VARIABLES = {"click": "temp", "purchase": "soil_temp", "signup": "rh", "view": "ppfd", "error": "solar"}
MINUTES = 60.0
SECONDS = 3600
NOW = datetime(2024, 1, 31, 6)
DAILY_START = "1995-03-01"
#: What the queries set beside the defaults, so that each rule meets its case in data of this kind.
SETTINGS = config.deep_merge(config.DEFAULTS, {"qc": {"night_light_enabled": True, "rh_saturated_level": 30, "rh_saturated_hours": 2, "flatline_ignore_zero": ["ppfd", "solar"], "pair_divergence_enabled": True, "spike_warn_count": 2}, "sensors": {"rh": {"flat_minutes": 60}, "temp": {"flat_minutes": 60}, "soil_temp": {"flat_minutes": 60}, "ppfd": {"flat_minutes": 60}, "solar": {"flat_minutes": 60}}})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variable():
    out = None
    for event, var in VARIABLES.items():
        out = F.when(F.col("event_type") == event, var) if out is None else out.when(F.col("event_type") == event, var)
    return out


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reading: ``zone, serial, ts`` (its hour), ``base_var, v, event_id``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") % 4).cast("string").alias("zone"), F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("serial"), (F.col("user_id") % 3 + 1).cast("int").alias("rep"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), variable().alias("base_var"), F.floor(F.col("value") + 0.5).cast("double").alias("v"), "event_id",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone, ts, channel, base_var, rep, value``, one for each zone, hour and variable."""
    r = raw(spark, sf_dir).groupBy("zone", "ts", F.col("base_var").alias("channel")).agg(F.max_by("v", "event_id").alias("value"))
    return r.select("zone", "ts", "channel", F.col("channel").alias("base_var"), F.lit(0).alias("rep"), "value")


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with three repetitions of each variable in a zone."""
    r = raw(spark, sf_dir).groupBy("zone", "ts", "base_var", "rep").agg(F.max_by("v", "event_id").alias("value"))
    return r.select("zone", "ts", F.concat_ws("__rep", "base_var", F.col("rep").cast("string")).alias("channel"), "base_var", "rep", "value")


def gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from agrolith.operators.grid import on_grid

    return on_grid(readings(spark, sf_dir), ["zone", "channel", "base_var", "rep"], SECONDS)


def daily_environment(spark: SparkSession, sf_dir: str, treatment: bool = False) -> DataFrame:
    """Order lines as days: sums of quantity as light, means in thousandths as temperature."""
    li = table(spark, sf_dir, "lineitem")
    keys = [F.col("l_returnflag").alias("trt")] * treatment + [F.to_date("l_shipdate").alias("date")]
    n = F.count(F.lit(1))
    return li.groupBy(*keys).agg(
        F.sum("l_quantity").alias("dli"), F.floor(F.avg("l_quantity") * 1000 + 0.5).cast("double").alias("temp_mean"), F.max("l_quantity").alias("temp_max"), F.min("l_quantity").alias("temp_min"),
        F.least(n / 2.0, F.lit(1.0)).alias("completeness"), (n >= 2).alias("is_complete"),
    )


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey dates: the days that have orders."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("growth_date"))


def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.substring("o_orderstatus", 1, 1).alias("trt"), F.floor(F.col("o_totalprice") + 0.5).cast("double").alias("weight"))
