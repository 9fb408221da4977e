"""Readings to days: one aggregation, whatever the variables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.functions.expressions import between_hours, vpd

#: Variables whose days have a mean alone.
MEAN_ONLY = ("ec", "co2")


def expected_per_day(minutes: float) -> int:
    return max(round(1440 / minutes), 1)


def summary(readings: DataFrame, keys: list[str], minutes: float) -> DataFrame:
    """For each key, date and channel: number of readings, mean, least and most, share missing (half to even)."""
    expected = expected_per_day(minutes)
    days = readings.groupBy(*keys, "channel", F.to_date("ts").alias("date")).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    return days.withColumn("missing_ratio", F.bround(1 - F.col("n") / expected, 4))


def _stats(v: str, kinds: str) -> list[Column]:
    named = {"mean": F.avg, "min": F.min, "max": F.max}
    return [named[k](v).alias(f"{v}_{k}") for k in kinds.split()]


def wide_summary(wide: DataFrame, keys: list[str], minutes: float, gdd_base: float = 10.0, photoperiod_threshold: float = 10.0, daytime_hours=(9, 15), min_completeness: float = 0.9) -> DataFrame:
    """The daily table of a wide frame: temperatures, humidity, VPD, light sums, growing degree days, completeness.

    Columns of ``wide`` other than the keys and ``ts`` are channels. Values are averaged by record, so
    VPD is never made of daily means.
    """
    channels = [c for c in wide.columns if c not in (*keys, "ts", "serial", "qc_status")]
    has = set(channels)
    seconds, expected = minutes * 60, expected_per_day(minutes)
    df = wide
    if {"temp", "rh"} <= has:
        df = df.withColumn("vpd", vpd(F.col("temp"), F.col("rh")))
    day = between_hours(F.hour("ts"), *daytime_hours)
    any_value = F.coalesce(*[F.col(c) for c in channels]).isNotNull()
    out = [F.sum(any_value.cast("long")).alias("n_records")]
    for v in channels:
        if v == "temp":
            out += [*_stats(v, "mean min max"), (F.max(v) - F.min(v)).alias("temp_amp"), F.greatest(F.avg(v) - gdd_base, F.lit(0.0)).alias("gdd")]
        elif v == "ppfd":
            lit = F.col(v) > photoperiod_threshold
            out += [
                F.coalesce(F.sum(v) * seconds / 1e6, F.lit(0.0)).alias("dli"),
                F.bround(F.sum(lit.cast("long")) * minutes / 60, 2).alias("photoperiod_h"),
                F.coalesce(F.avg(F.when(lit, F.col(v))), F.lit(0.0)).alias("ppfd_day_mean"),
                F.max(v).alias("ppfd_max"),
            ]
        elif v == "solar":
            out += [F.coalesce(F.sum(v) * seconds / 1e6, F.lit(0.0)).alias("solar_MJ"), F.max(v).alias("solar_max")]
        else:
            out += _stats(v, "mean" if v in MEAN_ONLY else "mean min max")
        out.append(F.bround(1 - F.count(v) / expected, 4).alias(f"{v}_missing_ratio"))
    if "vpd" in df.columns and "vpd" not in has:
        out += [F.avg("vpd").alias("vpd_mean"), F.avg(F.when(day, F.col("vpd"))).alias("vpd_day")]
    found = df.groupBy(*keys, F.to_date("ts").alias("date")).agg(*out)
    complete = F.bround(F.col("n_records") / expected, 4)
    return found.withColumns({"expected": F.lit(expected), "completeness": complete, "is_complete": complete >= min_completeness})


def light(readings: DataFrame, keys: list[str], minutes: float, threshold: float) -> DataFrame:
    """Light sum, lit hours, mean of lit readings and most light of each day."""
    lit = F.col("value") > threshold
    out = readings.groupBy(*keys, F.to_date("ts").alias("date")).agg(F.sum("value").alias("_sum"), F.sum(lit.cast("long")).alias("_lit"), F.avg(F.when(lit, F.col("value"))).alias("_mean"), F.max("value").alias("light_max"))
    return out.select(*keys, "date", (F.coalesce("_sum", F.lit(0.0)) * (minutes * 60) / 1e6).alias("dli"), F.bround(F.col("_lit") * minutes / 60, 2).alias("photoperiod_h"), F.coalesce("_mean", F.lit(0.0)).alias("light_day_mean"), "light_max")


def degree_days(readings: DataFrame, keys: list[str], base: float) -> DataFrame:
    """Mean, amplitude and growing degree days of each day."""
    out = readings.groupBy(*keys, F.to_date("ts").alias("date")).agg(F.avg("value").alias("mean"), (F.max("value") - F.min("value")).alias("amp"))
    return out.withColumn("gdd", F.greatest(F.col("mean") - base, F.lit(0.0)))


def completeness(readings: DataFrame, keys: list[str], minutes: float, least: float = 0.9) -> DataFrame:
    """Times with any value of each day against those expected."""
    expected = expected_per_day(minutes)
    seen = readings.where("value is not null").select(*keys, "ts").distinct()
    out = seen.groupBy(*keys, F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n_records"))
    share = F.bround(F.col("n_records") / expected, 4)
    return out.select(*keys, "date", "n_records", share.alias("completeness"), (share >= least).alias("is_complete"))
