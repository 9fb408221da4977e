"""Readings outside what a sensor can measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_specs(readings: DataFrame, specs: DataFrame) -> DataFrame:
    """Readings with their variable's specification; unknown variables have no bounds.

    ``specs`` has a row for each configured variable, so it is sent to all tasks.
    """
    return readings.join(F.broadcast(specs), "base_var", "left")


def outside(value: str = "value"):
    v = F.col(value)
    return v.isNotNull() & F.coalesce((v < F.col("lo")) | (v > F.col("hi")), F.lit(False))


def masked(readings: DataFrame, specs: DataFrame) -> DataFrame:
    """Readings with values out of range made null, repetitions of a variable as well."""
    out = with_specs(readings, specs)
    return out.withColumn("value", F.when(~outside(), F.col("value"))).select(*readings.columns)


def range_report(readings: DataFrame, specs: DataFrame, keys: list[str]) -> DataFrame:
    """How many readings of each channel are out of range, and their share of all rows, to five places (half to even)."""
    counted = with_specs(readings, specs).groupBy(*keys).agg(F.sum(outside().cast("long")).alias("masked"), F.count(F.lit(1)).alias("rows"))
    return counted.where("masked > 0").select(*keys, "masked", F.bround(F.col("masked") / F.col("rows"), 5).alias("ratio"))
