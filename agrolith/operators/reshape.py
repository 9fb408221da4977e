"""Wide to long and back, numeric cells, representative channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.functions import names
from agrolith.functions.expressions import is_error, number


def unpivot(wide: DataFrame, keys: list[str], columns: list[str], channel: str = "channel", value: str = "value") -> DataFrame:
    """A row for each key and column; one pass, no shuffle."""
    return wide.unpivot(keys, columns, channel, value)


def pivot(long: DataFrame, keys: list[str], channels: list[str], channel: str = "channel", value: str = "value") -> DataFrame:
    """A column for each of the named channels, in the order of variables; naming them spares a job."""
    cols = sorted(channels, key=names.column_order)
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col(channel) == c, F.col(value))).alias(c) for c in cols])


def coerce(long: DataFrame, raw: str = "raw") -> DataFrame:
    """``value`` and ``is_error`` of a column of cells."""
    return long.withColumns({"value": number(F.col(raw)), "is_error": is_error(F.col(raw))})


def alive(long: DataFrame, keys: list[str]) -> DataFrame:
    """``usable`` and ``alive`` of each channel: whether it has values, and values that are not all 0 or all equal."""
    v = F.col("value")
    stats = long.groupBy(*keys).agg(F.count(v).alias("valid"), F.count(F.lit(1)).alias("rows"), F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.sum(F.coalesce(F.col("is_error"), F.lit(False)).cast("long")).alias("errors") if "is_error" in long.columns else F.lit(0).cast("long").alias("errors"))
    moving = (F.col("valid") > 0) & (F.col("_lo") < F.col("_hi"))
    return stats.select(*keys, "rows", "valid", (F.col("rows") - F.col("valid")).alias("missing"), "errors", (F.col("valid") > 0).alias("usable"), F.coalesce(moving, F.lit(False)).alias("alive"))


def mapping_report(long: DataFrame) -> DataFrame:
    """What became of each source column: its channel, counts of values, blanks and errors, and whether it is used."""
    found = alive(long, ["zone", "source", "channel", "base_var"])
    return found.withColumn("adopted", F.when(~F.col("usable"), "empty port").when(~F.col("alive"), "dead port").otherwise("in use"))


def representative(long: DataFrame, key: str = "zone") -> DataFrame:
    """For each zone and variable the readings of its first live channel, of its first channel if none is live."""
    state = alive(long, [key, "base_var", "channel", "rep"]).where("usable")
    chosen = state.groupBy(key, "base_var").agg(F.min_by("channel", F.struct((~F.col("alive")).cast("int"), "rep")).alias("chosen"))
    both = long.join(chosen, [key, "base_var"])
    return both.where(F.col("channel") == F.col("chosen")).select(key, "ts", "base_var", "channel", "value")


def replicate_mean(long: DataFrame, key: str = "zone") -> DataFrame:
    """For each zone, time and variable the mean over live channels; a variable with none has its first channel."""
    state = alive(long, [key, "base_var", "channel", "rep"]).where("usable")
    live = state.groupBy(key, "base_var").agg(F.max("alive").alias("_any"), F.min_by("channel", "rep").alias("_first"))
    kept = state.join(live, [key, "base_var"]).where(F.col("alive") | (~F.col("_any") & (F.col("channel") == F.col("_first")))).select(key, "base_var", "channel")
    return long.join(kept, [key, "base_var", "channel"], "left_semi").groupBy(key, "ts", "base_var").agg(F.avg("value").alias("value"), F.count("value").alias("sensors"))
