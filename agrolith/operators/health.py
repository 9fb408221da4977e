"""The state of each channel over its zone's last days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.operators.clean import outside, with_specs
from agrolith.operators.grid import window_of


def table(readings: DataFrame, specs: DataFrame, minutes: float, days: int = 7) -> DataFrame:
    """Received and missing share, values out of range, last value and time, mean, least, most, state.

    The window leaves out its very start, so a full one is not over 1. Channels that never had a value are left out.
    """
    expected = int(days * 1440 / minutes)
    recent = with_specs(window_of(readings, ["zone"], days, closed=False), specs)
    ever = readings.where("value is not null").select("zone", "channel").distinct()
    v = F.col("value")
    stats = recent.groupBy("zone", "channel").agg(
        F.count(v).alias("valid"), F.sum(outside().cast("long")).alias("out_of_range"), F.max_by(v, F.when(v.isNotNull(), F.col("ts"))).alias("last_value"),
        F.max(F.when(v.isNotNull(), F.col("ts"))).alias("last_seen"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
    )
    out = ever.join(stats, ["zone", "channel"], "left").withColumns({"valid": F.coalesce("valid", F.lit(0)), "out_of_range": F.coalesce("out_of_range", F.lit(0))})
    share = F.col("valid") / expected
    state = F.when((share >= 0.9) & (F.col("out_of_range") == 0), "normal").when(share >= 0.5, "caution").otherwise("danger")
    return out.select("zone", "channel", F.bround(share, 3).alias("received"), F.bround(1 - share, 3).alias("missing"), "out_of_range", "last_value", "mean", "min", "max", "last_seen", state.alias("status"))


def missing_heatmap(readings: DataFrame, minutes: float) -> DataFrame:
    """Share missing of each zone, date and channel."""
    from agrolith.operators.daily import expected_per_day

    out = readings.groupBy("zone", F.to_date("ts").alias("date"), "channel").agg(F.count("value").alias("n"))
    return out.select("zone", "date", "channel", F.bround(1 - F.col("n") / expected_per_day(minutes), 4).alias("missing_ratio"))
