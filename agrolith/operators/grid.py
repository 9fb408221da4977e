"""Time grids: the interval of a logger, snapping, dense spines, gaps, keep-first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.functions.expressions import snap
from agrolith.operators.ordered import islands, with_previous

INSERTED, ORIGINAL = "missing_timestamp_inserted", "original"


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first by ``order``. Combined before the shuffle, so no key's rows meet in one task."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def interval_minutes(df: DataFrame, keys: list[str], ts: str = "ts", default: float = 10.0) -> DataFrame:
    """The most frequent positive distance of successive times of each key, of equally frequent ones the least.

    Seconds count, so a logger that writes every 2.5 minutes has 2.5. Keys with under three times get ``default``.
    """
    times = df.select(*keys, ts).where(F.col(ts).isNotNull()).distinct()
    step = with_previous(times, keys, ts, {ts: "_before"}).withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp")))
    counts = step.where("_us > 0").groupBy(*keys, "_us").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.min_by("_us", F.struct(-F.col("n"), F.col("_us"))).alias("_us"), F.sum("n").alias("_n"))
    all_keys = times.select(*keys).distinct()
    found = F.when(F.col("_n") >= 2, F.col("_us") / 60_000_000.0).otherwise(F.lit(float(default)))
    return all_keys.join(best, keys, "left").select(*keys, F.coalesce(found, F.lit(float(default))).alias("interval_minutes"))


def snapped(df: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    """Times on the grid; several readings of one slot stay as they are."""
    return df.withColumn(ts, snap(F.col(ts), seconds))


def spine(df: DataFrame, keys: list[str], seconds: int, ts: str = "ts") -> DataFrame:
    """Every slot of each key from its first to its last time."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    return ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr(f"interval {seconds} seconds"))).alias(ts))


def on_grid(df: DataFrame, keys: list[str], seconds: int, ts: str = "ts") -> DataFrame:
    """``df`` with a row for each missing slot too; ``qc_status`` tells them apart. Times must be snapped."""
    slots = spine(df, keys, seconds, ts)
    found = slots.join(df.withColumn("_seen", F.lit(True)), [*keys, ts], "left")
    return found.withColumn("qc_status", F.when(F.col("_seen"), ORIGINAL).otherwise(INSERTED)).drop("_seen")


def gap_runs(grid: DataFrame, keys: list[str], minutes: float, ts: str = "ts") -> DataFrame:
    """Maximal runs of inserted slots: first and last missing slot, their number, their minutes."""
    runs = islands(grid.select(*keys, ts, "qc_status").distinct(), keys, ts, F.col("qc_status") == INSERTED)
    found = runs.groupBy(*keys, "island").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("missing"))
    return found.select(*keys, "start", "end", "missing", (F.col("missing") * F.lit(float(minutes))).alias("minutes"))


def gaps_between(df: DataFrame, keys: list[str], minutes: float, ts: str = "ts") -> DataFrame:
    """Gaps of readings that are on no grid: the readings around each, and how many are missing between."""
    step = with_previous(df.select(*keys, ts).distinct(), keys, ts, {ts: "start"})
    us = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    missing = F.floor(us / F.lit(minutes * 60_000_000)).cast("long") - 1
    found = step.withColumn("missing", missing).where("start is not null and missing > 0")
    return found.select(*keys, "start", F.col(ts).alias("end"), "missing", (F.col("missing") * F.lit(float(minutes))).alias("minutes"))


def gap_report(gaps: DataFrame) -> DataFrame:
    """Gaps, the longest first."""
    return gaps.orderBy(F.desc("missing"), "start")


def window_of(df: DataFrame, keys: list[str], days: int | None, now=None, ts: str = "ts", closed: bool = True) -> DataFrame:
    """Rows of the last ``days`` before ``now`` or each key's last time; ``closed``: with the row at the very start."""
    if not days:
        return df
    if now is not None:
        edge = F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {days} days")
        return df.where(F.col(ts) >= edge if closed else F.col(ts) > edge)
    last = df.groupBy(*keys).agg((F.max(ts) - F.expr(f"interval {days} days")).alias("_edge"))
    both = df.join(last, keys)
    return both.where(F.col(ts) >= F.col("_edge") if closed else F.col(ts) > F.col("_edge")).drop("_edge")


def latest(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key; keys' rows must be few (days, surveys, files)."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where(F.col("_n") <= n).drop("_n")
