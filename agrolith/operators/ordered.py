"""Ordered operators that cut long series into days.

A series is one key's rows in time order. Spark puts all rows of a window's key into one task, so a key
with a third of all rows would be one task. Here windows run over (key, day) only; what passes from
one day to the next comes from a table with one row for each key and day, which is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("_day", F.to_date(F.col(ts)))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = a["_day"] == b["_day"]
    for k in keys:
        cond &= a[k].eqNullSafe(b[k])
    return cond


def with_previous(df: DataFrame, keys: list[str], ts: str, cols: dict[str, str]) -> DataFrame:
    """Adds, for each ``old: new`` in ``cols``, the value of ``old`` in the row before, null in the first row.

    (key, ts) must be unique.
    """
    df = _day(df, ts)
    here = W.partitionBy(*keys, "_day").orderBy(ts)
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)])
    ends = df.groupBy(*keys, "_day").agg(F.max_by(packed, F.col(ts)).alias("_end"))
    ends = ends.withColumn("_carry", F.lag("_end").over(W.partitionBy(*keys).orderBy("_day"))).drop("_end")
    local = df.withColumn("_row", F.row_number().over(here)).withColumn("_prev", F.lag(packed).over(here))
    both = local.join(ends, _same(local, ends, keys), "left")
    before = F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    kept = [local[c] for c in df.columns if c != "_day"]
    return both.select(*kept, *[before[f"_{i}"].alias(new) for i, new in enumerate(cols.values())])


def running_sum(df: DataFrame, keys: list[str], ts: str, value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (nulls as 0) over the key's rows up to this one."""
    df = _day(df.withColumn(out, F.coalesce(value, F.lit(0))), ts)
    sums = df.groupBy(*keys, "_day").agg(F.sum(out).alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(W.partitionBy(*keys).orderBy("_day")) - F.col("_sum")).drop("_sum")
    local = df.withColumn("_local", F.sum(out).over(W.partitionBy(*keys, "_day").orderBy(ts)))
    both = local.join(sums, _same(local, sums, keys))
    return both.select(*[local[c] for c in df.columns if c not in ("_day", out)], (F.col("_local") + F.col("_before")).alias(out))


def islands(df: DataFrame, keys: list[str], ts: str, holds: Column) -> DataFrame:
    """The rows where ``holds``, with ``island``: a number for each maximal run of successive such rows of a key."""
    marked = df.withColumn("_holds", F.coalesce(holds, F.lit(False)))
    before = with_previous(marked, keys, ts, {"_holds": "_held"})
    start = F.col("_holds") & ~F.coalesce(F.col("_held"), F.lit(False))
    return running_sum(before, keys, ts, start.cast("long"), "island").where("_holds").drop("_holds", "_held")
