"""Exact medians of groups of any size, without a group's values in one buffer.

A sketch of each group (bounded, combined before the shuffle) gives two values between which the middle ranks lie; one more pass counts what
lies below and keeps only what lies between, each value once with its number. The middle ranks are then found among a few thousandths of
the group's different values. The counts are exact, and a sketch that was wrong would be seen and raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def medians(df: DataFrame, keys: list[str], value: str, accuracy: int = 2000, parts: int = 32) -> DataFrame:
    """``keys, median``: of an even number of values the mean of the two middle ones, as ``median`` does. Null values do not count; a group of none has null.

    A sketch has an error of ``1 / accuracy`` of a group's values in rank, so some ``6 / accuracy`` of them lie between its bounds.
    ``parts``: into how many ranges the values between the bounds are cut for their running counts. The sketches, a row for each group,
    meet the values by a join that Spark sends to all tasks where they are small and splits by size where they are not.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    off = 2.0 / accuracy
    near = F.percentile_approx("_v", [0.5 - off, 0.5 + off], accuracy)
    about = rows.groupBy(*keys).agg(near.alias("_near"), F.count("_v").alias("_n"))
    about = about.select(*keys, "_n", F.col("_near")[0].alias("_a"), F.col("_near")[1].alias("_b"))
    # Below and above the bounds a group is two rows; a value that half of the group has is one row.
    side = F.when(F.col("_v") < F.col("_a"), -1).when(F.col("_v") > F.col("_b"), 1).otherwise(0)
    width = F.col("_b") / 2 - F.col("_a") / 2
    part = F.coalesce(F.when((side == 0) & (width > 0), F.least(F.floor((F.col("_v") / 2 - F.col("_a") / 2) / width * parts), F.lit(parts))), F.lit(0))
    met = _meet(rows, about, keys).select(*keys, "_n", side.alias("_side"), part.alias("_part"), F.when(side == 0, F.col("_v")).alias("_v")).where("_side <> 0 or _v is not null or _n = 0")
    values = met.groupBy(*keys, "_n", "_side", "_part", "_v").agg(F.count(F.lit(1)).alias("_c"))
    order = W.partitionBy(*keys).orderBy("_side", "_part")  # rows: keys x parts
    sums = values.groupBy(*keys, "_side", "_part").agg(F.sum("_c").alias("_sum"))
    sums = sums.withColumn("_start", F.sum("_sum").over(order) - F.col("_sum")).drop("_sum")
    ranked = _meet(values, sums, [*keys, "_side", "_part"]).withColumn("_to", F.col("_start") + F.sum("_c").over(W.partitionBy(*keys, "_side", "_part").orderBy("_v")))
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # ranks from 0
    at = lambda rank: F.max(F.when((F.col("_to") - F.col("_c") <= rank) & (rank < F.col("_to")), F.struct("_side", "_v")))
    found = ranked.groupBy(*keys, "_n").agg(at(lo).alias("_lo"), at(hi).alias("_hi"))
    middle = F.col("_lo._v") * 0.5 + F.col("_hi._v") * 0.5
    held = (F.col("_lo._side") == 0) & (F.col("_hi._side") == 0)
    told = F.raise_error(F.lit("a sketch of a group was wrong: medians need a larger accuracy")).cast("double")
    return found.select(*keys, F.when(F.col("_n") == 0, F.lit(None)).when(held, middle).otherwise(told).alias("median"))


def _meet(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joined on keys that may be null."""
    b = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return a.join(b, cond, how).drop(*[f"_k{i}" for i in range(len(keys))])
