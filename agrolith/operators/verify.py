"""Checks of sensors against references: pairs, verdicts, due dates, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.config import LIGHT
from agrolith.functions.expressions import between_hours
from agrolith.operators.stats import correlation, slope

LOG = "date date, logger_id string, sensor_id string, sensor_type string, variable string, check_type string, reference_value double, sensor_value double, deviation double, rel_deviation double, result string, operator string, action string, note string"
LEAST_PAIRS = 6


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], LOG)


def pairs(readings: DataFrame, reference: str, test: str, keys: list[str], start=None, end=None, daytime: tuple[int, int] | None = None) -> DataFrame:
    """``ref`` and ``test`` of each key and time that has both channels."""
    rows = readings.where(F.col("channel").isin(reference, test) & F.col("value").isNotNull())
    for bound, op in ((start, lambda c, b: c >= b), (end, lambda c, b: c <= b)):
        if bound is not None:
            rows = rows.where(op(F.col("ts"), F.lit(bound).cast("timestamp_ntz")))
    if daytime:
        rows = rows.where(between_hours(F.hour("ts"), *daytime))
    both = rows.groupBy(*keys, "ts").agg(F.max(F.when(F.col("channel") == reference, F.col("value"))).alias("ref"), F.max(F.when(F.col("channel") == test, F.col("value"))).alias("test"))
    return both.where("ref is not null and test is not null")


def compare(both: DataFrame, keys: list[str]) -> DataFrame:
    """Bias, errors, correlation and line of each key with at least ``LEAST_PAIRS`` pairs."""
    diff, n = F.col("test") - F.col("ref"), F.count(F.lit(1))
    out = both.groupBy(*keys).agg(
        n.alias("n"), (F.sum("ref") / n).alias("ref_mean"), (F.sum("test") / n).alias("test_mean"), (F.sum(diff) / n).alias("bias"), (F.sum(F.abs(diff)) / n).alias("mae"),
        F.sqrt(F.sum(diff * diff) / n).alias("rmse"), F.covar_pop("test", "ref").alias("_xy"), F.var_pop("ref").alias("_xx"), F.var_pop("test").alias("_yy"),
        F.min("ts").alias("start"), F.max("ts").alias("end"),
    )
    line = slope(F.col("_xy"), F.col("_xx"))
    r = correlation(F.col("_xy"), F.col("_xx"), F.col("_yy"))
    cols = [*keys, "n", "ref_mean", "test_mean", "bias", "mae", "rmse", r.alias("r"), line.alias("slope"), (F.col("test_mean") - line * F.col("ref_mean")).alias("intercept"), "start", "end"]
    return out.where(F.col("n") >= LEAST_PAIRS).select(*cols)


def cross_check(both: DataFrame, keys: list[str], variable: str, tolerance: dict[str, float]) -> DataFrame:
    """``compare`` with a verdict. Light is judged by its relative bias, the bias by the mean size of the reference; others by their bias.

    ``result``: pass, fail, or unknown without a tolerance, and for light also where the reference is all zero. Bounds are inclusive.
    Keys with fewer than ``LEAST_PAIRS`` pairs have their ``n`` and ``result`` "too_few", and null figures.
    """
    base = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), (F.sum(F.abs("ref")) / F.count(F.lit(1))).alias("_size"))
    told = compare(both, keys).withColumnsRenamed({k: f"_of_{k}" for k in keys})
    j = base.join(told, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], "left")
    relative = F.when(F.col("_size") > 0, F.col("bias") / F.when(F.col("_size") > 0, F.col("_size"))) if variable in LIGHT else F.lit(None).cast("double")
    judged_by, limit = F.abs("rel_bias" if variable in LIGHT else "bias"), F.lit(tolerance.get(variable)).cast("double")
    result = F.when(F.col("_n") < LEAST_PAIRS, "too_few").when(judged_by <= limit, "pass").when(judged_by > limit, "fail").otherwise("unknown")
    figures = ["ref_mean", "test_mean", "bias", "mae", "rmse", "r", "slope", "intercept", "start", "end"]
    return j.withColumn("rel_bias", relative).select(*keys, F.lit(variable).alias("variable"), F.col("_n").alias("n"), *figures, "rel_bias", limit.alias("tolerance"), result.alias("result"))


def daily_pairs(both: DataFrame, keys: list[str]) -> DataFrame:
    diff = F.col("test") - F.col("ref")
    n = F.count(F.lit(1))
    return both.groupBy(*keys, F.to_date("ts").alias("date")).agg(n.alias("n"), (F.sum("ref") / n).alias("ref_mean"), (F.sum("test") / n).alias("test_mean"), (F.sum(diff) / n).alias("bias"), (F.sum(F.abs(diff)) / n).alias("mae"), F.max(F.abs(diff)).alias("max_abs_diff"))


def judged(checks: DataFrame, tolerance: dict[str, float]) -> DataFrame:
    """``result``: pass or fail by the variable's tolerance (relative for light), null without one or without a value."""
    t = checks.sparkSession.createDataFrame([(k, float(v)) for k, v in tolerance.items()], "variable string, _tol double")
    relative = F.abs(F.when(F.col("reference_value") != 0, F.col("deviation") / F.when(F.col("reference_value") != 0, F.col("reference_value"))))
    size = F.when(F.col("variable").isin(list(LIGHT)), relative).otherwise(F.abs("deviation"))
    out = checks.join(F.broadcast(t), "variable", "left").withColumn("result", F.when(size <= F.col("_tol"), "pass").when(size > F.col("_tol"), "fail"))
    return out.drop("_tol")


def recorded(checks: DataFrame, tolerance: dict[str, float]) -> DataFrame:
    """Checks with deviation, relative deviation and verdict derived."""
    dev = F.col("sensor_value") - F.col("reference_value")
    rel = F.when(F.col("reference_value") != 0, dev / F.when(F.col("reference_value") != 0, F.col("reference_value")))
    return judged(checks.withColumns({"deviation": dev, "rel_deviation": rel}), tolerance)


def due_status(log: DataFrame, sensors: DataFrame, schedule: dict[str, int], today, imminent: int = 3) -> DataFrame:
    """Each sensor (``logger_id, sensor_id, variable``) and check of the schedule: when last, when next, and how late.

    The schedule is a few rows of the configuration, so the product has a few rows for each sensor.
    """
    plan = log.sparkSession.createDataFrame([(k, int(v)) for k, v in schedule.items()], "check_type string, period int")
    on = ["logger_id", "sensor_id", "variable"]
    last = log.groupBy(*on, "check_type").agg(F.max("date").alias("last_date"))
    every = sensors.select(*on).distinct().crossJoin(F.broadcast(plan)).join(last, [*on, "check_type"], "left")
    late = F.datediff(F.lit(today).cast("date"), F.date_add("last_date", F.col("period")))
    status = F.when(F.col("last_date").isNull(), "never").when(F.col("overdue_days") > 0, "late").when(F.col("overdue_days") > -imminent, "imminent").otherwise("ok")
    out = every.withColumn("next_date", F.date_add("last_date", F.col("period"))).withColumn("overdue_days", late).withColumn("status", status)
    order = F.when(F.col("status") == "late", 0).when(F.col("status") == "never", 1).when(F.col("status") == "imminent", 2).otherwise(3)
    return out.select(*on, "check_type", "period", "last_date", "next_date", "overdue_days", "status").orderBy(order, F.desc_nulls_last("overdue_days"), *on, "check_type")


def drift(log: DataFrame, keys: list[str]) -> DataFrame:
    """The line of deviations over days of each sensor with three checks or more: slope by day and by year, last deviation, and the period."""
    rows = log.where("deviation is not null and date is not null")
    first = rows.groupBy(*keys).agg(F.min("date").alias("_first"))
    d = rows.join(first, keys).withColumn("_x", F.datediff("date", "_first").cast("double"))
    out = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("_x", "deviation").alias("_xy"), F.var_pop("_x").alias("_xx"), F.max_by("deviation", F.struct("date", "deviation")).alias("last_deviation"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    by_day = slope(F.col("_xy"), F.col("_xx"))
    return out.where("n >= 3").select(*keys, "n", F.bround(by_day, 6).alias("slope_per_day"), F.bround(by_day * 365, 4).alias("slope_per_year"), "last_deviation", "first_date", "last_date")


def drift_history(log: DataFrame, keys: list[str]) -> DataFrame:
    """Each check with a deviation of the sensors that ``drift`` tells of, with its number in the sensor's order and the change since the one before.

    A sensor's checks are few (a person makes each), so its window is small. Checks of one day go by their kind, then their deviation.
    """
    rows = log.where("deviation is not null and date is not null").select(*keys, "date", "check_type", "deviation", "result")
    own = W.partitionBy(*keys)
    order = own.orderBy("date", "check_type", "deviation", "result")
    every = rows.withColumns({"_n": F.count(F.lit(1)).over(own), "number": F.row_number().over(order), "change": F.col("deviation") - F.lag("deviation").over(order)})
    return every.where("_n >= 3").drop("_n")
