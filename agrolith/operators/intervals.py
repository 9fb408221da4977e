"""Days to survey intervals, and intervals to growth measurements."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SUMS = ("dli", "gdd", "solar_MJ")
KEEP_NAME = ("vpd_day", "photoperiod_h")


def _date(x) -> date:
    if isinstance(x, date):
        return x
    try:
        return date.fromisoformat(str(x).strip().replace("/", "-").replace(".", "-"))
    except ValueError as e:
        raise ValueError(f"not a date: {x!r}") from e


def survey_dates(dates: list | None = None, start=None, end=None, interval: int | None = None, count: int | None = None) -> list[date]:
    """Survey dates, distinct and sorted: a list, or a start with a step and a count or an end."""
    if dates:
        return sorted({_date(x) for x in dates})
    if start is None or not interval or interval <= 0:
        raise ValueError("survey dates need a list, or a start and a positive interval")
    first = _date(start)
    if count:
        return [first + timedelta(days=interval * i) for i in range(int(count))]
    if end is None:
        raise ValueError("survey dates need a count or an end")
    last = _date(end)
    if last < first:
        raise ValueError("the last survey date lies before the first")
    return [first + timedelta(days=i) for i in range(0, (last - first).days + 1, interval)]


def planned(sites: DataFrame, keys: list[str], start: str, step: str, count=None, end: str | None = None) -> DataFrame:
    """``keys, survey``: the survey dates of each site, from its ``start`` every ``step`` days, ``count`` of them or up to ``end``.

    Sites without a start, a positive step, or a count or end, and those that end before they start, have none. Dates are made where the
    site's row is, and no more of them than the result has.
    """
    if (count is None) == (end is None):
        raise ValueError("survey dates need a count or an end")
    ok = F.col(step) > 0
    days = F.when(ok, F.col(step).cast("int"))
    n = count if count is not None else F.floor(F.datediff(F.col(end), F.col(start)) / days).cast("int") + 1
    steps = sites.where(ok & F.col(start).isNotNull()).withColumn("_n", F.when(F.datediff(F.col(end), F.col(start)) >= 0, n) if end is not None else n).where("_n > 0")
    each = steps.select(*keys, F.col(start).alias("_start"), days.alias("_step"), F.explode(F.sequence(F.lit(0), F.col("_n").cast("int") - 1)).alias("_i"))
    return each.select(*keys, F.date_add("_start", F.col("_i") * F.col("_step")).alias("survey"))


def listed(dates: DataFrame, keys: list[str], column: str = "survey") -> DataFrame:
    """``keys, survey``: the distinct dates of each site's own list, nulls left out."""
    return dates.select(*keys, F.to_date(column).alias("survey")).where("survey is not null").distinct()


def cadence(surveys: DataFrame, column: str = "growth_date") -> DataFrame:
    """One row, ``days``: the most frequent distance of distinct survey dates, of equally frequent ones the least; 0 for under two.

    Survey dates are few (field visits), so their one window is small.
    """
    dates = surveys.select(F.to_date(column).alias("d")).where("d is not null").distinct()
    gaps = dates.select(F.datediff("d", F.lag("d").over(W.orderBy("d"))).alias("gap")).where("gap is not null")
    counts = gaps.groupBy("gap").count()
    return counts.agg(F.coalesce(F.min_by("gap", F.struct(-F.col("count"), F.col("gap"))), F.lit(0)).cast("long").alias("days"))


def definitions(surveys: DataFrame, column: str = "growth_date", first_start=None, lag_days: int = 0, window_days: int | None = None) -> DataFrame:
    """``interval_id, growth_date, start_date, end_date, days_expected, lag_days`` of each survey date.

    With a window each interval is the window's days up to its survey; otherwise it starts the day after the
    survey before, and the first by ``first_start`` or one cadence back (7 days if there is none). A lag shifts both ends.
    """
    d = surveys.select(F.to_date(column).alias("growth_date")).where("growth_date is not null").distinct()
    order = W.orderBy("growth_date")
    if window_days:
        start = F.date_sub("growth_date", window_days - 1)
        d = d.withColumn("_days", F.lit(0))
    else:
        d = d.crossJoin(F.broadcast(cadence(surveys, column).withColumnRenamed("days", "_days")))  # one row
        step = F.when(F.col("_days") > 0, F.col("_days")).otherwise(7).cast("int")
        first = F.lit(_date(first_start)) if first_start is not None else F.date_add(F.date_sub("growth_date", step), 1)
        start = F.coalesce(F.date_add(F.lag("growth_date").over(order), 1), first)
    out = d.select(F.row_number().over(order).cast("long").alias("interval_id"), "growth_date", start.alias("_s"), F.col("growth_date").alias("_e"))
    shifted = out.select("interval_id", "growth_date", F.date_sub("_s", lag_days).alias("start_date"), F.date_sub("_e", lag_days).alias("end_date"))
    return shifted.select("*", (F.datediff("end_date", "start_date") + 1).cast("long").alias("days_expected"), F.lit(lag_days).cast("long").alias("lag_days"))


def days_of(intervals: DataFrame) -> DataFrame:
    """A row for each interval and day, so that days meet intervals by an equal date and not by a range."""
    return intervals.where("start_date <= end_date").select("interval_id", F.explode(F.sequence("start_date", "end_date")).alias("date"))


def measures(columns: list[str]) -> list[tuple[str, str, str]]:
    """(name, function, source) of each column's aggregate, by what its name ends with."""
    out = []
    for c in columns:
        if c in SUMS:
            out += [(f"{c}_sum", "sum", c), (f"{c}_mean", "avg", c)]
        elif c.endswith("_missing_ratio"):
            out.append((c, "ratio", c))
        elif c.endswith("_min"):
            out += [(c, "min", c), (f"{c}_mean", "avg", c)]
        elif c.endswith("_max"):
            out += [(c, "max", c), (f"{c}_mean", "avg", c)]
        elif c.endswith("_mean") or c in KEEP_NAME:
            out.append((c, "avg", c))
        else:
            out.append((f"{c}_mean", "avg", c))
    return out


def aggregate(daily: DataFrame, intervals: DataFrame, keys: list[str] | None = None, drop_incomplete: bool = False) -> DataFrame:
    """Each interval's aggregate over its days, for each key; intervals without days stay, with no values.

    Intervals may overlap. ``daily``: keys, ``date``, measures, and perhaps ``completeness`` and ``is_complete``.
    """
    keys = keys or []
    known = {"date", "n_records", "expected", "completeness", "is_complete", *keys}
    columns = [c for c in daily.columns if c not in known]
    used = daily.where("is_complete") if drop_incomplete and "is_complete" in daily.columns else daily
    agg = [F.count("date").alias("days_used")]
    if "completeness" in daily.columns:
        agg.append(F.bround(F.avg("completeness"), 3).alias("record_completeness"))
    if "is_complete" in daily.columns:
        agg.append(F.sum((~F.col("is_complete")).cast("long")).alias("n_incomplete_days"))
    for name, how, c in measures(columns):
        value = {"sum": F.coalesce(F.sum(c), F.lit(0.0)), "avg": F.avg(c), "min": F.min(c), "max": F.max(c), "ratio": F.bround(F.avg(c), 4)}[how]
        agg.append(value.alias(name))
    # Surveys are field visits, so the table of their days is small; Spark sends it or shuffles it by its size.
    met = used.join(days_of(intervals), "date").groupBy(*keys, "interval_id").agg(*agg)
    frame = intervals
    if keys:
        frame = used.select(*keys).distinct().crossJoin(intervals)  # keys (loggers, treatments) by intervals: the result's own rows
    out = frame.join(met, [*keys, "interval_id"], "left")
    used_days = F.coalesce("days_used", F.lit(0)).cast("long")
    return out.withColumns({"days_used": used_days, "day_coverage": F.bround(used_days / F.col("days_expected"), 3)})


def with_totals(summary: DataFrame, keys: list[str] | None = None, sums: tuple[str, ...] = SUMS) -> DataFrame:
    """Running totals ``cum_*`` of the sums in order of intervals, nulls as 0. A key has a row for each survey."""
    w = W.partitionBy(*(keys or [F.lit(1)])).orderBy("interval_id").rowsBetween(W.unboundedPreceding, 0)
    return summary.withColumns({f"cum_{c}": F.sum(F.coalesce(f"{c}_sum", F.lit(0.0))).over(w) for c in sums if f"{c}_sum" in summary.columns})


def with_flags(summary: DataFrame, least: float = 0.9) -> DataFrame:
    """``quality``: no data, too few days (used/expected), too few records, or normal."""
    few_days = F.when(F.col("day_coverage") < least, F.concat(F.lit("day shortage("), F.col("days_used").cast("string"), F.lit("/"), F.col("days_expected").cast("string"), F.lit(")")))
    parts = [few_days]
    if "record_completeness" in summary.columns:
        parts.append(F.when(F.col("record_completeness") < least, "record shortage"))
    text = F.concat_ws("; ", *parts)
    return summary.withColumn("quality", F.when(F.col("days_used") == 0, "no data").when(text != "", text).otherwise("normal"))


def match_growth(growth: DataFrame, summary: DataFrame, date_column: str = "date", treatment: str | None = None) -> DataFrame:
    """Growth rows with their interval's environment; rows without one stay.

    A summary with several rows for a survey date needs the key that tells them apart: without it the rows
    would multiply, so that raises.
    """
    keyed = [c for c in ("zone", "logger", "trt") if c in summary.columns]
    if set(keyed) - {treatment}:
        raise ValueError(f"the summary is by {keyed}: match by all of them, or select one first")
    on = [F.to_date(growth[date_column]) == summary["growth_date"]]
    if treatment:
        on.append(growth[treatment] == summary["trt"])
    drop = {"growth_date", "trt"} if treatment else {"growth_date"}
    right = [summary[c] for c in summary.columns if c not in drop and c not in growth.columns]
    return growth.join(summary, on, "left").select(*[growth[c] for c in growth.columns], *right)


def growth_rate(matched: DataFrame, values: list[str], group: list[str], date_column: str = "date", days: str = "days_expected") -> DataFrame:
    """Change of each value since the group's survey before, and that by day. A group has a row for each survey."""
    w = W.partitionBy(*group).orderBy(date_column)
    out = matched
    for v in values:
        delta = F.col(v) - F.lag(v).over(w)
        out = out.withColumns({f"{v}_delta": delta, f"{v}_rate": F.when(F.col(days) > 0, delta / F.col(days))})
    return out
