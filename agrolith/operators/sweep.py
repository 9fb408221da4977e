"""Seven rules in one pass over the readings, sorted once by zone, channel and day.

Out of range, flat lines, spikes, dark days, light at night, saturated humidity and heat all look at a channel in time order, or at
its days. So the readings are shuffled and sorted once by (zone, channel, day); each row learns of the row before it and of
the run of equal (or saturated) readings it ends, and a day becomes one row: its counts and extremes, its first and last reading, and its runs that
are long enough or touch midnight. What passes midnight (a jump, a run) is put together from those rows, a row for each channel and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.config import LIGHT, specs
from agrolith.functions.expressions import between_hours
from agrolith.operators.clean import outside, with_specs

CHANNEL = ["zone", "channel"]
ABOUT = ["base_var", "rep", "spike", "need", "floor"]  # a channel has one of each
ITEM = "rule string, begin timestamp_ntz, end timestamp_ntz, n long, v double, lo double, hi double, joins boolean"


def _no(c: Column) -> Column:
    return ~F.coalesce(c, F.lit(False))


def _with_limits(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """Readings with what their variable may do: bounds, the jump allowed in an interval, how many equal readings are too many and above which value they count."""
    qc = cfg["qc"]
    rows = with_specs(grid.select(*CHANNEL, "base_var", "rep", "ts", "value"), specs(grid.sparkSession, cfg))
    need = F.greatest(F.bround(F.coalesce("flat_minutes", F.lit(float(cfg["other_flat_minutes"]))) / minutes), F.lit(2.0))
    light, ignored = F.col("base_var").isin(list(LIGHT)), F.col("base_var").isin(list(qc["flatline_ignore_zero"]))
    floor = F.when(light & ignored, float(qc["flatline_light_floor"])).when(ignored, 0.0)
    allowed = F.when(~light, F.col("spike") * minutes / 10)
    return rows.select(*CHANNEL, "base_var", "rep", "ts", "value", outside().alias("out"), allowed.alias("spike"), need.alias("need"), floor.alias("floor"), F.to_date("ts").alias("date"))


def _equal(value: str, before: str) -> Column:
    return (F.col(value) == F.col(before)) & (F.col("floor").isNull() | (F.col(value) > F.col("floor")))


def _jump(value: str, before: str) -> Column:
    return F.abs(F.col(value) - F.col(before)) > F.col("spike")


def _saturated(value: str, cfg: dict) -> Column:
    return F.coalesce((F.col("base_var") == "rh") & (F.col(value) >= cfg["qc"]["rh_saturated_level"]), F.lit(False))


def _most(cfg: dict) -> Column:
    return F.when(F.col("base_var") == "temp", float(cfg["qc"]["heat_event_temp"])).otherwise(float(cfg["qc"]["heat_event_soil_temp"]))


def days(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """A row for each zone, channel and day. (zone, channel, ts) must be unique, and a channel of one variable and repetition.

    ``flat`` and ``wet`` are arrays of the day's runs ``(first, last, n, begin, end, v)``, where ``first`` and ``last`` say that the run has
    the day's first or last row.
    """
    qc = cfg["qc"]
    here = W.partitionBy(*CHANNEL, "date").orderBy("ts")
    so_far = here.rowsBetween(W.unboundedPreceding, 0)
    rows = _with_limits(grid, cfg, minutes)
    rows = rows.withColumns({"no": F.row_number().over(here), "before": F.lag("value").over(here), "last": F.lead(F.lit(1)).over(here).isNull()})
    rows = rows.withColumns({"equal": F.coalesce(_equal("value", "before"), F.lit(False)), "sat": _saturated("value", cfg), "sat_before": _saturated("before", cfg)})
    first_flat, first_wet = F.when(~F.col("equal"), F.struct("no", "ts")), F.when(F.col("sat") & ~F.col("sat_before"), F.struct("no", "ts"))
    rows = rows.withColumns({
        "flat_from": F.last(first_flat, True).over(so_far), "wet_from": F.last(first_wet, True).over(so_far),
        "flat_ends": _no(F.lead("equal").over(here)), "wet_ends": F.col("sat") & _no(F.lead("sat").over(here)),
    })

    def runs(begin: str, ends: str, need: Column) -> Column:
        n = (F.col("no") - F.col(begin)["no"] + 1).cast("long")
        edge = (F.col(begin)["no"] == 1) | F.col("last")
        run = F.struct((F.col(begin)["no"] == 1).alias("first"), F.col("last").alias("last"), n.alias("n"), F.col(begin)["ts"].alias("begin"), F.col("ts").alias("end"), F.col("value").alias("v"))
        return F.collect_list(F.when(F.col(ends) & (edge | (n >= need)), run))

    light, soil = F.col("base_var").isin(list(LIGHT)), F.col("base_var").isin("temp", "soil_temp") & (F.col("rep") <= 1)
    at = lambda hours: between_hours(F.hour("ts"), *hours)
    value, hot = F.col("value"), F.col("value") > _most(cfg)
    count = lambda c: F.count(F.when(c, 1))
    return rows.groupBy(*CHANNEL, *ABOUT, "date").agg(
        count(F.col("out")).alias("n_out"), F.min(F.when(F.col("out"), value)).alias("out_lo"), F.max(F.when(F.col("out"), value)).alias("out_hi"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), count(_jump("value", "before")).alias("jumps"),
        F.max(F.when(light & at(qc["noon_hours"]), value)).alias("noon"), F.max(F.when((F.col("base_var") == "ppfd") & at(qc["night_hours"]), value)).alias("night"),
        count(soil & hot).alias("n_hot"), F.min_by("value", "ts").alias("v_first"), F.max_by("value", "ts").alias("v_last"),
        runs("flat_from", "flat_ends", F.col("need")).alias("flat"), runs("wet_from", "wet_ends", F.lit(need_wet(cfg, minutes))).alias("wet"),
    )


def need_wet(cfg: dict, minutes: float) -> int:
    return int(cfg["qc"]["rh_saturated_hours"] * 60 / minutes)


def findings(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """What the seven rules found: ``zone, channel, base_var, rule, begin, end, n, v, lo, hi, need, constant``, a row for each day or run.

    ``rule`` is the number of the rule (3 to 8, 13). Rules that the settings turn off find nothing.
    """
    qc = cfg["qc"]
    by_day = W.partitionBy(*CHANNEL).orderBy("date")  # a row for each channel and day
    all_days = W.partitionBy(*CHANNEL)
    d = days(grid, cfg, minutes).withColumns({"carry": F.lag("v_last").over(by_day), "constant": F.min("lo").over(all_days) == F.max("hi").over(all_days)})
    jumps = F.col("jumps") + F.coalesce(_jump("v_first", "carry"), F.lit(False)).cast("long")
    none, day = F.lit(None).cast("double"), F.col("date").cast("timestamp_ntz")

    def item(rule: int, where: Column, n: Column, hi: Column = none, lo: Column = none) -> Column:
        return F.when(where, F.struct(*[c.alias(x.split()[0]) for c, x in zip((F.lit(rule), day, day, n, none, lo, hi, F.lit(False)), ITEM.split(", "), strict=True)]))

    def of_runs(rule: int, runs: str, joined: Column) -> Column:
        return F.transform(runs, lambda r: F.struct(F.lit(rule).alias("rule"), r["begin"].alias("begin"), r["end"].alias("end"), r["n"].alias("n"), r["v"].alias("v"), none.alias("lo"), none.alias("hi"), (r["first"] & F.coalesce(joined, F.lit(False))).alias("joins")))

    dark = F.when(F.col("base_var") == "solar", qc["daytime_dark_ppfd_max"] / 2).otherwise(float(qc["daytime_dark_ppfd_max"]))
    one = F.lit(1).cast("long")
    single = [item(3, F.col("n_out") > 0, F.col("n_out"), F.col("out_hi"), F.col("out_lo")), item(6, F.col("noon") < dark, one, F.col("noon")), item(13, F.col("n_hot") > 0, F.col("n_hot"), F.col("hi"))]
    if qc["spike_enabled"]:
        single.append(item(5, jumps >= qc["spike_warn_count"], jumps))
    if qc["night_light_enabled"]:
        single.append(item(7, F.col("night") > qc["night_light_ppfd"], one, F.col("night")))
    found = [F.filter(F.array(*single), lambda x: x.isNotNull()), of_runs(8, "wet", _saturated("v_first", cfg) & _saturated("carry", cfg))]
    if qc["flatline_enabled"]:
        found.append(of_runs(4, "flat", _equal("v_first", "carry")))
    about = ["base_var", "need", "constant"]
    items = d.select(*CHANNEL, *about, F.explode(F.concat(*found)).alias("x"))
    items = items.select("zone", F.when(F.col("x.rule") == 13, F.col("base_var")).otherwise(F.col("channel")).alias("channel"), *about, "x.*")  # heat is a variable's, not a channel's
    # A run that joins is the go-on of the one before it; two rows a day at most, beside the runs that are long enough themselves.
    whole = items.withColumn("chain", F.sum((~F.col("joins")).cast("long")).over(W.partitionBy(*CHANNEL, "rule").orderBy("begin").rangeBetween(W.unboundedPreceding, 0)))
    whole = whole.groupBy(*CHANNEL, "rule", "chain").agg(
        *[F.first(c).alias(c) for c in about], F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("n").alias("n"), F.min("v").alias("v"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    long_enough = (~F.col("rule").isin(4, 8)) | ((F.col("rule") == 4) & (F.col("n") >= F.col("need"))) | ((F.col("rule") == 8) & (F.col("n") >= need_wet(cfg, minutes)))
    return whole.where(long_enough).drop("chain")
