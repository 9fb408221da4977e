"""Quality rules over readings in long form: each is one plan over all zones and channels.

Input (``grid``): ``zone, ts, channel, base_var, rep, value`` and, on a grid, ``qc_status``. A zone's
times are those of any of its channels. Each rule returns the columns of ``ALERT``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.config import LEVELS, LIGHT, specs
from agrolith.functions.expressions import between_hours, level
from agrolith.operators import grid as G
from agrolith.operators.clean import outside, with_specs
from agrolith.operators.daily import expected_per_day
from agrolith.operators.ordered import islands, with_previous
from agrolith.operators.selection import medians
from agrolith.operators.sweep import findings
from agrolith.session import written

ALERT = ["zone", "rule", "level", "variable", "start", "end", "value", "detail", "message", "key"]
CHANNEL = ["zone", "channel"]


def alert(df: DataFrame, rule: Column | str, variable: Column | str, start: Column | None, end: Column | None, value: Column, message: Column, detail: Column | None = None) -> DataFrame:
    """The common shape. ``df`` has ``zone`` and ``level``; rows whose level is null are no alerts."""
    rule, var = (F.lit(x) if isinstance(x, str) else x for x in (rule, variable))
    none = F.lit(None)
    s, e = (x.cast("timestamp_ntz") if x is not None else none.cast("timestamp_ntz") for x in (start, end))
    key = F.concat_ws("|", rule, var, F.coalesce(F.date_format(s, "yyyy-MM-dd HH:mm"), F.lit("-")))
    cols = [F.col("zone").cast("string"), rule, F.col("level"), var, s, e, value.cast("double"), (detail if detail is not None else none).cast("string"), message, F.concat_ws("|", F.col("zone").cast("string"), key)]
    return df.where("level is not null").select(*[c.alias(n) for c, n in zip(cols, ALERT, strict=True)])


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("ts"))


def _told(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def primary(readings: DataFrame) -> DataFrame:
    """One channel for each variable: the variable's own, or its first repetition."""
    return readings.where("rep <= 1")


def r01_gaps(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    qc = cfg["qc"]
    times = grid.select("zone", "ts", *["qc_status"] * ("qc_status" in grid.columns))
    if "qc_status" in grid.columns:
        by_time = times.groupBy("zone", "ts").agg(F.min(F.col("qc_status") == G.INSERTED).alias("_none"))
        times = by_time.select("zone", "ts", F.when(F.col("_none"), G.INSERTED).otherwise(G.ORIGINAL).alias("qc_status"))
        found = G.gap_runs(times, ["zone"], minutes)
    else:
        found = G.gaps_between(times, ["zone"], minutes)
    found = found.withColumn("level", level(F.col("minutes"), qc["gap_critical_minutes"], qc["gap_warn_minutes"], "INFO"))
    return alert(found, "R01_timestamp_gap", "timestamp", F.col("start"), F.col("end"), F.col("missing"), _told(_text("missing"), " records missing (", _text("minutes"), " minutes)"))


def r02_missing(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """Days that the window holds in full, or that are not at its edge, between a channel's first and last reading."""
    qc, expected = cfg["qc"], expected_per_day(minutes)
    slots = _day(grid.select("zone", "ts").distinct()).groupBy("zone", "date").agg(F.count(F.lit(1)).alias("slots"))
    edges = slots.groupBy("zone").agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    days = slots.join(edges, "zone").where((F.col("slots") >= expected * 0.99) | ((F.col("date") > F.col("_a")) & (F.col("date") < F.col("_b")))).select("zone", "date")
    seen = _day(grid).groupBy("zone", "channel", "base_var", "date").agg(F.count("value").alias("n"))
    life = seen.where("n > 0").groupBy("zone", "channel", "base_var").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    every = life.join(days, "zone").where("date between _first and _last")  # a row for each channel and day
    found = every.join(seen.select("zone", "channel", "date", "n"), ["zone", "channel", "date"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ratio = 1 - F.col("n") / expected
    found = found.withColumn("level", level(ratio, qc["missing_critical_ratio"], qc["missing_warn_ratio"]))
    return alert(found, "R02_missing_ratio", F.col("channel"), F.col("date"), F.col("date"), F.bround(ratio, 4), _told(_text("n"), f" of {expected} records received"))


def r03_out_of_range(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    bad = _day(with_specs(grid, specs(grid.sparkSession, cfg))).where(outside())
    found = bad.groupBy("zone", "channel", "date").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    found = found.withColumn("level", F.when(F.col("n") >= cfg["qc"]["out_of_range_critical"], "CRITICAL").otherwise("WARN"))
    return alert(found, "R03_out_of_range", F.col("channel"), F.col("date"), F.col("date"), F.col("n"), _told(_text("n"), " readings out of range, seen ", _text("lo"), " to ", _text("hi")))


def flat_count(cfg: dict, minutes: float) -> Column:
    """How many equal readings are too many; ``flat_minutes`` as joined from the specifications."""
    return F.greatest(F.bround(F.coalesce("flat_minutes", F.lit(float(cfg["other_flat_minutes"]))) / minutes), F.lit(2.0))


def r04_flatline(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """Equal readings in succession; a run starts at the reading that the others repeat."""
    qc = cfg["qc"]
    if not qc["flatline_enabled"]:
        return _nothing(grid)
    rows = with_previous(grid.select("zone", "ts", "channel", "base_var", "value"), CHANNEL, "ts", {"value": "before", "ts": "ts_before"})
    light, ignored = F.col("base_var").isin(list(LIGHT)), F.col("base_var").isin(list(qc["flatline_ignore_zero"]))
    floor = F.when(light & ignored, float(qc["flatline_light_floor"])).when(ignored, 0.0)
    same = (F.col("value") == F.col("before")) & (floor.isNull() | (F.col("value") > floor))
    runs = islands(rows, CHANNEL, "ts", same)
    found = runs.groupBy(*CHANNEL, "base_var", "island").agg((F.count(F.lit(1)) + 1).alias("n"), F.min("ts_before").alias("start"), F.max("ts").alias("end"), F.min("value").alias("v"))
    constant = grid.groupBy(*CHANNEL).agg((F.min("value") == F.max("value")).alias("constant"))
    found = with_specs(found, specs(grid.sparkSession, cfg)).where(F.col("n") >= flat_count(cfg, minutes)).join(constant, CHANNEL)
    found = found.withColumn("level", F.when(F.col("n") * minutes / 60 >= 12, "CRITICAL").otherwise("WARN"))
    cause = F.when(F.col("constant"), "unconnected or broken port").otherwise("stuck sensor or link")
    return alert(found, "R04_flatline", F.col("base_var"), F.col("start"), F.col("end"), F.col("v"), _told(_text("n"), " equal readings: ", cause), F.col("channel"))


def r05_spike(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """Days with several changes above the threshold, which scales with the interval. Light may jump."""
    qc = cfg["qc"]
    if not qc["spike_enabled"]:
        return _nothing(grid)
    rows = with_specs(grid.where(~F.col("base_var").isin(list(LIGHT))), specs(grid.sparkSession, cfg)).where("spike is not null")
    step = with_previous(rows.select("zone", "ts", "channel", "value", "spike"), CHANNEL, "ts", {"value": "before"})
    hits = _day(step.where(F.abs(F.col("value") - F.col("before")) > F.col("spike") * minutes / 10))
    found = hits.groupBy(*CHANNEL, "date").agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.when(F.col("n") >= qc["spike_warn_count"], "WARN"))
    return alert(found, "R05_spike", F.col("channel"), F.col("date"), F.col("date"), F.col("n"), _told(_text("n"), " jumps: loose contact or noise"))


def _extreme(grid: DataFrame, variables: list[str], hours: tuple[int, int] | None) -> DataFrame:
    rows = grid.where(F.col("base_var").isin(variables) & F.col("value").isNotNull())
    if hours:
        rows = rows.where(between_hours(F.hour("ts"), *hours))
    return _day(rows).groupBy("zone", "channel", "base_var", "date").agg(F.max("value").alias("hi"))


def r06_daytime_dark(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    qc = cfg["qc"]
    most = F.when(F.col("base_var") == "solar", qc["daytime_dark_ppfd_max"] / 2).otherwise(float(qc["daytime_dark_ppfd_max"]))
    found = _extreme(grid, list(LIGHT), tuple(qc["noon_hours"])).withColumn("level", F.when(F.col("hi") < most, "CRITICAL"))
    return alert(found, "R06_daytime_dark", F.col("channel"), F.col("date"), F.col("date"), F.col("hi"), _told("dark at noon: at most ", _text("hi")))


def r07_night_light(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    qc = cfg["qc"]
    if not qc["night_light_enabled"]:
        return _nothing(grid)
    found = _extreme(grid, ["ppfd"], tuple(qc["night_hours"])).withColumn("level", F.when(F.col("hi") > qc["night_light_ppfd"], "WARN"))
    return alert(found, "R07_night_light", F.col("channel"), F.col("date"), F.col("date"), F.col("hi"), _told("light at night: up to ", _text("hi")))


def r08_rh_saturated(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    qc = cfg["qc"]
    need = int(qc["rh_saturated_hours"] * 60 / minutes)
    runs = islands(grid.where("base_var = 'rh'").select("zone", "ts", "channel", "value"), CHANNEL, "ts", F.col("value") >= qc["rh_saturated_level"])
    found = runs.groupBy(*CHANNEL, "island").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"))
    found = found.withColumn("level", F.when(F.col("n") >= need, "WARN"))
    return alert(found, "R08_rh_saturated", F.col("channel"), F.col("start"), F.col("end"), F.col("n"), _told(_text("n"), " saturated readings in succession"))


def r09_offline(grid: DataFrame, cfg: dict, now) -> DataFrame:
    """Zones whose last time is long before ``now``, which is a value, so that results do not depend on the clock."""
    qc = cfg["qc"]
    ref = F.lit(now).cast("timestamp_ntz")
    last = grid.groupBy("zone").agg(F.max("ts").alias("last"))
    delay = (F.unix_micros(ref.cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / 60_000_000
    found = last.withColumn("delay", delay).withColumn("level", level(F.col("delay"), qc["offline_critical_minutes"], qc["offline_warn_minutes"]))
    return alert(found, "R09_logger_offline", "logger", F.col("last"), ref, F.bround("delay", 1), _told("last seen ", _text("last")))


def r10_pair_divergence(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """The first repetition of a variable against each other one, over times that both have."""
    qc = cfg["qc"]
    if not qc["pair_divergence_enabled"]:
        return _nothing(grid)
    limits = grid.sparkSession.createDataFrame([(k, float(v)) for k, v in qc["pair_divergence"].items()], "base_var string, most double")
    rows = grid.where("value is not null").join(F.broadcast(limits), "base_var").select("zone", "base_var", "rep", "channel", "ts", "value", "most")
    a = rows.where("rep = 1").select("zone", "base_var", "ts", F.col("channel").alias("first"), F.col("value").alias("x"))
    both = rows.where("rep > 1").join(a, ["zone", "base_var", "ts"])
    diff = F.abs(F.col("value") - F.col("x"))
    metric = F.when(F.col("base_var").isin(list(LIGHT)), F.when(F.col("x") > 50, diff / F.when(F.col("x") > 50, F.col("x")))).otherwise(diff)
    pair = ["zone", "base_var", "first", "channel", "most"]
    both = both.withColumn("metric", metric)
    found = both.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end")).where("n >= 6")
    found = found.join(medians(both, pair, "metric"), pair).withColumnRenamed("median", "metric")
    found = found.withColumn("level", F.when(F.col("metric") > F.col("most"), "WARN"))
    return alert(found, "R10_pair_divergence", F.col("base_var"), F.col("start"), F.col("end"), F.bround("metric", 4), _told("sensors differ: median ", _text("metric")), F.concat_ws(" vs ", "first", "channel"))


def transmittance(grid: DataFrame, cfg: dict) -> DataFrame:
    """Each day's median of light inside against light outside, at noon and by enough sun."""
    t = cfg["qc"]["transmittance"]
    noon = primary(grid).where(between_hours(F.hour("ts"), *cfg["qc"]["noon_hours"]) & F.col("base_var").isin(list(LIGHT)))
    both = noon.groupBy("zone", "ts").agg(*[F.max(F.when(F.col("base_var") == v, F.col("value"))).alias(v) for v in LIGHT])
    kept = both.where("ppfd is not null and solar > 50").withColumn("ratio", F.col("ppfd") / (F.col("solar") * t["solar_to_ppfd_factor"]))
    return _day(kept).groupBy("zone", "date").agg(F.median("ratio").alias("ratio"))


def r11_transmittance(grid: DataFrame, cfg: dict) -> DataFrame:
    from pyspark.sql import Window as W

    t = cfg["qc"]["transmittance"]
    if not t["enabled"]:
        return _nothing(grid)
    recent, base = int(t["recent_days"]), int(t["baseline_days"])
    days = transmittance(grid, cfg).withColumn("n", F.row_number().over(W.partitionBy("zone").orderBy(F.desc("date"))))  # a row for each zone and day
    new, old = F.col("n") <= recent, (F.col("n") > recent) & (F.col("n") <= recent + base)
    found = days.groupBy("zone").agg(F.count(F.lit(1)).alias("days"), F.median(F.when(new, F.col("ratio"))).alias("now"), F.median(F.when(old, F.col("ratio"))).alias("was"), F.min(F.when(new, F.col("date"))).alias("start"), F.max("date").alias("end"))
    share = F.when(F.col("was") > 0, F.col("now") / F.when(F.col("was") > 0, F.col("was")))
    found = found.where("days >= 5").withColumn("share", share).withColumn("level", F.when(F.col("share") < t["drop_ratio"], "WARN"))
    return alert(found, "R11_transmittance_drop", "ppfd", F.col("start"), F.col("end"), F.bround("share", 3), F.lit("less light passes: dirt, screen or shade"))


def r12_errors(report: DataFrame, cfg: dict) -> DataFrame:
    """From a mapping report: ``zone, source, base_var, rows, errors``."""
    share = F.col("errors") / F.greatest("rows", F.lit(1))
    found = report.where("errors > 0").withColumn("level", F.when(share > 0.3, "CRITICAL").when(share > cfg["qc"]["error_warn_ratio"], "WARN").otherwise("INFO"))
    return alert(found, "R12_error_value", F.col("base_var"), None, None, F.col("errors"), _told(_text("errors"), " error values"), F.col("source"))


def r13_heat(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    qc = cfg["qc"]
    most = F.when(F.col("base_var") == "temp", float(qc["heat_event_temp"])).otherwise(float(qc["heat_event_soil_temp"]))
    rows = _day(primary(grid).where(F.col("base_var").isin("temp", "soil_temp"))).withColumn("over", F.col("value") > most)
    found = rows.groupBy("zone", "base_var", "date").agg(F.sum(F.col("over").cast("long")).alias("n"), F.max("value").alias("hi")).where("n > 0")
    found = found.withColumn("level", F.when(F.col("n") * minutes / 60 >= 1, "CRITICAL").otherwise("WARN"))
    return alert(found, "R13_heat_event", F.col("base_var"), F.col("date"), F.col("date"), F.col("hi"), _told("heat in ", _text("n"), " readings, up to ", _text("hi")))


def _nothing(grid: DataFrame) -> DataFrame:
    none = grid.where(F.lit(False)).select("zone", F.lit("INFO").alias("level"))
    return alert(none, "none", "-", None, None, F.lit(0.0), F.lit(""))


def swept(grid: DataFrame, cfg: dict, minutes: float) -> DataFrame:
    """Rules 3 to 8 and 13 in one pass: what ``r03_out_of_range`` to ``r08_rh_saturated`` and ``r13_heat`` give, in any order."""
    qc, rule = cfg["qc"], F.col("rule")
    n, hours = F.col("n"), F.col("n") * minutes / 60
    pick = lambda **of: F.coalesce(*[F.when(rule == int(k[1:]), v if isinstance(v, Column) else F.lit(v)) for k, v in of.items()])
    cause = F.when(F.col("constant"), "unconnected or broken port").otherwise("stuck sensor or link")
    worst = lambda c: F.when(c, "CRITICAL").otherwise("WARN")
    found = findings(grid, cfg, minutes)
    found = found.select(
        "zone",
        pick(_3="R03_out_of_range", _4="R04_flatline", _5="R05_spike", _6="R06_daytime_dark", _7="R07_night_light", _8="R08_rh_saturated", _13="R13_heat_event").alias("name"),
        pick(_3=worst(n >= qc["out_of_range_critical"]), _4=worst(hours >= 12), _5="WARN", _6="CRITICAL", _7="WARN", _8="WARN", _13=worst(hours >= 1)).alias("level"),
        F.when(rule.isin(4, 13), F.col("base_var")).otherwise(F.col("channel")).alias("variable"), "begin", "end",
        F.when(rule.isin(3, 5, 8), n.cast("double")).when(rule == 4, F.col("v")).otherwise(F.col("hi")).alias("value"),
        F.when(rule == 4, F.col("channel")).alias("detail"),
        pick(_3=_told(_text("n"), " readings out of range, seen ", _text("lo"), " to ", _text("hi")), _4=_told(_text("n"), " equal readings: ", cause), _5=_told(_text("n"), " jumps: loose contact or noise"), _6=_told("dark at noon: at most ", _text("hi")), _7=_told("light at night: up to ", _text("hi")), _8=_told(_text("n"), " saturated readings in succession"), _13=_told("heat in ", _text("n"), " readings, up to ", _text("hi"))).alias("message"),
    )
    return alert(found, F.col("name"), F.col("variable"), F.col("begin"), F.col("end"), F.col("value"), F.col("message"), F.col("detail"))


#: The rules over the grid; those over a clock, days or a mapping report are called beside them.
RULES = (r01_gaps, r02_missing, swept, r10_pair_divergence)

# What a rule's own fault is not: executors, disks and connections that are lost. Such faults end the run.
LOST = ("No space left", "ExecutorLost", "SparkContext was shut down", "cancelled", "FetchFailed", "java.io.IOException", "OutOfMemory")


def run_all(grid: DataFrame, cfg: dict, minutes: float, lookback_days: int | None = 7, now=None, report: DataFrame | None = None, rules=RULES) -> DataFrame:
    """All rules' alerts, the worst first, then by start with empty ones last. No rows give no alerts.

    The library's own rules are one plan, run when it is read and not before; ``grid`` is read by each of its parts, so give a written
    table where making it costs much. Rules of others are run by themselves, over a written window: one that fails, planned or running, gives
    an ``R00_rule_error`` row and leaves the rest alone; a lost disk or cluster is no rule's fault and raises.
    """
    others = [f for f in rules if f not in RULES]
    recent = G.window_of(grid, ["zone"], lookback_days, now)
    if others:
        recent = written(recent, "window")
    whole = recent if lookback_days is None else grid
    plans = [(f.__name__, lambda f=f: f(recent, cfg, minutes)) for f in rules]
    plans.append(("r11_transmittance", lambda: r11_transmittance(whole, cfg)))
    if now is not None:
        plans.append(("r09_offline", lambda: r09_offline(whole, cfg, now)))
    if report is not None:
        plans.append(("r12_errors", lambda: r12_errors(report, cfg)))
    foreign = {f.__name__ for f in others}

    def run(named) -> DataFrame:
        name, plan = named
        try:
            return written(plan(), name) if name in foreign else plan()
        except Exception as e:  # one rule's fault is reported as such
            if any(x in str(e) for x in LOST):
                raise
            one = grid.sparkSession.createDataFrame([("-", "INFO")], "zone string, level string")
            return alert(one, "R00_rule_error", "-", None, None, F.lit(0.0), F.lit(f"{name}: {str(e)[:200]}"))

    return by_severity(reduce(DataFrame.unionByName, map(run, plans)))


def severity(c: str = "level") -> Column:
    return F.coalesce(*[F.when(F.col(c) == k, v) for k, v in LEVELS.items()], F.lit(0))


def by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(severity().desc(), F.col("start").asc_nulls_last(), "key")
