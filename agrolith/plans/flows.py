"""Whole flows: exports to an archive, an archive to alerts, exports and surveys to matched tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith import config
from agrolith.functions.names import column_order
from agrolith.operators import alerts, archive, clean, daily, grid, health, intervals, ledger, reshape, rules, store, treatment
from agrolith.session import written
from agrolith.sources import logger_files


def ingest(spark: SparkSession, paths: list[str], overrides: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Readings of logger exports, told apart by logger, time and channel; the mapping report; files that could not be read."""
    cells = written(logger_files.cells(spark, paths, overrides), "cells")  # three results of one reading
    typed = logger_files.readings(cells).withColumn("row", F.lit(0))
    report = reshape.mapping_report(typed.withColumn("zone", F.col("serial")))
    return logger_files.deduplicated(typed).drop("row"), report, logger_files.problems(cells)


def interval_of(readings: DataFrame, cfg: dict, keys: list[str]) -> float:
    """The interval in minutes: as configured, else the most frequent one of the loggers' own (a row for each logger)."""
    if isinstance(cfg["interval_minutes"], (int, float)):
        return float(cfg["interval_minutes"])
    own = grid.interval_minutes(readings, keys, default=float(cfg["default_interval"])).groupBy("interval_minutes").count()
    best = own.orderBy(F.desc("count"), "interval_minutes").first()
    return float(best[0]) if best else float(cfg["default_interval"])


def update_archive(spark: SparkSession, paths: list[str], path: str, registry: dict, cfg: dict | None = None, overrides: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Put exports into the archive at ``path``: newer readings win, no logger may vanish. Summary, report and problems."""
    cfg = cfg or config.load()
    fresh, report, problems = ingest(spark, paths, overrides)
    names = store.registry_table(spark, registry).select("serial", "zone")
    seconds = round(interval_of(fresh, cfg, ["serial"]) * 60)
    master = archive.read(spark, path)
    new = archive.build(spark, [fresh.select("serial", "ts", "channel", "base_var", "rep", "value")], master, names, seconds)
    archive.replace_guarded(spark, new, path, f"{path}.staging")
    kept = archive.read(spark, path)
    return {"summary": archive.summary(kept), "report": report, "problems": problems, "serials": archive.serials(kept, ["zone"])}


def _of_store(spark: SparkSession, root: str, registry: dict, cfg: dict, overrides: dict[str, str] | None, loads: list[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the store's files hold: readings by zone on the grid, with ``load``; the mapping report; files that could not be read."""
    cells = written(logger_files.taken_apart(store.stored(spark, root, loads), overrides), "cells")
    typed = logger_files.readings(cells, "load").withColumn("row", F.lit(0))
    fresh = logger_files.deduplicated(typed, "load")
    seconds = round(interval_of(fresh, cfg, ["serial"]) * 60)
    named = archive.zone_of(grid.snapped(fresh, seconds), store.registry_table(spark, registry).select("serial", "zone"))
    report = reshape.mapping_report(typed.withColumn("zone", F.col("serial")))
    return named.select("zone", "serial", "ts", "channel", "base_var", "rep", "value", "load"), report, logger_files.problems(cells)


def add_uploads(spark: SparkSession, paths: list[str], root: str, registry: dict, now: datetime, cfg: dict | None = None, overrides: dict[str, str] | None = None) -> dict:
    """Exports into the store and, if their content is new, the days that they touch into the archive by days."""
    cfg = cfg or config.load()
    new = store.keep(spark, paths, f"{root}/uploads", now)
    loads = [r.load for r in new.select("load").distinct().collect()]  # one
    if not loads:
        return {"new_files": 0}
    fresh, report, problems = _of_store(spark, f"{root}/uploads", registry, cfg, overrides, loads)
    ledger.add(spark, f"{root}/archive", fresh)
    return {"new_files": new.count(), "report": report, "problems": problems}


def rebuild(spark: SparkSession, root: str, registry: dict, cfg: dict | None = None, overrides: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The archive anew from the store alone, wherever the exports have gone; refused where a logger would lose readings."""
    every, report, problems = _of_store(spark, f"{root}/uploads", registry, cfg or config.load(), overrides)
    ledger.replace(spark, f"{root}/archive", every)
    return {"report": report, "problems": problems}


def monitor(readings: DataFrame, cfg: dict, now: datetime, lookback_days: int | None = 7, report: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Alerts and health of every zone at once."""
    minutes = interval_of(readings, cfg, ["zone"])
    keys = ["zone", "channel", "base_var", "rep"]
    on = grid.on_grid(grid.snapped(readings.select(*keys, "ts", "value"), round(minutes * 60)), keys, round(minutes * 60))
    state = health.table(readings, config.specs(readings.sparkSession, cfg), minutes)
    found = rules.run_all(written(on, "grid"), cfg, minutes, lookback_days, now, report)  # each part of the rules reads the grid
    return rules.by_severity(written(found, "alerts")), state  # a summary, an exit code and sinks read the alerts


def send(found: DataFrame, cfg: dict, now: datetime, state_path: str, sinks: dict, dry_run: bool = False):
    """Alerts that are due to the sinks; what went out is noted under ``state_path``. The alerts due, and what became of each sink."""
    a = cfg["alerts"]
    new, _, outcome = alerts.dispatch(found, alerts.load_state(found.sparkSession, state_path), now, sinks, a["min_level"], a["cooldown_hours"], dry_run)
    if "sent" in outcome.values():
        alerts.note_sent(new, state_path, now)
    return new, outcome


#: Sums are 0 over days without values; where a key never has the variable, they are blank.
SUMMED = {"temp": ("gdd", "cum_gdd"), "ppfd": ("dli", "photoperiod_h", "ppfd_day_mean", "cum_dli"), "solar": ("solar_MJ", "cum_solar_MJ")}


def _blanked(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with sums blank for keys that ``known`` (keys, ``channels``) gives no such variable. A row for each key."""
    out = df.join(known, keys, "left")
    for v, starts in SUMMED.items():
        has = F.array_contains("channels", v)
        out = out.withColumns({c: F.when(has, F.col(c)) for c in df.columns if c.startswith(starts)})
    return out.select(*df.columns)


def preprocess(readings: DataFrame, cfg: dict, growth: DataFrame | None = None, surveys: list | None = None, sensor_map: dict | None = None, lag_days: int | None = None, window_days: int | None = None, first_start=None, drop_incomplete: bool | None = None) -> dict[str, DataFrame]:
    """Readings to daily tables, survey intervals and, with growth measurements, matched rows; by treatment with a map.

    Survey dates that are given stand before those of the growth table; what is not given is as configured.
    """
    spark, own = readings.sparkSession, cfg["intervals"]
    lag_days, window_days = own["lag_days"] if lag_days is None else lag_days, window_days or own["window_days"]
    drop_incomplete = own["drop_incomplete_days"] if drop_incomplete is None else drop_incomplete
    minutes = interval_of(readings, cfg, ["zone"])
    seconds = round(minutes * 60)
    snapped = grid.keep_first(grid.snapped(readings, seconds), ["zone", "ts", "channel", "base_var", "rep", "serial"], ["value"])
    specs = config.specs(spark, cfg)
    kept = clean.masked(snapped, specs)
    out = {"gaps": grid.gap_report(grid.gap_runs(grid.on_grid(kept.select("zone", "channel", "ts", "value"), ["zone", "channel"], seconds), ["zone", "channel"], minutes)), "range_report": clean.range_report(snapped, specs, ["zone", "channel"])}
    if sensor_map:
        kept = treatment.split(kept, treatment.map_table(spark, sensor_map))
        out["coverage"] = treatment.coverage(snapped, treatment.map_table(spark, sensor_map))
        keys, long = ["zone", "trt"], kept.select("zone", "trt", "ts", F.col("base_var").alias("channel"), "value")
    else:
        keys, long = ["zone"], reshape.representative(kept.select("zone", "ts", "channel", "base_var", "rep", "value")).select("zone", "ts", F.col("base_var").alias("channel"), "value")
    channels = sorted((r.channel for r in long.select("channel").distinct().collect()), key=column_order)  # names of variables: few
    wide = reshape.pivot(long, [*keys, "ts"], channels)
    d = cfg["daily"]
    known = long.where("value is not null").groupBy(*keys).agg(F.collect_set("channel").alias("channels"))
    out["daily"] = _blanked(daily.wide_summary(wide, keys, minutes, d["gdd_base"], d["photoperiod_threshold"], tuple(d["daytime_hours"]), d["min_completeness"]), known, keys)
    dates = spark.createDataFrame([(x,) for x in intervals.survey_dates(surveys)], "growth_date date") if surveys else None
    if dates is None and growth is not None:
        dates = growth.select(F.to_date("date").alias("growth_date"))
    if dates is None:
        return out
    out["intervals"] = intervals.definitions(dates, first_start=first_start, lag_days=lag_days, window_days=window_days)
    summary = intervals.with_totals(intervals.aggregate(out["daily"], out["intervals"], keys, drop_incomplete), keys)
    out["summary"] = intervals.with_flags(_blanked(summary, known, keys))
    if growth is not None:
        one = out["summary"].drop("zone") if len(keys) == 1 or "zone" not in growth.columns else out["summary"]
        if out["summary"].select("zone").distinct().limit(2).count() > 1 and "zone" not in growth.columns:
            raise ValueError("several zones: growth rows need a column zone, or match one zone at a time")
        if "zone" in growth.columns:
            g, one = growth.withColumn("_zone", F.col("zone")), out["summary"].withColumnRenamed("zone", "_z")
            on = [F.to_date(g["date"]) == one["growth_date"], g["_zone"] == one["_z"]] + ([g["trt"] == one["trt"]] if sensor_map else [])
            out["matched"] = g.join(one, on, "left").select(*[g[c] for c in growth.columns], *[one[c] for c in one.columns if c not in ("_z", "trt", "growth_date")])
        else:
            out["matched"] = intervals.match_growth(growth, one, treatment="trt" if sensor_map else None)
    return out


def weekly(spark: SparkSession, paths: list[str], root: str, cfg: dict, registry: dict, now: datetime, surveys: list | None = None, sinks: dict | None = None) -> dict:
    """New uploads into the store and the archive by days, alerts of the whole archive, those due to the sinks (by default a log of JSON lines), and a stored run of the preprocessed tables."""
    told = add_uploads(spark, paths, root, registry, now, cfg)
    master = ledger.read(spark, f"{root}/archive")
    if told["new_files"]:
        told |= {"summary": archive.summary(master), "serials": archive.serials(master, ["zone"])}
    found, state = monitor(master, cfg, now)
    sinks = sinks or {"log": lambda df: alerts.to_json(df, f"{root}/alerts", now)}
    new_alerts, outcome = send(found, cfg, now, f"{root}/alert_state", sinks)
    tables = preprocess(master, cfg, surveys=surveys)
    run = store.save_result({"alerts": found, "health": state, **tables}, f"{root}/results", "weekly", now)
    return {"run": run, "exit_code": alerts.exit_code(found), "sent": new_alerts.count(), "sinks": outcome, **told}
