"""The queries of the sensor engine over the test tables, by name."""

from __future__ import annotations

from datetime import date, datetime
from itertools import groupby, islice
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith import config
from agrolith.functions import expressions as X
from agrolith.operators import alerts, archive, clean, daily, grid, health, intervals, ledger, reshape, rules, stats, store, treatment, verify
from agrolith.plans import inputs as I

QUERIES: dict = {}
ALERT = ["zone", "rule", "level", "variable", "start", "end", "value", "detail", "key"]
CHANNEL = ["zone", "channel"]


def query(f):
    QUERIES[f.__name__] = f
    return f


def _specs(spark):
    return config.specs(spark, I.SETTINGS)


# --- time and shape


@query
def readings_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return I.readings(spark, sf).select("zone", "ts", "channel", "value")


@query
def readings_keep_first(spark, sf):
    return grid.keep_first(I.raw(spark, sf).select("zone", "ts", "base_var", "event_id", "v"), ["zone", "ts", "base_var"], ["event_id"])


@query
def interval_mode(spark, sf):
    e = I.table(spark, sf, "events").select((F.col("user_id") % 4).cast("string").alias("zone"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"))
    return grid.interval_minutes(e, ["zone"])


@query
def snap_half_even(spark, sf):
    return I.table(spark, sf, "events").select("event_id", X.snap(F.col("ts"), 600).alias("slot"))


@query
def grid_spine(spark, sf):
    return I.gridded(spark, sf).select("zone", "channel", "ts", "value", "qc_status")


@query
def gap_runs(spark, sf):
    return grid.gap_runs(I.gridded(spark, sf), CHANNEL, I.MINUTES)


@query
def gaps_between(spark, sf):
    return grid.gaps_between(I.readings(spark, sf), CHANNEL, I.MINUTES)


@query
def lookback_window(spark, sf):
    r = I.readings(spark, sf)
    out = grid.window_of(r, ["zone"], 7)
    half_open = grid.window_of(r, ["zone"], 7, closed=False)
    return out.groupBy("zone").agg(F.count(F.lit(1)).alias("closed")).join(half_open.groupBy("zone").agg(F.count(F.lit(1)).alias("half_open")), "zone")


@query
def pivot_wide(spark, sf):
    return reshape.pivot(I.readings(spark, sf), ["zone", "ts"], list(I.VARIABLES.values()))


@query
def unpivot_wide(spark, sf):
    li = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return reshape.unpivot(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


def _cells(spark, sf):
    e, k = I.table(spark, sf, "events"), F.col("event_id") % 8
    raw = F.when(k == 0, "ERROR").when(k == 1, "").when(k == 2, "#VALUE!").when(k == 3, " 12.5 ").when(k == 4, "-").when(k == 5, "inf").when(k == 6, "1.5d").otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", (F.col("user_id") % 4).cast("string").alias("zone"), F.col("event_type").alias("source"), I.variable().alias("base_var"), raw.alias("raw"))


@query
def numeric_coercion(spark, sf):
    return reshape.coerce(_cells(spark, sf)).select("event_id", "value", "is_error")


@query
def mapping_report(spark, sf):
    cells = reshape.coerce(_cells(spark, sf)).withColumn("channel", F.col("base_var"))
    return reshape.mapping_report(cells).select("zone", "source", "channel", "rows", "valid", "missing", "errors", "adopted")


@query
def normalize_key(spark, sf):
    return I.table(spark, sf, "part").select("p_partkey", X.normalised_key(F.concat_ws(" / ", "p_name", F.lit("배지 온도"), "p_brand")).alias("key"))


@query
def serial_extract(spark, sf):
    c = I.table(spark, sf, "customer")
    k = F.col("c_custkey") % 4
    text = F.when(k == 0, F.concat(F.lit("Plot Title : A-"), "c_custkey")).when(k == 1, F.concat(F.lit("x LGR S/N: "), "c_custkey")).when(k == 2, F.concat(F.lit("Serial Number: "), "c_custkey")).otherwise(F.col("c_name"))
    return c.select("c_custkey", X.serial(text).alias("serial"))


@query
def representative_channel(spark, sf):
    return reshape.representative(I.repeated(spark, sf)).select("zone", "ts", "base_var", "channel", "value")


@query
def replicate_mean(spark, sf):
    return reshape.replicate_mean(I.repeated(spark, sf)).select("zone", "ts", "base_var", "value", "sensors")


# --- exports as files


def _export(spark, sf, folder: str) -> None:
    """The readings as exports of loggers, a file for each zone and month: a title, the names of columns, a line for each hour."""
    names = {"temp": "°C Air Temperature", "soil_temp": "°C Soil Temperature", "rh": "% Relative Humidity", "ppfd": "µmol·m⁻²·s⁻¹ PPFD", "solar": "W/m² Solar Radiation"}
    wide = reshape.pivot(I.readings(spark, sf), ["zone", "ts"], list(names))
    cells = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    body = wide.select("zone", F.date_format("ts", "yyyyMM").alias("month"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("n"), cells.alias("line"))
    head = F.array(F.concat(F.lit("Plot Title: L-100"), "zone"), F.lit(",".join(["Timestamp", *names.values()])))
    heads = body.select("zone", "month").distinct().select("zone", "month", F.posexplode(head).alias("n", "line")).withColumn("n", F.col("n") - 2_000_000_000_000)
    files = body.unionByName(heads).repartition("zone", "month").sortWithinPartitions("zone", "month", "n")
    files.select("zone", "month", "line").write.partitionBy("zone", "month").text(folder)


@query
def ingest_csv(spark, sf):
    """Exports written, found, taken apart, typed and told apart, as the flow of files to readings does it."""
    import uuid

    from agrolith.session import shared_root
    from agrolith.sources import logger_files

    folder = f"{shared_root(spark)}/exports-{uuid.uuid4().hex}"
    _export(spark, sf, folder)
    read = logger_files.readings(logger_files.cells(spark, f"{folder}/*/*/*.txt"))
    return logger_files.deduplicated(read).where("value is not null").select("serial", "ts", "channel", "value")


@query
def ingest_source(spark, sf):
    """The same exports through the data source ``logger``, in ranges of 4 KB, so that several tasks read each."""
    import uuid

    from agrolith.session import shared_root
    from agrolith.sources import logger_files, logger_source

    folder = f"{shared_root(spark)}/exports-{uuid.uuid4().hex}"
    _export(spark, sf, folder)
    cells = logger_source.cells(logger_source.raw(spark, f"{folder}/*/*/*.txt", 4096))
    read = logger_files.readings(cells, "path")
    return logger_files.deduplicated(read).where("value is not null").select("serial", "ts", "channel", "value")


def _workbooks(spark, sf) -> DataFrame:
    """The readings as workbooks, one for each zone: two configurations that share the time, a raw sheet and metadata. ``path, content, load``."""
    wide = reshape.pivot(I.readings(spark, sf), ["zone", "ts"], list(I.VARIABLES.values()))
    wide = wide.withColumn("day", (F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000) + 25_569)

    def write(zone):
        from agrolith.sources.workbooks import workbook

        zone, name = zone.sort_values("ts"), f"z6-{int(zone.zone.iloc[0]):05d}"

        def sheet(columns):
            rows = [(float(r[0]), *[None if x != x else x for x in r[1:]]) for r in zone[["day", *columns]].itertuples(index=False)]
            return [[name, *[f"Port {i}" for i in range(1, len(columns) + 1)]], [f"{len(rows)} records", *["ATMOS"] * len(columns)], ["Timestamp", *[columns[c] for c in columns]], *rows]

        one = sheet({"temp": "°C Air Temperature", "rh": "% Relative Humidity"})
        two = sheet({"soil_temp": "°C Soil Temperature", "ppfd": "µmol·m⁻²·s⁻¹ PPFD", "solar": "W/m² Solar Radiation"})
        book = workbook({"Processed Data Config 1": one, "Processed Data Config 2": two, "Raw Data Config 1": one[:3], "Metadata": [["z6"]]})
        return pd.DataFrame([(f"{name}.xlsx", book, 0)], columns=["path", "content", "load"])

    return wide.groupBy("zone").applyInPandas(write, "path string, content binary, load long")


@query
def ingest_xlsx(spark, sf):
    """Workbooks with two configurations, read as events."""
    from agrolith.session import written
    from agrolith.sources import logger_files

    cells = written(logger_files.taken_apart(written(_workbooks(spark, sf), "workbooks")).drop("load"), "cells")
    return logger_files.deduplicated(logger_files.readings(cells)).where("value is not null").select("serial", "model", "ts", "channel", "value")


@query
def growth_xlsx(spark, sf):
    """Orders as measurements in workbooks, one for each customer, read back; the notes of some are blank."""
    from agrolith.session import ship, written
    from agrolith.sources import logger_files

    ship(spark)
    day = F.datediff(F.to_date("o_orderdate"), F.lit(date(1899, 12, 30))).cast("double")
    rows = I.table(spark, sf, "orders").select(F.col("o_custkey").alias("site"), day.alias("serial"), F.substring("o_orderstatus", 1, 1).alias("trt"), F.col("o_orderkey").cast("double").alias("plant"), F.floor(F.col("o_totalprice") + 0.5).cast("double").alias("weight"), F.when(F.col("o_orderkey") % 3 != 0, "dry").alias("note"))

    def write(batches):
        from agrolith.sources.workbooks import workbook

        every = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        sites = (workbook({"Growth": [["date", "trt", "plant", "fresh_wt", "note"], *(r[1:] for r in site)]}, "date") for _, site in groupby(every, key=itemgetter(0)))
        while some := list(islice(sites, 100)):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["content"])

    books = written(rows.repartition("site").sortWithinPartitions("site").mapInArrow(write, "content binary"), "growth-books")
    read = logger_files.grown(books)
    return read.select(F.to_date(F.substring("date", 1, 10)).alias("date"), "trt", X.number(F.col("plant")).cast("long").alias("plant"), X.number(F.col("fresh_wt")).alias("fresh_wt"), "note")


@query
def time_format_vote(spark, sf):
    """Orders as files that write their dates in different ways, each file in one way, some of it unreadable."""
    from agrolith.sources import logger_files

    k, d = F.col("o_custkey") % 7, F.to_timestamp("o_orderdate")
    text = F.when(F.col("o_orderkey") % 50 == 7, "broken").when(k == 0, F.date_format(d, "dd/MM/yyyy")).when(k == 1, F.date_format(d, "MM/dd/yyyy HH:mm")).when(k == 2, F.date_format(d, "yyyy-MM-dd"))
    text = text.when(k == 3, F.date_format(d, "dd.MM.yyyy HH:mm:ss")).when(k == 4, F.date_format(d, "yyyy/MM/dd HH:mm")).when(k == 5, F.when(F.dayofmonth(d) <= 12, F.date_format(d, "dd/MM/yyyy"))).otherwise(F.date_format(d, "dd. MM. yyyy"))
    rows = I.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("f"), k.cast("string")).alias("file"), text.alias("ts_raw"))
    return logger_files.timed(rows, ["file"]).select("o_orderkey", "file", "ts")


@query
def store_rebuild(spark, sf):
    """Exports into the store, the exports deleted, the archive built from the store."""
    import uuid

    from agrolith.plans import flows
    from agrolith.session import shared_root

    root = f"{shared_root(spark)}/store-{uuid.uuid4().hex}"
    _export(spark, sf, f"{root}/in")
    store.keep(spark, [f"{root}/in/*/*/*.txt"], f"{root}/uploads", I.NOW)
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/in")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    flows.rebuild(spark, root, {"loggers": {f"L-100{z}": {"zone": f"house {z}"} for z in range(3)}}, config.load() | {"interval_minutes": I.MINUTES})
    return ledger.read(spark, f"{root}/archive").where("value is not null").select("zone", "serial", "ts", "channel", "value")


# --- cleaning and days


@query
def range_mask(spark, sf):
    return clean.masked(I.readings(spark, sf), _specs(spark)).select("zone", "ts", "channel", "value")


@query
def range_report(spark, sf):
    return clean.range_report(I.readings(spark, sf), _specs(spark), CHANNEL)


@query
def vpd_daily(spark, sf):
    wide = reshape.pivot(I.readings(spark, sf), ["zone", "ts"], ["temp", "rh"]).where("temp is not null and rh is not null")
    return wide.groupBy("zone", F.to_date("ts").alias("date")).agg(F.round(F.avg(X.vpd(F.col("temp"), F.col("rh"))), 6).alias("vpd_mean"))


@query
def daily_summary(spark, sf):
    return daily.summary(I.readings(spark, sf), ["zone"], I.MINUTES)


@query
def daily_wide(spark, sf):
    wide = reshape.pivot(I.readings(spark, sf), ["zone", "ts"], list(I.VARIABLES.values()))
    out = daily.wide_summary(wide, ["zone"], I.MINUTES)
    return out.select("zone", "date", "n_records", "completeness", "is_complete", "temp_mean", "temp_min", "temp_max", "temp_amp", "gdd", "rh_mean", "soil_temp_max", "dli", "photoperiod_h", "ppfd_day_mean", "ppfd_max", F.col("solar_MJ").alias("solar_mj"), "solar_max", "temp_missing_ratio")


@query
def daily_vpd(spark, sf):
    """VPD of whole days and of daytime, of records that have both temperature and humidity; null on days with other readings alone."""
    wide = reshape.pivot(I.readings(spark, sf), ["zone", "ts"], ["temp", "rh"])
    out = daily.wide_summary(wide, ["zone"], I.MINUTES)
    return out.select("zone", "date", *[F.round(c, 6).alias(c) for c in ("vpd_mean", "vpd_day")])


@query
def daily_light(spark, sf):
    return daily.light(I.readings(spark, sf).where("channel = 'ppfd'"), ["zone"], I.MINUTES, 10.0)


@query
def daily_gdd(spark, sf):
    return daily.degree_days(I.readings(spark, sf).where("channel = 'temp'"), ["zone"], 10.0)


@query
def daily_missing_ratio(spark, sf):
    return health.missing_heatmap(I.readings(spark, sf), I.MINUTES)


@query
def daily_completeness(spark, sf):
    return daily.completeness(I.readings(spark, sf), ["zone"], I.MINUTES)


@query
def daily_by_treatment(spark, sf):
    r = I.readings(spark, sf).withColumn("trt", F.when(F.col("zone").cast("int") % 2 == 0, "even").otherwise("odd"))
    return daily.summary(r, ["trt"], I.MINUTES).drop("missing_ratio")


# --- intervals and growth


def _seasons(spark, sf):
    """Each nation's customers as a site: the first and last day of their orders, and a step of days."""
    o = I.table(spark, sf, "orders").join(I.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.to_date("o_orderdate")
    return o.groupBy(F.col("c_nationkey").alias("site")).agg(F.min(day).alias("first"), F.max(day).alias("last")).withColumn("step", F.col("site") % 5 * 7)


@query
def survey_dates_count(spark, sf):
    return intervals.planned(_seasons(spark, sf), ["site"], "first", "step", count=F.col("site") + 1)


@query
def survey_dates_end(spark, sf):
    return intervals.planned(_seasons(spark, sf), ["site"], "first", "step", end="last")


@query
def survey_dates_list(spark, sf):
    return intervals.listed(I.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("site"), F.to_date("o_orderdate").alias("survey")), ["site"])


@query
def cadence(spark, sf):
    return intervals.cadence(I.surveys(spark, sf))


@query
def interval_defs_variable(spark, sf):
    return intervals.definitions(I.surveys(spark, sf), first_start=I.DAILY_START)


@query
def interval_defs_lag(spark, sf):
    return intervals.definitions(I.surveys(spark, sf), lag_days=3)


@query
def interval_defs_fixed(spark, sf):
    return intervals.definitions(I.surveys(spark, sf), window_days=14)


def _intervals(spark, sf, by: bool = False):
    defs = intervals.definitions(I.surveys(spark, sf), window_days=14)
    return intervals.aggregate(I.daily_environment(spark, sf, by), defs, ["trt"] * by)


@query
def interval_agg(spark, sf):
    return _intervals(spark, sf).select("interval_id", "growth_date", "days_used", "day_coverage", "record_completeness", "n_incomplete_days", "dli_sum", "dli_mean", "temp_mean", "temp_max", "temp_min", "temp_max_mean")


@query
def interval_agg_treatment(spark, sf):
    return _intervals(spark, sf, True).select("trt", "interval_id", "days_used", "dli_sum", "temp_mean")


@query
def interval_running_totals(spark, sf):
    return intervals.with_totals(_intervals(spark, sf, True), ["trt"]).select("trt", "interval_id", "dli_sum", "cum_dli")


@query
def interval_quality_flag(spark, sf):
    return intervals.with_flags(_intervals(spark, sf)).select("interval_id", "days_used", "quality")


@query
def growth_join(spark, sf):
    out = intervals.match_growth(I.growth(spark, sf), _intervals(spark, sf))
    return out.select("o_orderkey", "date", "weight", "interval_id", "dli_sum", "temp_mean")


@query
def growth_join_treatment(spark, sf):
    env = _intervals(spark, sf, True).withColumn("trt", F.translate("trt", "ARN", "FOP"))
    return intervals.match_growth(I.growth(spark, sf), env, treatment="trt").select("o_orderkey", "date", "trt", "interval_id", "dli_sum")


@query
def growth_rate(spark, sf):
    g = I.growth(spark, sf).groupBy("trt", "date").agg(F.max("weight").alias("weight")).withColumn("days_expected", F.lit(7))
    return intervals.growth_rate(g, ["weight"], ["trt"]).select("trt", "date", "weight_delta", "weight_rate")


# --- rules


def _rule(name, source):
    def run(spark, sf):
        return source(spark, sf).select(*ALERT)

    run.__name__ = name
    return query(run)


_rule("r01_gaps", lambda s, d: rules.r01_gaps(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r01_gaps_no_grid", lambda s, d: rules.r01_gaps(I.readings(s, d).where("channel = 'temp'"), I.SETTINGS, I.MINUTES))
_rule("r02_missing", lambda s, d: rules.r02_missing(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r03_out_of_range", lambda s, d: rules.r03_out_of_range(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r04_flatline", lambda s, d: rules.r04_flatline(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r05_spike", lambda s, d: rules.r05_spike(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r06_daytime_dark", lambda s, d: rules.r06_daytime_dark(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r07_night_light", lambda s, d: rules.r07_night_light(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r08_rh_saturated", lambda s, d: rules.r08_rh_saturated(I.gridded(s, d), I.SETTINGS, I.MINUTES))
_rule("r09_offline", lambda s, d: rules.r09_offline(I.readings(s, d), I.SETTINGS, I.NOW))
_rule("r10_pair_divergence", lambda s, d: rules.r10_pair_divergence(I.repeated(s, d), I.SETTINGS, I.MINUTES))
_rule("r11_transmittance", lambda s, d: rules.r11_transmittance(I.readings(s, d), config.deep_merge(I.SETTINGS, {"qc": {"transmittance": {"drop_ratio": 1.5, "baseline_days": 7}}})))
def _report(spark, sf):
    return reshape.mapping_report(reshape.coerce(_cells(spark, sf)).withColumn("channel", F.col("base_var")))


_rule("r12_errors", lambda s, d: rules.r12_errors(_report(s, d), I.SETTINGS))
_rule("r13_heat", lambda s, d: rules.r13_heat(I.gridded(s, d), I.SETTINGS, I.MINUTES))


@query
def transmittance_ratio(spark, sf):
    return rules.transmittance(I.readings(spark, sf), I.SETTINGS)


def _alerts(spark, sf):
    """Alerts of all thirteen rules; repetitions meet in one of them only, so that one takes the readings that have them."""
    alone = [f for f in rules.RULES if f is not rules.r10_pair_divergence]
    found = rules.run_all(I.gridded(spark, sf), I.SETTINGS, I.MINUTES, None, I.NOW, _report(spark, sf), alone)
    return rules.by_severity(found.unionByName(rules.r10_pair_divergence(I.repeated(spark, sf), I.SETTINGS, I.MINUTES)))


@query
def rule_union_sorted(spark, sf):
    return _alerts(spark, sf).select("zone", "rule", "level", "variable", "start", "value", "key")


@query
def alert_summary(spark, sf):
    return alerts.summary(_alerts(spark, sf))


@query
def alerts_by_zone(spark, sf):
    return alerts.by_zone(_alerts(spark, sf))


@query
def alerts_cooldown(spark, sf):
    found = _alerts(spark, sf)
    zones = F.col("zone")
    sent = found.where(zones == "0").select("key", F.lit(datetime(2024, 1, 31, 0)).cast("timestamp_ntz").alias("last_sent"), "level", "rule", "message")
    old = found.where(zones == "1").select("key", F.lit(datetime(2024, 1, 29, 0)).cast("timestamp_ntz").alias("last_sent"), "level", "rule", "message")
    return alerts.due(found, sent.unionByName(old), I.NOW, "CRITICAL", 12).select("key", "level")


@query
def alert_state(spark, sf):
    """Two runs that send: the first what began by the middle of the month, the second, six hours later, all that is due then."""
    import uuid

    from agrolith.session import shared_root

    path = f"{shared_root(spark)}/state-{uuid.uuid4().hex}"
    found = rules.r03_out_of_range(I.gridded(spark, sf), I.SETTINGS, I.MINUTES)
    for now, some in ((datetime(2024, 2, 1), found.where("start < '2024-01-16'")), (datetime(2024, 2, 1, 6), found)):
        alerts.note_sent(alerts.due(some, alerts.load_state(spark, path), now), path, now)
    return alerts.load_state(spark, path).select("key", "last_sent", "level", "rule")


@query
def health_table(spark, sf):
    return health.table(I.readings(spark, sf), _specs(spark), I.MINUTES)


# --- verification


@query
def pair_compare(spark, sf):
    out = verify.compare(verify.pairs(I.readings(spark, sf), "ppfd", "temp", ["zone"]), ["zone"])
    return out.select("zone", "n", "ref_mean", "test_mean", "bias", "mae", *[F.round(c, 8).alias(c) for c in ("rmse", "r", "slope", "intercept")], "start", "end")


@query
def daily_pair(spark, sf):
    return verify.daily_pairs(verify.pairs(I.readings(spark, sf), "ppfd", "temp", ["zone"], daytime=(9, 16)), ["zone"])


def _log(spark, sf):
    """Customers as checks of sensors: a balance in whole units as the sensor's value against 5,000."""
    c = I.table(spark, sf, "customer")
    var = F.when(F.col("c_custkey") % 3 == 0, "temp").when(F.col("c_custkey") % 3 == 1, "ppfd").otherwise("other")
    check = F.when(F.col("c_custkey") % 2 == 0, "cross_check").otherwise("calibration")
    return c.select(
        F.date_add(F.lit(date(2025, 1, 1)), (F.col("c_custkey") % 400).cast("int")).alias("date"), F.col("c_nationkey").cast("string").alias("logger_id"), F.concat(F.lit("s"), (F.col("c_custkey") % 2).cast("string")).alias("sensor_id"),
        var.alias("variable"), check.alias("check_type"), F.lit(5000.0).alias("reference_value"), F.floor(F.col("c_acctbal") + 0.5).cast("double").alias("sensor_value"), "c_custkey",
    )


_TOLERANCE = {"temp": 2500.0, "ppfd": 0.5}


@query
def judge_tolerance(spark, sf):
    return verify.recorded(_log(spark, sf), _TOLERANCE).select("c_custkey", "deviation", "rel_deviation", "result")


@query
def due_status(spark, sf):
    log = _log(spark, sf)
    return verify.due_status(log, log, {"cross_check": 30, "calibration": 365}, date(2026, 1, 15))


@query
def drift_trend(spark, sf):
    return verify.drift(verify.recorded(_log(spark, sf), _TOLERANCE), ["logger_id", "sensor_id", "variable"])


@query
def drift_history(spark, sf):
    return verify.drift_history(verify.recorded(_log(spark, sf), _TOLERANCE), ["logger_id", "sensor_id", "variable"])


@query
def cross_check(spark, sf):
    """Temperature judged against light by bias, sun against light by relative bias, humidity without a tolerance; by logger and day, so that some have few pairs."""
    r = I.readings(spark, sf).withColumn("day", F.to_date("ts"))
    out = None
    for variable, test in (("temp", "temp"), ("solar", "solar"), ("rh", "rh")):
        one = verify.cross_check(verify.pairs(r, "ppfd", test, ["zone", "day"]), ["zone", "day"], variable, {"temp": 8.0, "solar": 0.5})
        out = one if out is None else out.unionByName(one)
    return out.select("zone", "day", "variable", "n", *[F.round(c, 8).alias(c) for c in ("ref_mean", "test_mean", "bias", "mae", "rmse", "r", "slope", "intercept", "rel_bias")], "tolerance", "result")


# --- archive, treatments, uploads


def _loads(spark, sf):
    """Events in two loads: odd ids are newer."""
    r = I.raw(spark, sf).withColumn("load_ord", F.when(F.col("event_id") % 2 == 1, 0).otherwise(1).cast("long"))
    r = r.groupBy("zone", "ts", "base_var", "serial", "load_ord").agg(F.max_by("v", "event_id").alias("value"))
    return r.select("zone", "serial", "ts", F.col("base_var").alias("channel"), "base_var", F.lit(0).alias("rep"), F.when(F.col("value") % 5 != 0, F.col("value")).alias("value"), "load_ord")


@query
def zone_upsert(spark, sf):
    return archive.upsert(_loads(spark, sf))


@query
def archive_increment(spark, sf):
    """Two loads, one after the other, into an archive by days."""
    import uuid

    from agrolith.session import shared_root

    path = f"{shared_root(spark)}/archive-{uuid.uuid4().hex}"
    loads = _loads(spark, sf).withColumn("load", 1 - F.col("load_ord"))
    for n in (0, 1):
        ledger.add(spark, path, loads.where(F.col("load") == n))
    return ledger.read(spark, path).select("zone", "ts", "channel", "rep", "serial", "value")


@query
def serial_concat(spark, sf):
    return archive.serials(_loads(spark, sf), ["zone", "ts"])


@query
def collision_rename(spark, sf):
    out = archive.renamed_collisions(_loads(spark, sf))
    return out.groupBy("zone", "serial", "channel", "rep").agg(F.count(F.lit(1)).alias("n"))


@query
def zone_lookup(spark, sf):
    registry = spark.createDataFrame([("S0", "North"), ("S1", "  ")], "serial string, zone string")
    out = archive.zone_of(_loads(spark, sf).drop("zone"), registry)
    return out.groupBy("serial", "zone").agg(F.count(F.lit(1)).alias("n"))


@query
def archive_summary(spark, sf):
    return archive.summary(I.readings(spark, sf), I.MINUTES)


@query
def daily_record_count(spark, sf):
    return archive.daily_counts(I.readings(spark, sf), ["zone"])


_MAP = {"loggers": {"0": {"treatments": {"control": {"temp": "temp"}, "lit": {"temp": "soil_temp", "ppfd": "ppfd"}}, "shared": ["rh"]}, "1": {"treatments": {"control": {"ppfd": "ppfd"}}, "shared": ["co2"]}}}


@query
def treatment_split(spark, sf):
    out = treatment.split(I.readings(spark, sf), treatment.map_table(spark, _MAP), logger="zone")
    return out.select("zone", "trt", "base_var", "channel", "ts", "value")


@query
def treatment_coverage(spark, sf):
    return treatment.coverage(I.readings(spark, sf), treatment.map_table(spark, _MAP), logger="zone")


@query
def logger_lookup(spark, sf):
    """Customers' numbers look for the part whose number contains theirs or is part of it."""
    keys = I.table(spark, sf, "customer").select((F.col("c_custkey") * 7 + 100).cast("string").alias("key"))
    loggers = I.table(spark, sf, "part").where("p_size > 5").select((F.col("p_partkey") * 13).cast("string").alias("logger"), F.col("p_partkey").alias("place"))
    return treatment.lookup(keys, loggers)


@query
def upload_dedup(spark, sf):
    files = I.table(spark, sf, "documents").select(store.fingerprint(F.col("text")).alias("fingerprint"), "doc_id")
    return store.first_of_each(files, "doc_id")


# --- statistics


def _wide(spark, sf):
    return reshape.pivot(I.readings(spark, sf), ["zone", "ts"], list(I.VARIABLES.values()))


@query
def corr_matrix(spark, sf):
    return stats.correlations(_wide(spark, sf), ["temp", "rh", "ppfd", "solar"]).withColumn("r", F.round("r", 8))


@query
def ols(spark, sf):
    out = stats.least_squares(_wide(spark, sf), "temp", "ppfd", "solar")
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("intercept", "b1", "b2")])


# --- streams


@query
def stream_daily(spark, sf):
    """Readings as a stream, in days, those still open too."""
    import uuid

    from agrolith.session import shared_root
    from agrolith.streaming import live

    # As a pattern, since a stream takes no single file as its folder.
    events = live.read(spark, f"{sf}/event[s].parquet", I.table(spark, sf, "events").schema)
    r = events.select((F.col("user_id") % 4).cast("string").alias("zone"), I.variable().alias("channel"), "ts", F.floor(F.col("value") + 0.5).cast("double").alias("value"))
    token = uuid.uuid4().hex
    return live.kept(live.daily(r), f"{shared_root(spark)}/days-{token}", f"{shared_root(spark)}/stream-{token}")


def _delivered(df: DataFrame) -> DataFrame:
    """What a stream tells of all that it has so far, as a table in the shared folder."""
    import uuid

    from agrolith.session import shared_root

    root = f"{shared_root(df.sparkSession)}/told-{uuid.uuid4().hex}"
    df.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/rows")


def _event_stream(spark, sf) -> DataFrame:
    from agrolith.streaming import live

    events = live.read(spark, f"{sf}/event[s].parquet", I.table(spark, sf, "events").schema)
    zone, serial = (F.col("user_id") % 4).cast("string"), F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string"))
    return events.select(zone.alias("zone"), serial.alias("serial"), I.variable().alias("channel"), "ts", F.floor(F.col("value") + 0.5).alias("value"))


@query
def stream_cooldown(spark, sf):
    """Readings over 100 as alerts of their logger and channel: the first, then each 12 hours or more after the last one sent."""
    from agrolith.streaming import stateful

    high = _event_stream(spark, sf).where("value > 100").withColumnRenamed("ts", "detected_at")
    return _delivered(stateful.cooled(high, ["zone", "serial", "channel"]))


@query
def stream_offline(spark, sf):
    """Losses of contact of each logger: runs of its readings that ended in two hours of silence."""
    from agrolith.streaming import stateful

    return _delivered(stateful.contact_lost(_event_stream(spark, sf), ["zone", "serial"]))
