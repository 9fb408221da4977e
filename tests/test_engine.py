"""Injected faults, known results and invariants of the sensor operators."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from agrolith import config
from agrolith.operators import alerts, archive, clean, daily, grid, health, intervals, ordered, reshape, rules, stats, store, treatment, verify

T0 = datetime(2026, 4, 1)
SCHEMA = "zone string, serial string, ts timestamp_ntz, channel string, base_var string, rep int, value double"


def frame(spark, series, zone="A", minutes=10, start=T0):
    """``series``: channel -> list of values, one for each slot."""
    out = []
    for ch, values in series.items():
        base, _, rep = ch.partition("__rep")
        out += [(zone, f"L-{zone}", start + timedelta(minutes=minutes * i), ch, base, int(rep or 0), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(out, SCHEMA)


def alert_rows(df):
    return df.orderBy("start").collect()


@pytest.fixture(scope="module")
def cfg():
    return config.load()


@pytest.fixture(scope="module")
def season(spark):
    """Sixty days of ten-minute readings with six injected faults."""
    rng, rows = random.Random(42), []
    for i in range(60 * 144):
        t = T0 + timedelta(minutes=10 * i)
        if datetime(2026, 4, 30, 2) <= t < datetime(2026, 4, 30, 10):
            continue
        sun = max(0.0, math.sin((t.hour + t.minute / 60 - 6) / 12 * math.pi))
        temp = -99.9 if datetime(2026, 5, 20, 12) <= t < datetime(2026, 5, 20, 15) else 18 + 8 * sun + rng.gauss(0, 0.2)
        soil = 21.5 if datetime(2026, 5, 10) <= t < datetime(2026, 5, 10, 20) else 20 + 2 * sun + rng.gauss(0, 0.05)
        ppfd = 0.0 if t.date() == date(2026, 5, 25) else 900 * sun + (rng.random() if sun else 0)
        rh = None if t.date() == date(2026, 5, 15) else 70 - 20 * sun + rng.gauss(0, 0.5)
        rows += [("A", "L", t, c, c, 0, v) for c, v in (("temp", temp), ("soil_temp", soil), ("ppfd", ppfd), ("rh", rh))]
    df = spark.createDataFrame(rows, SCHEMA)
    return grid.on_grid(df.drop("serial"), ["zone", "channel", "base_var", "rep"], 600).cache()


def test_outage_becomes_one_gap_of_48(season, cfg):
    (a,) = alert_rows(rules.r01_gaps(season, cfg, 10))
    assert (a.value, a.level, a.start, a.end) == (48, "CRITICAL", datetime(2026, 4, 30, 2), datetime(2026, 4, 30, 9, 50))


def test_mask_counts_18(season, cfg):
    report = clean.range_report(season, config.specs(season.sparkSession, cfg), ["zone", "channel"]).collect()
    assert [(r.channel, r.masked) for r in report] == [("temp", 18)]
    assert clean.masked(season, config.specs(season.sparkSession, cfg)).where("value = -99.9").count() == 0


def test_rules_name_the_injected_days(season, cfg):
    found = {(r.rule, r.variable, r.start.date()) for r in rules.run_all(season, cfg, 10, lookback_days=None).collect()}
    assert ("R02_missing_ratio", "rh", date(2026, 5, 15)) in found
    assert ("R03_out_of_range", "temp", date(2026, 5, 20)) in found
    assert ("R04_flatline", "soil_temp", date(2026, 5, 10)) in found
    assert ("R06_daytime_dark", "ppfd", date(2026, 5, 25)) in found


def test_severity_order(season, cfg):
    levels = [config.LEVELS[r.level] for r in rules.run_all(season, cfg, 10, lookback_days=None).collect()]
    assert levels == sorted(levels, reverse=True)


def test_no_alerts_on_clean_data(spark, cfg):
    n = 1440
    wave = [math.sin(i / 144 * 2 * math.pi) for i in range(n)]
    df = frame(spark, {"temp": [20 + 5 * w + (i % 7) * 0.01 for i, w in enumerate(wave)], "rh": [60 - 10 * w + (i % 5) * 0.01 for i, w in enumerate(wave)], "ppfd": [max(0, -w) * 1000 + (i % 3) * 0.1 * (w < 0) for i, w in enumerate(wave)]})
    assert [r for r in rules.run_all(df, cfg, 10, None).collect() if r.level != "INFO"] == []


def test_empty_data_gives_no_alerts(spark, cfg):
    none = frame(spark, {"temp": [1]}).where("false")
    assert rules.run_all(none, cfg, 10, None, datetime(2026, 5, 1)).count() == 0
    assert alerts.exit_code(rules.run_all(none, cfg, 10, None)) == 0


def test_dli_and_photoperiod(spark):
    wide = spark.createDataFrame([("A", T0 + timedelta(minutes=10 * i), 1000.0 if 36 <= i < 108 else 0.0) for i in range(144)], "zone string, ts timestamp_ntz, ppfd double")
    (r,) = daily.wide_summary(wide, ["zone"], 10).collect()
    assert (r.dli, r.photoperiod_h, r.ppfd_day_mean, r.is_complete) == (pytest.approx(43.2), 12.0, 1000.0, True)


def test_vpd_is_not_made_of_means(spark):
    rows = [("A", T0 + timedelta(minutes=10 * i), 10.0 + 20 * (i % 2), 50.0) for i in range(144)]
    (r,) = daily.wide_summary(spark.createDataFrame(rows, "zone string, ts timestamp_ntz, temp double, rh double"), ["zone"], 10).collect()
    assert r.vpd_mean > 0.6108 * math.exp(17.27 * 20 / 257.3) * 0.5


def test_daily_matches_long_form(season):
    wide = daily.wide_summary(reshape.pivot(season, ["zone", "ts"], ["temp", "rh", "soil_temp", "ppfd"]), ["zone"], 10)
    long = daily.summary(season, ["zone"], 10).where("channel = 'temp'").select("date", "mean", "missing_ratio")
    both = wide.select("date", "temp_mean", "temp_missing_ratio").join(long, "date").collect()
    assert len(both) == 60 and all(abs(r.temp_mean - r["mean"]) < 1e-9 and r.temp_missing_ratio == r.missing_ratio for r in both)


@pytest.mark.parametrize("minutes", [1, 2.5, 5, 10, 15, 30, 60])
def test_interval_is_found(spark, minutes):
    rows = [("A", T0 + timedelta(seconds=minutes * 60 * i)) for i in range(50) if i not in (7, 8, 20)]
    (r,) = grid.interval_minutes(spark.createDataFrame(rows, "zone string, ts timestamp_ntz"), ["zone"]).collect()
    assert r.interval_minutes == minutes


def test_interval_of_few_times_is_the_default(spark):
    rows = [("A", T0), ("A", T0 + timedelta(minutes=3)), ("B", T0)]
    assert {r.interval_minutes for r in grid.interval_minutes(spark.createDataFrame(rows, "zone string, ts timestamp_ntz"), ["zone"]).collect()} == {10.0}


def test_windows_cut_into_days_are_whole(spark):
    rng = random.Random(1)
    rows = [(k, T0 + timedelta(hours=5 * i), rng.choice([0, 0, 1])) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    got = {(r.k, r.ts): (r.before, r.total) for r in ordered.running_sum(ordered.with_previous(df, ["k"], "ts", {"v": "before"}), ["k"], "ts", F.col("v"), "total").collect()}
    for k in "ab":
        own, total, before = [r for r in rows if r[0] == k], 0, None
        for _, t, v in own:
            total += v
            assert got[k, t] == (before, total)
            before = v
    runs = ordered.islands(df, ["k"], "ts", F.col("v") == 1).groupBy("k", "island").count().collect()
    expected = sum(r[2] == 1 and (i == 0 or rows[i - 1][2] == 0 or rows[i - 1][0] != r[0]) for i, r in enumerate(rows))
    assert len(runs) == expected


def test_flatline_starts_at_the_repeated_reading(spark, cfg):
    values = [float(i % 10) for i in range(50)] + [5.5] * 40 + [float(i % 10) for i in range(50)]
    (a,) = alert_rows(rules.r04_flatline(frame(spark, {"temp": values}), cfg, 10))
    assert a.start == T0 + timedelta(minutes=500) and a.end == T0 + timedelta(minutes=890) and a.level == "WARN"


def test_constant_port_is_reported_though_zero(spark, cfg):
    df = frame(spark, {"vwc__rep1": [0.0] * 200, "vwc__rep2": [30 + (i % 9) for i in range(200)]})
    (a,) = alert_rows(rules.r04_flatline(df, cfg, 10))
    assert a.detail == "vwc__rep1" and "port" in a.message
    assert {r.channel for r in reshape.representative(df).collect()} == {"vwc__rep2"}


def test_replicate_mean_leaves_dead_ports_out(spark):
    df = frame(spark, {"vwc__rep1": [0.0] * 20, "vwc__rep2": list(range(20)), "vwc__rep3": list(range(10, 30))})
    assert [r.value for r in reshape.replicate_mean(df).orderBy("ts").limit(2).collect()] == [5.0, 6.0]


def test_pair_divergence(spark, cfg):
    on = config.deep_merge(cfg, {"qc": {"pair_divergence_enabled": True}})
    df = frame(spark, {"vwc__rep1": [25.0] * 300, "vwc__rep2": [45.0] * 300})
    (a,) = alert_rows(rules.r10_pair_divergence(df, on, 10))
    assert (a.value, a.detail) == (20.0, "vwc__rep1 vs vwc__rep2")
    assert rules.r10_pair_divergence(df, cfg, 10).count() == 0


def test_offline_levels(spark, cfg):
    df = frame(spark, {"temp": [1, 2, 3]})
    last = T0 + timedelta(minutes=20)
    levels = [[r.level for r in rules.r09_offline(df, cfg, last + timedelta(minutes=m)).collect()] for m in (60, 120, 720)]
    assert levels == [[], ["WARN"], ["CRITICAL"]]


def test_transmittance_drop(spark, cfg):
    rows = {"ppfd": [], "solar": []}
    for day in range(20):
        for i in range(144):
            noon = 60 <= i < 90
            rows["solar"].append(400.0 if noon else 0.0)
            rows["ppfd"].append((800.0 if day < 17 else 200.0) if noon else 0.0)
    (a,) = alert_rows(rules.r11_transmittance(frame(spark, rows), cfg))
    assert a.value == 0.25 and a.start.date() == date(2026, 4, 18)


def test_rule_error_is_isolated(spark, cfg):
    def broken(grid, cfg, minutes):
        raise RuntimeError("no")

    def failing(grid, cfg, minutes):
        return rules.r03_out_of_range(grid.withColumn("value", F.raise_error(F.lit("no")).cast("double")), cfg, minutes)

    for bad in (broken, failing):  # planned, running
        out = rules.run_all(frame(spark, {"temp": [1, 2, 99]}), cfg, 10, None, rules=(bad, rules.r03_out_of_range)).collect()
        assert [r.rule for r in out] == ["R03_out_of_range", "R00_rule_error"]


# --- intervals


def test_survey_dates():
    assert intervals.survey_dates(start="2026-04-10", interval=10, count=3) == [date(2026, 4, 10), date(2026, 4, 20), date(2026, 4, 30)]
    for bad in ({}, {"start": "2026-04-10"}, {"start": "2026-04-10", "interval": 5}, {"start": "x", "interval": 5, "count": 1}, {"start": "2026-04-10", "interval": 5, "end": "2026-04-01"}):
        with pytest.raises(ValueError):
            intervals.survey_dates(**bad)


def days(spark, n=30, missing=()):
    return spark.createDataFrame([(date(2026, 4, 1) + timedelta(days=i), 10.0, 20.0, 1.0, True) for i in range(n) if i not in missing], "date date, dli double, temp_mean double, completeness double, is_complete boolean")


def test_intervals_cover_days_once_and_totals_run(spark):
    s = spark.createDataFrame([(date(2026, 4, d),) for d in (10, 20, 30)], "growth_date date")
    out = intervals.with_flags(intervals.with_totals(intervals.aggregate(days(spark, missing=(14,)), intervals.definitions(s)))).orderBy("interval_id").collect()
    assert [r.days_used for r in out] == [10, 9, 10] and [r.cum_dli for r in out] == [100.0, 190.0, 290.0]
    assert [r.quality for r in out] == ["normal", "normal", "normal"]
    early = intervals.with_flags(intervals.aggregate(days(spark, 5), intervals.definitions(s))).orderBy("interval_id").collect()
    assert [r.quality for r in early] == ["day shortage(5/10)", "no data", "no data"]


def test_lag_shifts_and_windows_overlap(spark):
    s = spark.createDataFrame([(date(2026, 4, d),) for d in (10, 12)], "growth_date date")
    lag = intervals.definitions(s, lag_days=2).orderBy("interval_id").collect()
    assert (lag[1].start_date, lag[1].end_date, lag[1].growth_date) == (date(2026, 4, 9), date(2026, 4, 10), date(2026, 4, 12))
    both = intervals.aggregate(days(spark), intervals.definitions(s, window_days=7)).collect()
    assert {r.days_used for r in both} == {7}


def test_growth_rows_never_multiply(spark):
    s = spark.createDataFrame([(date(2026, 4, 10),)], "growth_date date")
    by = intervals.aggregate(days(spark).crossJoin(spark.createDataFrame([("a",), ("b",)], "trt string")), intervals.definitions(s), ["trt"])
    g = spark.createDataFrame([(date(2026, 4, 10), "a", 1.0), (date(2026, 4, 11), "b", 2.0)], "date date, trt string, h double")
    with pytest.raises(ValueError):
        intervals.match_growth(g, by)
    assert [(r.h, r.dli_sum) for r in intervals.match_growth(g, by, treatment="trt").orderBy("h").collect()] == [(1.0, 70.0), (2.0, None)]  # one survey: seven days


def test_growth_rate(spark):
    g = spark.createDataFrame([("a", date(2026, 4, 1), 1.0, 10), ("a", date(2026, 4, 11), 4.0, 10), ("b", date(2026, 4, 1), 7.0, 10)], "trt string, date date, h double, days_expected int")
    assert [r.h_rate for r in intervals.growth_rate(g, ["h"], ["trt"]).orderBy("trt", "date").collect()] == [None, 0.3, None]


# --- alerts


def test_cooldown_and_failed_sinks(spark, cfg):
    df = rules.r03_out_of_range(frame(spark, {"temp": [99.0] * 20}), cfg, 10)
    now, sent = datetime(2026, 4, 2), []

    def broken(_):
        raise OSError("down")

    new, state, told = alerts.dispatch(df, alerts.empty_state(spark), now, {"down": broken})
    assert new.count() == 1 and state.count() == 0 and told["down"].startswith("failed")
    new, state, told = alerts.dispatch(df, state, now, {"down": broken, "list": lambda d: sent.extend(d.collect())})
    assert len(sent) == 1 and state.count() == 1 and told["list"] == "sent"
    assert alerts.due(df, state, now + timedelta(hours=11)).count() == 0
    assert alerts.due(df, state, now + timedelta(hours=13)).count() == 1
    assert "R03_out_of_range" in alerts.text(df) and "| CRITICAL |" in alerts.markdown(df)
    assert alerts.exit_code(df) == 2


# --- verification


def test_compare_and_constants(spark):
    df = frame(spark, {"temp__rep1": [float(i) for i in range(20)], "temp__rep2": [2.0 * i + 1 for i in range(20)]})
    (r,) = verify.compare(verify.pairs(df, "temp__rep1", "temp__rep2", ["zone"]), ["zone"]).collect()
    assert (round(r.slope, 9), round(r.intercept, 9), round(r.r, 9), r.n) == (2.0, 1.0, 1.0, 20)
    flat = frame(spark, {"a": [1.0] * 10, "b": [2.0] * 10})
    (r,) = verify.compare(verify.pairs(flat, "a", "b", ["zone"]), ["zone"]).collect()
    assert r.slope is None and r.r is None and r.bias == 1.0
    assert verify.compare(verify.pairs(frame(spark, {"a": [1.0] * 5, "b": [2.0] * 5}), "a", "b", ["zone"]), ["zone"]).count() == 0


def test_due_drift_and_verdicts(spark):
    rows = [(date(2026, 1, 1) + timedelta(days=30 * i), "L", "S", "t", "temp", "field_check", 20.0, 20.0 + 0.1 * i) for i in range(5)]
    log = verify.recorded(spark.createDataFrame(rows, "date date, logger_id string, sensor_id string, sensor_type string, variable string, check_type string, reference_value double, sensor_value double"), {"temp": 0.25})
    assert [r.result for r in log.orderBy("date").collect()] == ["pass", "pass", "pass", "fail", "fail"]
    (d,) = verify.drift(log, ["sensor_id", "variable"]).collect()
    assert d.slope_per_day == 0.003333 and d.n == 5
    status = {r.check_type: r.status for r in verify.due_status(log, log, {"field_check": 90, "calibration": 365}, date(2026, 7, 29)).collect()}
    assert status == {"field_check": "imminent", "calibration": "never"}


# --- archive


def test_upsert_newer_wins_and_older_fills(spark):
    rows = [("A", "new", T0, "temp", 1.0, 0), ("A", "old", T0, "temp", 2.0, 1), ("A", "new", T0, "rh", None, 0), ("A", "old", T0, "rh", 5.0, 1), ("A", "x", None, "rh", 9.0, 0)]
    out = {r.channel: (r.value, r.serial) for r in archive.upsert(spark.createDataFrame(rows, "zone string, serial string, ts timestamp_ntz, channel string, value double, load_ord long")).collect()}
    assert out == {"temp": (1.0, "new"), "rh": (5.0, "old")}


def test_serials_are_taken_apart(spark):
    df = spark.createDataFrame([("A", "b+a"), ("A", "a"), ("A", "c")], "zone string, serial string")
    assert archive.serials(df, ["zone"]).first().serial == "a+b+c"


def test_rebuild_equals_increment_and_reload_changes_nothing(spark):
    reg = spark.createDataFrame([("L-A", "North"), ("L-B", "North")], "serial string, zone string")
    a = frame(spark, {"temp": [1, 2, None, 4]}).drop("zone")
    b = frame(spark, {"temp": [9, 8, 7, 6, 5]}, zone="B").drop("zone")
    rows = lambda df: sorted(map(tuple, df.select("zone", "ts", "channel", "value").collect()), key=str)
    whole = archive.build(spark, [b, a], None, reg, 600)
    again = archive.build(spark, [b, a, a], None, reg, 600)
    assert rows(whole) == rows(again)
    assert {r.channel for r in whole.collect()} == {"temp", "temp__rep2"}


def test_guard_refuses_to_lose_loggers(spark, tmp_path):
    df = frame(spark, {"temp": [1, 2]}).unionByName(frame(spark, {"temp": [3]}, zone="B"))
    path = f"file://{tmp_path}/master"
    archive.replace_guarded(spark, df, path, f"{path}.new")
    with pytest.raises(ValueError, match="L-B"):
        archive.replace_guarded(spark, df.where("zone = 'A'"), path, f"{path}.new")
    assert spark.read.parquet(path).count() == 3


def test_treatments(spark):
    m = {"loggers": {"L-A": {"treatments": {"t1": {"vwc": "vwc__rep1"}, "t2": {"vwc": "vwc__rep2", "temp": "vwc__rep1"}}, "shared": ["temp"]}}}
    df = frame(spark, {"vwc__rep1": [1], "vwc__rep2": [2], "temp": [20], "co2": [400]})
    table = treatment.map_table(spark, m)
    out = {(r.trt, r.base_var): r.value for r in treatment.split(df, table).collect()}
    assert out == {("t1", "vwc"): 1.0, ("t1", "temp"): 20.0, ("t2", "vwc"): 2.0, ("t2", "temp"): 1.0}
    assert [(r.channel, r.state) for r in treatment.coverage(df, table).collect()] == [("co2", "found, not mapped")]
    assert treatment.resolve(m, "L-A_2026") == "L-A" and treatment.resolve(m, "Q") is None


def test_uploads_and_results(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, text in (("a.csv", "x"), ("b.csv", "x"), ("c.csv", "y")):
        (tmp_path / "in" / n).write_text(text)
    log = f"{tmp_path}/log"
    assert store.save_uploads(spark, [f"{tmp_path}/in"], log, T0).count() == 2
    assert store.save_uploads(spark, [f"{tmp_path}/in"], log, T0 + timedelta(days=1)).count() == 0
    store.save_result({"days": spark.range(3)}, f"{tmp_path}/out", "one", T0)
    store.save_result({"days": spark.range(4)}, f"{tmp_path}/out", "two", T0 + timedelta(days=1))
    assert [r.label for r in store.results(spark, f"{tmp_path}/out").collect()] == ["two", "one"]


def test_registry(spark, tmp_path):
    path = tmp_path / "reg.yaml"
    reg = store.set_zone(store.load_registry(path), "z6-1", "North")
    seen = spark.createDataFrame([("z6-1", "METER ZL6", f"f{i}.csv", "2026-04-01", f"2026-04-0{i + 1}") for i in range(7)], "serial string, model string, file string, first string, last string")
    store.save_registry(store.touch(reg, seen), path)
    own = store.load_registry(path)["loggers"]["z6-1"]
    assert own["zone"] == "North" and own["last_seen"] == "2026-04-07" and own["recent_files"] == [f"f{i}.csv" for i in (6, 5, 4, 3, 2)]
    assert store.registry_table(spark, {"loggers": {"z6-1": own}}).first().files == 7


def test_health(spark, cfg):
    out = health.table(frame(spark, {"temp": [20.0] * 100 + [99.0], "rh": [50.0] * 101}), config.specs(spark, cfg), 10, days=1).collect()
    assert {r.channel: (r.status, r.out_of_range, r.last_value) for r in out} == {"temp": ("caution", 1, 99.0), "rh": ("caution", 0, 50.0)}


def test_least_squares_and_correlations(spark):
    rng = random.Random(5)
    rows = [(a := rng.random(), b := rng.random(), 3 + 2 * a - b) for _ in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    r = stats.least_squares(df, "y", "a", "b").first()
    assert [round(x, 6) for x in (r.intercept, r.b1, r.b2)] == [3.0, 2.0, -1.0]
    assert stats.correlations(df, ["a", "b", "y"]).count() == 3
