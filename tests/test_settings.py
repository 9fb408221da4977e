"""Settings files, and plain names of columns."""

from datetime import date, datetime, timedelta

import pytest

from agrolith import config
from agrolith.functions import names
from agrolith.operators import alerts
from agrolith.plans import flows

FILE = """
site: {name: Greenhouse, timezone: Asia/Seoul, interval_minutes: 60}
preprocess: {gdd_base: 8, daily_min_completeness: 0.5, drop_incomplete_days: true, photoperiod_ppfd_threshold: 20, daytime_hours: [8, 16], lag_days: 1, window_days: 3}
sensors:
  temp: {label: Air, unit: ℃, min: -10, max: 60, flat_n: 12, spike: 4}
  ph: {label: pH, unit: "", min: 3, max: 9}
qc: {gap_warn_minutes: 30, pair_divergence: {ec: 0.2}, transmittance: {drop_ratio: 0.6}}
alerts: {min_level: INFO, report_dir: out/reports, state_file: x.json, channels: {console: true, file: false, slack: false}, email: {recipients: [a], sender: b}}
verification: {log_file: log.csv, schedule_days: {visual_check: 14}, tolerance: {ppfd_rel: 0.1, vwc: 2.0}}
"""


def test_a_settings_file_in_use(tmp_path):
    (tmp_path / "c.yaml").write_text(FILE, encoding="utf-8")
    cfg = config.load(tmp_path / "c.yaml")
    assert cfg["interval_minutes"] == 60 and cfg["daily"] == {"gdd_base": 8, "photoperiod_threshold": 20, "daytime_hours": [8, 16], "min_completeness": 0.5}
    assert cfg["intervals"] == {"lag_days": 1, "window_days": 3, "drop_incomplete_days": True}
    assert cfg["qc"]["gap_warn_minutes"] == 30 and cfg["qc"]["gap_critical_minutes"] == 360 and cfg["qc"]["pair_divergence"] == {"temp": 1.0, "soil_temp": 1.0, "rh": 5.0, "vwc": 5.0, "ppfd": 0.15, "ec": 0.2}
    assert cfg["qc"]["transmittance"]["drop_ratio"] == 0.6 and cfg["qc"]["transmittance"]["recent_days"] == 3
    assert cfg["alerts"] == {"min_level": "INFO", "cooldown_hours": 12, "out_dir": "out/reports", "log": False, "console": True}
    assert cfg["verification"]["tolerance"]["ppfd"] == 0.1 and cfg["verification"]["schedule_days"]["visual_check"] == 14
    assert cfg["sensors"]["ph"]["max"] == 9 and cfg["sensors"]["rh"]["max"] == 100.0
    assert config.load() == config.DEFAULTS == config.deep_merge(config.DEFAULTS, None)


@pytest.mark.parametrize("text, told", [("qc: {gap_wran_minutes: 3}", "qc.gap_wran_minutes"), ("preprocess: {gdd: 3}", "preprocess.gdd"), ("sensors: {temp: {mni: 3}}", "sensors.temp.mni"), ("daily: {gdd_base: warm}", "gdd_base"), ("qc: {spike_enabled: 3}", "spike_enabled")])
def test_unknown_names_and_wrong_kinds_raise(tmp_path, text, told):
    (tmp_path / "c.yaml").write_text(text)
    with pytest.raises(ValueError, match=told):
        config.load(tmp_path / "c.yaml")


def test_settings_change_results(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("site: {interval_minutes: 60}\npreprocess: {gdd_base: 8, lag_days: 1, window_days: 2}\n")
    t0 = datetime(2026, 4, 1)
    rows = [("A", "L", t0 + timedelta(hours=h), "temp", "temp", 0, 20.0) for h in range(10 * 24)]
    readings = spark.createDataFrame(rows, "zone string, serial string, ts timestamp_ntz, channel string, base_var string, rep int, value double")
    out = {k: flows.preprocess(readings, config.load(p), surveys=["2026-04-06", "2026-04-09"]) for k, p in (("own", tmp_path / "c.yaml"), ("plain", None))}
    assert {r.gdd for r in out["own"]["daily"].collect()} == {12.0} and {r.gdd for r in out["plain"]["daily"].collect()} == {10.0}
    ends = {k: sorted((r.start_date, r.end_date) for r in v["intervals"].collect()) for k, v in out.items()}
    assert ends["own"] == [(date(2026, 4, 4), date(2026, 4, 5)), (date(2026, 4, 7), date(2026, 4, 8))] and ends["plain"][1] == (date(2026, 4, 7), date(2026, 4, 9))


@pytest.mark.parametrize("heading, plain", [
    ("m/s Wind Speed (avg)", "wind_speed"), ("(%)", "col"), ("% Relative Humidity", "relative_humidity"), ("%RH", "rh"), ("µmol·m⁻²·s⁻¹ PPFD", "ppfd"), ("[kPa] Matric Potential [kPa]", "matric_potential"),
    ("-1.5 kPa Suction", "suction"), ("수온 (℃)", "수온"), ("pH", "ph"), ("M", "m"), ("2nd Probe", "2nd_probe"), ("Flow (l/h) in", "flow_l_h_in"), ("a_b  c", "a_b_c"), ("°C", "col"), ("W/m² Net (in (out))", "net"), ("mmHg level", "mmhg_level"), ("", "col"),
])
def test_plain_names(heading, plain):
    assert names.sanitised(heading) == plain


def test_reports_count_all_alerts(spark):
    df = spark.range(30).selectExpr("'A' as zone", "'R' as rule", "if(id = 7, 'CRITICAL', 'WARN') as level", "'v' as variable", "cast(null as timestamp_ntz) as start", "cast(null as timestamp_ntz) as end", "1.0D as value", "'m' as message", "cast(id as string) as key")
    lines = alerts.text(df, "x", most=10).splitlines()
    assert lines[0] == "x: 30 alerts" and lines[1] == "the worst 10 are listed, 20 are left out" and len(lines) == 12 and "CRITICAL" in lines[2]
    assert "10 of 30 rows; 20 are left out" in alerts.markdown(df, most=10) and "left out" not in alerts.markdown(df)
