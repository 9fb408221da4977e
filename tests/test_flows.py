"""Exports to archive to alerts to matched tables, in one go."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from agrolith import config
from agrolith.operators import alerts, archive
from agrolith.plans import flows


def export(path, serial, first, days, hot=False):
    lines = [f"Plot Title: {serial}", "", "#,Date Time,°C Air Temperature,% Relative Humidity,PPFD (umol)"]
    for i in range(days * 144):
        t = first + timedelta(minutes=10 * i, seconds=1)
        sun = max(0.0, math.sin((t.hour - 6) / 12 * math.pi))
        lines.append(f"{i + 1},{t:%Y-%m-%d %H:%M:%S},{(99 if hot and i == 300 else 18 + 8 * sun + (i % 5) * 0.1):.2f},{60 + (i % 7)},{900 * sun + i % 3:.1f}")
    path.write_text("\n".join(lines), encoding="utf-8")


@pytest.fixture()
def week(tmp_path):
    (tmp_path / "in").mkdir()
    export(tmp_path / "in" / "a1.csv", "L-1001", datetime(2026, 4, 1), 5)
    export(tmp_path / "in" / "a2.csv", "L-1001", datetime(2026, 4, 5), 6, hot=True)
    export(tmp_path / "in" / "b1.csv", "L-2002", datetime(2026, 4, 1), 10)
    return tmp_path


REGISTRY = {"loggers": {"L-1001": {"zone": "North"}, "L-2002": {"zone": ""}}}


def test_archive_monitor_and_match(spark, week):
    cfg, path = config.load(), f"{week}/archive"
    told = flows.update_archive(spark, [f"{week}/in"], path, REGISTRY, cfg)
    rows = {r.zone: (r.rows, r.missing, r.interval_minutes) for r in told["summary"].collect()}
    assert rows == {"North": (1440, 0, 10.0), "L-2002": (1440, 0, 10.0)} and told["problems"].count() == 0
    before = spark.read.parquet(path).count()
    flows.update_archive(spark, [f"{week}/in/a2.csv"], path, REGISTRY, cfg)
    master = spark.read.parquet(path)
    assert master.count() == before == 2 * 3 * 1440

    now = datetime(2026, 4, 11)
    found, state = flows.monitor(master, cfg, now, lookback_days=None)
    assert {(r.zone, r.rule) for r in found.collect()} >= {("North", "R03_out_of_range"), ("North", "R13_heat_event")}
    assert alerts.exit_code(found) == 1 and {r.zone for r in state.collect()} == {"North", "L-2002"}

    growth = spark.createDataFrame([(date(2026, 4, d), z, 1.0 * d) for d in (5, 10) for z in ("North", "L-2002")], "date date, zone string, height double")
    out = flows.preprocess(master, cfg, growth)
    assert out["matched"].count() == 4 and out["matched"].where("quality = 'normal'").count() == 4
    assert {(r.zone, r.channel, r.masked) for r in out["range_report"].collect()} == {("North", "temp", 1)}
    with pytest.raises(ValueError):
        flows.preprocess(master, cfg, growth.drop("zone"))
    one = flows.preprocess(master.where("zone = 'North'"), cfg, growth.where("zone = 'North'").drop("zone"))
    assert one["matched"].count() == 2


def test_weekly_takes_each_upload_once(spark, week):
    cfg, now = config.load(), datetime(2026, 4, 11)
    first = flows.weekly(spark, [f"{week}/in"], f"{week}/root", cfg, REGISTRY, now, ["2026-04-05", "2026-04-10"])
    again = flows.weekly(spark, [f"{week}/in"], f"{week}/root", cfg, REGISTRY, now + timedelta(days=1), ["2026-04-05", "2026-04-10"])
    assert (first["new_files"], again["new_files"]) == (3, 0)
    assert first["sinks"] == {"log": "sent"} and first["sent"] > 0 and spark.read.json(f"{week}/root/alerts").count() == first["sent"] + again["sent"]
    soon = flows.weekly(spark, [f"{week}/in"], f"{week}/root", cfg, REGISTRY, now + timedelta(days=1, hours=1), ["2026-04-05"])
    assert soon["sent"] == 0  # all within the cool-down, whose state lasts between runs
    run = f"{week}/root/results/run={first['run']}"
    assert spark.read.parquet(f"{run}/summary").count() == 4 and spark.read.parquet(f"{run}/alerts").count() > 0


def test_treatments(spark, week):
    cfg, path = config.load(), f"{week}/archive"
    flows.update_archive(spark, [f"{week}/in/b1.csv"], path, REGISTRY, cfg)
    m = {"loggers": {"L-2002": {"treatments": {"t1": {"temp": "temp"}, "t2": {"ppfd": "ppfd"}}, "shared": ["rh"]}}}
    growth = spark.createDataFrame([(date(2026, 4, 10), t, 1.0) for t in ("t1", "t2", "t3")], "date date, trt string, height double")
    out = flows.preprocess(spark.read.parquet(path).where("zone = 'L-2002'"), cfg, growth.withColumn("zone", F.lit("L-2002")), sensor_map=m)
    got = {r.trt: (r.temp_mean is not None, r.dli_sum is not None, r.rh_mean is not None) for r in out["matched"].collect()}
    assert got == {"t1": (True, False, True), "t2": (False, True, True), "t3": (False, False, False)}


def test_the_archive_loses_nothing(spark, tmp_path):
    """Zones that look like numbers, a move cut short, a master that cannot be read, and fewer readings of a logger."""
    path = f"{tmp_path}/archive"
    rows = [(datetime(2026, 4, d), "temp", "temp", 0, "L-1", float(d), z) for d in range(1, 6) for z in ("007", "1e3")]
    master = spark.createDataFrame(rows, archive.SCHEMA)
    assert archive.read(spark, path) is None
    archive.replace_guarded(spark, master, path, f"{path}.staging")
    assert {r.zone for r in archive.read(spark, path).collect()} == {"007", "1e3"}

    (tmp_path / "archive").rename(tmp_path / "archive.before")
    assert archive.read(spark, path).count() == 10 and not (tmp_path / "archive.before").exists()

    for less in (master.where("ts < '2026-04-05'"), master.where("zone = '007'"), master.where("false")):
        with pytest.raises(ValueError):
            archive.replace_guarded(spark, less, path, f"{path}.staging")
        assert archive.read(spark, path).count() == 10
    for f in (tmp_path / "archive").rglob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):  # noqa: B017
        flows.update_archive(spark, [f"{tmp_path}/none.csv"], path, REGISTRY)
    assert (tmp_path / "archive").exists()
