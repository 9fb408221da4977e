"""Seven rules in one pass give what each gives by itself; exact medians by selection give Spark's."""

import random
from collections import Counter
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from agrolith import config
from agrolith.operators import grid, rules, selection

ALONE = (rules.r03_out_of_range, rules.r04_flatline, rules.r05_spike, rules.r06_daytime_dark, rules.r07_night_light, rules.r08_rh_saturated, rules.r13_heat)
ON = {"qc": {"night_light_enabled": True, "rh_saturated_hours": 5, "spike_warn_count": 1, "pair_divergence_enabled": True}, "sensors": {"temp": {"flat_minutes": 180}, "rh": {"flat_minutes": 180}, "ppfd": {"flat_minutes": 120}}}


def series(seed: int):
    """Rough series: long equal stretches over midnight, saturated ones, missing values, days with one row, days without any."""
    r, rows = random.Random(seed), []
    for zone in ("A", "B"):
        for channel, var, rep in (("temp", "temp", 0), ("temp__rep1", "temp", 1), ("temp__rep2", "temp", 2), ("rh", "rh", 0), ("ppfd", "ppfd", 0), ("solar", "solar", 0), ("odd", "odd", 0)):
            v = 20.0
            for h in range(24 * 6):
                if 48 <= h < 72 and r.random() < 0.97 or r.random() < 0.1:
                    continue
                if r.random() < 0.25:
                    v = r.choice([0.0, 5.0, 12.0, 20.0, 46.0, 99.0, 99.5, 130.0, 3000.0, None])
                rows.append((zone, datetime(2026, 5, 1) + timedelta(hours=h), channel, var, rep, v))
    return rows


def told(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(2))
def test_one_pass_gives_what_each_rule_gives(spark, seed):
    df = spark.createDataFrame(series(seed), "zone string, ts timestamp_ntz, channel string, base_var string, rep int, value double").cache()
    cfg = config.deep_merge(config.DEFAULTS, ON if seed % 2 else {})
    for data in (df, grid.on_grid(df, ["zone", "channel", "base_var", "rep"], 3600)):
        alone = told(reduce(lambda a, b: a.unionByName(b), [f(data, cfg, 60) for f in ALONE]))
        assert told(rules.swept(data, cfg, 60)) == alone and len(alone) > 20


def test_rules_turned_off_find_nothing(spark):
    df = spark.createDataFrame(series(1), "zone string, ts timestamp_ntz, channel string, base_var string, rep int, value double")
    cfg = config.deep_merge(config.DEFAULTS, {"qc": {"flatline_enabled": False, "spike_enabled": False}})
    assert {r.rule for r in rules.swept(df, cfg, 60).collect()}.isdisjoint({"R04_flatline", "R05_spike", "R07_night_light"})
    assert rules.swept(df.where("false"), cfg, 60).count() == 0


def test_rules_run_when_they_are_read(spark):
    df = spark.createDataFrame(series(1), "zone string, ts timestamp_ntz, channel string, base_var string, rep int, value double")
    spark.sparkContext.setJobGroup("planned", "planned")
    rules.run_all(df, config.deep_merge(config.DEFAULTS, ON), 60, None, datetime(2026, 5, 9))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planned")) == []
    spark.sparkContext.setJobGroup("other", "other")


def test_one_sort_of_the_readings(spark):
    df = spark.createDataFrame(series(1), "zone string, ts timestamp_ntz, channel string, base_var string, rep int, value double")
    plan = rules.swept(df, config.DEFAULTS, 60)._jdf.queryExecution().sparkPlan().toString()
    full = rules.swept(df, config.DEFAULTS, 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("Scan ExistingRDD") <= 2  # readings and specifications
    assert full.count("hashpartitioning(") == 3  # by day, by channel, by rule


def test_a_lost_disk_is_no_rules_fault(spark):
    df = spark.createDataFrame(series(1), "zone string, ts timestamp_ntz, channel string, base_var string, rep int, value double")

    def unlucky(g, cfg, minutes):
        raise OSError("java.io.IOException: No space left on device")

    with pytest.raises(OSError):
        rules.run_all(df, config.DEFAULTS, 60, None, rules=(unlucky,))


# --- medians


@pytest.mark.parametrize("accuracy", [10, 2000])
def test_medians_are_exact(spark, accuracy):
    r = random.Random(3)
    groups = {
        "one": [4.5], "two": [1.0, 2.0], "same": [7.0] * 501, "half": [1.0] * 50 + [9.0] * 50, "none": [None, None], "wide": [10.0 ** r.randint(-300, 300) * r.choice((-1, 1)) for _ in range(999)],
        "hot": [r.gauss(0, 1) for _ in range(20000)], "ties": [float(r.randint(0, 3)) for _ in range(5000)], None: [3.0, None, 8.0], "holes": [r.choice((None, 1.25, -4.0, r.random())) for _ in range(400)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(7)
    got = {x.k: x.median for x in selection.medians(df, ["k"], "v", accuracy).collect()}
    assert got == {x.k: x.m for x in df.groupBy("k").agg(F.median("v").alias("m")).collect()} and set(got) == set(groups)


def test_medians_of_nothing(spark):
    assert selection.medians(spark.createDataFrame([], "k string, v double"), ["k"], "v").count() == 0


def test_a_wrong_sketch_is_seen(spark, monkeypatch):
    df = spark.createDataFrame([("a", float(i)) for i in range(1001)], "k string, v double")
    monkeypatch.setattr(selection.F, "percentile_approx", lambda *a: F.array(F.lit(900.0), F.lit(910.0)))
    with pytest.raises(Exception, match="sketch"):
        selection.medians(df, ["k"], "v").collect()
