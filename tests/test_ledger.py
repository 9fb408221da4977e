"""The archive by days: increments equal a rebuild, untouched files stay, writers do not lose each other's loads."""

import random
from datetime import datetime, timedelta

import pytest

from agrolith.operators import ledger as L

SCHEMA = "zone string, serial string, ts timestamp_ntz, channel string, base_var string, rep int, value double, load long"
T0 = datetime(2026, 4, 1)


def shown(df):
    return sorted((r.zone, r.ts, r.channel, r.rep, r.serial, r.value) for r in df.collect())


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet") if "version=" in str(f)}


def load(rng, n, rows=120):
    out = {}
    for _ in range(rows):
        zone, serial = rng.choice("AB"), rng.choice(["L1", "L2", "L3"])
        name, rep = rng.choice([("temp", 0), ("temp__rep2", 2), ("rh", 0)])
        ts = T0 + timedelta(days=rng.randrange(5), hours=rng.randrange(24))
        out[zone, serial, ts, name] = (zone, serial, ts, name, name.split("__")[0], rep, rng.choice([None, float(rng.randrange(99))]), n)
    return list(out.values())


def test_increments_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(4)
    loads = [load(rng, n) for n in range(4)]
    step, whole = f"{tmp_path}/step", f"{tmp_path}/whole"
    assert L.read(spark, step) is None
    for x in loads:
        L.add(spark, step, spark.createDataFrame(x, SCHEMA))
    every = spark.createDataFrame(sum(loads, []), SCHEMA)
    L.add(spark, whole, every)
    assert shown(L.read(spark, step)) == shown(L.read(spark, whole))

    # by hand: names by first come, then the newest value of each name
    owner, names, best = {}, {}, {}
    for x in loads:
        own = {}
        for r in x:
            own.setdefault((r[0], r[1]), set()).add(r[3])
        for zone, serial, base, rep, name in sorted({(r[0], r[1], r[4], r[5], r[3]) for r in x}):
            if (zone, serial, name) in names:
                continue
            to, k = name, 2
            while owner.get((zone, to), serial) != serial or (to != name and (to in own[zone, serial] or (zone, to) in owner)):
                to, k = f"{base}__rep{k}", k + 1
            owner[zone, to], names[zone, serial, name] = serial, to
        for zone, serial, ts, name, _, _, value, _ in x:
            key = zone, ts, names[zone, serial, name]
            if value is not None or key not in best:
                best[key] = serial, value
    assert {(r.zone, r.ts, r.channel): (r.serial, r.value) for r in L.read(spark, step).collect()} == best

    L.replace(spark, step, every)
    assert shown(L.read(spark, step)) == shown(L.read(spark, whole))
    for less in (every.where("serial <> 'L1'"), every.where("ts < '2026-04-04'"), every.where("false")):
        with pytest.raises(ValueError, match="refused"):
            L.replace(spark, step, less)
        assert shown(L.read(spark, step)) == shown(L.read(spark, whole))


def test_untouched_days_keep_their_files(spark, tmp_path):
    path = tmp_path / "a"
    rows = [(z, "L1", T0 + timedelta(days=d, hours=h), "temp", "temp", 0, 1.0, 0) for z in ("007", "1e3") for d in range(4) for h in range(3)]
    L.add(spark, str(path), spark.createDataFrame(rows, SCHEMA))
    before = files(path)
    L.add(spark, str(path), spark.createDataFrame([("007", "L1", T0 + timedelta(days=2), "temp", "temp", 0, 5.0, 1)], SCHEMA))
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == before
    assert all("day=2026-04-03" in f for f in set(after) - set(before)) and len(after) > len(before)
    got = {(r.zone, r.ts): r.value for r in L.read(spark, str(path)).collect()}
    assert len(got) == 24 and [k for k, v in got.items() if v == 5.0] == [("007", T0 + timedelta(days=2))]
    L.add(spark, str(path), spark.createDataFrame([], SCHEMA))
    assert files(path) == after and L.Ledger(spark, str(path)).last == 2


def test_compaction_and_vacuum(spark, tmp_path):
    path = tmp_path / "a"
    rows = lambda n: [("A", "L1", T0 + timedelta(days=d, hours=h), "temp", "temp", 0, float(n), n) for d in ((0, 1) if n else range(4)) for h in range(5)]
    for n in range(4):
        L.add(spark, str(path), spark.createDataFrame(rows(n), SCHEMA))
    want, before = shown(L.read(spark, str(path))), files(path)
    L.compact(spark, str(path))
    assert shown(L.read(spark, str(path))) == want
    assert all("day=2026-04-01" in f or "day=2026-04-02" in f for f in set(files(path)) - set(before))
    assert L.vacuum(spark, str(path)) == 0  # readers of earlier commits may still be at work
    assert shown(L.Ledger(spark, str(path), upto=4).readings().drop("day")) == want
    assert L.vacuum(spark, str(path), keep=0) > 0
    assert shown(L.read(spark, str(path))) == want and len({f.split("/")[1] for f in files(path)}) == 2
    L.add(spark, str(path), spark.createDataFrame(rows(9), SCHEMA))
    assert {r[5] for r in shown(L.read(spark, str(path))) if r[1] < T0 + timedelta(days=2)} == {9.0}


def test_two_writers(spark, tmp_path, monkeypatch):
    """A writer that finds its number taken starts over on what the other left."""
    path = f"{tmp_path}/a"
    one = spark.createDataFrame([("A", "L1", T0, "temp", "temp", 0, 1.0, 0)], SCHEMA)
    two = spark.createDataFrame([("A", "L2", T0, "temp", "temp", 0, 2.0, 1)], SCHEMA)
    L.add(spark, path, one.withColumn("value", one.value * 0))
    stale = L.Ledger(spark, path)
    L.add(spark, path, one)
    with pytest.raises(L.Taken):
        stale.commit(L._whole(spark))
    assert {(r.channel, r.value) for r in L.read(spark, path).collect()} == {("temp", 1.0)}

    ledgers = iter([stale])
    real = L.Ledger
    monkeypatch.setattr(L, "Ledger", lambda *a: next(ledgers, None) or real(*a))
    L.add(spark, path, two)
    assert {(r.channel, r.value) for r in real(spark, path).readings().collect()} == {("temp", 1.0), ("temp__rep2", 2.0)}
