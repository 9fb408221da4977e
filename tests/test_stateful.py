"""Cool-down and lost contact with state: as a plain loop over all rows tells them, in one batch or in many."""

import random
from datetime import datetime, timedelta

from agrolith.streaming import live, stateful

T0 = datetime(2026, 4, 1)
SCHEMA = "zone string, ts timestamp_ntz, other int"


def put(spark, path, rows):
    spark.createDataFrame([(z, t, 1) for z, t in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def plain_cooled(rows, hours):
    out, last = [], {}
    for z, t in sorted(rows, key=lambda r: (r[1], r[0] or "")):
        if z not in last or t - last[z] >= timedelta(hours=hours):
            last[z] = t
            out.append((z, t))
    return sorted(out, key=str)


def plain_lost(rows, minutes, watermark):
    out, span = [], timedelta(minutes=minutes)
    for z in {z for z, _ in rows}:
        times = sorted(t for k, t in rows if k == z)
        first = n = 0
        for i, t in enumerate(times):
            n += 1
            following = times[i + 1] if i + 1 < len(times) else None
            if (following is None and t + span <= watermark) or (following is not None and following - t >= span):
                out.append((z, times[first], t, n, t + span))
                first, n = i + 1, 0
    return sorted(out, key=str)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = [(rng.choice(["A", "B", None]), T0 + timedelta(minutes=rng.randrange(0, 60 * 24 * 5, 5))) for _ in range(n)]
    return rows + rows[:5]  # repeated rows


def run(spark, tmp_path, batches, make, name):
    """The stream, run once after each batch of rows has come."""
    src, out, cp = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"
    for rows in batches:
        put(spark, src, rows)
        df = make(live.read(spark, src, SCHEMA))
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    return sorted([tuple(r) for r in spark.read.schema(df.schema).parquet(out).collect()], key=str)


def test_cool_down_runs_from_the_last_sent(spark, tmp_path):
    rows = random_rows(1)
    cut = T0 + timedelta(days=2)
    batches = [[r for r in rows if r[1] < cut], [r for r in rows if r[1] >= cut] + [("A", None)]]
    make = lambda r: stateful.cooled(r, ["zone"], "ts", 12, "1 day")
    assert run(spark, tmp_path, batches, make, "c") == plain_cooled(rows, 12)


def test_contact_is_lost_once_and_out_of_order_rows_join_runs(spark, tmp_path):
    rows = random_rows(2)
    early = [r for r in rows if r[1] < T0 + timedelta(days=3)]
    late = set([r for r in early if r[1] > T0 + timedelta(days=2, hours=12)][::2])  # come with the next batch, within the lateness
    held = [r for r in early if r in late]
    batches = [[r for r in early if r not in late], held + [r for r in rows if r not in early]]
    make = lambda r: stateful.contact_lost(r, ["zone"], 120, "1 day")
    end = max(t for _, t in rows) - timedelta(days=1)
    want = [x for x in plain_lost(rows, 120, end) if x[4] <= end]
    assert want and run(spark, tmp_path, batches, make, "l") == want


def test_nothing_comes(spark, tmp_path):
    make = lambda r: stateful.contact_lost(r, ["zone"])
    assert run(spark, tmp_path, [[("A", None)]], make, "n") == []
