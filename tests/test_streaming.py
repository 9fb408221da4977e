"""The engine on streams gives what it gives on tables, as far as days have closed."""

from datetime import datetime, timedelta

from agrolith.operators.archive import upsert
from agrolith.operators.daily import summary
from agrolith.streaming import live

SCHEMA = "zone string, serial string, ts timestamp_ntz, channel string, value double"


def write(spark, path, days, value=1.0, first=0):
    t0 = datetime(2026, 4, 1)
    rows = [("A", "L", t0 + timedelta(days=d, hours=h), "temp", value + h) for d in range(first, first + days) for h in range(24)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_days_close_behind_the_watermark(spark, tmp_path):
    write(spark, f"{tmp_path}/in", 10)
    out = live.drained(live.daily(live.read(spark, f"{tmp_path}/in", SCHEMA)), "days_t", f"{tmp_path}/cp")
    table = summary(spark.read.parquet(f"{tmp_path}/in"), ["zone"], 60)
    same = out.join(table.select("zone", "channel", "date", "n", "mean", "min", "max"), ["zone", "channel", "date", "n", "mean", "min", "max"])
    assert out.count() == same.count() and out.count() >= 7


def test_upsert_is_the_batch_upsert(spark, tmp_path):
    write(spark, f"{tmp_path}/in", 2, 1.0)
    r = live.read(spark, f"{tmp_path}/in", SCHEMA)
    live.upserted(r, f"{tmp_path}/arc", f"{tmp_path}/cp").awaitTermination()
    write(spark, f"{tmp_path}/in", 2, 5.0, first=1)
    live.upserted(live.read(spark, f"{tmp_path}/in", SCHEMA), f"{tmp_path}/arc", f"{tmp_path}/cp").awaitTermination()
    got = live.archived(spark, f"{tmp_path}/arc")
    assert not list((tmp_path / "arc" / "epoch=1").rglob("date=2026-04-01"))  # a day that the batch has not
    assert got.count() == 72 and got.agg({"value": "sum"}).first()[0] == upsert(spark.read.parquet(f"{tmp_path}/in").selectExpr("*", "case when value - hour(ts) = 5 then 0L else 1L end as load_ord"), ["zone", "ts", "channel"]).agg({"value": "sum"}).first()[0]


def test_alerts_cool_down(spark, tmp_path):
    t0 = datetime(2026, 4, 1)
    rows = [("k", t0 + timedelta(hours=h)) for h in (0, 1, 5)] + [("q", t0)]
    spark.createDataFrame(rows, "key string, detected_at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = live.drained(live.cooled(live.read(spark, f"{tmp_path}/in", "key string, detected_at timestamp")), "cool_t", f"{tmp_path}/cp")
    assert sorted(r.key for r in out.collect()) == ["k", "q"]


def test_lost_contact(spark, tmp_path):
    t0 = datetime(2026, 4, 1)
    rows = [("A", t0 + timedelta(minutes=10 * i)) for i in range(6)] + [("A", t0 + timedelta(days=2))] + [("B", t0 + timedelta(days=3))]
    spark.createDataFrame(rows, "zone string, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = live.drained(live.offline(live.read(spark, f"{tmp_path}/in", "zone string, ts timestamp_ntz")), "off_t", f"{tmp_path}/cp")
    assert (out.orderBy("last_seen").first().records, out.orderBy("last_seen").first().last_seen) == (6, t0 + timedelta(minutes=50))


def test_daily_query_has_the_open_days(spark, sf):
    from agrolith.plans import inputs
    from agrolith.plans.queries import QUERIES

    got = {(r.zone, r.channel, str(r.date)): r.n for r in QUERIES["stream_daily"](spark, sf).collect()}
    rows = inputs.raw(spark, sf).selectExpr("zone", "base_var as channel", "to_date(ts) as date", "v").groupBy("zone", "channel", "date").agg({"v": "count"}).collect()
    assert got == {(r[0], r[1], str(r[2])): r[3] for r in rows}
