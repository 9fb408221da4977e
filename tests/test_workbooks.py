"""Workbooks read as events, times voted by file, results as csv."""

import tracemalloc
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from agrolith.operators import store
from agrolith.sources import logger_files as L
from agrolith.sources import parsing
from agrolith.sources.workbooks import workbook

T0 = datetime(2026, 4, 1)


@pytest.mark.parametrize("shared", [True, False])
def test_round_trip(shared):
    rows = [["a & <b>", None, "é 한"], [], ["Timestamp", "x", "x"], [T0, 1.5, None], [46113.25, "ERROR", -2], [None, None, None]]
    book = parsing.Workbook(workbook({"One": rows, "T & wo": [["z"] * 30]}, shared=shared))
    assert list(book.sheets) == ["One", "T & wo"]
    assert list(book.rows("One")) == [["a & <b>", "", "é 한"], ["Timestamp", "x", "x"], ["2026-04-01 00:00:00", "1.5"], ["2026-04-01 06:00:00", "ERROR", "-2"]]
    assert list(book.rows("T & wo")) == [["z"] * 30]


def test_a_large_sheet_is_never_held():
    rows = [["Timestamp", *[f"v{i}" for i in range(20)]]] + [[T0 + timedelta(minutes=i), *[i + j / 7 for j in range(19)], f"note {i}"] for i in range(20_000)]
    data = workbook({"Data": rows})
    del rows
    tracemalloc.start()
    n = sum(1 for _ in parsing.cells_of(data, "z6-00001.xlsx"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000 * 19 and most < len(data) + 12e6  # its 420,000 cells as texts alone are over 25 MB


def test_one_format_for_a_file(spark):
    days = [T0 + timedelta(days=d, hours=5) for d in range(2, 25)]
    written = {"day first": "%d/%m/%Y %H:%M", "month first": "%m/%d/%Y %H:%M", "afternoon": "%m/%d/%y %I:%M:%S PM", "iso": "%Y-%m-%d %H:%M:%S"}
    rows = [(f, f"{t:{w}}", t + timedelta(hours=12 * (f == "afternoon"))) for f, w in written.items() for t in days]
    rows += [("early", f"{t:%d/%m/%Y}", datetime(2026, t.day, t.month)) for t in days if t.day <= 12]  # nothing tells: the first format
    rows += [("mixed", "2026-04-01", T0), ("mixed", "2026-04-02 10:00", T0 + timedelta(days=1, hours=10)), ("mixed", "01/02/2026", None), ("mixed", None, None), ("none", "x", None), (None, "2026-04-01", T0)]
    df = spark.createDataFrame([(f, x) for f, x, _ in rows], "file string, ts_raw string")
    assert sorted(map(str, L.timed(df, ["file"]).collect())) == sorted(map(str, spark.createDataFrame(rows, "file string, ts_raw string, ts timestamp_ntz").collect()))
    votes = {r.file: (r.format, round(r.share, 2)) for r in L.time_formats(df, ["file"]).collect()}
    assert votes["day first"] == ("dd/MM/yyyy[ HH:mm[:ss]]", 1.0) and votes["mixed"][1] == 0.67 and "none" not in votes


def test_times_of_korean_loggers(spark):
    df = spark.createDataFrame([("a", f"05. {d}. 25 오후 0{d % 9 + 1}시 30분 01초") for d in range(10, 29)], "file string, ts_raw string")
    got = L.timed(df, ["file"]).agg(F.min("ts"), F.count("ts")).first()
    assert tuple(got) == (datetime(2025, 5, 10, 14, 30, 1), 19)


def test_results_as_csv_and_runs_of_one_second(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n long, t string")
    runs = [store.save_result({"t": df}, f"{tmp_path}/r", "x", T0, kind="csv") for _ in range(3)]
    assert runs == ["20260401-000000-x", "20260401-000000-x(2)", "20260401-000000-x(3)"]
    assert sorted(map(tuple, spark.read.csv(f"{tmp_path}/r/run={runs[1]}/t", header=True).collect())) == [("1", "a,b"), ("2", None)]
    assert store.results(spark, f"{tmp_path}/r").count() == 3


def test_growth_of_a_workbook(spark, tmp_path):
    rows = [["date", "trt", "rep", "fresh_wt", "", "note", "fresh_wt"], [T0, "NI", 1, 2.5, "x", "wet", 9.0], [T0, "NI", 1, 2.5, "x", "wet", 9.0], [], [None, "NI+SL", 2, "ERROR"]]
    (tmp_path / "g.xlsx").write_bytes(workbook({"Growth": rows, "Other": [["a"], [1.0]]}, "date"))
    (tmp_path / "no.xlsx").write_bytes(workbook({"Growth": [["day"], [1.0]]}, "day"))
    got = L.growth(spark, f"{tmp_path}/g.xlsx")
    assert got.columns == ["date", "trt", "rep", "fresh_wt", "note"]
    first = (T0.date(), "NI", "1", 2.5, "wet")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([first, first, (None, "NI+SL", "2", None, None)], key=str)
    with pytest.raises(ValueError, match="no column 'date'"):
        L.growth(spark, f"{tmp_path}/no.xlsx")


def test_small_workbooks_share_batches():
    import pyarrow as pa

    books = [workbook({"Growth": [["a", f"b{i % 2}"], [float(i), "x"], [f"{i}", None]]}, shared=False) for i in range(300)] + [workbook({"Growth": [["only"]]})]
    found = list(L._survey_rows(iter([pa.RecordBatch.from_pydict({"content": books[:7]}), pa.RecordBatch.from_pydict({"content": books[7:]})])))
    assert [b.num_rows for b in found] == [600]
    assert found[0]["headings"].to_pylist() == [x for i in range(300) for x in (["a", f"b{i % 2}"], None)]
    assert found[0]["cells"].to_pylist() == [x for i in range(300) for x in ([("a", f"{float(i)}"), (f"b{i % 2}", "x")], [("a", f"{i}")])]


def test_growth_of_sites_without_a_key_and_of_orders_that_repeat(spark, tmp_path):
    from agrolith.plans.queries import QUERIES

    orders = [(k // 2, 7 if k < 12_000 else None if k % 2 else k, "F", 10.5 + k, T0 + timedelta(days=k % 9)) for k in range(12_050)]  # one site of 12,000
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    rows = sorted(tuple(r) for r in QUERIES["growth_xlsx"](spark, str(tmp_path)).select("date", "trt", "plant", "fresh_wt", F.coalesce("note", F.lit(""))).collect())
    assert rows == sorted((t.date(), s, k, p + 0.5, "dry" if k % 3 else "") for k, _, s, p, t in orders)
