"""The data source ``logger`` gives what whole files give, wherever ranges cut them."""

import io

import pytest

from agrolith.sources import logger_files, logger_source

TITLE = "Plot Title: L-9\n"
FILES = {
    "a.csv": TITLE + "Date Time,Air Temp,RH %,Battery,Water Content,Water Content\n" + "".join(f"2026-04-{1 + i % 9:02d} 0{i % 10}:00,{i}.5,{'' if i % 3 else 40 + i},3.1,{i},x\n" for i in range(60)),
    "b.txt": "날짜;시각;온도(℃);상대습도(%)\n" + "".join(f"2026-04-0{1 + i % 9};0{i % 10}:30;{20 + i};ERROR\n" for i in range(30)),
    "c.tsv": "Timestamp\tPAR\tpH\tlast\r\n" + "".join(f"2026/04/01 {i % 24:02d}:00\t{i}\t\"7,{i}\"\t{i}\r\n\r\n" for i in range(40)) + "2026/04/02 01:00\t5\t6\t7\t8",
    "none.csv": "a,b\n1,2\n",
    "empty.csv": "",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode("cp949" if name == "b.txt" else "utf-8"))
    (tmp_path / "wide.csv").write_bytes(FILES["a.csv"].encode("utf-16"))
    (tmp_path / "_hidden.csv").write_text(FILES["a.csv"])
    return tmp_path


COLS = ["file", "serial", "model", "ts_raw", "source", "channel", "base_var", "rep", "raw", "problem"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


@pytest.mark.parametrize("most", [150, 1 << 20])
def test_ranges_give_what_files_give(spark, folder, most):
    found = logger_source.raw(spark, str(folder), most)
    want = logger_files.cells(spark, [f"{folder}/*.csv", f"{folder}/*.t*"]).where("file not like '\\_%'")
    assert rows(logger_source.cells(found)) == rows(want)
    if most == 150:
        assert found.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("read", [1, 3, 1000])
def test_each_line_is_of_one_range(monkeypatch, read):
    monkeypatch.setattr(logger_source, "READ", read)
    for data in (b"ab\n\ncdefghij\nk", b"\n\n", b"abc", b"", b"a\n" + b"x" * 40 + b"\nb\n"):
        whole = list(logger_source._lines(io.BytesIO(data), 0, len(data)))
        assert b"\n".join(x for _, x in whole) == data.removesuffix(b"\n") and all(data[a : a + len(x)] == x for a, x in whole)
        for most in range(1, len(data) + 2):
            cut = [x for r in logger_source.ranges([(0, "p", len(data))], most) for x in logger_source._lines(io.BytesIO(data), r.start, r.end)]
            assert cut == whole


def test_patterns_and_names(spark, folder):
    (folder / "sub").mkdir()
    (folder / "sub" / "a.csv").write_text(FILES["a.csv"])
    assert {r.file for r in logger_source.raw(spark, f"file://{folder}/s*/*.csv").select("file").distinct().collect()} == {"a.csv"}
    some = logger_source.raw(spark, str(folder)).where("file = 'c.tsv'")
    assert some.rdd.getNumPartitions() == 1 and {r.file for r in some.collect()} == {"c.tsv"}
    assert logger_source.raw(spark, f"{folder}/nothing/*.csv").count() == 0


def test_stream_takes_each_file_once(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")

    def run():
        df = logger_source.register(spark).readStream.format("logger").option("rangeBytes", 200).load(str(folder))
        q = df.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/cp").start()
        q.processAllAvailable()
        q.stop()
        return spark.read.schema(logger_source.RAW).parquet(f"{out}/rows")

    first = run().count()
    assert first == logger_source.raw(spark, str(folder)).count()
    (folder / "later.csv").write_text(FILES["a.csv"])
    assert run().where("file = 'later.csv'").count() == 60 * 5 and run().count() == first + 300
