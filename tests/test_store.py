"""Uploads by content: kept once, rebuilt from without their sources, safe to repeat."""

import shutil
from datetime import datetime, timedelta

import pytest

from agrolith import config
from agrolith.operators import ledger, store
from agrolith.plans import flows
from tests.test_flows import REGISTRY, export

NOW = datetime(2026, 4, 20)


def shown(df):
    return sorted((r.zone, r.serial, r.ts, r.channel, r.value) for r in df.collect())


def test_an_archive_is_rebuilt_without_its_sources(spark, tmp_path):
    root, src = f"{tmp_path}/root", tmp_path / "in"
    src.mkdir()
    export(src / "a.csv", "L-1001", datetime(2026, 4, 1), 3)
    assert flows.add_uploads(spark, [str(src)], root, REGISTRY, NOW)["new_files"] == 1
    (src / "more").mkdir()
    export(src / "more" / "a.csv", "L-1001", datetime(2026, 4, 3), 2, hot=True)  # the same name, another content
    export(src / "more" / "copy.csv", "L-1001", datetime(2026, 4, 1), 3)
    export(src / "more" / "b.csv", "L-2002", datetime(2026, 4, 1), 1)
    (src / "more" / "bad.xlsx").write_bytes(b"no workbook")
    told = flows.add_uploads(spark, [f"{src}/more"], root, REGISTRY, NOW + timedelta(days=1))
    assert told["new_files"] == 3 and [r.file for r in told["problems"].collect()] == ["bad.xlsx"]
    assert flows.add_uploads(spark, [str(src), f"{src}/more"], root, REGISTRY, NOW)["new_files"] == 0
    want = shown(ledger.read(spark, f"{root}/archive"))
    assert len(want) == 3 * (4 * 144 + 144)

    shutil.rmtree(src)
    shutil.rmtree(f"{root}/archive")
    flows.rebuild(spark, root, REGISTRY)
    assert shown(ledger.read(spark, f"{root}/archive")) == want
    flows.rebuild(spark, root, {"loggers": {"L-1001": {"zone": "South"}}}, config.load())
    assert {r[0] for r in shown(ledger.read(spark, f"{root}/archive"))} == {"South", "L-2002"}


def test_a_run_cut_short_is_repeated(spark, tmp_path):
    root, src = tmp_path / "root", tmp_path / "in"
    src.mkdir()
    (src / "x.csv").write_text("one")
    (src / "y.csv").write_text("two")
    store.keep(spark, [str(src)], str(root), NOW)
    shutil.rmtree(root / "log")  # the objects are there, the log is not
    assert store.keep(spark, [str(src)], str(root), NOW).count() == 2
    got = {r.path.rpartition("/")[2]: (bytes(r.content), r.load) for r in store.stored(spark, str(root)).collect()}
    assert got == {"x.csv": (b"one", 1), "y.csv": (b"two", 1)}
    (src / "z.csv").write_text("three")
    assert [(r.name, r.load) for r in store.keep(spark, [str(src)], str(root), NOW).collect()] == [("z.csv", 2)]
    assert store.stored(spark, str(root), [2]).count() == 1


def test_changed_bytes_raise(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("one")
    root = f"{tmp_path}/root"
    digest = store.keep(spark, [f"{tmp_path}/in"], root, NOW).first().digest
    spark.createDataFrame([(bytearray(b"other"),)], "content binary").write.mode("overwrite").parquet(f"{root}/objects/digest={digest}")
    with pytest.raises(Exception, match="changed in the store"):
        store.stored(spark, root).collect()
