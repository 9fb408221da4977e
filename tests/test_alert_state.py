"""What was sent, over many runs: the latest of each key, in a bounded number of files."""

from datetime import datetime, timedelta

from agrolith.operators import alerts as A

NOW = datetime(2026, 4, 1)


def test_many_runs_leave_few_files(spark, tmp_path):
    path, want = f"{tmp_path}/state", {}
    assert A.load_state(spark, path).count() == 0
    most = 0
    for n in range(17):
        keys = [f"k{n % 5}", f"own{n}"]
        A.note_sent(spark.createDataFrame([(k, "WARN", "R01", f"m{n}") for k in keys], "key string, level string, rule string, message string"), path, NOW + timedelta(hours=n), every=4)
        want |= {k: (NOW + timedelta(hours=n), f"m{n}") for k in keys}
        most = max(most, len(list((tmp_path / "state").rglob("*.parquet"))))
    assert {r.key: (r.last_sent, r.message) for r in A.load_state(spark, path).collect()} == want
    assert most <= 11 and not list((tmp_path / "state").glob("_*"))


def test_states_of_older_runs_are_read(spark, tmp_path):
    path = f"{tmp_path}/state"
    spark.createDataFrame([("a", NOW, "WARN", "R", "old"), ("b", NOW, "WARN", "R", "old")], A.STATE).write.parquet(path)
    A.note_sent(spark.createDataFrame([("b", "WARN", "R", "new")], "key string, level string, rule string, message string"), path, NOW + timedelta(days=1))
    assert {r.key: r.message for r in A.load_state(spark, path).collect()} == {"a": "old", "b": "new"}
