"""Alerts: cool-down, summaries, text, sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.config import LEVELS
from agrolith.operators.ledger import Taken, put
from agrolith.operators.rules import by_severity, severity
from agrolith.session import written

STATE = "key string, last_sent timestamp_ntz, level string, rule string, message string"


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE)


def due(alerts: DataFrame, state: DataFrame, now, min_level: str = "WARN", cooldown_hours: float = 12) -> DataFrame:
    """Alerts of at least ``min_level`` whose key was not sent within the cool-down before ``now``."""
    edge = F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {int(cooldown_hours * 60)} minutes")
    recent = state.where(F.col("last_sent") > edge).select("key").distinct()
    return alerts.where(severity() >= LEVELS[min_level]).join(recent, "key", "left_anti").select(*alerts.columns)


def mark_sent(state: DataFrame, sent: DataFrame, now) -> DataFrame:
    """The state after ``sent`` went out at ``now``: a row for each key, the latest."""
    return _latest(state.unionByName(_noted(sent, now)))


def _noted(sent: DataFrame, now) -> DataFrame:
    return sent.select("key", F.lit(now).cast("timestamp_ntz").alias("last_sent"), "level", "rule", "message")


def _latest(state: DataFrame) -> DataFrame:
    rest = [c for c in state.columns if c != "key"]
    last = state.groupBy("key").agg(F.max_by(F.struct(*rest), "last_sent").alias("_s"))
    return last.select("key", *[F.col(f"_s.{c}").alias(c) for c in rest])


#: Runs after which the state is written as a whole again, and alerts in a file of it.
EVERY, PER_FILE = 20, 1_000_000


def _kept(spark, path: str) -> tuple[list[int], list[int], list[str]]:
    """Numbers of the runs and of the wholes under ``path``, and files that lie there by themselves, as older runs left them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    of = lambda kind: sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))
    return of("run"), of("whole"), [f"{path}/{n}" for n in names if n.endswith(".parquet")]


def load_state(spark, path: str) -> DataFrame:
    """The alerts noted under ``path``, the latest of each key; none where nothing was noted yet."""
    runs, wholes, files = _kept(spark, path)
    last = max(wholes, default=0)
    paths = [f"{path}/run={n:010d}" for n in runs if n > last] + ([f"{path}/whole={last:010d}"] if last else files)
    return _latest(spark.read.schema(STATE).parquet(*paths)) if paths else empty_state(spark)


def note_sent(sent: DataFrame, path: str, now, every: int = EVERY) -> None:
    """Note what went out at ``now``; a run that is repeated notes the same again, which changes nothing.

    Each call adds one numbered run. After ``every`` of them the latest of each key, dealt by key, is written as a whole, from
    which readers start, and what the whole before it had replaced is deleted; so the folders are ``2 * every`` or so, however
    many runs there were, and a reader that began before has its files.
    """
    spark, noted = sent.sparkSession, written(_noted(sent, now), "noted")
    staging = f"{path}/_{uuid.uuid4().hex}"
    noted.coalesce(max(1, -(-noted.count() // PER_FILE))).write.parquet(staging)
    runs, wholes, _ = _kept(spark, path)
    number = max([0, *runs, *wholes]) + 1
    while True:
        try:
            put(spark, staging, f"{path}/run={number:010d}")
            break
        except Taken:  # another writer noted meanwhile: the next number
            noted.write.parquet(staging)
            number += 1
    before = max(wholes, default=0)
    if number - before < every:
        return
    state = load_state(spark, path)
    state.repartition(max(1, -(-state.count() // PER_FILE)), "key").write.parquet(staging)
    try:
        put(spark, staging, f"{path}/whole={number:010d}")
    except Taken:
        return
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for kind, numbers in (("run", [n for n in runs if n <= before]), ("whole", [n for n in wholes if n < before])):
        for n in numbers:
            fs.delete(at(f"{path}/{kind}={n:010d}"), True)


def summary(alerts: DataFrame) -> DataFrame:
    """Alerts by level and rule, with their variables sorted; variables are the channels of the configuration, so few."""
    found = alerts.groupBy("level", "rule").agg(F.count(F.lit(1)).alias("alerts"), F.sort_array(F.collect_set("variable")).alias("_v"))
    return found.select("level", "rule", "alerts", F.size("_v").cast("long").alias("variables"), F.array_join("_v", ", ").alias("variable_names"))


def by_zone(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("zone").agg(F.count(F.lit(1)).alias("alerts"), F.max(severity()).alias("worst"))


def exit_code(alerts: DataFrame) -> int:
    """2 for any CRITICAL, 1 for any WARN, else 0; no alerts are no fault."""
    worst = alerts.agg(F.max(severity())).first()[0] or 0
    return max(0, worst - 1)


def text(alerts: DataFrame, context: str = "", most: int = 500) -> str:
    """A plain report of the worst ``most`` alerts; a report is for people, so it is limited, and says how many it leaves out."""
    rows, all_ = by_severity(alerts).limit(most).collect(), alerts.count()
    head = [f"{context}: {all_} alerts" if context else f"{all_} alerts"]
    if all_ > len(rows):
        head.append(f"the worst {len(rows)} are listed, {all_ - len(rows)} are left out")
    return "\n".join(head + [f"[{r['level']}] {r['zone']} {r['rule']} {r['variable']}: {r['message']}" for r in rows])


def markdown(alerts: DataFrame, context: str = "", health: DataFrame | None = None, most: int = 500) -> str:
    def grid(df: DataFrame, cols: list[str]) -> list[str]:
        rows, all_ = df.select(*cols).limit(most).collect(), df.count()
        line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
        left = ["", f"{len(rows)} of {all_} rows; {all_ - len(rows)} are left out"] if all_ > len(rows) else []
        return [line(cols), "|" + "---|" * len(cols), *map(line, rows), *left]

    out = [f"# Sensor report {context}".rstrip(), "", *grid(by_severity(alerts), ["level", "zone", "rule", "variable", "start", "end", "value", "message"])]
    if health is not None:
        out += ["", "## Health", "", *grid(health, health.columns)]
    return "\n".join(out)


def to_json(alerts: DataFrame, folder: str, now: datetime) -> None:
    """Appends the alerts as JSON lines under the day of ``now``."""
    alerts.withColumn("detected_at", F.lit(now).cast("timestamp_ntz")).write.mode("append").json(f"{folder}/date={now:%Y-%m-%d}")


def dispatch(alerts: DataFrame, state: DataFrame, now: datetime, sinks: dict[str, Callable[[DataFrame], None]], min_level: str = "WARN", cooldown_hours: float = 12, dry_run: bool = False) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """What is due goes to each sink; the new alerts, the new state and each sink's outcome.

    Alerts count as sent if at least one sink took them.
    """
    new = written(due(alerts, state, now, min_level, cooldown_hours), "due")  # each sink gets the same rows, whatever is noted meanwhile
    outcome = {}
    for name, sink in ({} if dry_run else sinks).items():
        try:
            sink(new)
            outcome[name] = "sent"
        except Exception as e:  # a broken channel must not keep the others from being told
            outcome[name] = f"failed: {e}"
    return new, mark_sent(state, new, now) if "sent" in outcome.values() else state, outcome
