"""An archive of readings that grows by days of zones: a load reads and writes the days that it touches, and no others.

``<path>/data/version=V/day=D/`` holds the readings that one load wrote of that day, and ``<path>/log/commit=N/`` what the
N-th commit changed: for each zone and day the version that holds it from then on, and the names that channels of loggers got.
A reader takes the last commit of each zone and day. A commit becomes visible by one rename that fails if the number is taken,
so two writers cannot both win and a writer that is cut short leaves nothing that a reader sees; the loser starts over on
what the winner left. On stores without such a rename, one writer at a time.

A load is never a loss: newer readings win where they have a value, older ones fill the gaps. A rebuild replaces everything in
one commit and is refused where a logger would vanish or shrink. ``compact`` rewrites days that are mostly superseded and begins
a new log; ``vacuum`` deletes what no recent commit needs.

Channels of one name that several loggers of a zone bring: the logger that brought it first keeps it, later ones get the next
free ``__rep`` number, which they keep for good. Loads count in order, so increments and a rebuild give the same names. A zone's
names are few, whatever its readings; they are the only thing that is dealt with a zone at a time.

Rows without time or zone are left out; loads without rows change nothing.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.operators.archive import shrunk, upsert
from agrolith.session import written

KEYS = ["zone", "ts", "channel", "base_var", "rep"]
DATA = "zone string, ts timestamp_ntz, channel string, base_var string, rep int, serial string, value double"
LOG = "kind string, zone string, day date, version string, readings long, serial string, source string, channel string, base_var string, rep int"
#: Rows of a narrow table that is sent to all tasks; larger ones are shuffled.
SENT = 1_000_000
ATTEMPTS = 5


class Taken(Exception):
    """Another writer made this commit."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _sendable(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT else df


class Ledger:
    """What is committed at ``path`` as of now; the log is read once."""

    def __init__(self, spark: SparkSession, path: str, upto: int | None = None):
        fs, at = _fs(spark, f"{path}/log")
        self.spark, self.path = spark, path.rstrip("/")
        numbers = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(at)) if fs.exists(at) else []
        self.numbers = [n for n in numbers if upto is None or n <= upto]
        self.last = self.numbers[-1] if self.numbers else 0
        rows = spark.createDataFrame([], f"{LOG}, commit long")
        if self.numbers:
            rows = spark.read.schema(f"{LOG}, commit long").option("basePath", f"{self.path}/log").parquet(*[self._commit(n) for n in self.numbers])
        self.every = rows
        wholes = [r.commit for r in rows.where("kind = 'whole'").select("commit").distinct().collect()]
        self.wholes = sorted(wholes)
        self.log = rows.where(F.col("commit") >= max(wholes, default=0))

    def _commit(self, n: int) -> str:
        return f"{self.path}/log/commit={n:010d}"

    def entries(self) -> DataFrame:
        """``zone, day, version, readings``: where each day of a zone is."""
        last = self.log.where("kind = 'day'").groupBy("zone", "day").agg(F.max_by(F.struct("version", "readings"), "commit").alias("e"))
        return last.select("zone", "day", "e.version", "e.readings")

    def names(self) -> DataFrame:
        """``zone, serial, source, channel, base_var, rep``: what each logger's channel is called in the archive."""
        return self.log.where("kind = 'name'").select("zone", "serial", "source", "channel", "base_var", "rep")

    def readings(self) -> DataFrame | None:
        """The readings with ``day``; None where nothing was committed."""
        if not self.numbers:
            return None
        entries = self.entries()
        live = [r.version for r in entries.select("version").distinct().collect()]  # versions since the last compaction
        if not live:
            return self.spark.createDataFrame([], f"{DATA}, day date")
        rows = self.spark.read.schema(f"{DATA}, version string, day date").option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/version={v}" for v in live])
        stale = self.every.where((F.col("kind") == "day") & F.col("version").isin(live)).select("zone", "day", "version").distinct().join(entries, ["zone", "day", "version"], "left_anti")
        n = stale.count()
        rows = rows.join(_sendable(stale, n), ["zone", "day", "version"], "left_anti") if n else rows
        return rows.drop("version")

    def write(self, readings: DataFrame) -> DataFrame:
        """A new version of ``readings``; the log's rows of its days. Nobody sees it yet."""
        version = f"{self.last + 1:010d}-{uuid.uuid4().hex[:12]}"
        target = f"{self.path}/data/version={version}"
        typed = readings.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in DATA.split(", ")]).withColumn("day", F.to_date("ts"))
        typed.repartitionByRange("day", "zone", "ts").sortWithinPartitions("day", "zone", "channel", "ts").write.partitionBy("day").parquet(target)
        rows = self.spark.read.schema(f"{DATA}, day date").parquet(target).groupBy("zone", "day").agg(F.count(F.lit(1)).alias("readings"))
        return _logged(rows.withColumns({"kind": F.lit("day"), "version": F.lit(version)}))

    def commit(self, rows: DataFrame) -> None:
        """Make ``rows`` the next commit; raises ``Taken`` if another writer was first."""
        staging = f"{self.path}/staging-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(staging)  # a row for each day touched
        put(self.spark, staging, self._commit(self.last + 1))


def put(spark: SparkSession, staging: str, target: str) -> None:
    """Rename a written folder to ``target``, in one step; raises ``Taken`` if there is one."""
    jvm, fs = spark._jvm, _fs(spark, staging)[0]
    here, there = (jvm.org.apache.hadoop.fs.Path(p) for p in (staging, target))
    fs.mkdirs(there.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(here).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(here), fs.makeQualified(there), none)
    except Exception as e:
        fs.delete(here, True)
        if fs.exists(there):
            raise Taken(str(there)) from e
        raise


def _logged(df: DataFrame) -> DataFrame:
    """``df`` with all columns of the log."""
    kinds = dict(c.split() for c in LOG.split(", "))
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])


def named(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The names of channels that are new. ``pairs``: ``zone, serial, source, base_var, rep, load``, the load that brought it first."""
    new = pairs.join(known.select("zone", "serial", "source"), ["zone", "serial", "source"], "left_anti").withColumn("channel", F.lit(None).cast("string"))
    old = known.join(pairs.select("zone").distinct(), "zone", "left_semi").withColumn("load", F.lit(-1).cast("long"))

    def assign(zone: pd.DataFrame) -> pd.DataFrame:
        owner = {r.channel: r.serial for r in zone.itertuples() if r.load < 0}
        out = []
        for _, load in zone[zone.load >= 0].sort_values(["load", "serial", "base_var", "rep", "source"]).groupby("load"):
            own = load.groupby("serial").source.agg(set).to_dict()
            for r in load.itertuples():
                name, rep = r.source, r.rep
                if owner.get(name, r.serial) != r.serial:
                    rep = 2
                    while (name := f"{r.base_var}__rep{rep}") in owner or name in own[r.serial]:
                        rep += 1
                owner[name] = r.serial
                out.append((r.zone, r.serial, r.source, name, r.base_var, rep))
        return pd.DataFrame(out, columns=["zone", "serial", "source", "channel", "base_var", "rep"]).astype({"rep": "int32"})

    cols = ["zone", "serial", "source", "channel", "base_var", "rep", "load"]
    both = new.select(cols).unionByName(old.select(cols))
    return both.groupBy("zone").applyInPandas(assign, "zone string, serial string, source string, channel string, base_var string, rep int")


def _merged(ledger: Ledger, readings: DataFrame, whole: bool) -> tuple[DataFrame, DataFrame] | None:
    """The readings of all touched days with what the archive has of them, and the new names."""
    cols = ["zone", "serial", "ts", "channel", "base_var", "rep", "value", "load"]
    kept = readings.where("ts is not null and zone is not null").select(*[F.col(c).cast("string") if c in ("zone", "serial") else F.col(c) for c in cols])
    fresh = written(kept.withColumnRenamed("channel", "source"), "load")
    pairs = fresh.groupBy("zone", "serial", "source", "base_var", "rep").agg(F.min("load").alias("load"))
    known = ledger.names().limit(0) if whole else ledger.names()
    new = written(named(pairs, known), "names")
    names = new.unionByName(known).select("zone", "serial", "source", "channel", F.col("rep").alias("number"))
    order = (-F.col("load")).alias("load_ord")  # newer loads first
    every = fresh.join(_sendable(names, names.count()), ["zone", "serial", "source"]).select("zone", "serial", "ts", "channel", "base_var", F.col("number").alias("rep"), "value", order)
    before = None if whole else ledger.readings()
    if before is not None:
        touched = written(fresh.select("zone", F.to_date("ts").alias("day")).distinct(), "touched")
        first, last, n = touched.agg(F.min("day"), F.max("day"), F.count(F.lit(1))).first()
        if not n:
            return None
        old = before.where(F.col("day").between(F.lit(first), F.lit(last))).join(_sendable(touched, n), ["zone", "day"], "left_semi")
        every = every.unionByName(old.drop("day").withColumn("load_ord", F.lit((1 << 63) - 1)))
    return upsert(every, KEYS), new


def add(spark: SparkSession, path: str, readings: DataFrame) -> None:
    """Put loads into the archive. ``readings``: ``zone, serial, ts, channel, base_var, rep, value, load``; of two loads the larger is the newer."""
    for attempt in range(ATTEMPTS):
        ledger = Ledger(spark, path)
        found = _merged(ledger, readings, False)
        if found is None or (not ledger.numbers and found[0].isEmpty()):
            return
        rows, names = found
        try:
            return ledger.commit(ledger.write(rows).unionByName(_logged(names.withColumn("kind", F.lit("name")))))
        except Taken:
            if attempt + 1 == ATTEMPTS:
                raise


def _whole(spark: SparkSession) -> DataFrame:
    return _logged(spark.createDataFrame([("whole",)], "kind string"))


def replace(spark: SparkSession, path: str, readings: DataFrame) -> None:
    """Put ``readings``, all loads of the archive, in the place of everything; refused where a logger would vanish or shrink."""
    ledger = Ledger(spark, path)
    rows, names = _merged(ledger, readings, True)
    days = written(ledger.write(rows), "days")
    before = ledger.readings()
    if before is not None:
        version = days.select("version").first()
        after = spark.read.schema(f"{DATA}, day date").parquet(f"{ledger.path}/data/version={version[0]}") if version else before.limit(0)
        lost = [r.serial for r in shrunk(before, after).limit(20).collect()]  # some names for the message
        if lost:
            raise ValueError(f"refused: the new archive lacks loggers or readings of them: {lost}")
    ledger.commit(days.unionByName(_logged(names.withColumn("kind", F.lit("name")))).unionByName(_whole(spark)))


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The readings of the archive, None where there is none."""
    rows = Ledger(spark, path).readings()
    return None if rows is None else rows.drop("day")


def compact(spark: SparkSession, path: str, share: float = 0.5) -> None:
    """Rewrite the days of which at least ``share`` of the stored readings are superseded, and begin the log anew with what stands.

    A commit of another writer meanwhile wins, and ``Taken`` is raised: nothing is lost, compact again.
    """
    ledger = Ledger(spark, path)
    if not ledger.numbers:
        return
    entries = written(ledger.entries(), "entries")
    live = entries.select("version").distinct()
    stored = ledger.every.where("kind = 'day'").select("zone", "day", "version", "readings").distinct().join(live, "version", "left_semi").groupBy("day").agg(F.sum("readings").alias("stored"))
    used = entries.groupBy("day").agg(F.sum("readings").alias("used"))
    worn = written(stored.join(used, "day").where(F.col("stored") - F.col("used") >= share * F.col("stored")).where("stored > used").select("day"), "worn")
    rows = entries
    if n := worn.count():
        again = ledger.write(ledger.readings().join(_sendable(worn, n), "day", "left_semi"))
        rows = entries.join(worn, "day", "left_anti").unionByName(again.select(*entries.columns))
    names = ledger.names().withColumn("kind", F.lit("name"))
    ledger.commit(_logged(rows.withColumn("kind", F.lit("day"))).unionByName(_logged(names)).unionByName(_whole(spark)))


def vacuum(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Delete days of versions that no reader of the last ``keep`` commits needs, and the log before the whole that stood then; returns how many folders went.

    Run it while no load is being written: a version that is not committed yet counts as not needed.
    """
    ledger = Ledger(spark, path)
    if not ledger.numbers:
        return 0
    edge = ledger.last - keep
    base = max((n for n in ledger.wholes if n <= max(edge, ledger.numbers[0])), default=0)
    days = ledger.every.where(f"kind = 'day' and commit >= {base}")
    after = F.lead("commit").over(W.partitionBy("zone", "day").orderBy("commit"))  # commits of one zone and day
    whole = F.array_min(F.filter(F.array(*[F.lit(n).cast("long") for n in ledger.wholes]), lambda n: n > F.col("commit")))
    ends = days.withColumn("end", F.least(after, whole))
    needed = {(r.version, str(r.day)) for r in ends.where(F.col("end").isNull() | (F.col("end") > edge)).select("version", "day").distinct().collect()}  # folders
    fs, data = _fs(spark, f"{ledger.path}/data")
    gone = 0
    for version in fs.listStatus(data) if fs.exists(data) else []:
        name, folders = version.getPath().getName().partition("=")[2], [x for x in fs.listStatus(version.getPath()) if x.isDirectory()]
        out = [x for x in folders if (name, x.getPath().getName().partition("=")[2]) not in needed]
        for x in [version] if len(out) == len(folders) else out:
            fs.delete(x.getPath(), True)
        gone += len(out)
    for n in ledger.numbers:
        if n < base:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(ledger._commit(n)), True)
    return gone
