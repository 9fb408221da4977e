"""Channels to treatments: a logger's repetitions may stand in different plots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def map_table(spark: SparkSession, sensor_map: dict) -> DataFrame:
    """``logger, trt, base_var, channel`` of a map ``{loggers: {id: {treatments: {trt: {var: channel}}, shared: [channel]}}}``.

    Shared channels go to every treatment; an explicit one of the same variable stands before them.
    """
    rows = []
    for logger, entry in (sensor_map.get("loggers") or {}).items():
        for trt, own in (entry.get("treatments") or {}).items():
            rows += [(str(logger), trt, var, ch) for var, ch in own.items()]
            rows += [(str(logger), trt, ch.partition("__rep")[0], ch) for ch in entry.get("shared") or [] if ch.partition("__rep")[0] not in own]
    return spark.createDataFrame(rows, "logger string, trt string, base_var string, channel string")


def split(readings: DataFrame, mapping: DataFrame, logger: str = "serial") -> DataFrame:
    """Readings with their treatment, once for each that uses the channel. The map is configuration and small."""
    m = mapping.select(F.col("logger").alias(logger), "trt", F.col("base_var").alias("_var"), "channel")
    out = readings.withColumn(logger, F.col(logger).cast("string")).join(F.broadcast(m), [logger, "channel"])
    return out.withColumn("base_var", F.col("_var")).drop("_var")


def resolve(mapping: dict, key: str) -> str | None:
    """The map's logger for ``key``: the same, else the first that contains it or is contained in it."""
    loggers = list(map(str, mapping.get("loggers") or {}))
    return key if key in loggers else next((x for x in loggers if x in key or key in x), None)


#: Length of the pieces by which names find each other.
PIECE = 3


def _pieces(names: DataFrame, size) -> DataFrame:
    """``names`` with each different ``piece`` of ``name`` of so many characters."""
    starts = F.sequence(F.lit(1), F.length("name") - size + 1)
    return names.where(F.length("name") >= size).withColumn("piece", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("name"), i, size)))))


def _within(short: DataFrame, long: DataFrame) -> DataFrame:
    """``id`` of ``short`` and ``of`` of ``long`` (both ``id, name``) where the first name, not empty, is part of the second.

    A name that is part of another shares all its pieces with it, so its rarest piece alone finds the candidates.
    """
    whole = F.least(F.length("name"), F.lit(PIECE))
    there = [_pieces(long, F.lit(n)).select(F.col("id").alias("of"), F.col("name").alias("in"), "piece") for n in range(1, PIECE + 1)]
    every = there[0]
    for x in there[1:]:
        every = every.unionAll(x)
    often = every.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    own = _pieces(short.where("name <> ''"), whole)
    found = own.join(often, "piece", "left").groupBy("id", "name").agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), F.col("piece"))).alias("piece"))
    return found.join(every, "piece").where(F.contains("in", "name")).select("id", "of")


def lookup(keys: DataFrame, loggers: DataFrame) -> DataFrame:
    """``key, logger``: for each different key the logger of that name, else the first by ``place`` that contains the key or is part of it; null where none is.

    ``keys``: ``key``. ``loggers``: ``logger, place``; of one name the first counts. Null names meet nothing; an empty
    one is part of every other. Candidates are found by pieces of names, so no key meets all loggers.
    """
    every = keys.select(F.col("key").cast("string").alias("key")).distinct()
    known = loggers.where("logger is not null").groupBy(F.col("logger").cast("string").alias("logger")).agg(F.min("place").alias("place"))
    k, m = (df.select(F.col(c).alias("id"), F.col(c).alias("name")) for df, c in ((every.where("key is not null"), "key"), (known, "logger")))
    part = _within(m, k).select(F.col("of").alias("key"), F.col("id").alias("logger"))
    whole = _within(k, m).select(F.col("id").alias("key"), F.col("of").alias("logger"))
    first = known.agg(F.min_by("logger", "place").alias("logger"))  # one row
    empty = every.where("key = ''").crossJoin(F.broadcast(first)).unionByName(every.where("key is not null").crossJoin(F.broadcast(known.where("logger = ''").select("logger"))))
    order = F.struct((F.col("key") != F.col("logger")).alias("other"), "place")
    best = part.unionByName(whole).unionByName(empty).join(known, "logger").groupBy("key").agg(F.min_by("logger", order).alias("logger"))
    return every.join(best, "key", "left").select("key", "logger")


def coverage(readings: DataFrame, mapping: DataFrame, logger: str = "serial") -> DataFrame:
    """Channels that the map names and readings lack, and the other way round; channels of loggers that the map knows."""
    seen = readings.select(F.col(logger).cast("string").alias("logger"), "channel").distinct()
    named = mapping.select("logger", "channel").distinct()
    known = seen.join(mapping.select("logger").distinct(), "logger", "left_semi")
    missing = named.join(known, ["logger", "channel"], "left_anti").withColumn("state", F.lit("mapped, not found"))
    return missing.unionByName(known.join(named, ["logger", "channel"], "left_anti").withColumn("state", F.lit("found, not mapped")))


def template(readings: DataFrame, logger: str, zone: str) -> dict:
    """A map to fill in, with all of a logger's channels as shared; a logger has few channels."""
    rows = readings.where(F.col("serial").cast("string") == logger).select("channel").distinct().orderBy("channel").collect()
    return {"loggers": {logger: {"zone": zone, "shared": [r.channel for r in rows], "treatments": {}}}}
