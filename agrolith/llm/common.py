"""What the operators of this package share: the shared folder, materialised tables, Arrow helpers."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.session import shared_root, ship

#: Rows of a side of two longs or so that are sent to every task, at most; larger ones are shuffled.
SENT = 1_000_000


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage with a table that every executor sees, so a lost executor costs
    nothing but its running tasks.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, names: list[str], rows: int, most: int) -> DataFrame:
    """At most ``most`` of the ``rows`` rows of ``df``, those of least hash.

    What no task could add is left out first by the hash alone, so that tasks together send about
    twice ``most`` rows, and not ``most`` each.
    """
    fine = 1 << 40
    share = min(fine, -(-2 * most * fine // max(rows, 1)))
    return df.select(names).where(F.pmod(F.xxhash64(*names), F.lit(fine)) < share).orderBy(F.xxhash64(*names), *names).limit(most)


def sendable(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a narrow table of ``rows`` rows, broadcast where it is small enough."""
    return F.broadcast(df) if rows <= SENT else df


def spread(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has a key once; the rows of a hot key are dealt over several tasks.

    A key is hot with over 1 of 256 rows of ``left``, so there are 256 at most and their parts are under 512; the
    rows of ``right`` are repeated for the parts alone. ``left`` is read twice: it should be a table.
    """
    rows = left.count()
    fair = max(rows // 256, 1000)
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > fair)
    hot = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.ceil(F.col("_n") / fair).cast("int").alias("_parts"))
    same = lambda df: df.join(F.broadcast(hot), [F.col(k) == F.col(f"_hot_{k}") for k in keys], "left").drop(*[f"_hot_{k}" for k in keys])
    parts = F.coalesce("_parts", F.lit(1))
    dealt = same(left).withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts).cast("int"))
    each = same(right).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.drop("_parts").join(each.drop("_parts"), [*keys, "_part"], how).drop("_part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """``name``, made longer until no column is called that."""
    known = {c.lower() for c in columns}
    while name.lower() in known:
        name += "_"
    return name


def buckets_for(rows: int, per_bucket: int) -> int:
    """How many buckets keep each near ``per_bucket`` rows."""
    return max(1, -(-rows // per_bucket))


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null counts as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def row_numbers(df: DataFrame, group: list[str], order: list, per_bucket: int, rows: int, out: str = "rank") -> DataFrame:
    """Gapless ranks from 0 within ``group``, without bringing a whole group into one task.

    Rows go to hash buckets; each bucket counts and numbers its own rows, and the running sum
    of the small table of counts gives each bucket its first number. The order within a group
    is by bucket, then by ``order``.
    """
    from pyspark.sql import Window as W

    n = buckets_for(rows, per_bucket)
    keyed = df.withColumn("_b", F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(n)).cast("int"))
    counts = keyed.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(*group, "_b", (F.sum("_n").over(W.partitionBy(*group).orderBy("_b")) - F.col("_n")).alias("_first"))
    local = keyed.withColumn("_r", F.row_number().over(W.partitionBy(*group, "_b").orderBy(*order)) - 1)
    cond = [local[g].eqNullSafe(first[g]) for g in group] + [local["_b"] == first["_b"]]
    both = local.join(first, cond)
    return both.select(*[local[c] for c in df.columns], (F.col("_r") + F.col("_first")).cast("long").alias(out))
