"""Exact deduplication by an extendible-hash index on shared files (operator 11), with built-in functions alone.

Texts are equal if they are identical after lower-casing A-Z. A key is the XXH64 of that text. The directory has a slot
for each value of the first ``depth`` bits of a key; several slots share a bucket. A bucket that holds more than
``capacity`` is split by its next bit, and where its own depth reaches the directory's, the directory doubles. Each
bucket has an owner task, which gets the texts of its range of keys, groups them by key and compares those of one key
byte by byte: different texts of one key make a chain. The index (bucket, key, place in the chain, digest, length, the
row that stays, number of rows) is written to the shared folder, sorted by key in each bucket.

Sizes. ``capacity`` is 8 MB or, on large corpora, what keeps the buckets near ``BUCKETS``, so the directory is a table
that can be sent to all tasks; it is sent only if it is small, and joined by shuffle else. A key whose rows weigh over
half a bucket is hot: its copies are first combined in ``SALTS`` parts, so its owner reads at most ``SALTS`` copies of
each text. In the sums that decide on splits a key counts for a quarter of a bucket at most, as no split divides it.

Defined results: a null text counts as empty; null ids are less than all others, and where a group has no id, one of its
rows stays. Of rows that repeat the id that stays, one stays. Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.llm.common import materialise, sendable, spread

CAPACITY = 8 << 20
BUCKETS = 1 << 18
SALTS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text):
    """The text with A-Z in lower case; all else stays, and null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _slot(key, depth):
    """The first ``depth`` bits of a key, 1 to 62 of them."""
    return F.shiftrightunsigned(key, 64 - depth)


def keys_of(rows: DataFrame, capacity: int) -> DataFrame:
    """``key, weight, hot``: what each key's rows bring to its bucket, and whether they are combined first."""
    per = rows.groupBy("key").agg(F.sum("bytes").alias("all"), F.max("bytes").alias("longest"), F.count(F.lit(1)).alias("n"))
    hot = (F.col("all") > capacity // 2) & (F.col("n") > SALTS)
    weight = F.least(F.when(hot, F.col("longest") * SALTS).otherwise(F.col("all")), F.lit(capacity // 4))
    return per.select("key", weight.alias("weight"), hot.alias("hot"))


def directory(keys: DataFrame, capacity: int, first: int) -> tuple[DataFrame, int]:
    """The buckets (``prefix, depth``) that have keys, none over ``capacity`` if a split can help, and the directory's depth.

    Starts with all slots of ``first`` bits. Each pass counts the children of the buckets that are overfull alone.
    """
    filled = lambda df, d: df.groupBy(_slot(F.col("key"), d).alias("prefix")).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    depth, now, done = first, materialise(filled(keys, first), "buckets"), []
    over = (F.col("w") > capacity) & (F.col("n") > 1)
    while True:
        done.append(now.where(~over).select("prefix", F.lit(depth).alias("depth")))
        split = now.where(over).select(F.col("prefix").alias("parent"))
        n = split.count()
        if not n or depth == 62:
            done.append(split.select(F.col("parent").alias("prefix"), F.lit(depth).alias("depth")))
            break
        inside = keys.join(sendable(split, n), _slot(F.col("key"), depth) == F.col("parent"), "left_semi")
        depth += 1
        now = materialise(filled(inside, depth), "buckets")
    every = done[0]
    for x in done[1:]:
        every = every.unionAll(x)
    return materialise(every, "directory"), depth


def slots(buckets: DataFrame, depth: int) -> DataFrame:
    """The directory: ``slot`` of ``depth`` bits, and its bucket, numbered in the order of keys."""
    wide = F.lit(depth) - F.col("depth")
    start = F.expr(f"shiftleft(prefix, {depth} - depth)")
    order = W.orderBy("start")  # over buckets: BUCKETS or so
    numbered = buckets.select(start.alias("start"), wide.alias("wide"), F.col("depth").alias("local")).withColumn("bucket", (F.row_number().over(order) - 1).cast("int"))
    last = F.expr("start + shiftleft(1L, wide) - 1")
    return numbered.select("bucket", "local", F.explode(F.sequence(F.col("start"), last)).alias("slot"))


def index(docs: DataFrame, rows: DataFrame, capacity: int = CAPACITY, keep_texts: bool = False) -> DataFrame:
    """The written index: ``bucket, key, chain, digest, bytes, keep_id, group_size``, with ``keep_texts`` also ``text``.

    ``rows``: ``key`` and ``bytes`` of each row of ``docs``.
    """
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(capacity, total // BUCKETS)
    keys = materialise(keys_of(rows, capacity), "keys")
    buckets, depth = directory(keys, capacity, max(1, ceil(log2(max(1, total / capacity)))))
    place = materialise(slots(buckets, depth), "slots")
    known = place.agg(F.count(F.lit(1)), F.max("bucket")).first()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text")).withColumn("key", F.xxhash64("text"))
    hot = keys.where("hot").select("key")
    n_hot = hot.count()
    combine = [F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")]
    if n_hot:  # copies of hot keys are combined where they are read, then in SALTS parts
        here = sendable(hot, n_hot)
        few = texts.join(here, "key", "left_semi").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        few = few.groupBy("key", "text", "salt").agg(*combine).select("doc_id", "text", "key", "n")
        texts = texts.join(here, "key", "left_anti").withColumn("n", F.lit(1).cast("long")).unionByName(few)
    else:
        texts = texts.withColumn("n", F.lit(1).cast("long"))
    owned = texts.join(sendable(place, known[0]), _slot(F.col("key"), depth) == F.col("slot")).select("bucket", "key", "text", "doc_id", "n")
    owned = owned.repartitionById((known[1] or 0) + 1, F.col("bucket"))
    entry = owned.groupBy("bucket", "key", "text").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))  # compares bytes
    entry = entry.select("bucket", "key", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("bytes"), "keep_id", "group_size", *["text"] * keep_texts)
    chain = F.row_number().over(W.partitionBy("bucket", "key").orderBy("digest")) - 1
    cols = ["bucket", "key", "chain", "digest", "bytes", "keep_id", "group_size", *["text"] * keep_texts]
    return materialise(entry.withColumn("chain", chain.cast("int")).select(cols), "index")


def duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Rows find their entry by key and digest. That the bytes of an entry are the same is known from its owner; two texts
    of one key and one SHA-256 would be two entries, which raises.
    """
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows, "rows")
    entries = index(docs, rows, capacity)
    if not entries.where("chain > 0").groupBy("key", "digest").count().where("count > 1").isEmpty():
        raise ValueError("two texts of one XXH64 and one SHA-256")
    found = spread(rows.drop("bytes"), entries.select("key", "digest", "keep_id", "group_size"), ["key", "digest"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = ["doc_id", "keep_id", "group_size"]
    again = rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again"))
    if again.isEmpty():
        return found.select(*out, stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    found = materialise(found, "found")  # ids repeat: of the rows that have the id that stays, the first one
    first = found.where(stays).groupBy("key", "digest").agg(F.min("row").alias("first"))
    both = spread(found, first, ["key", "digest"], "left")
    return both.select(*out, (F.col("row") == F.col("first")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with the columns of ``docs``."""
    kept = duplicates(docs, capacity).where("kept").select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).alias("at"))
    at = F.struct(F.col("doc_id").cast("long").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("digest"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), at.alias("at"))
    return named.join(kept, "at", "left_semi").dropDuplicates(["at"]).select("row.*")
