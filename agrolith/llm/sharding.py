"""K-d tree partitioning of documents into shards of nearly equal bytes (operator 6, native).

Points are groups of equal texts, weighted by their bytes, so copies lie in one shard. Groups over
``1 / PART`` of a shard's even share are few (under shards x ``PART``): they are placed first, the largest first, each whole into
the shard with the most room, and the tree deals all others to the room that is left. A group that no shard can take without
passing the even share by over ``1 / PART`` of it, as one larger than a shard, is cut by a hash of its ids into small parts that the tree deals.

The tree is grown on the driver from aggregates alone. At each level one pass finds, for every
open node, the widest metadata dimension (size, bytes per character, language, source), and passes of
histograms find the weighted median along it (or the split that the numbers of shards on both sides
ask for). Dimensions are scaled to 20 bits; ties are ordered by text hash, so that any node can be cut
where its weight demands. What comes to the driver is bounded by nodes x ``BINS``. The finished tree is one
CASE expression. Slots come from bucket counts and their running sum. Only DataFrame functions are used.

Defined results: a null text has size 16 and CRC 0. A missing or null ``lang`` or ``source`` counts as the empty one;
of copies that differ there the least counts. Repeated rows and null ids get slots of their own. An empty
table gives an empty result. With fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from heapq import heapify, heapreplace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import materialise, row_numbers, spread

SHARDS = 40
#: The part of a shard's even share from which groups are placed before the tree, and by which a whole group may pass it.
PART = 50
#: A group that is cut has so many parts for each such share: small parts balance best.
FINE = 16
BINS = 4096
BITS, TIE = 20, 43
EXTRA = 16
#: Rows numbered in one task.
BUCKET = 100_000
_GROUP = ["_hash", "size", "text_crc32"]


def _scaled(x: Column) -> Column:
    """0 to 1 as ``BITS`` bits."""
    return F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * ((1 << BITS) - 1)).cast("long")


def _lettered(x: Column) -> Column:
    """A name's place by its first letters, then by a hash."""
    head = F.ascii(F.substring(x, 1, 1)) % 128 * 128 + F.ascii(F.substring(x, 2, 1)) % 128
    return (head.cast("long") * 64 + F.pmod(F.xxhash64(x), F.lit(64))).cast("long")


DIMENSIONS = ("size", "width", "lang", "source")


def _dimensions() -> dict[str, Column]:
    size, chars = F.col("size"), F.col("_chars")
    return {
        "size": _scaled(F.log2(size) / 34),
        "width": _scaled((size - EXTRA - chars) / (3 * F.greatest(chars, F.lit(1)))),
        "lang": _lettered(F.col("_lang")),
        "source": _lettered(F.col("_source")),
    }


def _narrow(docs: DataFrame) -> DataFrame:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(EXTRA)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_hash"),
        F.length(text).alias("_chars"),
        named("lang").alias("_lang"),
        named("source").alias("_source"),
    )


class _Node:
    def __init__(self, shards: int, first: int):
        self.shards, self.first, self.dimension, self.cut, self.low, self.high = shards, first, None, None, None, None


def _leaf(node: _Node, label) -> Column:
    if node.cut is None:
        return F.lit(label(node))
    return F.when(F.col(node.dimension) < node.cut, _leaf(node.low, label)).otherwise(_leaf(node.high, label))


def settle(groups: list[tuple[int, int]], shards: int, even: float, part: int = PART) -> tuple[list[int | None], list[float]]:
    """The shard of each large group, None where it must be cut, and the room that is left in each shard.

    ``groups``: bytes and rows, in any order. A single row is never cut.
    """
    rooms, out = [(-even, i) for i in range(shards)], [None] * len(groups)
    heapify(rooms)
    for i in sorted(range(len(groups)), key=lambda i: (-groups[i][0], i)):
        weight, rows = groups[i]
        room, at = rooms[0]
        if rows == 1 or weight <= -room + even / part:
            heapreplace(rooms, (room + weight, at))
            out[i] = at
    return out, [max(0.0, -room) for room, _ in sorted(rooms, key=lambda x: x[1])]


def grow(points: DataFrame, shards: int, bins: int = BINS, room: list[float] | None = None) -> _Node:
    """``points``: a column for each dimension, and ``weight``. ``room``: of each shard, equal by default. Read three times a level."""
    room = room or [1.0] * shards
    share = lambda a, n: sum(room[a : a + n])
    root, names = _Node(shards, 0), list(DIMENSIONS)
    spread = points.agg(*[F.max(F.shiftright(d, TIE)) - F.min(F.shiftright(d, TIE)) for d in names]).first()
    scale = {d: max(int(x or 0), 1) for d, x in zip(names, spread, strict=True)}
    open_ = [root] if shards > 1 else []
    while open_:
        ids = {id(n): i for i, n in enumerate(open_)}
        at = points.withColumn("_node", _leaf(root, lambda n: ids.get(id(n), -1))).where("_node >= 0")
        ends = [f(d).alias(f"{d}_{f.__name__}") for d in names for f in (F.min, F.max)]
        seen = {r["_node"]: r for r in at.groupBy("_node").agg(F.sum("weight").alias("weight"), *ends).collect()}
        span, goal = {}, {}
        for i, n in enumerate(open_):
            if i not in seen:
                continue
            width = lambda d, r=seen[i]: ((r[f"{d}_max"] >> TIE) - (r[f"{d}_min"] >> TIE)) / scale[d]
            n.dimension = max(names, key=width)
            span[i] = seen[i][f"{n.dimension}_min"], seen[i][f"{n.dimension}_max"] + 1
            whole = share(n.first, n.shards)
            goal[i] = seen[i]["weight"] * (share(n.first, n.shards // 2) / whole if whole else 0.5)
        while span:  # the bins of the span, then those of one of its bins, until that weighs little
            step = {i: max(1, -(-(b - a) // bins)) for i, (a, b) in span.items()}
            place = lambda f: F.element_at(F.create_map(*[F.lit(y) for i in span for y in (i, f(i))]), F.col("_node"))
            key = F.element_at(F.create_map(*[y for i in span for y in (F.lit(i), F.col(open_[i].dimension))]), F.col("_node"))
            low, high, wide = place(lambda i: span[i][0]), place(lambda i: span[i][1]), place(lambda i: step[i])
            inside = at.where(F.col("_node").isin(list(span))).withColumn("_key", key).where((F.col("_key") >= low) & (F.col("_key") < high))
            found = inside.groupBy("_node", F.floor((F.col("_key") - low) / wide).cast("long").alias("bin")).agg(F.sum("weight").alias("w")).collect()
            done = []
            for i in span:
                (a, b), left = span[i], goal[i]
                for bin_, w in sorted((r["bin"], r["w"]) for r in found if r["_node"] == i):
                    span[i], goal[i] = (a + bin_ * step[i], min(b, a + (bin_ + 1) * step[i])), left
                    last = w
                    if left < w:
                        break
                    left -= w
                open_[i].cut = span[i][0] if 2 * goal[i] < last else span[i][1]  # the nearer end of the bin
                if step[i] == 1 or last * open_[i].shards * 200 <= seen[i]["weight"]:
                    done.append(i)
            for i in done:
                del span[i]
        todo = []
        for n in open_:
            half = n.shards // 2
            if n.cut is None:
                continue
            n.low, n.high = _Node(half, n.first), _Node(n.shards - half, n.first + half)
            todo += [x for x in (n.low, n.high) if x.shards > 1]
        open_ = todo
    return root


def shard(docs: DataFrame, shards: int = SHARDS, part: int = PART, bins: int = BINS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``."""
    rows = materialise(_narrow(docs), "narrow")
    groups = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"), F.min("_lang").alias("_lang"), F.min("_source").alias("_source"), F.min("_chars").alias("_chars"))
    groups = materialise(groups, "groups")
    n, total = groups.agg(F.sum("n"), F.sum(F.col("size") * F.col("n"))).first()
    even = (total or 0) / shards
    limit = max(1, int(even / part))
    weight = F.col("size") * F.col("n")
    large = groups.where(weight > limit).select(*_GROUP, "n").orderBy(*_GROUP).collect()  # under shards * part rows
    to, room = settle([(r["size"] * r["n"], r["n"]) for r in large], shards, even, part)
    values = [f"({r['_hash']}L, {r['size']}L, {r['text_crc32']}L, {'null' if i is None else i}, {-(-r['size'] * r['n'] * FINE // limit)}L)" for r, i in zip(large, to, strict=True)]
    known_large = rows.sparkSession.sql(f"select * from values {', '.join(values or ['(0L, -1L, 0L, 0, 0L)'])} as t(_hash, size, text_crc32, _to, _parts)")
    piece = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")), F.lit(0)).cast("int").alias("_piece")
    with_large = lambda df: df.join(F.broadcast(known_large), _GROUP, "left")
    cut_rows = rows.join(F.broadcast(known_large.where("_to is null")), _GROUP).groupBy(*_GROUP, piece).agg(F.count(F.lit(1)).alias("n"))
    pieces = with_large(groups).where("_parts is null").select(*_GROUP, F.lit(0).alias("_piece"), "n").unionByName(cut_rows)
    tie = F.shiftrightunsigned(F.xxhash64("_hash", "_piece"), 64 - TIE)
    keys = [(F.shiftleft(e, TIE) + tie).alias(d) for d, e in _dimensions().items()]
    known = pieces.join(groups.drop("n"), _GROUP)
    points = materialise(known.select(*[F.col(c).alias("_size" if c == "size" else c) for c in _GROUP], "_piece", *keys, weight.alias("weight")), "points")
    root = grow(points, shards, bins, room)
    placed = points.select("_hash", F.col("_size").alias("size"), "text_crc32", "_piece", _leaf(root, lambda x: x.first).alias("_at"))
    keyed = materialise(with_large(rows).withColumn("_piece", F.when(F.col("_to").isNull(), piece).otherwise(0)), "keyed")
    settled = keyed.where("_to is not null").select("doc_id", "size", "text_crc32", F.col("_to").alias("shard"))
    spread_out = spread(keyed.where("_to is null").drop("_to", "_parts"), placed, [*_GROUP, "_piece"]).select("doc_id", "size", "text_crc32", F.col("_at").alias("shard"))
    dealt = materialise(settled.unionByName(spread_out), "dealt")
    return row_numbers(dealt, ["shard"], ["doc_id", "text_crc32", "size"], BUCKET, n or 0, "slot")
