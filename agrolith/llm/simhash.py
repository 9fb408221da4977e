"""Near-duplicates by SimHash and vantage-point trees (operator 1).

A 64-bit fingerprint has, at each bit, the majority of the XXH64 hashes of a text's word
shingles. Fingerprints within ``max_distance`` bits are linked; documents that links join,
directly or through others, form a component.

**Search.** Distances between whole 64-bit fingerprints crowd around 32, so the triangle
inequality on them prunes little. The bits are therefore cut into ``max_distance // 2 + 1``
bands. A pair within ``max_distance`` is within ``max_distance // bands`` (1 for a distance of 4)
in at least one band, and the Hamming distance on a band, its key, is a metric of its own. One
vantage-point tree is built for each key from a bounded sample of fingerprints; the tree says
only where fingerprints are cut apart, so the sample bears on balance, never on results. At a
node with vantage point v and radius m, fingerprints with d(x, v) <= m go inside, and those with
d(x, v) > m - t outside (t: the key's radius). By the triangle inequality two fingerprints
within t of each other never take only different branches: at least one shard gets both. The
overlap, d in (m - t, m], is what is held twice.

**Shards.** Each leaf is one shard. A shard grows the tree on with its own fingerprints, down to leaves of ``LEAF``,
so what it compares does not follow its size squared; there, all pairs within the radius on the key are
compared on all bits. For links it returns a spanning forest, at most one link a member, so groups of copies never
become all pairs. Copies were already merged: shards hold distinct fingerprints.

**Similarity.** ``deduplicated`` asks for a word-shingle similarity s (0.8 at five words by default). Two
sets of that similarity have the cosine c = 2s / (1 + s), and a SimHash bit differs between them with
chance acos(c) / pi, 0.15 at 0.8. On 64 bits that is 10 bits give or take 3, so it takes a wider fingerprint of
``WORDS`` words of 64 bits, from as many mixes of the hash of each shingle of the set. Each word has three trees on a band of
21 or 22 bits with radius 1. Fingerprints give only candidates, up to three deviations beyond the mean, of sets whose sizes
allow the similarity, and of these a spanning forest again: its components are clusters, outside of which no pair is a candidate.
Within each cluster the sets themselves are compared, all pairs by numbers of common hashes in one matrix, and a link counts
if the sets are that similar (``confirmed``); no pair is ever a row. A cluster of over ``BLOCK`` hashes is dealt
in blocks, and each two blocks meet in a group of their own, so no group grows with the cluster. Not every pair is
within 1 bit in some band: what the bands miss is the recall that the tests measure.

**Components** of the links come from alternating large-star and small-star steps, each written
to the shared folder.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked
like any other. Rows with a null ``doc_id`` keep their fingerprint and get a null component; they
link nothing. Repeated rows and repeated ids are kept, one row out for each row in. An empty table
gives an empty result. Further columns are passed over.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.llm.common import column, fresh, hash_sample, materialise, sendable, spread, text_column
from agrolith.session import ship

BITS = 64
SHINGLE = 4
MAX_DISTANCE = 4
#: Words of a wide fingerprint.
WORDS = 6
#: Fingerprints that the trees are built from, at most. They go to the driver: 8 bytes a word each.
SAMPLE = 131_072
#: Fingerprints aimed at in a shard, and in a leaf of the tree that a shard grows itself.
SHARD = 4096
LEAF = 256
#: Hashes of shingles in a block of a cluster; a set counts as ``LEAST`` of them at least, so blocks have 2048 sets at most.
BLOCK = 1 << 20
LEAST = 512


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hash of each shingle of a text: A-Z lower-cased, words split at ASCII white space."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(own), xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = list(accumulate(map(len, own), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends[: n - shingle])]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]
    return np.array(hashes, np.uint64)


def majority(values: np.ndarray, words: int = 1) -> np.ndarray:
    """At each bit of ``words`` words of 64 bits, what most of the hashes have."""
    counts = np.zeros((words, BITS), np.int64)
    for at in range(0, len(values), 65536):
        for w in range(words):
            part = _mixed(values[at : at + 65536], w).view(np.uint8)
            counts[w] += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(values), axis=1, bitorder="little").view(np.uint64).ravel()


def sketch(text: str | None, shingle: int = SHINGLE, words: int = 1) -> np.ndarray:
    """The SimHash of one text in ``words`` words of 64 bits."""
    return majority(shingles(text, shingle), words)


def _mixed(hashes: np.ndarray, w: int) -> np.ndarray:
    """The hashes of word ``w``: for the first as they are, else multiplied and shifted anew."""
    if not w:
        return hashes
    x = hashes + np.uint64(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text."""
    return int(sketch(text, shingle)[0])


def columns(words: int) -> list[str]:
    """The columns of a fingerprint, each a word as a signed long."""
    return ["fp", *(f"fp{w}" for w in range(1, words))]


def _words(batch: pa.RecordBatch | pa.Table, names: list[str]) -> np.ndarray:
    """The fingerprints of a batch, a row each."""
    return np.stack([np.asarray(batch[c], np.int64) for c in names], axis=1).view(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """``doc_id`` and the fingerprint in ``columns(words)``."""
    names = columns(words)

    def run(batches):
        for b in batches:
            fp = np.array([sketch(t, shingle, words) for t in text_column(b)], np.uint64).reshape(-1, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *(pa.array(fp[:, w]) for w in range(words))], names=["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", *names]))


def shingled(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """``doc_id``, the fingerprint of the set of shingles, ``set`` (the set's hash) and ``size``, how many it has."""
    names = columns(words)

    def run(batches):
        for b in batches:
            sets = [np.unique(shingles(t, shingle)) for t in text_column(b)]
            fp = np.array([majority(s, words) for s in sets], np.uint64).reshape(-1, words).view(np.int64)
            size = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *(pa.array(fp[:, w]) for w in range(words)), _keys(sets), pa.array(size)], names=["doc_id", *names, "set", "size"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", *names, "set", "size"]))


def grams(docs: DataFrame, shingle: int) -> DataFrame:
    """``set`` and ``grams``, the hashes of its shingles, of each row."""

    def run(batches):
        for b in batches:
            sets = [np.unique(shingles(t, shingle)) for t in text_column(b)]
            yield pa.RecordBatch.from_arrays([_keys(sets), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set", "grams"])

    return docs.select("text").mapInArrow(run, "set long, grams array<long>")


def _keys(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64))


def bands(max_distance: int) -> list[int]:
    """The mask of each of ``max_distance // 2 + 1`` bands of bits."""
    n = max_distance // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]


def keys_of(words: int, max_distance: int) -> list[tuple[int, int, int]]:
    """Word, mask and radius of each tree: for one word so that no pair is missed, else three bands a word of radius 1."""
    if words > 1:
        return [(w, mask, 1) for w in range(words) for mask in bands(5)]
    masks = bands(max_distance)
    return [(0, mask, max_distance // len(masks)) for mask in masks]


def cut(own: np.ndarray, radius: int, rng) -> tuple | None:
    """Of a few vantage points and all radii, what leaves the least to compare; None if nothing parts the points."""
    best, n = (0.9 * len(own) ** 2, None), len(own)
    for v in own[rng.integers(0, n, 6)]:
        count = np.bincount(np.bitwise_count(own ^ v), minlength=BITS + 1)
        inside = np.cumsum(count)
        outside = n - np.concatenate([np.zeros(radius, np.int64), inside])[: BITS + 1]
        cost = inside.astype(float) ** 2 + outside.astype(float) ** 2
        m = int(cost.argmin())
        if cost[m] < best[0]:
            best = (cost[m], (v, m))
    return best[1]


def leaves(points: np.ndarray, radius: int, leaf: int = LEAF) -> Iterator[np.ndarray]:
    """Positions of the points in each leaf of a tree grown over all of them: any two within ``radius`` share one."""
    rng, todo = np.random.default_rng(42), [np.arange(len(points))]
    while todo:
        at = todo.pop()
        own = points[at]
        split = cut(own, radius, rng) if len(at) > leaf else None
        if split is None:
            yield at
            continue
        d = np.bitwise_count(own ^ split[0]).astype(np.int64)
        todo += [at[d <= split[1]], at[d > split[1] - radius]]


class Tree:
    """A vantage-point tree over the bits of ``mask``: arrays of nodes, and a shard number for each leaf."""

    def __init__(self, points: np.ndarray, mask: int, radius: int, leaf: int, first_shard: int):
        self.mask, self.radius, self.shards = np.uint64(mask), radius, 0
        self.point, self.cut, self.inner, self.outer, self.shard = [], [], [], [], []
        rng = np.random.default_rng(42)
        todo = [(points & self.mask, self._node())]
        while todo:
            own, at = todo.pop()
            split = cut(own, radius, rng) if len(own) > leaf else None
            if split is None:
                self.shard[at] = first_shard + self.shards
                self.shards += 1
                continue
            v, m = split
            d = np.bitwise_count(own ^ v).astype(np.int64)
            self.point[at], self.cut[at], self.inner[at], self.outer[at] = v, m, self._node(), self._node()
            todo += [(own[d <= m], self.inner[at]), (own[d > m - radius], self.outer[at])]
        self.point = np.array(self.point, np.uint64)
        self.cut, self.inner, self.outer, self.shard = (np.array(x, np.int64) for x in (self.cut, self.inner, self.outer, self.shard))

    def _node(self) -> int:
        for x, v in ((self.point, 0), (self.cut, 0), (self.inner, -1), (self.outer, -1), (self.shard, -1)):
            x.append(v)
        return len(self.shard) - 1

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (position in ``points``, shard) that the points belong to."""
        own = points & self.mask
        at, node, out = np.arange(len(own)), np.zeros(len(own), np.int64), []
        while len(at):
            leaf = self.shard[node] >= 0
            out.append((at[leaf], self.shard[node[leaf]]))
            at, node = at[~leaf], node[~leaf]
            d = np.bitwise_count(own[at] ^ self.point[node]).astype(np.int64)
            i, o = d <= self.cut[node], d > self.cut[node] - self.radius
            at, node = np.concatenate([at[i], at[o]]), np.concatenate([self.inner[node[i]], self.outer[node[o]]])
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def forest(points: np.ndarray, max_distance: int, key: np.ndarray, radius: int, size: np.ndarray | None = None, similarity: float = 0.0, leaf: int = LEAF) -> np.ndarray:
    """For each point the first position of its component, by the links of pairs within ``radius`` on ``key``.

    ``points``: a row of words each. With ``size``, only pairs whose sizes allow the similarity link. Pairs are
    compared leaf by leaf, in tiles of 512 x 4096; links found are merged at once: what is joined is not compared again.
    """
    root = np.arange(len(points))
    for at in leaves(key, radius, leaf):
        own, keys = points[at], key[at]
        for a in range(0, len(at), 512):
            for b in range(a, len(at), 4096):
                i, j = np.nonzero(np.bitwise_count(keys[a : a + 512, None] ^ keys[None, b : b + 4096]) <= radius)
                i, j = i + a, j + b
                for k in range(0, len(i), 65536):
                    x, y = i[k : k + 65536], j[k : k + 65536]
                    apart = root[at[x]] != root[at[y]]
                    x, y = x[apart], y[apart]
                    near = np.bitwise_count(own[x] ^ own[y]).sum(1, dtype=np.int64) <= max_distance
                    x, y = at[x[near]], at[y[near]]
                    if size is not None:
                        fits = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y])
                        x, y = x[fits], y[fits]
                    _merge(root, x, y)
    return root


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many members any two of the sets share.

    Members of few sets are counted pair by pair, those of many by a product of matrices.
    """
    n = len(sets)
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    often = np.diff(np.append(starts, len(flat)))
    column_of, many = np.repeat(np.arange(len(starts)), often), np.repeat(often > 32, often)
    out = np.zeros((n, n), np.float32)
    few, where = row[~many], column_of[~many]
    for step in range(1, 32):
        same = np.flatnonzero(where[step:] == where[:-step])
        if not len(same):
            break
        np.add.at(out, (few[same], few[same + step]), 1)  # rows rise within a member, as the order is stable
    out += out.T
    place = np.cumsum(often > 32) - 1
    place, row = place[column_of[many]], row[many]
    for a in range(0, int(place[-1]) + 1 if len(place) else 0, 2048):
        x, y = np.searchsorted(place, (a, a + 2048))
        part = np.zeros((n, 2048), np.float32)
        part[row[x:y], place[x:y] - a] = 1
        out += part @ part.T
    return out


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first position of its component, by the links of all pairs of that exact similarity."""
    root, size, both = np.arange(len(sets)), np.array([len(x) for x in sets], float), common(sets)
    for a in range(0, len(sets), 512):
        i, j = np.nonzero(both[a : a + 512] >= similarity / (1 + similarity) * (size[a : a + 512, None] + size[None]) - 0.5)
        i = i + a
        shared, total = both[i, j].astype(float), size[i] + size[j]
        sure = (i < j) & ((total == 0) | (shared / np.maximum(total - shared, 1) >= similarity))
        _merge(root, i[sure], j[sure])
    return root


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of ``i`` and ``j``, pair by pair."""
    while True:
        x, y = root[i], root[j]
        open_ = x != y
        if not open_.any():
            return
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (again := root[root]).tobytes() != root.tobytes():
            root[:] = again


def _grown(points: DataFrame, names: list[str], plan: list[tuple[int, int, int]], sample: int, shard: int) -> tuple[list[Tree], list[int]]:
    """The tree of each key, and the first shard number of each."""
    n = points.count()
    known = _words(hash_sample(points, names, n, sample).toArrow(), names)
    leaf, trees, shards = max(8, int(shard * len(known) / max(n, 1))), [], [0]
    for word, mask, radius in plan:
        trees.append(Tree(known[:, word], mask, radius, leaf, shards[-1]))
        shards.append(shards[-1] + trees[-1].shards)
    return trees, shards


def _dealt(points: DataFrame, names: list[str], plan: list[tuple[int, int, int]], trees: list[Tree], carried: list[str]) -> DataFrame:
    """``shard``, ``carried`` and the fingerprint: a row for each shard that a point belongs to."""
    sent = points.sparkSession.sparkContext.broadcast(trees)

    def deal(batches):
        for b in batches:
            with_it, fps = [np.asarray(column(b, c)) for c in carried], _words(b, names)
            for tree, (word, _, _) in zip(sent.value, plan, strict=True):
                at, to = tree.visits(fps[:, word])
                own = fps[at].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(to), *(pa.array(x[at]) for x in with_it), *(pa.array(own[:, w]) for w in range(len(names)))], names=["shard", *carried, *names])

    return points.select(*carried, *names).mapInArrow(deal, ", ".join(f"{c} long" for c in ["shard", *carried, *names]))


def links(points: DataFrame, max_distance: int = MAX_DISTANCE, sample: int = SAMPLE, shard: int = SHARD, words: int = 1, similarity: float = 0.0, leaf: int = LEAF) -> DataFrame:
    """``a > b``: links that join fingerprints within ``max_distance`` bits, directly or through others.

    ``points``: ``id`` and ``columns(words)``, each fingerprint once; with a similarity also ``size``, and sizes
    must allow it. At most one link a fingerprint and shard.
    """
    names, plan, carried = columns(words), keys_of(words, max_distance), ["id", "size"] if similarity else ["id"]
    trees, shards = _grown(points, names, plan, sample, shard)

    def compare(group: pa.Table) -> pa.Table:
        ids, fps = np.asarray(group["id"]), _words(group, names)
        order = np.argsort(ids)
        ids, fps = ids[order], fps[order]
        size = np.asarray(group["size"])[order] if similarity else None
        word, mask, radius = plan[bisect_right(shards, group["shard"][0].as_py()) - 1]
        root = forest(fps, max_distance, fps[:, word] & np.uint64(mask), radius, size, similarity, leaf)
        linked = root != np.arange(len(root))
        return pa.table({"a": ids[linked], "b": ids[root[linked]]})

    return _dealt(points, names, plan, trees, carried).groupBy("shard").applyInArrow(compare, "a long, b long")


def confirmed(docs: DataFrame, points: DataFrame, similarity: float, shingle: int, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """``id`` and ``root`` of components whose every link is between sets of that exact similarity.

    ``points``: ``set, id, size`` and ``columns(words)``. The sets of shingles are made again for texts with candidates alone.
    """
    cluster = components(links(points, distance_for(similarity, words), words=words, similarity=similarity))
    cluster = cluster.unionAll(cluster.select("root", "root").distinct())
    asked = materialise(points.join(cluster, "id").select("set", "id", F.col("root").alias("cluster"), "size"), "asked")
    weight = asked.groupBy("cluster").agg(F.sum(F.greatest("size", F.lit(LEAST))).alias("_w"))
    blocks = F.ceil(F.col("_w") / block).cast("int").alias("_blocks")
    members = spread(asked, weight, ["cluster"]).select("set", "id", "cluster", blocks)
    rows = docs.join(sendable(asked.select(F.col("id").alias("_id")), asked.count()), F.col("doc_id") == F.col("_id"), "left_semi")
    own = grams(rows, shingle).groupBy("set").agg(F.first("grams").alias("grams"))
    here = F.pmod(F.xxhash64("set"), F.col("_blocks")).cast("int")
    there = F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda x: (x != F.col("_here")) | (F.col("_blocks") == 1))
    dealt = members.join(own, "set").withColumn("_here", here).withColumn("_there", F.explode(there))
    dealt = dealt.select("cluster", F.least("_here", "_there").alias("i"), F.greatest("_here", "_there").alias("j"), "id", "grams")

    def compare(group: pa.Table) -> pa.Table:
        ids = np.asarray(group["id"])
        order = np.argsort(ids)
        ids, grams_ = ids[order], group["grams"].combine_chunks().take(pa.array(order))
        ends, flat = np.asarray(grams_.offsets), np.asarray(grams_.values)
        root = alike([flat[a:b] for a, b in zip(ends, ends[1:], strict=False)], similarity)
        linked = root != np.arange(len(root))
        return pa.table({"a": ids[linked], "b": ids[root[linked]]})

    return components(dealt.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root``, the least id of its component, for each id that is not the least itself.

    ``edges``: ``a > b``. Alternating large-star and small-star steps, until nothing changes.
    """
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    now = materialise(edges.distinct(), "links")
    state = mark(now)
    while state[0]:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = spread(now.select(F.col("b").alias("u"), "a"), least, ["u"]).select("a", F.col("m").alias("b"))
        large = materialise(large.unionAll(least.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        rest = spread(large.select(F.col("a").alias("u"), "b"), least, ["u"]).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(rest.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "small")
        before, state = state, mark(now)
        if before == state:
            break
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root"))


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE, shingle: int = SHINGLE, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the least doc_id reachable)."""
    ship(docs.sparkSession)
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    points = materialise(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "points")
    return _named(prints, points, components(links(points, max_distance, sample, shard)), ["fp"], ["fp"])


def _named(prints: DataFrame, points: DataFrame, root: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Each row of ``prints`` with its component's least id."""
    named = materialise(points.join(root, "id", "left").select(*keys, F.coalesce("root", "id").alias("component_id")), "roots")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    shown = F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in names]).alias("fingerprint")
    return spread(prints, named, keys, "left").select("doc_id", shown, component)


def distance_for(similarity: float, words: int = WORDS) -> int:
    """Bits in which texts of that similarity differ on average, and three standard deviations more: candidates, all but one in a thousand."""
    bits, p = words * BITS, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * p + 3 * math.sqrt(bits * p * (1 - p)))


def similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, words: int = WORDS) -> DataFrame:
    """Columns of ``near_duplicates``: components of texts whose sets of shingles are that similar, each link checked exactly."""
    ship(docs.sparkSession)
    names, docs = columns(words), docs.select("doc_id", "text")
    prints = materialise(shingled(docs, shingle, words), "shingled")
    points = prints.where("doc_id is not null").groupBy("set").agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), *[F.first(c).alias(c) for c in names])
    points = materialise(points, "points")
    return _named(prints, points, confirmed(docs, points, similarity, shingle, words), ["set"], names)


def deduplicated(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, words: int = WORDS) -> DataFrame:
    """The rows of ``docs``, of each group of similar texts only that with the least ``doc_id``.

    Rows with a null ``doc_id`` stay. Of rows that repeat the kept id, one stays, the first by the hash of its text.
    """
    found = materialise(similar(docs, similarity, shingle, words).select("doc_id", "component_id"), "components")
    id_, place, alone = (fresh(docs.columns, n) for n in ("gone", "place", "alone"))  # further columns may have any name
    gone = materialise(found.where("doc_id > component_id").select(F.col("doc_id").alias(id_)).distinct(), "gone")
    kept = docs.join(sendable(gone, gone.count()), F.col("doc_id") == F.col(id_), "left_anti")
    again = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():  # ids are unique: no row needs to meet another
        return kept
    first = W.partitionBy("doc_id", alone).orderBy(F.xxhash64("text"))
    own = kept.withColumn(alone, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return own.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*[f"`{c}`" for c in docs.columns])
