import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from agrolith.llm import simhash as S


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(ids, fps, most=4):
    """Least id reachable, by comparing all pairs."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def test_fingerprint_is_the_contract(corpus):
    for r in corpus.limit(60).collect():
        assert S.fingerprint(r.text) == slow_fingerprint(r.text)
    for t in (None, "", " ", "A", "a b\x0bc", "é è ê ë É", "The a b c d"):
        assert S.fingerprint(t) == slow_fingerprint(t)


def test_against_all_pairs(spark, corpus):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(corpus).collect()}
    ids = sorted(got)
    want = closure(ids, [int(got[i][0], 16) for i in ids])
    assert {i: c for i, (_, c) in got.items()} == want


@pytest.mark.parametrize("shard", [4, 64])
def test_planted_fingerprints(spark, shard):
    """Random points, chains of 4-bit steps and dense balls; small shards make deep trees."""
    rng = random.Random(shard)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(10):
        f = rng.getrandbits(64)
        for _ in range(30):
            f ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.append(f)
    fps += [fps[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    fps = list(dict.fromkeys(fps))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    edges = S.links(spark.createDataFrame(rows, "id long, fp long"), shard=shard, leaf=shard // 2)
    root = {r.id: r.root for r in S.components(edges).collect()}
    assert {i: root.get(i, i) for i in range(len(fps))} == closure(list(range(len(fps))), fps)


def test_triangle_bounds_hold():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 63, 3000, np.uint64)
    for _, mask, radius in S.keys_of(1, 4):
        tree = S.Tree(points, mask, radius, 20, 0)
        flips = np.uint64(1) << rng.integers(0, 64, 3000, np.uint64)
        at, shard = tree.visits(points)
        bt, other = tree.visits(points ^ flips)
        a, b = [set() for _ in points], [set() for _ in points]
        for i, s in zip(at, shard, strict=True):
            a[i].add(s)
        for i, s in zip(bt, other, strict=True):
            b[i].add(s)
        assert all(x & y for x, y in zip(a, b, strict=True))


def test_similar_texts_are_found(spark):
    """Against the exact similarity of all pairs with a shingle in common, and planted edits of each strength."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts, twins = [], []
    for i in range(300):
        own = [word() for _ in range(rng.randint(120, 400))]
        copy = list(own)
        for at in rng.sample(range(len(own)), max(1, len(own) // (60 if i % 2 else 12))):
            copy[at] = word()
        twins.append((len(texts), len(texts) + 1))
        texts += [" ".join(own), " ".join(copy)]
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    likeness = [len(grams[a] & grams[b]) / len(grams[a] | grams[b]) for a, b in twins]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    root = {r.doc_id: r.component_id for r in S.similar(docs).collect()}
    hit = [root[a] == root[b] for a, b in twins]
    near = [h for h, s in zip(hit, likeness, strict=True) if s >= 0.8]
    assert len(near) > 100 and sum(near) >= 0.9 * len(near)
    assert not any(h for h, s in zip(hit, likeness, strict=True) if s < 0.5)
    assert all(root[a] in (a, a - a % 2) for a in root)  # nothing joins texts that are not alike


def test_lower_trees_part_no_pair():
    rng = np.random.default_rng(3)
    key = np.repeat(rng.integers(0, 1 << 21, 400, np.uint64), 3) ^ np.uint64(1) << rng.integers(0, 21, 1200, np.uint64)
    together = np.zeros((len(key), len(key)), bool)
    for at in S.leaves(key, 1, 16):
        together[np.ix_(at, at)] = True
    assert together[np.bitwise_count(key[:, None] ^ key[None]) <= 1].all() and not together.all()


def test_odd_rows(odd):
    out = S.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    zero = [r for r in out if r.doc_id in (0, 1, 2)]
    assert {(r.fingerprint, r.component_id) for r in zero} == {("0" * 16, 0)}
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert {r.component_id for r in out if r.doc_id in (4, 5)} == {4}
    assert S.near_duplicates(odd.where("false")).count() == 0


def test_dedup_keeps_one_of_each(make, odd):
    docs = make(["a b c d e f", "a b c d e f", "g h i j k l", "a b c d e f"])
    kept = S.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]
    ids = [r.doc_id for r in S.deduplicated(odd).collect()]
    assert ids.count(100) == 1 and ids.count(None) == 1 and 5 not in ids


def test_links_are_checked_exactly(spark):
    """Groups at 0.6 to 0.97, chains and texts of one repeated passage, against the exact similarity of all pairs."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = []
    for g in range(40):
        base = [word() for _ in range(300)]
        for _ in range(8):
            own = list(base)
            for at in rng.sample(range(300), 1 + g % 8):
                own[at] = word()
            texts.append(" ".join(own))
    texts += [" ".join(["again"] * 3000 + [word() for _ in range(200)]) for _ in range(5)]  # one fingerprint by counts, unlike as sets
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if want[i] != want[j] and 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]):
                a, b = sorted((want[i], want[j]))
                want = [a if x == b else x for x in want]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    root = {r.doc_id: r.component_id for r in S.similar(docs).collect()}
    assert all(want[a] == want[root[a]] for a in root)  # no link below 0.8
    split = sum(want[i] == want[j] and root[i] != root[j] for i in root for j in root if j < i)
    assert split <= 0.1 * sum(want[i] == want[j] for i in root for j in root if j < i)


def test_wide_forest_is_all_pairs_near_on_the_band():
    rng = np.random.default_rng(3)
    points = np.repeat(rng.integers(0, 1 << 63, (40, 6), np.uint64), 5, axis=0)
    points ^= np.uint64(1) << rng.integers(0, 60, points.shape, np.uint64)
    key, size = points[:, 2] & np.uint64(S.bands(5)[1]), rng.integers(80, 110, len(points))
    root = S.forest(points, 20, key, 1, size, 0.8, leaf=16)
    bits = np.bitwise_count(points[:, None] ^ points[None]).sum(2, dtype=np.int64)
    near = (np.bitwise_count(key[:, None] ^ key[None]) <= 1) & (bits <= 20) & (np.minimum(size[:, None], size[None]) >= 0.8 * np.maximum(size[:, None], size[None]))
    want = list(range(len(points)))
    for i, j in zip(*np.nonzero(near), strict=True):
        if want[i] != want[j]:
            a, b = sorted((want[i], want[j]))
            want = [a if x == b else x for x in want]
    assert root.tolist() == want


def test_common_members_and_similarity():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60 if i < 80 else 4000, rng.integers(0, 50))) for i in range(160)] + [np.zeros(0, np.int64)] * 2
    both = S.common(sets)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i))
    for s in (0.3, 0.8, 1.0):
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if want[i] != want[j] and n >= s * (len(sets[i]) + len(sets[j]) - n) - 1e-12:
                    a, b = sorted((want[i], want[j]))
                    want = [a if x == b else x for x in want]
        assert S.alike(sets, s).tolist() == want


def test_hot_groups_and_repeated_ids(spark):
    """Copies, near copies of one text and a repeated id that hold most rows: all joined, one row of each kept."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    near = []
    for i in range(120):
        own = list(base)
        own[i] = "edited"
        near.append(" ".join(own))
    rows = [(i, "the same text of six words") for i in range(3000)] + [(5000 + i, t) for i, t in enumerate(near)] + [(9000, "a repeated identifier with words")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(r.doc_id for r in S.deduplicated(docs).collect()) == [0, 5000, 9000]
    assert {r.component_id for r in S.near_duplicates(docs).where("doc_id < 3000").collect()} == {0}
    points = S.shingled(docs, 5, S.WORDS).groupBy("set").agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), *[F.first(c).alias(c) for c in S.columns(S.WORDS)])
    parts = {r.id: r.root for r in S.confirmed(docs, points, 0.8, 5, block=20_000).collect()}  # three blocks
    assert set(parts.values()) == {5000} and len(parts) == 119


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_of_any_name_pass(spark, repeated):
    """Names that the operator might use inside come back as they were, with ids that repeat too."""
    names = ["_id", "_gone", "_n", "_alone", "gone", "place", "ALONE", "a.b", "id", "set", "cluster"]
    rows = [(i, "copy of one text in eight words or so" if i % 2 else f"text {i} of its own words {i * i}", *[f"{n}{i}" for n in names]) for i in range(8)]
    rows += [(1, rows[1][1], *rows[1][2:])] * 2 * repeated
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    out = S.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == sorted(r for r in set(rows) if r[0] % 2 == 0 or r[0] == 1)
