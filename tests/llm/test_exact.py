import hashlib
import random
from collections import defaultdict

import duckdb

from agrolith.llm import exact as E
from agrolith.llm.queries import ORACLE_SQL, op11_exact

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """By a dictionary of whole texts; of each group how many rows stay is told apart from which."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        x = (t or "").translate(LOWER)
        keep = max((j for j in groups[x] if j is not None), default=None)
        out.append((i, keep, len(groups[x]), hashlib.sha256(x.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def one_of_each(df):
    kept = defaultdict(list)
    for r in df.collect():
        kept[r.text_sha256].append(r.kept)
        assert not r.kept or r.doc_id == r.keep_id
    assert all(sum(x) == 1 for x in kept.values())


def test_query(spark, sf):
    out = op11_exact(spark, sf)
    assert [n for n, _ in out.dtypes] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = duck.sql(ORACLE_SQL["op11_exact"]).fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert any(r[2] > 1 for r in want)


def test_odd_rows(spark, make, odd):
    for df in (odd, make(["A", "a", "Ä", "ä", None, "", "b"] * 2, [*range(7), *range(7)]), make([], [])):
        out = E.duplicates(df)
        assert shown(out) == plain([(r.doc_id, r.text) for r in df.collect()])
        one_of_each(out)
        kept = E.deduplicated(df)
        assert kept.columns == df.columns and kept.count() == len({r[3] for r in shown(out)})


def test_buckets_split_and_hot_groups_are_combined(spark):
    """A third of all rows are one text; buckets are small, so the directory doubles well beyond its first size."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abCD é", k=rng.randrange(300))) for _ in range(4000)]
    texts += texts[:500] + ["Hot text " * 5] * 2500 + ["hot tExt " * 5] * 300
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = E.duplicates(df, capacity=4096)
    assert shown(out) == plain(rows)
    one_of_each(out)


def test_directory(spark):
    """Buckets are disjoint, cover all keys, hold no more than their capacity; slots lead each key to its bucket."""
    keys = spark.range(20_000).selectExpr("xxhash64(id) as key", "10L + id % 7 as weight", "false as hot")
    buckets, depth = E.directory(keys, 2_000, 3)
    found = buckets.collect()
    assert depth > 6 and max(r.depth for r in found) == depth and min(r.depth for r in found) < depth
    weight = defaultdict(int)
    mine = {(r.depth, r.prefix) for r in found}
    for r in keys.collect():
        bits = r.key % (1 << 64)
        own = [d for d in range(1, depth + 1) if (d, bits >> (64 - d)) in mine]
        assert len(own) == 1
        weight[own[0], bits >> (64 - own[0])] += r.weight
    assert max(weight.values()) <= 2_000
    place = E.slots(buckets, depth).collect()
    assert len(place) == len({r.slot for r in place}) == 1 << depth
    order = sorted(place, key=lambda r: r.slot)
    assert [r.bucket for r in order] == sorted(r.bucket for r in order)


def test_texts_of_one_key_are_chained(spark, monkeypatch):
    """With a key that is the same for all texts of one length, different texts stay apart."""
    monkeypatch.setattr(E.F, "xxhash64", lambda *c: E.F.length(c[0]).cast("long") if c == ("text",) else E.F.hash(*c).cast("long"))
    rows = [(i, t) for i, t in enumerate(["aa", "bb", "AA", "cc", "c", "aa", "dd"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = E.duplicates(df)
    assert shown(out) == plain(rows)
    one_of_each(out)


def test_only_built_in_functions(spark, corpus):
    plan = E.duplicates(corpus)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
