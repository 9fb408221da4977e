import random
import zlib
from collections import Counter, defaultdict

from agrolith.llm import sharding as S
from agrolith.llm.queries import op6_sharding


def check(docs, rows, shards=40):
    assert len(docs) == len(rows)
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in docs) == Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    total = [0] * shards
    for r in rows:
        total[r.shard] += r["size"]
    return max(total) / (sum(total) / shards), min(total) / (sum(total) / shards)


def test_query(spark, sf, corpus):
    out = op6_sharding(spark, sf)
    assert [(n, t) for n, t in out.dtypes] == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    check(corpus.collect(), out.collect())


def test_even_sizes_and_whole_groups(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdé \n", k=int(rng.lognormvariate(4, 1)))) for _ in range(6000)]
    texts += [t for t in texts[:300] for _ in range(3)] + ["hot group " * 20] * 3000
    rows = [(i, t, rng.choice(["en", "de", None]), f"s{rng.randrange(9)}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = S.shard(df).collect()
    most, least = check(df.collect(), out)
    assert most < 1.1 and least > 0.9
    by_text = defaultdict(set)
    for r in out:
        by_text[texts[r.doc_id]].add(r.shard)
    assert all(len(by_text[t]) == 1 for t in set(texts) if not t.startswith("hot group")) and len(by_text["hot group " * 20]) > 3


def test_groups_of_the_test_data_stay_whole(spark):
    """None of them is near a shard's share, so none is cut, and sizes stay near equal."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = S.shard(docs).collect()
    most, least = check(docs.collect(), out)
    assert most < 1.1 and least > 0.9
    text = {r.doc_id: r.text for r in docs.collect()}
    by_text = defaultdict(set)
    for r in out:
        by_text[text[r.doc_id]].add(r.shard)
    assert len(by_text) < len(text) and all(len(x) == 1 for x in by_text.values())


def test_large_groups_are_settled_first():
    to, room = S.settle([(60, 2), (60, 3), (60, 2), (30, 2), (150, 9), (130, 1)], 3, 100)
    assert to[5] is not None and to[4] is None  # a single row is never cut, a group over a shard is
    assert sum(x is not None for x in to[:3]) == 2 and sum(x is None for x in to[:3]) == 1  # two fit beside it, the third passes every share
    assert to[3] is not None and min(room) >= 0
    assert S.settle([], 2, 10.0) == ([], [10.0, 10.0])


def test_cuts_are_weighted_medians(spark):
    """One cut of one dimension against all rows, weights and ties included."""
    rng = random.Random(3)
    rows = [(rng.randrange(50) << S.TIE | rng.randrange(1 << S.TIE), rng.choice([1, 1, 1, 40])) for _ in range(500)]
    df = spark.createDataFrame([(0, 0, 0, k, w) for k, w in rows], "width long, lang long, source long, size long, weight long")
    root = S.grow(df, 3, bins=64, room=[1.0, 2.0, 1.0])
    left = sum(w for k, w in rows if k < root.cut)
    goal = sum(w for _, w in rows) / 4
    assert root.dimension == "size" and abs(left - goal) <= 40


def test_odd_rows(odd, spark):
    out = S.shard(odd, 3)
    check(odd.collect(), out.collect(), 3)
    assert S.shard(odd.where("false")).count() == 0
    assert check(odd.select("doc_id", "text").collect(), S.shard(odd.select("doc_id", "text"), 1).collect(), 1) == (1, 1)


def test_native(corpus):
    plan = S.shard(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
