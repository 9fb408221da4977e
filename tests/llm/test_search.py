import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from agrolith.llm import search as S
from agrolith.llm.queries import ORACLE_SQL, op13_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in TERM.findall(text or "")]


def plain(docs, items, k=50):
    """Every document against every item."""
    texts = [words(t) for _, t in docs]
    n, total = sum(bool(t) for t in texts), sum(map(len, texts))
    df = Counter(w for t in texts for w in set(t))
    out = []
    for item, q in items:
        found = []
        for (doc, _), t in zip(docs, texts, strict=True):
            tf, m = Counter(t), 100 - 50 + (50 * len(t) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * tf[w]) // (1000 * tf[w] + 20 * m)) for w in set(words(q)) if tf[w])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark, sf):
    out = op13_search(spark, sf)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = duck.sql(ORACLE_SQL["op13_search"]).fetchall()
    assert shown(out) == sorted(want, key=str) and len(want) > 1000


def test_terms():
    for t in ("Été À 9a_b-c", "日本 x😀y", "", "\x00\x7f[]{}", "A1 É2\u0085ß ﬁ"):
        assert [x.decode() for x in S.terms_of(t.encode())] == words(t)


def test_odd_rows_and_hot_groups(spark, odd, make):
    items = spark.createDataFrame([(1, "word a One"), (2, None), (3, ""), (None, "x" * 50_000), (3, "same ID é"), (3, "same ID é")], "item_id long, text string")
    want = [(r.item_id, r.text) for r in items.collect()]
    hot = make(["Alike text of many rows"] * 400 + ["alike text", "rows rows rows of it", "many"] * 20)
    for df in (odd, hot, make([], [])):
        docs = [(r.doc_id, r.text) for r in df.collect()]
        assert shown(S.search(df, items)) == plain(docs, want)
        assert shown(S.search(df, items, k=3, block=64, most=2)) == plain(docs, want, 3)
    assert S.search(odd, items.where("false")).count() == 0


def test_random_texts_in_small_blocks(spark):
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=int(rng.lognormvariate(3, 1))))) for i in range(700)]
    docs += [(i + 700, docs[i][1]) for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = S.search(df, spark.createDataFrame(items, "item_id long, text string"), k=7, block=2000, most=20)
    assert shown(out) == plain(docs, items, 7)


def test_impacts_bound_rates():
    tf, m = np.meshgrid(np.array([1, 2, 3, 10, 1000, 10**6]), np.array([50, 51, 100, 1000, 10**6, 10**9]))
    r = S.rates(tf.ravel(), m.ravel())
    q = -(-r // S.STEP)
    assert q.max() <= 255 and (S.STEP * q >= r).all() and (S.STEP * (q - 1) <= r).all()
