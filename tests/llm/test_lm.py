import math
from collections import Counter

from agrolith.llm import lm
from agrolith.llm.queries import QUERIES


def plain(texts, good):
    """The same scores from whole tables of counts."""
    own = []
    for t in texts:
        w = [b" ", *lm.words(t)]
        own.append((Counter(w), Counter(zip(w, w[1:], strict=False)), w))
    out = []
    v = len(set().union(*(set(w) for _, _, w in own)))
    for i, (_, _, w) in enumerate(own):
        bits = []
        for keep in (lambda j, i=i: good[j] and j != i, lambda j, i=i: j != i):
            one, two = Counter(), Counter()
            for j, (a, b, _) in enumerate(own):
                if keep(j):
                    one.update(a)
                    two.update(b)
            n, sum_ = sum(one.values()), 0.0
            for x, y in zip(w, w[1:], strict=False):
                p = (one[y] + lm.PRIOR_1 / v) / (n + lm.PRIOR_1)
                sum_ -= math.log2((two[x, y] + lm.PRIOR_2 * p) / (one[x] + lm.PRIOR_2))
            bits.append(sum_ / max(len(w) - 1, 1))
        out.append((len(w) - 1, *bits))
    return out


def held(spark, rows, labels, monkeypatch=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, good int, n int").repartition(3)
    target = lm.good(spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: r for r in lm.score(docs, target).collect()}
    want = plain([r[1] for r in rows], [(r[0], 1) in set(labels) for r in rows])
    for r, (n, t, b) in zip(rows, want, strict=True):
        x = got[r[0]]
        assert x.n_tokens == n and abs(x.target_bits - t) < 1e-9 and abs(x.background_bits - b) < 1e-9
        assert abs(x.score - (t - b)) < 1e-9


def test_against_whole_tables(spark, corpus, monkeypatch):
    rows = [(r.doc_id, r.text, "b", 5, 1) for r in corpus.orderBy("doc_id").limit(60).collect()]
    rows += [(10_000, rows[3][1], "x", 1, 1), (10_001, "", "x", 1, 1), (10_002, None, "x", 1, 1), (10_003, "word " * 50_000, "x", 1, 1)]
    labels = [(r[0], int(r[0] % 3 == 0)) for r in rows if r[0] % 2 == 0] + [(999_999, 1), (None, 1)]
    monkeypatch.setattr(lm, "BLOCK", 20_000)  # many blocks and buckets
    monkeypatch.setattr(lm, "BUCKET", 20_000)
    held(spark, rows, labels)


def test_no_target_and_empty(spark, odd):
    rows = [(1, "a b c a b", "x", 1, 1), (2, "A B d", "x", 1, 1)]
    held(spark, rows, [])
    held(spark, rows, [(1, 1), (1, 1), (1, 0)])
    none = lm.good(spark.createDataFrame([], "doc_id long, quality int"))
    assert lm.score(odd, none).count() == odd.count()
    assert lm.score(odd.where("false"), none).count() == 0


def test_copies_are_told_from_single_documents(spark, sf):
    """A text that occurs twice is known to the background by its other copy, one that occurs once is not."""
    out = QUERIES["op10_lm"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text")
    seen = [(r.n, r.background_bits) for r in out.join(docs, "doc_id").selectExpr("n_tokens", "background_bits", "count(*) over (partition by text) as n").where("n_tokens > 30").collect()]
    twice, once = [b for n, b in seen if n > 1], sorted(b for n, b in seen if n == 1)
    assert twice and max(twice) < once[len(once) // 10]
