import re
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agrolith.llm import quality as Q
from agrolith.llm.queries import ORACLE_SQL, op9_quality

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_query_against_sql_and_by_hand(spark, sf, corpus):
    ours = {r.doc_id: r for r in op9_quality(spark, sf).collect()}
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    theirs = {r.doc_id: r for r in c.sql(ORACLE_SQL["op9_quality"]).df().itertuples()}
    for r in corpus.collect():
        assert tuple(ours[r.doc_id][b] for b in BASE) == plain(r.text)
        assert tuple(getattr(theirs[r.doc_id], b) for b in [*BASE, "kept"]) == tuple(ours[r.doc_id][b] for b in [*BASE, "kept"])


def test_any_text(make):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.text(alphabet="ab \n\t\x0b\x0c\r\x1c\x85\xa0#*é😀", max_size=60), min_size=40, max_size=60))
    def run(texts):
        got = {r.doc_id: tuple(r[b] for b in BASE) for r in Q.judge(make(texts)).collect()}
        assert got == {i: plain(t) for i, t in enumerate(texts)}

    run()


def test_odd_rows(odd):
    out = Q.judge(odd).collect()
    assert len(out) == odd.count() and not any(r.kept for r in out)
    for r in out:
        if r.doc_id is not None and r.doc_id < 11:
            from tests.llm.conftest import ODD

            assert tuple(r[b] for b in BASE) == plain(ODD[r.doc_id])
    assert Q.judge(odd.where("false")).count() == 0
    kept = Q.filtered(odd)
    assert kept.columns == odd.columns and kept.count() == 0


def test_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.judge(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.02 * n[0, False]


def test_one_projection(corpus):
    plan = Q.judge(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Generate"))


def test_windows_of_one_hash_are_told_apart_by_words(make):
    texts = ["a b c d e a b c x", "a b c a b c", "a b c d", "a a a a", "x y", "p q r s p q r t u v s p q"]
    split = F.split("text", " ")
    for hashed in (F.xxhash64, lambda *w: F.lit(7), lambda a, b, c: F.length(a)):
        got = make(texts).select("doc_id", Q.let(split, lambda w: Q._repeated(w, F.size(w), hashed)).alias("n")).collect()
        assert {r.doc_id: r.n for r in got} == {i: plain(t)[4] for i, t in enumerate(texts)}
