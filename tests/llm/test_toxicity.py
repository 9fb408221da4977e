import random
import zlib

import pytest
from pyspark.sql import functions as F

from agrolith.llm import toxicity as T
from agrolith.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automata_find_what_distances_find():
    rng = random.Random(3)
    terms = {w: 2.0 for w in ("idiot", "moron", "worthless", "pathetic", "scum", "trash")}
    lex = T.Lexicon(terms, {"lowei": 3.0})
    words = list(terms) + ["loweiabc", "lowe", "xlowei"]
    for w in list(words):
        for _ in range(200):
            v = list(w)
            for _ in range(rng.randint(0, 3)):
                k, i = rng.randint(0, 2), rng.randrange(len(v) + 1)
                v[i : i + (k > 0)] = [rng.choice("aeiotrs")] * (k < 2)
            words.append("".join(v))
    for w in words:
        fits = [d for t in terms if (d := distance(w, t)) <= T.edits_for(t)] + [0] * w.startswith("lowei")
        found = lex.match(w)
        assert (found is None) == (not fits), w
        assert found is None or found[1] == min(fits), w


def test_quotation_is_told_apart():
    lex = T.Lexicon({"idiot": 4.0}, {})
    plain, quoted, said = (T.features(t, lex) for t in ("you idiot there", 'they read "you idiot" aloud', "she said idiot twice"))
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0 and said[2] > 0
    assert T.features("you idiott", lex)[1] > 0 and T.features("", lex) == T.NONE


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, T.train(docs, labels)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    scores = {r.doc_id: r.score for r in T.score(docs, model).collect() if r.doc_id in known}
    toxic, clean = [scores[i] for i in known if known[i]], [scores[i] for i in known if not known[i]]
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.8
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.01


def test_odd_rows_and_no_labels(trained, odd, make):
    model = trained[2]
    out = T.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score < 0.5 for r in out)
    assert T.filtered(odd, model).columns == odd.columns and T.filtered(odd, model).count() == odd.count()
    labels = odd.selectExpr("doc_id", "cast(null as int) as toxic", "cast(null as int) as quality")
    bare = T.train(odd, labels)
    assert {r.score < 0.5 for r in T.score(odd, bare).collect()} == {True}
    assert T.score(odd.where("false"), bare).count() == 0
    assert T.train(odd.where("false"), labels.where("false")).lexicon.terms == {}


def test_query_and_its_fold(spark):
    """The query's columns against the operator's scores; labels of the held-out fold change no score."""
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op4_toxicity"](spark, sf)
    assert [(n, t) for n, t in out.dtypes] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in T.score(docs, T.train(docs, turned)).collect()}
    rows = out.collect()
    assert len(rows) == len(again) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.score == again[r.doc_id] and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_repeated_rows_and_ties_in_the_sample(spark):
    """A bounded sample of equal rows is the same whatever their order."""
    rows = [(i, ("you vile grobnik " if i % 3 == 0 else "a fine day ") + f"word{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] * 2, "doc_id long, toxic int")
    models = [T.train(docs.repartition(n), labels.repartition(n), sample=100) for n in (1, 5)]
    assert models[0].lexicon.terms == models[1].lexicon.terms and abs(models[0].weights - models[1].weights).max() < 1e-9


def test_learning_holds_few_pairs_whatever_a_batch_has(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "PAIRS", 100)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["worthless", "people", "of", "trash", "trashy", "lowest", "Ébène"], k=rng.randint(0, 9))) for _ in range(500)]
    batch = [pa.RecordBatch.from_arrays([pa.array(texts + [None])], names=["text"])]  # one batch, and few different words
    for wanted in (None, (frozenset(["trash", "of"]), frozenset(["trash*"]))):
        want = [(k, T._like(T._words(t))) for t in texts for w in [T._words(t)] for k in w | {s for x in w for s in T._prefixes(x)} if wanted is None or k in wanted[0] | wanted[1]]
        found = list(T._pairs(iter(batch), wanted))
        assert sorted(x for b in found for x in zip(b["key"].to_pylist(), b["like"].to_pylist())) == sorted(want)
        assert len(found) > 5 and max(b.num_rows for b in found) <= 100 + 50
