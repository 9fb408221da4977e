import corpus_pipeline as C
from agrolith.llm import packing, pii, quality, simhash, toxicity
from agrolith.llm.common import materialise, table
from agrolith.llm.queries import tokenizer


def test_stages_against_their_own_rules(spark):
    """Each stage on its predecessor's rows, held against the operator row by row."""
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in C.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "personal_data", "packing"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    one = materialise(C.STAGES[0][1](spark, docs, sf), "t")
    assert one.columns == columns and ids(one) == ids(quality.judge(docs).where("kept"))

    two = materialise(C.STAGES[1][1](spark, one, sf), "t")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    assert two.columns == columns and ids(two) == ids(toxicity.score(one, model).where("score < 0.5"))

    three = materialise(C.STAGES[2][1](spark, two, sf), "t")
    groups = simhash.similar(two)
    assert three.columns == columns and ids(three) == {r.component_id for r in groups.collect()}

    four = materialise(C.STAGES[3][1](spark, three, sf), "t")
    before = {r.doc_id: r.text for r in three.collect()}
    assert four.columns == columns
    assert {r.doc_id: r.text for r in four.collect()} == {i: pii.masked(t) for i, t in before.items()}

    five = C.STAGES[4][1](spark, four, sf)
    assert ids(five) == ids(four)
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(five) == key(packing.pieces(four, tokenizer("word_bpe_49k.json")))
    assert key(C.run(spark, sf)) == key(five)


def test_odd_rows_and_empty_input(spark, odd, tmp_path):
    labels = odd.selectExpr("doc_id", "0 as quality", "0 as toxic")
    for name, df in (("documents", odd), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        df.where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
    for d in (str(tmp_path), f"{tmp_path}/none"):
        assert C.run(spark, d).count() == 0
    for _, stage in C.STAGES[1:4]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns
