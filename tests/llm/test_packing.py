import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.llm import packing as P
from agrolith.llm.queries import QUERIES, tokenizer

PATH = tokenizer("word_bpe_49k.json")


def whole(texts):
    """Ids of whole texts by the tokenizer alone."""
    from tokenizers import Tokenizer

    return [[*e.ids, P.CLOSING] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(docs, placed):
    rows = placed.collect()
    want = {}
    for r, ids in zip(docs, whole([d.text for d in docs]), strict=True):
        want.setdefault(r.doc_id, []).append(ids)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        if len(texts) == 1:
            at, ids = 0, np.array(texts[0], "<u4")
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids)) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in by_doc[i]) == sum(map(len, texts))
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.CAPACITY
    tokens = sum(r.length for r in rows)
    return (len(seqs) * P.CAPACITY - tokens) / max(tokens, 1)


def test_corpus(spark, corpus):
    assert check(corpus.collect(), P.pack(corpus, PATH)) < 0.02


def test_odd_rows(odd):
    check(odd.collect(), P.pack(odd, PATH))
    assert P.pack(odd.where("false"), PATH).count() == 0


def test_cuts_are_whole_and_fit_their_class():
    for n in range(9000):
        at = 0
        for a, size, k in P.cuts(n):
            assert a == at and 1 <= k * size <= P.CAPACITY
            at += size
        assert at == n


def test_open_bins_are_put_together():
    sizes = {k: 1 + 997 * k % P.CAPACITY for k in range(2, 90)}
    at = P.first_fit(sizes, P.CAPACITY)
    ends = {}
    for k, (i, a) in sorted(at.items(), key=lambda x: x[1]):
        assert a == ends.get(i, 0)
        ends[i] = a + sizes[k]
    assert set(at) == set(sizes) and max(ends.values()) <= P.CAPACITY
    assert len(ends) < 1.2 * sum(sizes.values()) / P.CAPACITY + 1 and P.first_fit({}, 8) == {}


def test_query(spark, sf, corpus):
    assert check(corpus.collect(), QUERIES["op5_packing"](spark, sf)) < 0.05


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBcé .,'s!?\n\t<|>1ﬁ́Σσ😀", max_size=40), max_size=5), st.sampled_from(["", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]))
def test_chunks_give_the_ids_of_whole_texts(texts, mark):
    texts = [t[:9] + mark + t[9:] for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() + [P.CLOSING] for x in P.Encoder.of(PATH).encode(texts)]
    assert got == whole(texts)


def test_ids_travel(make):
    docs = make(["hello wide world", "x y"])
    seqs = P.sequences(P.pack(docs, PATH, ids=True)).collect()
    assert sorted(x for s in seqs for x in s.ids) == sorted(x for ids in whole(["hello wide world", "x y"]) for x in ids)


def test_workers_number_their_own(spark, corpus):
    from agrolith.llm.common import materialise

    found = materialise(P.pieces(corpus, PATH), "t")
    placed = P.packed(found, bucket=20)
    assert check(corpus.collect(), placed) < 0.02


def test_words_are_learned_once_whatever_stands_behind_them_and_outlive_a_full_memory(monkeypatch):
    made = []
    plain = P.Encoder._make
    monkeypatch.setattr(P.Encoder, "_make", lambda self, chunks: made.extend(chunks) or plain(self, chunks))
    encoder = P.Encoder(PATH)
    ends = [".", ",", "!?", "***", ").", '."', "'", "'s", "'s.", "’.", "\u0301.", "<|endoftext|>.", "<.", "_", "-x", "7.", "7,5.", "\u00a0.", ".é"]
    texts = [" ".join(w + e for w in ("house", "don't", "été", "İstanbul", "x<|endoftext|>y", "")) for e in ends] + [" ".join(f"house{e}" for e in ends)]
    assert [np.frombuffer(x, "<u4").tolist() + [P.CLOSING] for x in encoder.encode(texts)] == whole(texts)
    assert made.count(b"house") == 1 and b"house." not in made and b"house***" not in made
    monkeypatch.setattr(P, "MEMORY", 40)
    for i in range(50):
        encoder.encode([f"frequent, words stay; seldom{i} ones{i} go{i}."])
        assert i < 10 or len(encoder.known) + len(encoder.older) <= 2 * 40
    assert made.count(b"frequent") == 1 and made.count(b"stay") == 1


def test_words_of_plain_letters_go_to_the_merges_alone(monkeypatch):
    asked = []
    plain = P.Encoder._ids
    monkeypatch.setattr(P.Encoder, "_ids", lambda self, texts: asked.extend(texts) or plain(self, texts))
    latin = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    texts = [" ".join(f"{a}{b}x{c}" for a, b, c in zip(latin, latin[7:] + latin[:7], "Wiederholung" * 6, strict=False)), "Eau aiÈle <| éÉß ſ ﬁ x× x÷y", "", " \n", *latin, "á Ω\x1cq"]
    texts += [t.replace(" ", "., ") + ".***" for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() + [P.CLOSING] for x in P.Encoder(PATH).encode(texts)] == whole(texts)
    assert asked and not set(latin).intersection("".join(asked)) and "aiÈle" not in "".join(asked)


def test_workers_let_go_of_chunks_after_their_task(spark, corpus):
    def held(batches):
        for b in batches:
            e = P.Encoder._by_path.get(PATH)
            yield pa.RecordBatch.from_arrays([pa.array([-1 if e is None else len(e.known) + len(e.older)] * b.num_rows, pa.int64())], names=["n"])

    assert P.pieces(corpus, PATH).count() > 0
    seen = {r.n for r in spark.range(64, numPartitions=16).mapInArrow(held, "n long").collect()}
    assert 0 in seen and max(seen) == 0
