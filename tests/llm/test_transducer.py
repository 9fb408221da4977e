import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.llm import transducer as T
from agrolith.llm.queries import op8_transducer, tokenizer

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aehinorstTHE  .,'\n\t▁éßñ你😀"), st.characters(codec="utf-8", exclude_characters="\0")), max_size=50))
def test_ids_are_the_library_s(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = T.Transducer.load(PATH)
    ids = np.frombuffer(own.encode([text])[0], "<u4").tolist()
    assert ids == sp.encode(text)
    if "▁" not in text:
        assert own.decode(own.encode([text])[0]) == text


def test_query(spark, sf, corpus, theirs):
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for r in op8_transducer(spark, sf).collect():
        ids = theirs.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


def test_unigram_takes_the_cheapest_path():
    pieces = {"▁a": (3, -1.0), "b": (4, -2.0), "▁": (5, -3.0), "ab": (6, -0.5), "▁ab": (7, -3.5), "a": (8, -4.0)}
    own = T.Transducer(pieces, None, 0, merges=False)
    assert own.shortest("▁ab") == (7,) or own.shortest("▁ab") == (3, 4)
    best = min((sum(-pieces[p][1] for p in x), x) for x in (("▁a", "b"), ("▁", "ab"), ("▁ab",), ("▁", "a", "b")))
    assert [own.text[i] for i in own.shortest("▁ab")] == list(best[1]) or abs(best[0] - 3.0) < 1e-9
    assert own.shortest("▁a?") == (3, 0)


def model(kind, rule="nmt_nfkc", fallback=True, own=(), squeeze=True):
    """A model file made by rule, without training: single characters, and every run of 2 to 4 in some sentences."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=squeeze, escape_whitespaces=True).serialized_model_proto())
    del m.pieces[:]
    spec = m.normalizer_spec
    spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = True, squeeze, True
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = {"unigram": 1, "bpe": 2}[kind], fallback
    m.trainer_spec.unk_surface = " \u2047 "

    def add(piece, score, type_):
        m.pieces.append(pb.ModelProto.SentencePiece(piece=piece, score=score, type=type_))

    add("<unk>", 0.0, 2)
    add("<s>", 0.0, 3)
    add("</s>", 0.0, 3)
    for x in own:
        add(x, 0.0, 4)
    if fallback:
        for b in range(256):
            add(f"<0x{b:02X}>", 0.0, 6)
    words = "▁the ▁rain ▁in ▁spain ▁stays ▁mainly ▁there ▁and ▁notes ▁are ▁to ▁be ▁read ▁5 ▁né ▁fi".split()
    found = {w[a:b] for w in words for a in range(len(w)) for b in range(a + 1, min(len(w), a + 4) + 1)} | set("▁abcdefghijklmnopqrstuvwxyz ")
    for i, x in enumerate(sorted(found - {" ", *own}, key=lambda x: (len(x), x))):
        add(x, -float(i) if kind == "bpe" else -3.0 - 1.7 * len(x) ** 0.5 - (i * 37 % 101) / 30, 1)
    return m.SerializeToString()


KINDS = [(k, r, f, o, q) for k in ("unigram", "bpe") for r, q in (("nmt_nfkc", True), ("nfkc_cf", False), ("identity", False)) for f, o in ((True, ()), (False, ("<sep>", "ain", "é")))]


@pytest.fixture(scope="module")
def both(tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("models"), []
    for i, kind in enumerate(KINDS):
        path = folder / f"{i}.model"
        path.write_bytes(model(*kind))
        out.append((kind, T.Transducer.load(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))))
    return out


_PARTS = ["the", "rain", "spain", " ", "  ", "\t", "\n", "▁", "é", "e\u0301", "ﬁ", "漢", "漢漢漢", "½", "\u00a8", "\u200b", "Ａ", "ß", "<sep>", "ain", "<s>", "가", "\u1100\u1161", "x", "5", "notes", "ＴＨＥ", "😀", "İ"]


@settings(max_examples=150, deadline=None)
@given(text=st.lists(st.one_of(st.sampled_from(_PARTS), st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=3)), max_size=12).map("".join))
def test_models_with_maps_unknowns_and_own_pieces_are_the_library_s(both, text):
    for kind, ours, theirs in both:
        raw = ours.encode([text])[0]
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == theirs.encode(text), kind
        assert ours.decode(raw) == theirs.decode(ids), kind


def test_whole_documents_in_models_with_maps(both, corpus):
    texts = [r.text or "" for r in corpus.collect()]
    for kind, ours, theirs in both:
        for t, raw in zip(texts, ours.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == theirs.encode(t), kind


def test_the_longest_rule_goes_first_and_kept_texts_stay():
    n = T.Normaliser({"a": "1", "ab": "2", "abc": "3", "bd": "4"}, {"abx"})
    assert n("abcabdabxaab b") == "32dabx12 b"
    assert T.Normaliser({}, set())("as it is") == "as it is"


def test_odd_rows(odd):
    from tests.llm.conftest import ODD

    out = T.encode(odd, PATH).collect()
    assert len(out) == odd.count() and all(r.round_trip for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (0, 1)} == {0}
    back = {r.doc_id: r.text for r in T.decode(T.encode(odd, PATH), PATH).collect()}
    assert back[6] == ODD[6] and back[0] == ""
    assert T.encode(odd.where("false"), PATH).count() == 0
