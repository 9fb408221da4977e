import hashlib
import random

import numpy as np
import pytest

from agrolith.llm import winnowing as W
from agrolith.llm.queries import op7_winnowing

M = (1 << 64) - 1


def slow(text, k=W.K, window=W.WINDOW):
    p = [ord(c) for c in text]
    k = min(k, len(p))
    hashes = []
    for i in range(len(p) - k + 1 if k else 0):
        h = 0
        for c in p[i : i + k]:
            h = (h * W._BASE + c) & M
        h ^= h >> 31
        hashes.append((h * 0xBF58476D1CE4E5B9 & M) >> 32)
    w, picks = min(window, len(hashes)), []
    for i in range(len(hashes) - w + 1 if hashes else 0):
        at = min(range(i, i + w), key=lambda j: (hashes[j], -j))
        if not picks or picks[-1] != at:
            picks.append(at)
    return [(hashes[a], a) for a in picks]


@pytest.mark.parametrize("k, window", [(1, 1), (2, 3), (5, 4), (7, 16), (25, 76), (24, 75)])
def test_picks(k, window):
    rng = random.Random(k)
    for n in (0, 1, 2, 6, 24, 25, 26, 100, 400):
        for letters in ("ab", "abcdefgé😀", "a"):
            t = "".join(rng.choices(letters, k=n))
            h, at = W.fingerprint(t, k, window)
            assert list(zip(h.tolist(), at.tolist(), strict=True)) == slow(t, k, window)


def test_common_passages_leave_common_picks():
    rng = random.Random(2)
    for _ in range(50):
        passage = "".join(rng.choices("abcdefgh ", k=W.K + W.WINDOW - 1))
        a, b = ("".join(rng.choices("ijklmn", k=300)) + passage + "".join(rng.choices("opqrst", k=200)) for _ in range(2))
        assert len(np.intersect1d(W.fingerprint(a)[0], W.fingerprint(b)[0]))


def brute(rows):
    """By falling id, nulls last, equal ids by the order given."""
    out = {}
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, after = (slow(x) for x in (text, changed, following))
        alike = lambda a, b: 1.0 if not a and not b else 2 * len({h for h, _ in a} & {h for h, _ in b}) / (len({h for h, _ in a}) + len({h for h, _ in b}))
        shown = lambda x: "".join(f"{h:08x}{p:08x}" for h, p in x)
        out[doc] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), shown(own), shown(other), alike(own, other), alike(own, after))
    return out


def rows_of(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


def test_query_against_brute_force(spark, sf, corpus):
    some = corpus.where("n_chars < 900")
    rows = sorted(((r.doc_id, r.text) for r in some.collect()), reverse=True)
    for per in (3, 50, 4000):
        assert rows_of(W.compare_in_order(some, per_bucket=per)) == brute(rows)
    assert op7_winnowing(spark, sf).count() == corpus.count()


def test_odd_rows(odd, make):
    out = W.compare_in_order(odd, per_bucket=3)
    assert out.count() == odd.count()
    one = make(["abc"])
    assert rows_of(W.compare_in_order(one)) == brute([(0, "abc")])
    rows = [(2, None), (1, ""), (None, "x" * 40)]
    assert rows_of(W.compare_in_order(make([t for _, t in rows], [i for i, _ in rows]), per_bucket=1)) == brute(rows)
    assert W.compare_in_order(odd.where("false")).count() == 0
    assert W.compare_in_order(make(["a", "b"], [None, None])).count() == 2
    assert W.fingerprints(odd).count() == odd.count()


def test_kept_half_of_a_short_text_leaves_a_pick():
    rng = random.Random(9)
    for n in range(50, 200):
        text, following = ("".join(rng.choices("abcdefgh ", k=n)) for _ in range(2))
        assert W.likeness(W.fingerprint(text)[0], W.fingerprint(W.edited(text, following))[0]) > 0


def test_an_id_of_a_third_of_all_rows_is_many_ranges(spark, make):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(0, 80))) for _ in range(300)]
    ids = [7 if i % 3 == 0 else None if i % 30 == 1 else i * (-1) ** i for i in range(300)]
    texts[30:60:3] = ["the same"] * 10  # rows alike in id and text
    docs = make(texts, ids)
    bounds = W._firsts(W._keys(docs), 4)
    place = [(r[0], r[1], r[2]) for r in W._keys(docs).select(*W._PLACE).collect()]
    at = np.searchsorted(bounds, W._packed(*zip(*place, strict=True)), "right") - 1
    assert at.min() == 0 and np.bincount(at).max() < 40 and len(bounds) > 40
    assert [x for _, x in sorted(zip(W._packed(*zip(*place, strict=True)).tolist(), place, strict=True))] == sorted(place)
    rows = [r.text for r in W._keys(docs).orderBy(*W._PLACE).collect()]
    want = brute(list(enumerate(rows)))
    for per in (4, 1000):
        assert sorted(tuple(r)[1:] for r in W.compare_in_order(docs, per_bucket=per).collect()) == sorted(want.values())


def test_the_number_of_ranges_is_bounded(make, monkeypatch):
    monkeypatch.setattr(W, "RANGES", 5)
    assert len(W._firsts(W._keys(make([str(i) for i in range(500)])), 1)) <= 5
