"""Toxicity by a learned lexicon, met through Levenshtein automata (operator 4).

**Lexicon.** From a bounded sample of labelled documents outside the held-out fold (``SAMPLE`` rows,
a parameter): words that toxic documents hold far more often than others, and stems, under which
several such words stand. A word counts once for a group of like documents (one min-hash each), so
that copies of one toxic document do not make its other words toxic.

**Matching.** The lexicon is a trie. The Levenshtein automata of its terms (one edit from five
letters, two from eight) are intersected with it and made deterministic as far as words demand: a
state is the set of trie nodes that the read letters may have led to, with the edits spent.
Most words end after two or three letters in the empty state. Verdicts on words are remembered in bounded memory.

**Context.** Each match is weighed by its log-odds, and counts as quotation if quotation marks
enclose it or a word of saying stands before it, within a window. A logistic model over matched,
misspelled and quoted weight, fitted on the same sample, gives the score.

Defined results: a null or empty text scores as one without matches. Null labels and labels of unknown documents are
passed over; of several labels of a document the largest counts. Without labels the lexicon is empty and all
scores are equal, under 0.5. A null ``doc_id`` is never held out. Repeated rows are scored each. Further columns are passed over.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import column, hash_sample, materialise, text_column

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 30_000
#: Words and stems, each with a text, that a worker holds before it hands them on.
PAIRS = 200_000
#: Verdicts that a worker remembers.
MEMORY = 500_000
WINDOW = 80

_word = re.compile(r"[^\W_]+")
# Words of saying, and quotation marks that open and close.
SAYING = frozenset("said says saying wrote writes called quoted quote reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split())
OPEN, CLOSE = "\"“„«‘", "\"”“»’"


NONE = (0.0, 0.0, 0.0, 0.0)
#: Where the weights of the features and the bias start, and what a ridge draws them to.
PRIOR = (1.5, 0.7, 0.1, 0.5, -3.0)


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Lexicon:
    """Terms and stems with weights; ``match`` gives a word's weight and edits."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.terms, self.stems = terms, stems
        self._children: list[dict[str, int]] = [{}]
        self._term: list[str | None] = [None]
        self._stem: list[str | None] = [None]
        self._deep = [0]  # the most edits that a term under a node allows
        for words, slot, fuzzy in ((terms, self._term, True), (stems, self._stem, False)):
            for w in sorted(words):
                at, most = 0, edits_for(w) if fuzzy else 0
                self._deep[0] = max(self._deep[0], most)
                for c in w:
                    if c not in self._children[at]:
                        self._children[at][c] = len(self._children)
                        self._children.append({})
                        self._term.append(None)
                        self._stem.append(None)
                        self._deep.append(0)
                    at = self._children[at][c]
                    self._deep[at] = max(self._deep[at], most)
                slot[at] = w
        self._reset()

    def __getstate__(self):
        return self.terms, self.stems

    def __setstate__(self, state):
        self.__init__(*state)

    def _reset(self) -> None:
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._next: list[dict[str, int]] = []
        self._ends: list[tuple[float, int] | None] = []
        self._sure: list[bool] = []
        self._known: dict[str, tuple[float, int] | None] = {}
        self._start = self._state({0: 0})

    def _state(self, best: dict[int, int]) -> int:
        """The state of trie nodes with the fewest edits each, skipped letters of the terms included."""
        todo = list(best.items())
        while todo:
            node, e = todo.pop()
            if best[node] < e:
                continue
            for child in self._children[node].values():
                if e + 1 <= self._deep[child] and best.get(child, 99) > e + 1:
                    best[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(best.items())
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(key)
            self._next.append({})
            found = [(e, -self.terms[t]) for n, e in key if (t := self._term[n]) is not None and e <= edits_for(t)]
            stem = [(0, -self.stems[s]) for n, e in key if e == 0 and (s := self._stem[n]) is not None]
            least = min(found + stem, default=None)
            self._ends.append(None if least is None else (-least[1], least[0]))
            self._sure.append(bool(stem))
        return self._ids[key]

    def _step(self, state: int, c: str) -> int:
        best: dict[int, int] = {}
        for node, e in self._sets[state]:
            for letter, child in self._children[node].items():
                spent = e + (letter != c)
                if spent <= (self._deep[child] if letter != c else 9) and best.get(child, 99) > spent:
                    best[child] = spent
            if e + 1 <= self._deep[node] and best.get(node, 99) > e + 1:
                best[node] = e + 1
        self._next[state][c] = to = self._state(best)
        return to

    def forget(self) -> None:
        """Let go of the words that were looked up; the automaton stays."""
        self._known.clear()

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the nearest term, or None."""
        if word in self._known:
            return self._known[word]
        if len(self._known) > MEMORY or len(self._sets) > 50_000:
            self._reset()
        state = self._start
        for c in word:
            if self._sure[state]:
                break
            to = self._next[state].get(c)
            state = self._step(state, c) if to is None else to
            if not self._sets[state]:
                break
        self._known[word] = found = self._ends[state]
        return found


def quoted(text: str, start: int, end: int) -> bool:
    """Whether quotation marks enclose the span, or a word of saying stands shortly before it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    if before.count('"') % 2 and '"' in after:
        return True
    if max(map(before.rfind, OPEN[1:])) > max(map(before.rfind, CLOSE[1:3:2] + "’")) and any(c in after for c in CLOSE[1:]):
        return True
    return any(w in SAYING for w in _word.findall(before.lower())[-4:])


def features(text: str, lexicon: Lexicon) -> tuple[float, ...]:
    """Weight of matches as spelled, of misspelled ones, of quoted ones, and of the first two by 100 words, each as log(1 + sum)."""
    low = text.lower()
    match = lexicon.match
    words = _word.findall(low)
    hit = {w: m for w in set(words) if (m := match(w)) is not None}
    if not hit:
        return NONE
    sums = [0.0, 0.0, 0.0]
    for m in re.finditer(r"(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(hit, key=len, reverse=True))) + r")(?![^\W_])", low):
        weight, edits = hit[m.group()]
        sums[2 if quoted(low, *m.span()) else min(edits, 1)] += weight / (1 + edits)
    return tuple(map(math.log1p, (*sums, 100 * (sums[0] + sums[1]) / len(words))))


def _words(text: str) -> set[str]:
    return set(_word.findall(text.lower()))


def _like(words: set[str]) -> int:
    return min((xxhash.xxh32_intdigest(w.encode()) for w in words), default=0)


def _prefixes(word: str) -> list[str]:
    return [word[:n] + "*" for n in range(4, min(9, len(word)))]


def _tail(k: int, n: int, p: float) -> float:
    """-log10 of an upper bound (Chernoff) of the chance of k or more in n."""
    q = k / n
    if q <= p:
        return 0.0
    return n * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0)) / math.log(10)


def _pairs(batches, wanted: tuple[frozenset, frozenset] | None = None):
    """Words and stems (those wanted, or all) with the group of their text, handed on after any text that makes them over ``PAIRS``: a batch may be of any size."""
    keys, likes = [], []
    flush = lambda: pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(likes, pa.int64())], names=["key", "like"])
    for b in batches:
        for t in text_column(b):
            words = _words(t)
            stems = {s for w in words for s in _prefixes(w)}
            own = [*words, *stems] if wanted is None else [*(words & wanted[0]), *(stems & wanted[1])]
            keys += own
            likes += [_like(words)] * len(own)
            if len(keys) > PAIRS:
                yield flush()
                keys, likes = [], []
    yield flush()


def learn_lexicon(train: DataFrame) -> Lexicon:
    """All terms and stems that pass the test. ``train``: ``text`` and ``toxic``, a bounded table, which bounds them too.

    Only words of toxic documents are counted in the others.
    """
    spark = train.sparkSession

    counts = lambda wanted: lambda batches: _pairs(batches, wanted and wanted.value)
    toxic, other = train.where("toxic = 1"), train.where("toxic = 0")
    count = lambda rows, wanted: rows.select("text").mapInArrow(counts(wanted), "key string, like long").distinct().groupBy("key").count()
    table = lambda df: dict(zip(*(df.toArrow()[c].to_pylist() for c in ("key", "count")), strict=True))
    found = table(materialise(count(toxic, None).where("count >= 2"), "terms"))
    n1, n0 = max(1, toxic.count()), max(1, other.count())
    words, stems = frozenset(w for w in found if w[-1] != "*"), frozenset(w for w in found if w[-1] == "*")
    sent = spark.sparkContext.broadcast((words, stems))
    also = table(materialise(count(other, sent), "others")) if found else {}
    p, chosen, under = n1 / (n0 + n1), {}, Counter()
    for w, k in found.items():
        weight = math.log((k + 0.5) / (n1 + 1)) - math.log((also.get(w, 0) + 0.5) / (n0 + 1))
        if weight >= 1 and w[-1] != "*":
            under.update([*_prefixes(w), w + "*"])
        if weight >= 2 and k >= 4 and _tail(k, k + also.get(w, 0), p) >= 5:
            chosen[w] = min(weight, 8.0)
    kept_stems = {}
    for s in sorted(s for s in chosen if s[-1] == "*"):
        longer = [x for x in chosen if x[-1] == "*" and len(x) == len(s) + 1 and x.startswith(s[:-1]) and found[x] >= 0.95 * found[s]]
        if under[s] >= 3 and not longer and not any(s[:-1].startswith(x) for x in kept_stems):
            kept_stems[s[:-1]] = chosen[s]
    alone = {w: v for w, v in chosen.items() if w[-1] != "*" and not any(w.startswith(s) for s in kept_stems)}
    return Lexicon(alone, kept_stems)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.003) -> np.ndarray:
    """Weights of a logistic model with a bias last, by damped Newton steps; weights of matches are kept at 0 or more."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = prior = np.array(PRIOR)
    if not len(y) or y.min() == y.max():
        return w
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + ridge * (w - prior)
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + (ridge + 1e-6) * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, g), -1, 1)
        w[:-1] = np.maximum(w[:-1], 0)
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, len(NONE))
        return 1 / (1 + np.exp(-(x @ self.weights[:-1] + self.weights[-1])))


def held_out():
    """The fold that labels are never learned from: crc32 of the id as text, divisible by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = hash_sample(known, ["_id", "toxic"], known.count(), sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("text", "toxic")  # at most ``sample`` small rows are sent
    rows = materialise(rows, "labelled")
    lexicon = learn_lexicon(rows)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for b in batches:
            x = np.array([features(t, sent.value) for t in text_column(b)], float).reshape(-1, len(NONE))
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T.copy()), column(b, "toxic")], names=[*"abcd", "toxic"])
        sent.value.forget()  # the worker goes on with the filter, which has a lexicon of its own

    seen = rows.mapInArrow(run, "a double, b double, c double, d double, toxic int").toArrow()
    x = np.column_stack([seen[c].to_numpy() for c in "abcd"]) if seen.num_rows else np.zeros((0, len(NONE)))
    return Model(lexicon, fit(x, seen["toxic"].to_numpy().astype(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(sent.value.scores(text_column(b)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def filtered(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(sent.value.scores(text_column(b)) < threshold))
        sent.value.lexicon.forget()  # the worker goes on with other stages

    return docs.mapInArrow(run, docs.schema)
