"""Harmonic packing of tokenised documents into sequences of a fixed capacity (operator 5).

A document's token ids are cut into full sequences and a rest. A piece of length r belongs to the
reciprocal class k = capacity // r: any k pieces of the class fill one bin. A rest that would leave
over ``SLACK`` of its bin empty is cut once more, at capacity // (k + 1), which fills the bins of
class k + 1; rests of up to the root of the capacity fill theirs anyhow.
A bin of class k takes exactly k pieces, so packing needs no look at other pieces: each worker
numbers its own pieces of a class, the running sum of the workers' counts gives its first number,
and number // k is the bin. Only the last bin of each class may stay open. Open bins, one a class and so under
twice the root of the capacity, are put together whole, first-fit by falling length; their pieces stay where they are.

Ids are made per blank-separated chunk of a text and remembered for the next one, in a memory of
bounded size: the tokenizer drops white space, so no token reaches over a blank. Punctuation behind a letter of Latin-1 or a digit of
ASCII is a token run of its own, so a word is learned once with all that stands behind it. Words of such letters alone need only
the tokenizer's merges. A full memory keeps what was met since it was half full.

Defined results: a null text counts as empty, and an empty one has the closing id alone. Repeated
rows and ids are packed as they come. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.llm.common import column, materialise, row_numbers, text_column

CAPACITY = 2048
CLOSING = 1
SLACK = 0.02
#: Chunks whose ids a worker remembers.
MEMORY = 500_000
#: Pieces numbered in one task.
BUCKET = 10_000
#: Characters that are cut into chunks in one turn.
TURN = 2_000_000
#: Punctuation that may stand behind a word. An apostrophe may be the start of a contraction, so it is not among these, nor are signs of special tokens.
BEHIND = b"]!\"#$%&()*+,./:;=?@[\\^_`{}~-"
# Letters of ASCII and Latin-1, in UTF-8, that are letters in every form: no normal form changes them, and they are lower-cased one by one.
_letter = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_letters, _ended = re.compile(_letter + rb"+"), re.compile(rb"(?:" + _letter + rb"|[0-9])\Z")
# What stands for a byte in the tokenizer's words: visible characters of Latin-1 themselves, others by number from 256 on; blanks stay.
_visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_alphabet = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _visible) if b != 0x20}


def cuts(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int, int]]:
    """Start, length and class of the pieces of ``n`` tokens."""
    out = [(a, capacity, 1) for a in range(0, n - capacity + 1, capacity)]
    at, rest = len(out) * capacity, n % capacity
    while rest:
        k = capacity // rest
        if rest * rest <= capacity or capacity - k * rest <= slack * capacity:
            out.append((at, rest, k))
            break
        size = capacity // (k + 1)
        out.append((at, size, k + 1))
        at, rest = at + size, rest - size
    return out


class Encoder:
    """Texts to the bytes of their ids (little-endian, 32 bits), by way of remembered chunks.

    ASCII letters are lower-cased before chunks are looked up, as the tokenizer lower-cases them anyhow.
    """

    _by_path: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own, self.known, self.older = Tokenizer.from_file(path), {}, {}
        self.mark = min(self.own.get_added_tokens_decoder())
        self.between = self.own.id_to_token(self.mark)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def forget(self) -> None:
        """Let go of the chunks; the tokenizer stays."""
        self.known, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> None:
        """Ids of new chunks, those with punctuation behind from the ids of both parts."""
        parted = [(c, word, c[len(word) :]) for c in chunks if c[-1] in BEHIND and _ended.search(word := c.rstrip(BEHIND))]
        parts = {x for c in parted for x in c[1:]}
        self._make(list((chunks.difference(c for c, _, _ in parted) | parts).difference(self.known)))
        self.known.update((c, self.known[word] + self.known[behind]) for c, word, behind in parted)

    def _make(self, chunks: list[bytes]) -> None:
        """Ids of words of plain letters by the tokenizer's merges alone, of other chunks by the whole tokenizer."""
        for a in range(0, len(chunks), 10_000):
            part = chunks[a : a + 10_000]
            ascii_ = [c for c in part if c.isalpha()]
            latin = [c for c in set(part).difference(ascii_) if _letters.fullmatch(c)]
            self._words(ascii_, b" ".join(ascii_).lower().decode())
            self._words(latin, b" ".join(latin).decode().lower().encode().decode("latin-1").translate(_alphabet))
            self._others(list(set(part).difference(ascii_, latin)))

    def _words(self, words: list[bytes], shown: str) -> None:
        """Such a word is one token run as it stands: only case and the alphabet that stands for bytes (``shown``) come before the merges."""
        for word, own in zip(words, map(self.own.model.tokenize, shown.split()), strict=True):
            self.known[word] = array("I", [t.id for t in own]).tobytes()

    def _others(self, chunks: list[bytes]) -> None:
        """Many chunks in one text with a special token between them."""
        between = self.between.encode()
        odd = [c for c in chunks if between in c]
        self.known.update(zip(odd, (x.tobytes() for x in self._ids([c.decode() for c in odd])), strict=True))
        plain = [c for c in chunks if between not in c]
        parts = [plain[a : a + 1000] for a in range(0, len(plain), 1000)]
        for part, ids in zip(parts, self._ids([between.join(p).decode() for p in parts]), strict=True):
            ends = np.flatnonzero(ids == self.mark)
            raw, cuts_at = ids.tobytes(), [-4, *(4 * ends).tolist(), 4 * len(ids)]
            self.known.update(zip(part, (raw[x + 4 : y] for x, y in zip(cuts_at, cuts_at[1:], strict=False)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Texts go in turns, so that the chunks of a batch of long ones are not held at once."""
        out, turn, size = [], [], 0
        for t in texts:
            turn.append(t)
            size += len(t)
            if size > TURN:
                out += self._turn(turn)
                turn, size = [], 0
        out += self._turn(turn)
        pa.default_memory_pool().release_unused()  # else Arrow keeps what the turns took
        return out

    def _turn(self, texts: list[str]) -> list[bytes]:
        """Arrow cuts the texts into chunks and numbers the different ones, so that each is looked up once."""
        raw = pa.array(texts, pa.large_string())
        raw = pc.if_else(pc.match_substring(raw, "<|"), raw, pc.ascii_lower(raw))  # a special token in capitals is none
        lists = pc.ascii_split_whitespace(raw)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        self._remember(set(chunks))
        own = list(map(self.known.__getitem__, chunks))
        size = np.fromiter(map(len, own), np.int32, len(own)) // 4
        at, of = size.cumsum(dtype=np.int64) - size, coded.indices.to_numpy()
        n = size[of]
        ends = np.append(0, n.cumsum(dtype=np.int64))
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        from_ = np.arange(ends[-1], dtype=kind)
        from_ += np.repeat((at[of] - ends[:-1]).astype(kind), n)
        ids = np.frombuffer(b"".join(own), "<u4")[from_].tobytes()
        edges = (4 * ends[lists.offsets.to_numpy()]).tolist()
        return [ids[a:b] for a, b in pairwise(edges)]

    def _remember(self, chunks: set[bytes]) -> None:
        chunks.discard(b"")
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > MEMORY // 2:
            self.known, self.older, new = {}, self.known, chunks
        again = new.intersection(self.older)
        self.known.update((c, self.older[c]) for c in again)
        self._learn(new - again)
        self.known[b""] = b""


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, k`` of every piece, and with ``ids`` its token ids."""
    end = np.array([closing], "<u4").tobytes()

    def run(batches):
        encoder = Encoder.of(path)
        for b in batches:
            doc = column(b, "doc_id").cast(pa.int64()).to_pylist()
            for a in range(0, len(doc), 500):
                rows = []
                for d, raw in zip(doc[a : a + 500], encoder.encode(text_column(b.slice(a, 500))), strict=True):
                    raw += end
                    n = len(raw) // 4
                    for at, size, k in cuts(n, capacity):
                        own = raw[4 * at : 4 * (at + size)]
                        rows.append((d, at, size, zlib.crc32(own), n, k, np.frombuffer(own, "<u4") if ids else None))
                cols = list(zip(*rows, strict=True))
                out = [pa.array(x, pa.int64()) for x in cols[:6]] + ([pa.array(cols[6], pa.list_(pa.int32()))] if ids else [])
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", *["ids"] * ids])
        encoder.forget()  # the worker goes on with other stages

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k long" + ", ids array<int>" * ids)


def first_fit(sizes: dict[int, int], capacity: int) -> dict[int, tuple[int, int]]:
    """The sequence and the offset of each open bin, by class: the longest first, each into the first sequence with room."""
    used, out = [], {}
    for k, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        i = next((i for i, u in enumerate(used) if u + size <= capacity), len(used))
        if i == len(used):
            used.append(0)
        out[k] = i, used[i]
        used[i] += size
    return out


def packed(found: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``found`` is read several times: it should be a table."""
    n = found.count()
    ranked = row_numbers(found, ["k"], ["doc_id", "start", "length", "ids_crc32"], bucket, n)
    totals = found.groupBy("k").agg(F.count(F.lit(1)).alias("_all"))  # a row for each class
    ranked = ranked.join(F.broadcast(totals), "k").withColumn("_bin", F.floor(F.col("rank") / F.col("k")))
    ranked = materialise(ranked.withColumn("_open", F.col("rank") >= F.col("_all") - F.col("_all") % F.col("k")), "ranked")
    inside = W.partitionBy("k", "_bin").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(inside), F.lit(0))
    open_ = {r.k: r.n for r in ranked.where("_open").groupBy("k").agg(F.sum("length").alias("n")).collect()}
    places = first_fit(open_, capacity)
    at = lambda i: F.element_at(F.create_map(*[F.lit(x) for k in sorted(places) for x in (k, places[k][i])]), F.col("k")) if places else F.lit(0)
    sequence = F.when(F.col("_open"), at(0)).otherwise(F.col("k") * F.lit(1 << 40) + F.col("_bin")).cast("long")
    offset = (before + F.when(F.col("_open"), at(1)).otherwise(0)).cast("long")
    return ranked.select(*[c for c in found.columns if c != "k"], sequence.alias("sequence_id"), offset.alias("offset"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, ids: bool = False) -> DataFrame:
    """Every piece with its place: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``)."""
    return packed(materialise(pieces(docs, path, capacity, closing, ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of each packed sequence, from the result of ``pack`` with ``ids=True``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
