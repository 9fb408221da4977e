"""Encoding and decoding with a SentencePiece model as a weighted transducer (operator 8).

Three transducers are compiled from the model file: the normaliser (rules of its character map, the longest first,
blanks to their mark, with one before the text, and runs of blanks to one where the model says so), the pieces (a
trie whose arcs read characters and write ids) and the byte fallback (a character in no piece writes its UTF-8
bytes' pieces, or is unknown; a run of unknown characters is one id). They are composed with each input
lazily, and the shortest path in the tropical semiring (min, +) gives the ids.

User-defined pieces pass the normaliser as they are. In a BPE model they part the text, in a unigram model
they are arcs of their own weight.

Weights: in a unigram model an arc weighs minus its piece's score, and an unknown character 10 more than the dearest
piece; sums are rounded to 32 bits from the start of the text on, as ties depend on it. In a BPE model merges decide, not sums;
there an arc weighs 0 if the piece may follow the one before it and infinity if not. Two
neighbours may stand together if merging their joint text gives exactly these two; a chain of such
neighbours is what merging the whole text gives, and only one path into each position is finite. (This holds where
a piece scores below those it is made of, as in every model that was made by merging.) Verdicts
on neighbours are made by the merges at their seam, once, and remembered.

In a BPE model where no piece has a blank mark after another character, no path crosses from a word into the
next blank, so words are composed one at a time and remembered, in bounded memory. Unigram models compose whole texts.

Decoding runs the transducer backwards: pieces to characters, byte pieces to bytes, marks to blanks.

Defined results: a null or empty text has no ids and decodes to the empty text. Repeated rows are
encoded each. An empty table gives an empty result. Further columns are passed over.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import column, text_column

MARK = "▁"
#: Words and neighbours that a worker remembers.
MEMORY = 1_000_000
_words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_blanks = re.compile("  +")
_LEAST_32, _MOST_32 = float(np.finfo(np.float32).tiny), float(np.finfo(np.float32).max)


def _to_32(x: float) -> float:
    return float(np.float32(x))


@lru_cache(4)
def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double array over UTF-8 bytes, then its targets, each ended by a zero."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, targets = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size :]
    offset = (units >> 10) << ((units & 512) >> 6)
    every, rules = np.arange(256), {}
    at, read = offset[:1], [b""]
    while len(at):
        child = at[:, None] ^ every
        inside = child < len(units)
        label = units[np.where(inside, child, 0)] & 0x800000FF
        row, byte = np.nonzero(inside & (label == every) & (child > 0))
        found = child[row, byte]
        read = [read[r] + bytes([b]) for r, b in zip(row.tolist(), byte.tolist(), strict=True)]
        at = found ^ offset[found]
        for key, node, ends in zip(read, at.tolist(), (units[found] & 256).tolist(), strict=True):
            if ends:
                a = int(units[node]) & 0x7FFFFFFF
                rules[key.decode()] = targets[a : targets.index(b"\0", a)].decode()
    return rules


class Normaliser:
    """Rewrites a text from the left, at each place by the longest rule; texts of ``kept`` go before rules and stay."""

    def __init__(self, rules: dict[str, str], kept: set[str]):
        self.steps: dict[str, list[tuple[int, dict[str, str]]]] = {}  # lengths to try by first character
        for table in ({k: k for k in kept}, rules):
            lengths: dict[str, set[int]] = {}
            for k in table:
                lengths.setdefault(k[0], set()).add(len(k))
            for c, found in lengths.items():
                self.steps.setdefault(c, []).extend((n, table) for n in sorted(found, reverse=True))
        every = kept | set(rules)
        single, later = {k for k in every if len(k) == 1}, {c for k in every for c in k[1:]}
        first = {k[0] for k in every if len(k) > 1}
        some = [x for x in (f"{_any(first)}(?={_any(later)})" if first else "", _any(single | later) if single | later else "") if x]
        # Every character that a rule can read lies in such a run, and no rule reads across its ends.
        self.runs = re.compile(f"(?:{'|'.join(some)})+") if some else None

    def __call__(self, text: str) -> str:
        return self.runs.sub(self._rewritten, text) if self.runs else text

    def _rewritten(self, run: re.Match) -> str:
        text, at, out = run[0], 0, []
        while at < len(text):
            for n, table in self.steps.get(text[at], ()):
                if (found := table.get(text[at : at + n])) is not None and at + n <= len(text):
                    out.append(found)
                    at += n
                    break
            else:
                out.append(text[at])
                at += 1
        return "".join(out)


def _any(characters: set[str]) -> str:
    return "[" + "".join(map(re.escape, sorted(characters))) + "]"


class Transducer:
    _by_path: dict[str, Transducer] = {}

    def __init__(
        self,
        pieces: dict[str, tuple[int, float]],
        byte_ids: list[int] | None,
        unknown: int,
        merges: bool,
        prefix: bool = True,
        own: dict[str, int] | None = None,
        rules: dict[str, str] | None = None,
        squeeze: bool = False,
        surface: str = "",
    ):
        """``pieces``: id and score by text. ``byte_ids``: ids of the 256 byte pieces. ``merges``: a BPE model.

        ``own``: ids of user-defined pieces. ``rules``: the character map. ``squeeze``: runs of blanks are one, and none is at
        an end. ``surface``: what an unknown id decodes to.
        """
        self.pieces, self.byte_ids, self.unknown, self.merges, self.prefix = pieces, byte_ids, unknown, merges, prefix
        self.own, self.squeeze = own or {}, squeeze
        self.normal = Normaliser(rules or {}, set(self.own))
        self.parted = re.compile("(" + "|".join(map(re.escape, sorted(self.own, key=len, reverse=True))) + ")") if self.own else None
        scores = [x for _, x in pieces.values()]
        most, least = max([*scores, _LEAST_32]), min([*scores, _MOST_32])
        self.weight = {p: -x for p, (_, x) in pieces.items()}
        self.unknown_weight = -_to_32(least - 10.0)
        if not merges:
            self.weight |= {p: -_to_32(len(p.encode()) * most - 0.1) for p in self.own}
            pieces = self.pieces = pieces | {p: (i, 0.0) for p, i in self.own.items()}
        self.whole = not merges or any(MARK in p.lstrip(MARK) for p in pieces)
        self.text = {i: p for p, (i, _) in pieces.items()}
        self.trie: list = [{}, None]  # pieces from their ends on: followers by character, and the piece that is complete
        for p in pieces:
            node = self.trie
            for c in reversed(p):
                node = node[0].setdefault(c, [{}, None])
            node[1] = p
        self.known: dict[str, bytes] = {}
        self.beside: dict[tuple[str | None, str], bool] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, float]]] = {}
        self.output = {i: p.replace(MARK, " ").encode() for p, i in [*((p, i) for p, (i, _) in pieces.items()), *self.own.items()]}
        self.output |= {i: bytes([b]) for b, i in enumerate(byte_ids or [])} | {unknown: surface.encode()}

    @classmethod
    def load(cls, path: str) -> Transducer:
        """From a model file; remembered in each worker."""
        if path not in cls._by_path:
            import sentencepiece as sp
            from sentencepiece import sentencepiece_model_pb2 as pb

            own = pb.ModelProto()
            own.ParseFromString(sp.SentencePieceProcessor(model_file=path).serialized_model_proto())
            n, t = own.normalizer_spec, own.trainer_spec
            kinds = {p.type for p in own.pieces}
            user = {p.piece: i for i, p in enumerate(own.pieces) if p.type == 4}
            if t.model_type not in (1, 2) or t.treat_whitespace_as_suffix or not n.escape_whitespaces or (t.model_type == 2 and 5 in kinds) or any("  " in p for p in user):
                raise ValueError("only unigram and BPE models are compiled, with blanks as marks before words and no unused merges")
            normal = {p.piece: (i, p.score) for i, p in enumerate(own.pieces) if p.type == 1}
            byte_ids = [i for i, p in enumerate(own.pieces) if p.type == 6] if 6 in kinds else None
            unknown = next(i for i, p in enumerate(own.pieces) if p.type == 2)
            rules = character_map(n.precompiled_charsmap)
            cls._by_path[path] = cls(normal, byte_ids, unknown, t.model_type == 2, n.add_dummy_prefix, user, rules, n.remove_extra_whitespaces, t.unk_surface)
        return cls._by_path[path]

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        own = self.normal(text)
        if self.squeeze:
            own = _blanks.sub(" ", own).lstrip(" ")
        own = MARK * self.prefix + own.replace(" ", MARK)
        return own.rstrip(MARK) if self.squeeze else own

    def _fallback(self, c: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")) if self.byte_ids else (self.unknown,)

    def _best(self, parts: list[str]) -> tuple[float, int]:
        best, at, pieces = -inf, -1, self.pieces
        for i in range(len(parts) - 1):
            found = pieces.get(parts[i] + parts[i + 1])
            if found is not None and found[1] > best:
                best, at = found[1], i
        return best, at

    def merged(self, text: str) -> list[str]:
        """``text`` merged by rank: the best-scored neighbours first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            _, at = self._best(parts)
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The symbols at one edge of a piece while merging makes it, from its character on: (text, score).

        Side 0 is the left edge, 1 the right. Empty if merging does not give the piece.
        """
        found = self.edges.get((piece, side))
        if found is None:
            parts, steps = list(piece), [piece[-side]]
            while len(parts) > 1:
                best, at = self._best(parts)
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if parts[-side] != steps[-1]:
                    steps.append(parts[-side])
            found = [(x, self.pieces[x][1] if x in self.pieces else -inf) for x in steps] if parts == [piece] else []
            self.edges[piece, side] = found
        return found

    def _seam_holds(self, before: str, piece: str) -> bool:
        """Whether merging the two texts as one leaves the seam between them.

        At any time two symbols meet at the seam. They merge if that scores over the next merge that
        changes either of them; on equal scores the leftmost merge goes first.
        """
        left, right = self._edge(before, 1), self._edge(piece, 0)
        if not left or not right:
            return False
        i = j = 0
        while True:
            pair = self.pieces.get(left[i][0] + right[j][0])
            grow_left = left[i + 1][1] if i + 1 < len(left) else -inf
            grow_right = right[j + 1][1] if j + 1 < len(right) else -inf
            if pair is not None and pair[1] > grow_left and pair[1] >= grow_right:
                return False
            if grow_left == grow_right == -inf:
                return True
            if grow_left >= grow_right:
                i += 1
            else:
                j += 1

    def _may_follow(self, before: str | None, piece: str) -> bool:
        if len(self.beside) > MEMORY:
            self.beside.clear()
        found = bool(self._edge(piece, 0)) if before is None else self._seam_holds(before, piece)
        self.beside[before, piece] = found
        return found

    def shortest(self, word: str) -> tuple[int, ...]:
        """The ids on the shortest path over ``word``, already normalised."""
        return self._ids(word, *(self._finite(word) if self.merges else self._cheapest(word)))

    def _cheapest(self, word: str) -> tuple[list, list]:
        """The last piece and where it starts, of the cheapest path into each position."""
        n = len(word)
        cost, back, last = [0.0] + [inf] * n, [0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            best = inf
            for i, piece in reversed(self._arcs(word, j)):
                if (c := _to_32(cost[i] + self.weight[piece])) < best:
                    best, back[j], last[j] = c, i, piece
            if word[j - 1] not in self.pieces and (c := _to_32(cost[j - 1] + self.unknown_weight)) < best:
                best, back[j], last[j] = c, j - 1, None
            cost[j] = best
        return last, back

    def _arcs(self, word: str, j: int) -> list[tuple[int, str]]:
        """Start and piece of the arcs into position ``j``, the shortest first."""
        node, out = self.trie, []
        for i in range(j - 1, -1, -1):
            node = node[0].get(word[i])
            if node is None:
                break
            if node[1] is not None:
                out.append((i, node[1]))
        return out

    def _finite(self, word: str, kept: int = 0, last: list | None = None, back: list | None = None) -> tuple[list, list]:
        """The same for weights of 0 and infinity: of the arcs into a position at most one is finite, mostly a long one.

        ``last`` and ``back`` may come from a word that has the first ``kept`` characters in common.
        """
        n, trie, beside = len(word), self.trie, self.beside
        last, back = (last or [None])[: kept + 1], (back or [0])[: kept + 1]
        for j in range(kept + 1, n + 1):
            node, arcs = trie, []
            for i in range(j - 1, -1, -1):
                node = node[0].get(word[i])
                if node is None:
                    break
                if node[1] is not None:
                    arcs.append((i, node[1]))
            start = end = None
            for i, piece in reversed(arcs):
                before = last[i]
                fits = beside.get((before, piece))
                if self._may_follow(before, piece) if fits is None else fits:
                    start, end = i, piece
                    break
            back.append(j - 1 if end is None else start)
            last.append(end)
        return last, back

    def _ids(self, word: str, last: list, back: list) -> tuple[int, ...]:
        out, at, pieces = [], len(word), self.pieces
        while at:
            piece = last[at]
            out.append(self._fallback(word[at - 1]) if piece is None else (pieces[piece][0],))
            at = back[at]
        return tuple(x for part in reversed(out) for x in part)

    def learn(self, words) -> None:
        """Remember the ids of ``words``; in order, so that each goes on from what it shares with the one before."""
        before, last, back = "", [None], [0]
        for w in sorted(words):
            if w in self.own and self.merges:
                self.known[w] = struct.pack("<I", self.own[w])
                continue
            if self.merges:
                kept, most = 0, min(len(w), len(before))
                while kept < most and w[kept] == before[kept]:
                    kept += 1
                before, (last, back) = w, self._finite(w, kept, last, back)
            else:
                last, back = self._cheapest(w)
            ids = self._ids(w, last, back)
            self.known[w] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian in 32 bits. Texts go in turns of bounded size."""
        out, turn, size = [], [], 0
        for t in texts:
            own = self.normalise(t)
            turn.append(self._words(own))
            size += len(t)
            if size > 2_000_000:
                out += self._turn(turn)
                turn, size = [], 0
        return out + self._turn(turn)

    def _words(self, text: str) -> list[str]:
        """What is composed one at a time; user-defined pieces of a BPE model are words of their own."""
        parts = self.parted.split(text) if self.parted and self.merges else [text]
        return [w for p in parts if p for w in ([p] if self.whole or p in self.own else _words.findall(p))]

    def _turn(self, words: list[list[str]]) -> list[bytes]:
        every = set().union(*words)
        new = every.difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.known, new = {}, every
        self.learn(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, w)) for w in words]
        if self.whole:
            self.known = {}  # whole texts seldom come again
        return out if self.byte_ids else [self._one_unknown(x) for x in out]

    def _one_unknown(self, ids: bytes) -> bytes:
        """A run of unknown characters is one id."""
        x = np.frombuffer(ids, "<u4")
        again = (x[1:] == self.unknown) & (x[:-1] == self.unknown)
        return x[np.r_[True, ~again]].tobytes() if again.any() else ids

    def decode(self, ids: bytes) -> str:
        parts = list(map(self.output.get, np.frombuffer(ids, "<u4").tolist(), _nothing))
        if self.squeeze:  # blanks before the first character go, but not those of an unknown one
            for i, own in enumerate(np.frombuffer(ids, "<u4").tolist()):
                if own == self.unknown or not parts[i].startswith(b" "):
                    break
                if parts[i] != b" ":
                    parts[i] = parts[i][1:]
                    break
                parts[i] = b""
        text = b"".join(parts).decode("utf-8", "replace")
        if self.squeeze:
            return text
        return text[1:] if self.prefix and text.startswith(" ") else text


class _Empty:
    def __iter__(self):
        return self

    def __next__(self):
        return b""


_nothing = _Empty()


def encode(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded_crc32, round_trip``, and with ``ids`` the ids themselves.

    ``decoded_crc32`` is of the text that the ids decode to, and ``round_trip`` whether that is the document's.
    """

    def run(batches):
        own = Transducer.load(path)
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                texts = text_column(part)
                found = own.encode(texts)
                back = [own.decode(x) for x in found]
                cols = [
                    column(part, "doc_id").cast(pa.int64()),
                    pa.array([len(x) // 4 for x in found], pa.int64()),
                    pa.array([zlib.crc32(x) for x in found], pa.int64()),
                    pa.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in back], pa.int64()),
                    pa.array([x == t for x, t in zip(back, texts, strict=True)]),
                ] + [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in found], pa.list_(pa.int32()))] * ids
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip", *["ids"] * ids])

    schema = "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``."""

    def run(batches):
        own = Transducer.load(path)
        for b in batches:
            texts = [own.decode(np.array(x or [], "<u4").tobytes()) for x in column(b, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
