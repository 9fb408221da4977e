"""Document fingerprints by winnowing (operator 7).

Rolling hashes of all k-grams of code points; of each window of ``window`` successive hashes the least
is picked, of equal ones the rightmost. Any passage of ``window + k - 1`` code points that two texts share
leaves a common pick. Picks keep their positions. A text shorter than a k-gram has one hash of all of it.

Hashes are polynomial, built by doubling, then mixed to 32 bits; the sliding minimum too is built by
doubling, over hash and reversed position in one 64-bit word. All of it is array arithmetic over
one text at a time.

Defined results: a null text counts as empty, and an empty text has the empty fingerprint. Two empty
fingerprints are alike (1), one empty and another are not (0). Repeated rows and ids are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import buckets_for, column, text_column

#: Together a guarantee of 25 common code points, so that the kept half of an edited text of 50 leaves a pick.
K = 10
WINDOW = 16
#: Ranges of the order, at most: the driver sees two places of 17 bytes for each.
RANGES = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams: sum of point[i + j] * base^(k - 1 - j), mixed."""
    k = min(k, len(points))
    if not k:
        return np.zeros(0, np.uint64)
    n, power, width, size = len(points), _BASE, 1, 0
    block = points.astype(np.uint64)  # block[i]: the hash of ``width`` points from i on
    h = np.zeros(n + 1, np.uint64)  # h[i]: that of ``size`` points
    while size < k:
        if k & width:
            m = n - size - width + 1
            h = h[:m] * np.uint64(power) + block[size : size + m]
            size += width
        if size < k:
            block = block[:-width] * np.uint64(power) + block[width:]
            power, width = power * power & _MASK, 2 * width
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(32)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the picks: the rightmost least hash of each window, each position once."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    own = hashes << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    w, width = min(window, n), 1
    least = own
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[: n - w + 1], least[w - width : w - width + n - w + 1])
    at = 0xFFFFFFFF - (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def fingerprint(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the picks."""
    hashes = gram_hashes(code_points(text), k)
    at = winnow(hashes, window)
    return hashes[at], at


def shown(picks: tuple[np.ndarray, np.ndarray]) -> str:
    """16 hex digits a pick: hash, then position."""
    return (picks[0] << np.uint64(32) | picks[1].astype(np.uint64)).astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the common hashes by all hashes of both sets."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) + len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``picks``: an array of ``hash`` and ``position``."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int32())]))

    def run(batches):
        for b in batches:
            found = [fingerprint(t, k, window) for t in text_column(b)]
            picks = [[{"hash": int(h), "position": int(p)} for h, p in zip(*x, strict=True)] for x in found]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(picks, kind)], names=["doc_id", "picks"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, picks array<struct<hash:long,position:int>>")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _keys(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the place of a row in the order: nulls last, ids falling, equal ones by the hash of their text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.select("doc_id", "text", F.col("doc_id").isNull().alias("_null"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("long").alias("_down"), F.xxhash64("text").alias("_hash"))


_PLACE = ["_null", "_down", "_hash"]


def _packed(null, down, hashed) -> np.ndarray:
    """Places as strings of 17 bytes that sort as the places do."""
    out = np.zeros((len(null), 17), np.uint8)
    out[:, 0] = null
    for at, x in ((1, down), (9, hashed)):
        out[:, at : at + 8] = (np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


def _firsts(keyed: DataFrame, per_bucket: int) -> np.ndarray:
    """The first places of the ranges: the very first, and quantiles of a sample of distinct places, two a range, at most ``2 * RANGES``."""
    place = keyed.select(*_PLACE)
    rows, first = place.agg(F.count(F.lit(1)), F.min(F.struct(*_PLACE))).first()
    if not rows:
        return np.zeros(0, "S17")
    n = min(buckets_for(rows, per_bucket), RANGES)
    bounds = _packed([first[0]], [first[1]], [first[2]])
    if n > 1:
        fine, mixed = 1 << 40, F.xxhash64(*_PLACE)
        share = min(fine, -(-4 * n * fine // rows))  # about twice what is taken, unless rows repeat
        few = place.where(F.pmod(mixed, F.lit(fine)) < share).distinct().orderBy(mixed, *_PLACE).limit(2 * n).toArrow()
        known = np.sort(_packed(*(few[c].to_numpy() for c in _PLACE)))
        bounds = np.unique(np.concatenate([bounds, known[len(known) * np.arange(1, n) // n]])) if len(known) else bounds
    return bounds


def compare_in_order(docs: DataFrame, k: int = K, window: int = WINDOW, per_bucket: int = 4000) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document by falling id.

    The order is by id and, for equal or null ids, by the hash of the text, and is cut into ranges of about ``per_bucket`` rows (more where
    that would make over ``RANGES``), so what the driver sees is bounded whatever the table's size, and an id that a third of all rows have is many
    ranges. Only rows that are alike in id and text share a range whatever their number; a range is sorted by Spark, which spills, and
    streamed, so it takes time and no memory. Texts are dealt to the ranges once, ranges to tasks by size; the first document of a range
    also goes to the range before it, so no range waits for another. Nulls come last.
    """
    keyed = _keys(docs)
    sent = docs.sparkSession.sparkContext.broadcast(_firsts(keyed, per_bucket))

    def deal(batches):
        bounds = sent.value
        for b in batches:
            place = _packed(*(column(b, c).to_numpy(zero_copy_only=False) for c in _PLACE))
            at = np.searchsorted(bounds, place, "right") - 1  # range i: from its first place on
            own = b.select(["doc_id", "text", "_hash"])
            yield own.append_column("_at", pa.array(at)).append_column("_tail", pa.array(np.zeros(len(at), np.int8)))
            range_, one = np.unique(np.where(bounds[at] == place, at, -1), return_index=True)
            range_, one = range_[range_ >= 0], one[range_ >= 0]  # of rows that are alike one is enough
            if len(one):
                yield own.take(pa.array(one)).append_column("_at", pa.array((range_ - 1) % len(bounds))).append_column("_tail", pa.array(np.ones(len(one), np.int8)))

    def stream(batches):
        held = opening = None  # document and text that wait for the next one; text that opened the range
        here, closed, rows = None, False, []

        def result(doc, text, own, following, picks):
            changed = edited(text, following)
            other = fingerprint(changed, k, window)
            return doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), shown(own), shown(other), likeness(own[0], other[0]), likeness(own[0], picks[0])

        def batch():
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in RESULT.split(", ")])

        for b in batches:
            for doc, text, at, tail in zip(*(column(b, c).to_pylist() for c in ("doc_id", "text", "_at", "_tail")), strict=True):
                if at != here:
                    if held and not closed:
                        rows.append(result(*held, *opening))
                    here, held, opening, closed = at, None, None, False
                if closed:
                    continue
                text = text or ""
                picks = fingerprint(text, k, window)
                if held:
                    rows.append(result(*held, text, picks))
                if opening is None:
                    opening = text, picks
                held, closed = (None, True) if tail else ((doc, text, picks), False)
                if len(rows) >= 200:
                    yield batch()
        if held and not closed:
            rows.append(result(*held, *opening))
        if rows:
            yield batch()

    dealt = keyed.mapInArrow(deal, "doc_id long, text string, _hash long, _at long, _tail byte")
    ordered = dealt.repartitionByRange("_at").sortWithinPartitions("_at", "_tail", F.desc_nulls_last("doc_id"), "_hash")
    return ordered.mapInArrow(stream, RESULT)
