"""Documents scored by cross-entropy difference (operator 10).

Two bigram models share one vocabulary, the words that the corpus has (A-Z lower-cased): that of the target
(documents labelled good, or any others) and that of the background (all documents). A document's score
is the mean over its words of the loss under the target less that under the background; lower means
nearer to the target. A document's own counts are left out of both models, so none is scored by itself.

Both models smooth by Dirichlet priors: a word after another by its share alone, and that by an even share of the
vocabulary: p(w) = (c(w) + PRIOR_1 / V) / (N + PRIOR_1), p(w | v) = (c(v w) + PRIOR_2 p(w)) / (c(v) + PRIOR_2).

No table of counts is ever held whole. Documents are dealt to blocks of bounded size by a hash of id and text. A block
asks once for each distinct word and pair that it has (``asked``), in a row for each bucket of hashes; a bucket sums what
all blocks have and answers each in its own order (``answered``); the block's documents meet the answers (``score``).
Only three totals come to the driver. Words and pairs are told apart by 32 bits of their hash within a
bucket, and the number of buckets grows with the corpus.

Defined results: a null or empty text has no words and a score of 0. Without target rows the target
model is even over the vocabulary. Repeated rows count and are scored each. Further columns are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import materialise, sendable

PRIOR_1, PRIOR_2 = 1000.0, 20.0
#: Bytes of text in a block, and bytes of text of the corpus for each bucket.
BLOCK, BUCKET = 4 << 20, 8 << 20
_START = xxhash.xxh64_intdigest(b" ", 42)  # no word holds a blank
_MEMORY = 500_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Coder:
    """Texts to codes of their words (even) and pairs (odd), the start of a text included; hashes of words are remembered."""

    def __init__(self, bits: int):
        self.bits, self.known = bits, {}

    def _code(self, hashes: np.ndarray, pair: int) -> np.ndarray:
        """Bucket, then 32 bits, the last of which tells pairs from words."""
        low = hashes & np.uint64(0xFFFFFFFE) | np.uint64(pair)
        return (hashes >> np.uint64(64 - self.bits) << np.uint64(32) | low).astype(np.int64)

    def codes(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The codes of the start and each word, and of each word with what stands before it."""
        own, known = words(text), self.known
        for w in set(own).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 42)
        ids = np.array([_START, *map(known.__getitem__, own)], np.uint64)
        if len(known) > _MEMORY:
            known.clear()
        return self._code(_mixed(ids), 0), self._code(_mixed(ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:]), 1)


def dealt(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, text, good, block`` of every row, and the number of bits of a bucket. ``target``: distinct ``_id``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sendable(target.withColumn("_good", F.lit(True)), target.count()), F.col("doc_id") == F.col("_id"), "left")
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK + 1)).cast("long")
    return known.select("doc_id", "text", F.coalesce("_good", F.lit(False)).alias("good"), block.alias("block")), max(1, (size // BUCKET).bit_length())


def asked(rows: DataFrame, bits: int) -> DataFrame:
    """``bucket, block, codes, n, t``: the distinct words and pairs of a block, and how often it has them in all and in good documents."""
    ints = pa.list_(pa.int32())

    def run(group: pa.Table) -> pa.Table:
        coder = Coder(bits)
        each = [np.concatenate(coder.codes(t)) for t in group["text"].to_pylist()]
        code, place = np.unique(np.concatenate(each), return_inverse=True)
        good = np.repeat(group["good"].to_numpy(), [len(x) for x in each])
        n, t = np.bincount(place, minlength=len(code)), np.bincount(place[good], minlength=len(code))
        bucket = code >> 32
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = pa.array(np.append(starts, len(code)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.uint32).view(np.int32))) for x in (code & 0xFFFFFFFF, n, t)]
        return pa.table([pa.array(bucket[starts]), pa.array(np.full(len(starts), group["block"][0].as_py())), *(x.cast(ints) for x in lists)], names=["bucket", "block", "codes", "n", "t"])

    return rows.groupBy("block").applyInArrow(run, "bucket long, block long, codes array<int>, n array<int>, t array<int>")


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists as one array, and where each list ends."""
    lists = pa.concat_arrays(table[name].chunks) if table[name].num_chunks != 1 else table[name].chunk(0)
    return np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()), dtype=np.int64)


def answered(requests: DataFrame) -> DataFrame:
    """``block, bucket, n, t``: the corpus's counts in the order that the block asked for; in a row with a null block a bucket's
    number of words, and the sums of their counts."""

    def run(group: pa.Table) -> pa.Table:
        codes, ends = _lists(group, "codes")
        code, place = np.unique(codes, return_inverse=True)
        sums = [np.bincount(place, _lists(group, c)[0], len(code)).astype(np.int64) for c in ("n", "t")]
        single = code & 1 == 0
        totals = pa.array([[int(single.sum()), int(sums[0][single].sum())]], pa.list_(pa.int64())), pa.array([[int(sums[1][single].sum())]], pa.list_(pa.int64()))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        n, t = (pa.concat_arrays([pa.ListArray.from_arrays(offsets, pa.array(s[place])), own]) for s, own in zip(sums, totals, strict=True))
        bucket = group["bucket"][0].as_py()
        return pa.table({"block": pa.array([*group["block"].to_pylist(), None], pa.int64()), "bucket": pa.array([bucket] * len(n), pa.int64()), "n": n, "t": t})

    return requests.groupBy("bucket").applyInArrow(run, "block long, bucket long, n array<long>, t array<long>")


def losses(n: np.ndarray, pair: np.ndarray, before: np.ndarray, total: float, vocabulary: float) -> np.ndarray:
    """Bits of each word from the counts of itself, of the pair and of the word before it."""
    alone = (n + PRIOR_1 / vocabulary) / (total + PRIOR_1)
    return -np.log2((pair + PRIOR_2 * alone) / (before + PRIOR_2))


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, target_bits, background_bits, score``. ``target``: ``good``, or distinct ids as ``_id``."""
    rows, bits = dealt(docs, target)
    answers = materialise(answered(asked(rows, bits)), "answers")
    sums = answers.where("block is null").agg(F.sum(F.col("n")[0]), F.sum(F.col("n")[1]), F.sum(F.col("t")[0])).first()
    vocabulary, total, good_total = (float(x or 0) for x in sums)

    def run(group: pa.Table, found: pa.Table) -> pa.Table:
        found, coder = found.sort_by("bucket"), Coder(bits)
        each = [np.concatenate(coder.codes(t)) for t in group["text"].to_pylist()]
        ends = np.cumsum([len(x) for x in each])
        place = np.unique(np.concatenate(each), return_inverse=True)[1].astype(np.int32)  # in the order of the answers
        sizes = [len(x) // 2 for x in each]
        del each
        n, t = (_lists(found, c)[0] for c in "nt")
        out = np.zeros((len(sizes), 2))
        for i, (size, end, good) in enumerate(zip(sizes, ends, group["good"].to_pylist(), strict=True)):
            if not size:
                continue
            one, back, often = np.unique(place[end - 2 * size - 1 : end], return_inverse=True, return_counts=True)
            for k, (counts, all_, left) in enumerate(((t, good_total, good), (n, total, True))):
                c = (counts[one] - left * often)[back]  # of the start and each word, then of each pair
                out[i, k] = losses(c[1 : size + 1], c[size + 1 :], c[:size], all_ - left * (size + 1), vocabulary).mean()
        cols = [group["doc_id"].combine_chunks(), pa.array(sizes, pa.int64()), pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(out[:, 0] - out[:, 1])]
        return pa.table(cols, names=["doc_id", "n_tokens", "target_bits", "background_bits", "score"])

    both = rows.groupBy("block").cogroup(answers.where("block is not null").groupBy("block"))
    return both.applyInArrow(run, "doc_id long, n_tokens long, target_bits double, background_bits double, score double")


def good(labels: DataFrame) -> DataFrame:
    """``_id``: the documents that any label gives quality 1."""
    return labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct()
