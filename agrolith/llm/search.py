"""Ranked lexical search on a two-level quantised index (operator 13).

**Index.** Documents are gathered into blocks of about ``BLOCK`` bytes of text; a row of the index is a block: its
documents and their lengths, its terms, and for each term the documents that hold it (two bytes each). The second level has how often
they hold it; the first has one byte instead, the *impact*. A term that occurs tf times in a document of measure m adds
w * r to a score, where r = 10^9 tf div (1000 tf + 20 m) < 10^6 and w is the term's weight. The impact is r in steps of
``STEP``, rounded up, so w * STEP * impact is never below w * r, and w * STEP * (impact - 1) never over it.

**Search.** For a block of queries each task adds up the bytes of its blocks and keeps the k best lower bounds of each
query; their merger gives the k-th lower bound of all documents. A second pass adds up the bytes again and rescores in
whole numbers, from the second level, every document whose upper bound reaches that; a block without one is passed over.
Each task hands on its k best of each query. Nothing is left out: what is not rescored has k documents above it.

Queries are taken in blocks of at most ``QUERIES`` items or ``QUERY_BYTES`` of text (one item alone may have more), which
bounds what is sent to tasks; numbers of documents, terms and frequencies are counted over all documents.

Defined results: null texts have no terms. Documents of equal score go by rising ``doc_id``, null ids last; rows that
repeat an id are documents of their own and have ranks of their own. Each row of the queries is an item; items without
terms, and all items where no document has terms, get no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.llm.common import column, materialise
from agrolith.session import ship

K = 50
BLOCK = 1 << 19
DOCS = 1 << 16
STEP = 4000
QUERIES = 512
QUERY_BYTES = 4 << 20
#: Parts in which the best of many tasks are merged before they meet.
PARTS = 64
#: What is no part of a term becomes a blank, A-Z become a-z; all bytes of other characters stay.
_TERMS = bytes(c if c >= 0x80 or re.match(rb"[0-9a-z]", bytes([c])) else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

INDEX = "doc_ids array<bigint>, lengths binary, terms binary, ends binary, docs binary, counts binary, wide int, impacts binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return (text or b"").translate(_TERMS).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def measure(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """m of documents of these lengths, among n documents with terms that have so many terms in all."""
    return 50 + (50 * lengths * n) // max(total, 1)


def rates(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """r of terms that occur so often in documents of measure m."""
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _block(ids: list, texts: list[bytes | None], n: int, total: int) -> pa.RecordBatch:
    """One row of the index."""
    known: dict[bytes, int] = {}
    place, counts, lengths, kinds = [], [], [], []
    for t in texts:
        own = Counter(terms_of(t))
        place.extend([known.setdefault(x, len(known)) for x in own])
        counts.extend(own.values())
        lengths.append(own.total())
        kinds.append(len(own))
    place, counts, lengths = np.array(place, np.int64), np.array(counts, np.int64), np.array(lengths, np.int64)
    order = np.argsort(place, kind="stable")
    docs, counts = np.repeat(np.arange(len(ids)), kinds)[order].astype("<u2"), counts[order]
    impacts = -(-rates(counts, measure(lengths, n, total)[docs]) // STEP)
    wide = np.min_scalar_type(counts.max(initial=0)).itemsize
    ends = np.cumsum(np.bincount(place, minlength=len(known))).astype("<i4")
    cells = [ids, lengths.astype("<i8").tobytes(), b" ".join(known), ends.tobytes(), docs.tobytes(), counts.astype(f"<u{wide}").tobytes(), wide, impacts.astype(np.uint8).tobytes()]
    kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])


def build(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """The index as a table in the shared folder, the number of documents with terms, and of all their terms."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def count(batches):
        n = total = 0
        for b in batches:
            for t in column(b, "text").cast(pa.binary()):
                own = len(terms_of(t.as_py()))
                n, total = n + (own > 0), total + own
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])

    n, total = (x or 0 for x in rows.select("text").mapInArrow(count, "n long, total long").agg(F.sum("n"), F.sum("total")).first())

    def gather(batches):
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(column(b, "doc_id").to_pylist(), column(b, "text").cast(pa.binary()), strict=True):
                ids.append(i)
                texts.append(t.as_py())
                size += len(texts[-1] or b"")
                if size >= block or len(ids) == DOCS:
                    yield _block(ids, texts, n, total)
                    ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts, n, total)

    return materialise(rows.mapInArrow(gather, INDEX), "index"), n, total


def _found(terms: bytes, ends: bytes, wanted: dict[bytes, int]):
    """Of the terms of a block those that are wanted: number of the term, first and end of its documents."""
    stop = np.frombuffer(ends, "<i4")
    for i, t in enumerate(terms.split()):
        if (k := wanted.get(t)) is not None:
            yield k, int(stop[i - 1]) if i else 0, int(stop[i])


def frequencies(index: DataFrame, wanted: dict[bytes, int]) -> dict[int, int]:
    """In how many documents each wanted term occurs."""
    sent = index.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for terms, ends in zip(column(b, "terms").to_pylist(), column(b, "ends").to_pylist(), strict=True):
                for k, first, end in _found(terms, ends, sent.value):
                    seen[k] += end - first
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["term", "n"])

    found = index.select("terms", "ends").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in found.collect()}  # terms of one block of queries


class Plan:
    """One block of queries: of each term its weight and the queries that hold it."""

    def __init__(self, texts: list[bytes | None]):
        held = defaultdict(list)
        for q, t in enumerate(texts):
            for x in set(terms_of(t)):
                held[x].append(q)
        self.size, self.terms = len(texts), {t: i for i, t in enumerate(held)}
        self.queries = [np.array(q) for q in held.values()]
        self.weights = np.zeros(len(held), np.int64)

    def weigh(self, n: int, df: dict[int, int]) -> None:
        for i, f in df.items():
            self.weights[i] = weight(n, f)

    def bounds(self, found: list, n_docs: int, docs: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of queries x documents in steps, and what the lower ones lie below them."""
        upper, slack = np.zeros((self.size, n_docs), np.int64), np.zeros((self.size, n_docs), np.int64)
        for k, first, end in found:
            at = self.queries[k][:, None], docs[first:end]
            upper[at] += self.weights[k] * impacts[first:end]
            slack[at] += self.weights[k]
        return upper, slack


def _rows(b: pa.RecordBatch, plan: Plan):
    """The blocks of a batch that hold any term of the queries, with the bounds of their documents."""
    for i in range(b.num_rows):
        cell = lambda c: column(b, c)[i].as_py()  # noqa: E731, B023
        found = [x for x in _found(cell("terms"), cell("ends"), plan.terms) if plan.weights[x[0]] > 0]
        if found:
            docs = np.frombuffer(cell("docs"), "<u2")
            yield cell, found, docs, *plan.bounds(found, cell("size"), docs, np.frombuffer(cell("impacts"), np.uint8).astype(np.int64))


def _best(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group, merged in parts first."""
    parts = df.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    for keys in ([group, "part"], [group]):
        parts = parts.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)
    return parts.drop("part")


def _thresholds(index: DataFrame, plan: Plan, k: int) -> np.ndarray:
    """The k-th lower bound of each query in steps; 0 where fewer documents have one above 0."""
    sent = index.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        best = np.zeros((plan.size, k), np.int64)
        for b in batches:
            for *_, upper, slack in _rows(b, sent.value):
                both = np.concatenate([best, upper - slack], axis=1)
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        q, at = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(best[q, at])], names=["query", "low"])

    low = index.select(F.size("doc_ids").alias("size"), "terms", "ends", "docs", "impacts").mapInArrow(run, "query int, low long")
    out = np.zeros(plan.size, np.int64)
    for r in _best(low, "query", [F.desc("low")], k).where(F.col("place") == k).collect():  # one a query
        out[r.query] = r.low
    return out


def _top(query: np.ndarray, doc: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """Of each query the k best by score, then by id, nulls last."""
    order = np.lexsort((doc, ~known, -score, query))
    q = query[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    kept = order[place < k]
    return query[kept], doc[kept], known[kept], score[kept]


RESULT = "query int, doc_id long, score long"


def _rescored(index: DataFrame, plan: Plan, least: np.ndarray, k: int, n: int, total: int) -> DataFrame:
    """Each task's ``k`` best of each query, by whole numbers, among all documents whose upper bound reaches ``least``."""
    sent = index.sparkSession.sparkContext.broadcast((plan, least))

    def run(batches):
        plan, least = sent.value
        held = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        for b in batches:
            for cell, found, docs, upper, _ in _rows(b, plan):
                wanted = (upper > 0) & (upper >= least[:, None])
                some = wanted.any(axis=0)
                if not some.any():
                    continue
                counts = np.frombuffer(cell("counts"), f"<u{cell('wide')}").astype(np.int64)
                m, score = measure(np.frombuffer(cell("lengths"), "<i8"), n, total), np.zeros(upper.shape, np.int64)
                for t, first, end in found:
                    own = some[docs[first:end]]
                    d = docs[first:end][own]
                    if len(d):
                        score[plan.queries[t][:, None], d] += plan.weights[t] * rates(counts[first:end][own], m[d])
                q, d = np.nonzero(wanted & (score > 0))
                ids = cell("doc_ids")
                known = np.array([x is not None for x in ids])
                number = np.array([x or 0 for x in ids], np.int64)
                held = _top(*(np.concatenate(x) for x in zip(held, (q, number[d], known[d], score[q, d]), strict=True)), k)
        query, doc, known, score = held
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(doc, mask=~known), pa.array(score)], names=["query", "doc_id", "score"])

    return index.select("doc_ids", F.size("doc_ids").alias("size"), "terms", "ends", "docs", "impacts", "lengths", "counts", "wide").mapInArrow(run, RESULT)


def _blocks(queries: DataFrame, most: int, size: int) -> DataFrame:
    """Queries with a ``block``: as many as keep each near half of ``most`` items and of ``size`` bytes, by hash; items over ``size`` are alone in theirs."""
    here = queries.select("item_id", F.col("text").cast("string").alias("text")).withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)))
    here = materialise(here.withColumn("row", F.monotonically_increasing_id()), "queries")
    long = F.col("bytes") > size
    n, total = here.where(~long).agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    blocks = max(1, -(-2 * n // most) if n > most else 1, -(-2 * total // size) if total > size else 1)
    return here.withColumn("block", F.when(long, F.col("row") + blocks).otherwise(F.pmod(F.xxhash64("row"), F.lit(blocks))))


def search(docs: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, most: int = QUERIES) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each row of ``queries`` (``item_id, text``) the ``k`` best of all ``docs``."""
    index, n, total = build(docs, block)
    return ranked(index, n, total, queries, k, most)


def ranked(index: DataFrame, n: int, total: int, queries: DataFrame, k: int = K, most: int = QUERIES) -> DataFrame:
    """``search`` on an index that was built before."""
    asked, out = _blocks(queries, most, QUERY_BYTES), None
    for number in sorted(r.block for r in asked.select("block").distinct().collect()):
        own = asked.where(F.col("block") == number)
        items = own.select("row", "text").orderBy("row").collect()  # a block of queries
        plan = Plan([None if r.text is None else r.text.encode() for r in items])
        plan.weigh(n, frequencies(index, plan.terms))
        best = _rescored(index, plan, _thresholds(index, plan, k), k, n, total)
        best = _best(best, "query", [F.desc("score"), F.asc_nulls_last("doc_id")], k)
        names = own.sparkSession.createDataFrame([(q, r.row) for q, r in enumerate(items)], "query int, row long")
        found = best.join(F.broadcast(names), "query").join(own.select("row", "item_id"), "row").select("item_id", F.col("place").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out
