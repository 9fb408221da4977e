"""Repair of the structure of conversations by a shortest path (operator 12).

A repaired conversation has roles whose initials are ``(s?(ua)+)?``. Rows are kept (0), given another role (2), deleted
(3; blank and repeated rows must be), and turns without text are put in (2); a row that ends without ``.``, ``!`` or
``?`` and is not deleted adds 1. The lattice of edits has a node for each number of rows that are dealt with and each
state of the grammar; it is never laid out. Dijkstra's search takes nodes by (cost, audit), the audit being the initials
of the edits so far, and stops at the first end node that it takes and the grammar accepts: the cheapest repair, and of
equal ones that with the least audit. An audit fixes the repair, as roles alternate.

Sizes. A conversation of at most ``SEGMENT`` rows and ``BYTES`` of text is repaired where it lies, one after the other in
its task. A longer one may hold a third of all rows, so its rows (without texts) are ordered by ranges over all tasks;
each run of ``SEGMENT`` rows is searched from each state of the grammar to each other, and the runs' results, a few
hundred bytes for each, are put together in order. No audit is a proper beginning of another between the same two nodes
at equal cost, so the least audits of runs make the least of all. Its repaired rows are then read in order with their
audit, a row at a time; the hash of a conversation's repaired text is sequential by its nature. Repetitions in long
conversations are found by a grouped least row.

Defined results: a role or a text that is null counts as one blank. Rows go by turn, null turns first, then by role
and by the digest of their text. Null ids are one conversation. ``gaps`` is null where the span of turns exceeds 64 bits.
Empty tables give empty ones; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import column, materialise, sendable, spread
from agrolith.session import ship

SEGMENT = 512
BYTES = 32 << 20
BLANK, REPEATED, CUT = 1, 2, 3
#: The grammar: state and initial to state. Nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
ACCEPTS = {START, AFTER_A}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


def paths(rows: list[tuple[str, int]], start: int, ends: set[int], first: bool) -> dict[int, tuple[int, str]]:
    """Cost and audit of the best paths over ``rows`` (initial, fault) from state ``start`` to ``ends``; with ``first`` the first alone."""
    heap, done, found, n = [(0, "", 0, start)], set(), {}, len(rows)
    while heap:
        cost, audit, i, state = heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == n and state in ends:
            found[state] = cost, audit
            if first or len(found) == len(ends):
                break
        turns = [to for x in NAMES if (to := STEPS.get((state, x))) is not None]
        for to in turns:
            heappush(heap, (cost + 2, audit + "I", i, to))
        if i < n:
            initial, fault = rows[i]
            heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if fault not in (BLANK, REPEATED):
                more = cost + (fault == CUT)
                if (to := STEPS.get((state, initial))) is not None:
                    heappush(heap, (more, audit + "K", i + 1, to))
                for to in turns:
                    heappush(heap, (more + 2, audit + "R", i + 1, to))
    return found


class Applied:
    """Follows an audit over rows that come one by one."""

    def __init__(self, audit):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._turn("I", None)

    def _turn(self, edit, text):
        x = next(x for x in NAMES if (self.state, x) in STEPS)
        self.state = STEPS[self.state, x]
        return edit, NAMES[x], text or ""

    def row(self, role: str, text: str):
        """The repaired rows (edit, role, text) up to and with this one."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._turn("R", text)
        elif edit == "K":
            self.state = STEPS[self.state, role[:1]]
            yield "K", role, text


class Chain:
    """Paths from the start of a conversation to each state, run by run.

    Audits are not kept whole to compare them: for two states, what follows their common beginning decides, and its
    first characters are enough once they differ.
    """

    def __init__(self):
        self.cost, self.behind, self.rest = {START: 0}, [], {}

    def _rest(self, p: int, q: int) -> tuple[str, str]:
        return ("", "") if p == q else self.rest[p, q]

    def _joined(self, p: int, a: str, q: int, b: str) -> tuple[str, str]:
        """What differs between the audits of ``p`` with ``a`` and of ``q`` with ``b``."""
        x, y = self._rest(p, q)
        if not (x and y):
            x, y = x + a, y + b
            n = len(commonprefix([x, y]))
            x, y = x[n:], y[n:]
        return (x[:1], y[:1]) if x and y else (x, y)

    def _less(self, one, other) -> bool:
        if one[0] != other[0]:
            return one[0] < other[0]
        x, y = self._joined(one[1], one[2], other[1], other[2])
        return x < y

    def add(self, matrix: dict[tuple[int, int], tuple[int, str]]) -> None:
        """``matrix``: state and state to cost and audit of the next run."""
        best = {}
        for (p, e), (cost, audit) in matrix.items():
            if p in self.cost and (e not in best or self._less((self.cost[p] + cost, p, audit), best[e])):
                best[e] = self.cost[p] + cost, p, audit
        self.rest = {(x, y): self._joined(best[x][1], best[x][2], best[y][1], best[y][2]) for x in best for y in best if x != y}
        self.cost = {e: b[0] for e, b in best.items()}
        self.behind.append({e: b[1:] for e, b in best.items()})

    def result(self) -> tuple[int, list[str]]:
        """The cost, and the audit of each run."""
        ends = [(self.cost[e], e, "") for e in ACCEPTS if e in self.cost]
        end = ends[0]
        for x in ends[1:]:
            end = x if self._less(x, end) else end
        state, audits = end[1], []
        for step in reversed(self.behind):
            state, audit = step[state]
            audits.append(audit)
        return end[0], audits[::-1]


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def _out(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64())}
    names = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[t]) for c, (_, t) in zip(cols, names, strict=True)], names=[n for n, _ in names])


def _groups(batches, names: list[str]):
    """Rows of a sorted partition by their first column."""

    def each():
        for b in batches:
            yield from zip(*(column(b, n).to_pylist() for n in names), strict=True)

    return groupby(each(), key=lambda r: r[0])


def _sent(rows, schema: str, size: int = 1000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _out(held, schema)
            held = []
    yield _out(held, schema)


def with_faults(rows: DataFrame) -> DataFrame:
    """``key, turn, role, text, digest, initial, fault`` of rows; repetitions are not known yet."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    end = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), CUT).otherwise(0)
    known = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return known.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


#: The order of a conversation's rows, nulls first.
ORDER = ["turn", "role", "digest"]
FOUND = "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED = "key string, place long, edit string, role string, text string"


def _whole(rows):
    """Initials and faults, in order, of the rows of a conversation."""
    seen, out = set(), []
    for _, _, role, _, digest, initial, fault in rows:
        again = (role, digest) in seen
        seen.add((role, digest))
        out.append((initial, fault if fault == BLANK or not again else REPEATED))
    return out


def short(rows: DataFrame, texts: bool = False) -> DataFrame:
    """Conversations that fit into a task: ``FOUND``, with ``texts`` the repaired rows, ``REPAIRED``."""

    def run(batches):
        for key, own in _groups(batches, ["key", "turn", "role", "text", "digest", "initial", "fault"]):
            own = list(own)
            marked = _whole(own)
            cost, audit = next(iter(paths(marked, START, ACCEPTS, True).values()))
            walk = Applied(audit)
            lines = [x for r in own for x in walk.row(r[2], r[3])] + list(walk.inserted())
            if texts:
                yield from ((key, i, *x) for i, x in enumerate(lines))
            else:
                n = [sum(f == k for _, f in marked) for k in (BLANK, REPEATED, CUT)]
                whole = "\n".join(f"{role}:{text}" for _, role, text in lines)
                yield key, *n, _illegal([x for x, _ in marked]), cost, audit, hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()

    schema = REPAIRED if texts else FOUND
    ordered = rows.repartition("key").sortWithinPartitions("key", *ORDER)
    return ordered.mapInArrow(lambda batches: _sent(run(batches), schema), schema)


PIECE = "key string, part int, seq int, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<bigint>, audits array<string>"
AUDIT = "key string, part int, seq int, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _pieces(batches, segment: int):
    """Runs of the long conversations of a range: their counts, and the paths between all states."""
    part = TaskContext.get().partitionId()
    for key, own in _groups(batches, ["key", "initial", "fault"]):
        own, seq = [(x, f) for _, x, f in own], 0
        for seq, at in enumerate(range(0, len(own), segment)):
            rows = own[at : at + segment]
            found = [paths(rows, s, set(range(4)), False) for s in range(4)]
            best = [found[s].get(e) for s in range(4) for e in range(4)]
            n = [sum(f == k for _, f in rows) for k in (BLANK, REPEATED, CUT)]
            yield key, part, seq, *n, _illegal([x for x, _ in rows]), rows[0][0], rows[-1][0], [x[0] if x else -1 for x in best], [x[1] if x else None for x in best]


def _chained(batches):
    for key, own in _groups(batches, [x.split()[0] for x in PIECE.split(", ")]):
        chain, told, last = Chain(), [], None
        for _, part, seq, blank, again, cut, illegal, first, end, costs, audits in own:
            between = int(last is not None and last + first not in LEGAL)
            chain.add({(k // 4, k % 4): (c, a) for k, (c, a) in enumerate(zip(costs, audits, strict=True)) if c >= 0})
            told.append((key, part, seq, blank, again, cut, illegal + between))
            last = end
        cost, audits = chain.result()
        for i, (t, a) in enumerate(zip(told, audits, strict=True)):
            yield *t, cost if i == 0 else 0, a


def _followed(batches, texts: bool):
    """Rows of long conversations in order, each conversation after the runs of its audit."""
    for key, own in _groups(batches, ["key", "audit", "role", "text"]):
        audit, walk, digest, place = [], None, hashlib.sha256(), 0

        def told(lines):
            nonlocal place
            for edit, role, text in lines:
                if texts:
                    yield key, place, edit, role, text  # noqa: B023
                else:
                    digest.update((("\n" if place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))  # noqa: B023
                place += 1

        for _, run, role, text in own:
            if run is not None:
                audit.append(run)
                continue
            walk = walk or Applied("".join(audit))
            yield from told(walk.row(role, text))
        yield from told((walk or Applied("".join(audit))).inserted())
        if not texts:
            yield key, digest.hexdigest()


def long(rows: DataFrame, segment: int = SEGMENT, texts: bool = False) -> DataFrame:
    """Conversations of any length: ``FOUND``, with ``texts`` the repaired rows, ``REPAIRED``."""
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "long")
    same = ["key", "role", "digest"]
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), F.col("row").alias("row"))
    first = rows.groupBy(*same).agg(F.min(at)["row"].alias("first"))
    narrow = spread(rows.select("key", "turn", "role", "digest", "row", "initial", "fault"), first, same)
    fault = F.when((F.col("fault") != BLANK) & (F.col("row") != F.col("first")), REPEATED).otherwise(F.col("fault"))
    order = ["key", *ORDER, "row"]
    marked = materialise(narrow.withColumn("fault", fault).drop("first"), "marked")
    n = max(1, -(-marked.count() // (100 * segment)))
    ranged = marked.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pieces = ranged.select("key", "initial", "fault").mapInArrow(lambda b: _sent(_pieces(b, segment), PIECE, 100), PIECE)
    runs = pieces.repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(lambda b: _sent(_chained(b), AUDIT), AUDIT)
    runs = materialise(runs, "runs")
    nothing = lambda names: [F.lit(None).cast(t).alias(c) for c, t in names.items()]
    ahead = runs.select("key", F.lit(0).alias("kind"), "part", "seq", "audit", *nothing({"turn": "long", "role": "string", "digest": "binary", "row": "long", "text": "string"}))
    behind = rows.select("key", F.lit(1).alias("kind"), *nothing({"part": "int", "seq": "int", "audit": "string"}), "turn", "role", "digest", "row", "text")
    stream = ahead.unionByName(behind).repartition("key").sortWithinPartitions("key", "kind", "part", "seq", *ORDER, "row").select("key", "audit", "role", "text")
    schema = REPAIRED if texts else "key string, repaired_sha256 string"
    out = stream.mapInArrow(lambda b: _sent(_followed(b, texts), schema), schema)
    if texts:
        return out
    runs_in_order = F.array_sort(F.collect_list(F.struct("part", "seq", "audit")))  # one cell of the result
    counts = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    total = runs.groupBy("key").agg(*counts, F.array_join(F.transform(runs_in_order, lambda x: x["audit"]), "").alias("audit"))
    return total.join(out, "key").select([x.split()[0] for x in FOUND.split(", ")])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, lost`` after the damage of the exercise; rows that it drops are marked and stay."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("how"))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("how") == 0).alias("lost"), times.alias("copy")).drop("copy")


def _measured(rows: DataFrame, segment: int, most: int) -> DataFrame:
    """A row for each conversation: ``key, conv_id, gaps, rows, long``. ``rows``: with ``lost``."""
    there = lambda c: F.when(~F.col("lost"), c)
    turn = there(F.col("turn").cast("long"))
    sizes = [F.count(there(F.lit(1))).alias("rows"), F.sum(there(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)))).alias("bytes")]
    per = rows.groupBy("conv_id").agg(*sizes, F.min(turn).alias("low"), F.max(turn).alias("high"), F.count_distinct(turn).alias("n"))
    gaps = F.when(F.col("n") == 0, F.lit(0).cast("long")).otherwise(F.try_subtract(F.try_add(F.try_subtract("high", "low"), F.lit(1)), F.col("n")))
    big = (F.col("rows") > segment) | (F.coalesce("bytes", F.lit(0)) > most)
    return per.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", gaps.alias("gaps"), "rows", big.alias("long"))


def _both(rows: DataFrame, per: DataFrame, segment: int, texts: bool) -> DataFrame:
    """Short conversations and long ones, each by its way."""
    marked, many = with_faults(rows.where("not lost")), per.where("long").select("key")
    n = many.count()
    if not n:
        return short(marked, texts)
    here = sendable(many, n)
    return short(marked.join(here, "key", "left_anti"), texts).unionByName(long(marked.join(here, "key", "left_semi"), segment, texts))


def report(rows: DataFrame, segment: int = SEGMENT, most: int = BYTES) -> DataFrame:
    """For each conversation its faults, the cost and audit of its repair, and the hash of the repaired text. ``rows``: as of ``damaged``."""
    ship(rows.sparkSession)
    per = materialise(_measured(rows, segment, most), "conversations")
    found = _both(rows, per, segment, False)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    nothing = hashlib.sha256(b"").hexdigest()
    none = F.col("rows") == 0
    out = per.join(found, "key", "left")
    return out.select("conv_id", F.when(none, F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps"), zero("blank"), zero("duplicate"), zero("truncated"), zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def repaired(conversations: DataFrame, segment: int = SEGMENT, most: int = BYTES) -> DataFrame:
    """The repaired rows: ``conv_id, place`` (from 0), ``edit`` (K, R or I), ``role, text``."""
    ship(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text", F.lit(False).alias("lost"))
    per = materialise(_measured(rows, segment, most), "conversations")
    return _both(rows, per, segment, True).join(per.select("key", "conv_id"), "key").select("conv_id", "place", "edit", "role", "text")
