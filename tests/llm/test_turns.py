import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from agrolith.llm import turns as T
from agrolith.llm.queries import op12_turns

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = lambda x: " " if x is None else str(x)
        how = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        out.append(T.BLANK if not bare else T.REPEATED if (role, text) in seen else T.CUT if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def best(rows):
    """By relaxing every node over and over, without a heap or segments: cost, audit and repaired lines."""
    least = {(0, ""): (0, "", ())}
    marks = faults(rows)
    for i in range(len(rows) + 1):
        for _ in range(3):  # turns that are put in: at most two before a path returns to its state
            for s in ["", "s", "u", "a"]:
                if (i, s) in least:
                    cost, audit, lines = least[i, s]
                    for x in set(NEXT[s]) & set("ua"):
                        new = cost + 2, audit + "I", (*lines, f"{T.NAMES[x]}:")
                        least[i, x] = min(least.get((i, x), new), new, key=lambda p: p[:2])
        if i == len(rows):
            break
        (_, _, role, text), fault = rows[i], marks[i]
        for s in ["", "s", "u", "a"]:
            if (i, s) not in least:
                continue
            cost, audit, lines = least[i, s]
            news = [(s, (cost + 3, audit + "D", lines))]
            if fault not in (T.BLANK, T.REPEATED):
                more = cost + (fault == T.CUT)
                if role[:1] and role[:1] in NEXT[s]:
                    news.append((role[:1], (more, audit + "K", (*lines, f"{role}:{text}"))))
                news += [(x, (more + 2, audit + "R", (*lines, f"{T.NAMES[x]}:{text}"))) for x in set(NEXT[s]) & set("ua")]
            for x, new in news:
                least[i + 1, x] = min(least.get((i + 1, x), new), new, key=lambda p: p[:2])
    return min((least[len(rows), s] for s in ("", "a") if (len(rows), s) in least), key=lambda p: p[:2])


def plain(rows, given=None):
    groups = {c: [] for c in (given or {r[0] for r in rows})}
    for r in rows:
        groups[r[0]].append(r)
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        turns, marks, initials = [r[1] for r in own if r[1] is not None], faults(own), [r[2][:1] for r in own]
        cost, audit, lines = best(own)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(marks.count(k) for k in (T.BLANK, T.REPEATED, T.CUT)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark, sf):
    out = op12_turns(spark, sf)
    assert [n for n, _ in out.dtypes] == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert shown(out) == plain(damage(rows), {r[0] for r in rows})


def test_relaxing_against_all_edits():
    """The plain version is held against every sequence of edits, on short conversations."""
    rng = random.Random(1)
    for _ in range(60):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b", "", "c!", "d d?"])) for i in range(rng.randrange(3))]
        marks, found = faults(rows), []
        gap = ["", "u", "a", "ua", "au"]
        for ins in itertools.product(gap, repeat=len(rows) + 1):
            for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
                if any(m in (T.BLANK, T.REPEATED) and e != "D" for m, e in zip(marks, edits, strict=True)):
                    continue
                roles, audit, cost = ins[0], "I" * len(ins[0]), 2 * len(ins[0])
                for r, m, e, more in zip(rows, marks, edits, ins[1:], strict=True):
                    roles += ("" if e == "D" else (r[2][:1] or "?") if e == "K" else e[1]) + more
                    audit += e[0] + "I" * len(more)
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and m == T.CUT) + 2 * len(more)
                if GRAMMAR.fullmatch(roles):
                    found.append((cost, audit))
        assert best(rows)[:2] == min(found)


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
TEXTS = ["One.", "two", "Three! ", " ", "", None, "é?\n", "x" * 30 + "."]


@pytest.mark.parametrize("segment", [1, 3, 512])
def test_random_conversations_and_segments(spark, segment):
    """Whole conversations, and the same cut into short runs that are put together again."""
    rng = random.Random(segment)
    rows = [(c, rng.choice([t, t, t, None, t + 3]), rng.choice(ROLES), rng.choice(TEXTS)) for c in [*range(40), None] for t in range(rng.randrange(25))]
    rows += [(77, t, rng.choice(["user", "user", None]), f"{rng.randrange(200)}.") for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", T.F.lit(1)).repartition(5)
    want = plain(damage(rows), {r[0] for r in rows})
    assert shown(T.report(T.damaged(df), segment=segment)) == want
    assert shown(T.report(T.damaged(df), most=20)) == want


@pytest.mark.parametrize("segment", [2, 512])
def test_repaired_rows(spark, segment):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for c in range(30) for t in range(rng.randrange(9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = defaultdict(list)
    for r in sorted(T.repaired(df, segment).collect(), key=lambda r: (r.conv_id, r.place)):
        own[r.conv_id].append(r)
    told = {r.conv_id: r for r in T.report(df.withColumn("lost", T.F.lit(False)), segment).collect()}
    for c, r in told.items():
        assert GRAMMAR.fullmatch("".join(x.role[0] for x in own[c]))
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own[c]).encode()).hexdigest() == r.repaired_sha256
        assert "".join(x.edit for x in own[c]) == r.audit.replace("D", "")


def test_empty_table_and_wide_turns(spark):
    df = spark.createDataFrame([(1, -(1 << 62) * 2, "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    assert T.report(T.damaged(df.where("false"))).collect() == []
    assert [r.gaps for r in T.report(df.withColumn("lost", T.F.lit(False))).collect()] == [None]
