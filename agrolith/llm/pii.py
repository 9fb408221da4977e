"""Personal data behind disguises, found with offsets into the source text (operator 3).

Base spans come from patterns over the source text itself. Then a chain of transducers rewrites
the text: look-alike letters and digits, spelled digits ("plus four nine ..."), and the at/dot
disguises ("name (at) host dot org"). Each transducer keeps, for every character that it writes,
the source span that it stands for, and the chain composes them; the same detectors run over the
rewritten text, and what they find is mapped back to source characters. An address whose "at" is a word and whose dots are
signs ("look at host.se") is taken for one with a known ending alone; where a dot is a word too, with any, unless a word like "the" stands before it. Spans that meet a base
span of their kind add nothing. Base spans are never changed.

All scans are linear in the text: an e-mail is looked for around each ``@`` and an address from the
start of a run of digits, so no run of characters is walked again and again.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows and ids are
kept; an empty table gives an empty result; further columns are passed over by ``detect`` and kept by ``redact``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolith.llm.common import column, text_column
from agrolith.session import ship

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# Characters that look like Latin letters or the signs of an identifier.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "ρ": "p", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
}
# Names of digits and of signs.
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "plus": "+", "dot": ".", "point": ".", "dash": "-", "hyphen": "-"}
# Endings that make "x at y.z" an address and not a sentence; after a written "dot" any letters are an ending.
ENDINGS = "com|org|net|edu|gov|info|biz|io|co|ai|dev|app|eu|uk|us|de|fr|es|it|nl|ch|at|be|pt|pl|kr|jp|cn|in|br|mx|ca|au|ru"
# Words before a noun, so that "look at the dot on it" is a sentence.
DETERMINERS = "the|a|an|this|that|each|every|any|some|no|one|my|your|his|her|its|our|their"
INVISIBLE = "­​‌‍⁠﻿"

_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_digit = "zero|one|two|three|four|five|six|seven|eight|nine"
_spelled = re.compile(rf"(?<![A-Za-z])(?:plus[ -]+)?(?:{_digit})(?:[ ,.-]+(?:dot[ ]+|point[ ]+|dash[ ]+|hyphen[ ]+)?(?:{_digit}))+(?![A-Za-z])", re.I)
_word = re.compile(r"[A-Za-z]+")
_bracketed = re.compile(r"[(\[{<]\s*(at|dot|@|\.)\s*[)\]}>]", re.I)
_asked = re.compile(r"@|\sat\s", re.I)
_chain = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:[.]|\s+dot\s+)[A-Za-z0-9_%+-]++)*+", re.I)
_host = r"(?:\s+at\s+|@)[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*"
_worded = re.compile(rf"(?!\s+at\s+(?:{DETERMINERS})\s){_host}\s+dot\s+(?:[A-Za-z0-9-]+(?:[.]|\s+dot\s+))*[A-Za-z]{{2,24}}(?![A-Za-z0-9-])|{_host}[.](?:{ENDINGS})(?![A-Za-z0-9-])", re.I)
_sign = re.compile(r"\s+(at|dot)\s+", re.I)


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _local:
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    small = lambda x: len(x := x.lstrip("0")) < 4 and int(x or 0) <= 255
    return [m.span() for m in _ip.finditer(text) if all(map(small, m.group().split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _card.finditer(text) if m.end() - m.start() > 12 and luhn(m.group())]


def luhn(shown: str) -> bool:
    digits = [int(x) for x in shown if x not in " -"]
    if not 13 <= len(digits) <= 19:
        return False
    return (sum(digits[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-2::-2])) % 10 == 0


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _phone.finditer(text) if 9 <= sum(x.isdigit() for x in m.group()) <= 15] if "+" in text else []


DETECTORS = (("email", emails), ("ip", addresses), ("card", cards), ("phone", phones))


class Rewritten:
    """A text and, for each of its characters, the span of the source that it stands for.

    Only changed places are held: from the place ``at[i]`` of the new text on, characters
    stand one by one for source characters from ``source[i]`` on, or all for one span (``end[i]`` set).
    """

    def __init__(self, text: str):
        self.text, self.at, self.source, self.end = text, [0], [0], [-1]

    def _run(self, i: int) -> tuple[int, int]:
        k = bisect_left(self.at, i + 1) - 1
        return (self.source[k], self.end[k]) if self.end[k] >= 0 else (self.source[k] + i - self.at[k], self.source[k] + i - self.at[k] + 1)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._run(start)[0], self._run(end - 1)[1]

    def edit(self, changes: list[tuple[int, int, str]]) -> Rewritten:
        """``changes``: start, end, what stands there instead; in order, apart from each other."""
        if not changes:
            return self
        out, parts, at, done = Rewritten(""), [], 0, 0
        out.at, out.source, out.end = [], [], []

        def keep(a: int, b: int) -> None:
            nonlocal at
            while a < b:  # by the runs that the text so far has
                k = bisect_left(self.at, a + 1) - 1
                to = min(b, self.at[k + 1] if k + 1 < len(self.at) else b)
                s, e = self._run(a)
                out.at.append(at)
                out.source.append(s)
                out.end.append(e if self.end[k] >= 0 else -1)
                parts.append(self.text[a:to])
                at, a = at + to - a, to

        for a, b, new in changes:
            keep(done, a)
            if new:
                s, e = self.span(a, b)
                out.at.append(at)
                out.source.append(s)
                out.end.append(e)
                parts.append(new)
                at += len(new)
            done = b
        keep(done, len(self.text))
        out.text = "".join(parts)
        return out


def _plain(x: str) -> str | None:
    """The Latin character that ``x`` looks like; "" for invisible ones, None for all others."""
    if x in INVISIBLE:
        return ""
    if x in LOOKALIKES:
        return LOOKALIKES[x]
    if "！" <= x <= "～":
        return chr(ord(x) - 0xFEE0)
    return str(unicodedata.digit(x)) if unicodedata.category(x) == "Nd" else None


_known: dict[str, str | None] = {}


def lookalikes(t: Rewritten) -> Rewritten:
    if t.text.isascii():
        return t
    odd = {x for x in set(t.text) if x > "\x7f" and (_known[x] if x in _known else _known.setdefault(x, _plain(x))) is not None}
    if not odd:
        return t
    return t.edit([(m.start(), m.end(), _known[m.group()]) for m in re.finditer("[" + re.escape("".join(sorted(odd))) + "]", t.text)])


def spelled_digits(t: Rewritten) -> Rewritten:
    changes = []
    for run in _spelled.finditer(t.text):
        last = None
        for w in _word.finditer(t.text, run.start(), run.end()):
            sign = SPELLED[w.group().lower()]
            changes.append((w.start() if last is None else last, w.end(), sign))  # what stands between two goes
            last = w.end()
    return t.edit(changes)


def at_and_dot(t: Rewritten) -> Rewritten:
    say, changes, done, text = {"at": "@", "dot": "."}, [], 0, t.text
    for m in _bracketed.finditer(text):
        a, b = m.span()
        while a > done and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        changes.append((a, b, say.get(m[1].lower(), m[1])))
        done = b
    t = t.edit(changes)
    if not _asked.search(t.text):
        return t
    changes, done = [], 0
    for local in _chain.finditer(t.text):  # each once, whatever follows it, so that long runs of "x dot x" stay linear
        found = _worded.match(t.text, local.end()) if local.start() >= done else None
        if found:
            done = found.end()
            changes += [(m.start(), m.end(), say[m[1].lower()]) for m in _sign.finditer(t.text, local.start(), done)]
    return t.edit(changes)


TRANSDUCERS = (lookalikes, spelled_digits, at_and_dot)


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans and all spans, by kind as in ``KINDS``, then by start."""
    base = [(kind, a, b) for kind, f in DETECTORS for a, b in f(text)]
    t = Rewritten(text)
    for step in TRANSDUCERS:
        t = step(t)
    if t.text == text:
        return base, base
    out = list(base)
    for kind, f in DETECTORS:
        own = [(a, b) for k, a, b in base if k == kind]
        starts = [a for a, _ in own]
        for a, b in f(t.text):
            a, b = t.span(a, b)
            k = bisect_left(starts, b)
            if not (k and own[k - 1][1] > a):
                out.append((kind, a, b))
    return base, sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of kind, start and end (exclusive) in code points."""
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            found = [find(t) for t in text_column(b)]
            both = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[i]] for x in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *both], names=["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, base {SPANS}, spans {SPANS}")


def masked(text: str) -> str:
    """``text`` with each span replaced by its kind in brackets; of spans that meet, the first and longest counts."""
    parts, done = [], 0
    for kind, a, b in sorted(find(text)[1], key=lambda x: (x[1], -x[2])):
        if a < done:
            if b > done:
                done = b
            continue
        parts += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``; a column ``n_chars`` follows the new text. Null texts stay null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(masked, na_action="ignore")

    out = docs.withColumn("text", mask("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
