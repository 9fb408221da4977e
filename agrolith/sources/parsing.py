"""Bytes of one logger export to rows of cells: encodings, ragged CSV, xlsx, headers, the time column.

These are small helpers over one file; Spark reads the files and spreads them over tasks. Sheets of workbooks are read as
events, a row at a time, twice: for what the columns are, and for the cells. What is held of a workbook is its compressed bytes, its
shared strings as one block of bytes, and the first rows of a sheet.
"""

from __future__ import annotations

import io
import re
import zipfile
from array import array
from collections import Counter
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import lru_cache, partial
from itertools import islice
from xml.etree import ElementTree

from agrolith.functions import names
from agrolith.functions.expressions import ERROR_TOKENS, MISSING_TOKENS, NUMBER, SERIAL_PATTERNS

ENCODINGS = ("utf-8-sig", "cp949", "euc-kr", "utf-16", "latin1")
# Words that name a time column.
TIME_NAMES = ("timestamp", "datetime", "date time", "date_time", "date", "time", "일시", "날짜", "시각", "시간", "측정시간", "수집시간")
# How dates and times are written in exports.
_DATE = re.compile(r"\d{4}[-/.]\s?\d{1,2}[-/.]\s?\d{1,2}|\d{1,2}[-/.]\s?\d{1,2}[-/.]\s?\d{2,4}|\d{1,4}년\s?\d{1,2}월\s?\d{1,2}일")
_TIME = re.compile(r"\d{1,2}:\d{2}|\d{1,2}시\s?\d{1,2}분")
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def decoded(data: bytes) -> str:
    for e in ENCODINGS:
        if e == "utf-16" and data[:2] not in (b"\xff\xfe", b"\xfe\xff"):
            continue
        try:
            return data.decode(e)
        except UnicodeDecodeError:
            continue
    return data.decode("latin1")


def separator(lines: list[str]) -> str:
    """The delimiter that most of the first lines agree on."""
    votes: Counter = Counter()
    for x in lines[:30]:
        best = max(",;\t|", key=x.count)
        votes[best] += x.count(best) > 0
    return votes.most_common(1)[0][0] if votes else ","


def ragged(text: str, sep: str | None = None) -> list[list[str]]:
    """Rows of a delimited text, padded to the widest; the delimiter is the one that most first lines agree on."""
    import csv

    lines = [x for x in text.splitlines() if x.strip()]
    rows = list(csv.reader(lines, delimiter=sep or separator(lines)))
    width = max(map(len, rows), default=0)
    return [[c.strip() for c in r] + [""] * (width - len(r)) for r in rows]


@lru_cache(maxsize=1000)
def _place(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n - 1


def _column(ref: str) -> int:
    return _place(ref.rstrip("0123456789"))


def _events(file, tag: str) -> Iterator:
    """Elements of that name as they end, each let go before the next."""
    open_: list = []
    for event, x in ElementTree.iterparse(file, events=("start", "end")):
        if event == "start":
            open_.append(x)
            continue
        open_.pop()
        if x.tag == tag:
            yield x
            open_[-1].remove(x)  # the first that is left


class Strings:
    """Shared strings as one block of bytes with the end of each."""

    def __init__(self, file=None):
        block, self.ends = io.BytesIO(), array("Q", [0])
        for x in _events(file, f"{_MAIN}si") if file else ():
            block.write("".join(t.text or "" for t in x.iter(f"{_MAIN}t")).encode())
            self.ends.append(block.tell())
        self.block = memoryview(block.getvalue())

    def __getitem__(self, i: int) -> str:
        return str(self.block[self.ends[i] : self.ends[i + 1]], "utf-8")


class Workbook:
    """The sheets of an xlsx file; cells as text, dates as ISO text."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        inside = set(self.zip.namelist())
        read = lambda n: ElementTree.fromstring(self.zip.read(n))
        self.strings = Strings(self.zip.open("xl/sharedStrings.xml") if "xl/sharedStrings.xml" in inside else None)
        self.dates = _date_styles(read("xl/styles.xml")) if "xl/styles.xml" in inside else set()
        targets = {r.get("Id"): r.get("Target").lstrip("/") for r in read("xl/_rels/workbook.xml.rels")}
        place = {s.get("name"): targets[s.get(f"{_REL}id")] for s in read("xl/workbook.xml").iter(f"{_MAIN}sheet")}
        self.sheets = {n: t if t.startswith("xl/") else f"xl/{t}" for n, t in place.items()}

    def rows(self, sheet: str) -> Iterator[list[str]]:
        """Rows with any text, each as long as its last cell."""
        with self.zip.open(self.sheets[sheet]) as file:
            for row in _events(file, f"{_MAIN}row"):
                cells: dict[int, str] = {}
                for i, c in enumerate(row.iter(f"{_MAIN}c")):
                    cells[_column(c.get("r")) if c.get("r") else i] = self._text(c).strip()
                if any(cells.values()):
                    yield [cells.get(i, "") for i in range(max(cells) + 1)]

    def _text(self, c) -> str:
        v, kind = c.find(f"{_MAIN}v"), c.get("t")
        text = "" if v is None else v.text or ""
        if kind == "s" and text:
            return self.strings[int(text)]
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        if text and kind in (None, "n") and int(c.get("s", 0)) in self.dates:
            return (datetime(1899, 12, 30) + timedelta(microseconds=round(float(text) * 86400 * 1000) * 1000)).isoformat(sep=" ", timespec="seconds")
        return text


def _date_styles(styles) -> set[int]:
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_MAIN}numFmt")}
    cells = styles.find(f"{_MAIN}cellXfs")
    is_date = lambda i: 14 <= i <= 22 or 45 <= i <= 47 or bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(i, "")).lower()))
    return {k for k, x in enumerate(cells if cells is not None else []) if is_date(int(x.get("numFmtId", 0)))}


def header_row(rows: list[list[str]], most: int = 20) -> int:
    """The first row with a cell that is a time column's name, else the first with one that holds such a name, else 0."""
    for test in (lambda c: c in TIME_NAMES, lambda c: any(k in c for k in ("timestamp", "date", "time", "일시", "날짜", "시각"))):
        for i, r in enumerate(rows[:most]):
            if any(test(c.strip().lower()) for c in r) and sum(bool(c) for c in r) > 1:
                return i
    return 0


def column_names(rows: list[list[str]], at: int) -> list[str]:
    """Names that are all different: blank ones by place, with a port's number before them, repeated ones with ``.n`` behind."""
    ports = rows[at - 2] if at >= 2 else []
    out, seen = [], Counter()
    for i, c in enumerate(rows[at]):
        name = c.strip() or f"Unnamed_{i}"
        port = ports[i].strip() if i < len(ports) else ""
        if re.fullmatch(r"(?i)port\s*\d+", port):
            name = f"{port.replace(' ', '')} {name}"
        n, seen[name] = seen[name], seen[name] + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def serial_in(rows: list[list[str]], filename: str, sheet: bool) -> str | None:
    text = "\n".join(" ".join(r) for r in rows[:3])
    for p in SERIAL_PATTERNS:
        if m := re.search(p, text):
            return m.group(1).strip()
    first = rows[0][0].strip() if sheet and rows and rows[0] else ""
    if first and len(first) <= 24 and " " not in first and sum(c.isdigit() for c in first) >= 4:
        return first
    return names.serial_of_file(filename)


def _shares(cells: list[str]) -> tuple[float, float]:
    known = [c for c in cells if c][:300]
    n = max(len(known), 1)
    return sum(bool(_DATE.search(c)) for c in known) / n, sum(bool(_TIME.search(c)) for c in known) / n


def time_columns(columns: list[str], rows: list[list[str]]) -> tuple[int, ...] | None:
    """The column of full time stamps, or those of date and of time, or None."""
    shares = [_shares([r[i] for r in rows[:400]]) for i in range(len(columns))]
    dates = [i for i, (d, t) in enumerate(shares) if d > 0.8 and t < 0.3]
    times = [i for i, (d, t) in enumerate(shares) if t > 0.8 and d < 0.3]
    score = lambda i: sum(shares[i]) + 0.3 * any(k in columns[i].lower() for k in TIME_NAMES) - (shares[i][0] < 0.5)
    best = max(range(len(columns)), key=score, default=None)
    if dates and times and (best is None or min(shares[best]) < 0.5):
        return dates[0], times[0]
    return (best,) if best is not None and score(best) > 0 else None


def _numeric(c: str) -> bool:
    low = c.lower()
    return low not in MISSING_TOKENS and low not in ERROR_TOKENS and bool(re.match(NUMBER, c))


#: Rows in which the header, the logger's name and the time column are looked for.
HEAD = 440


def cells_of(data: bytes, filename: str, overrides: dict[str, str] | None = None):
    """``sheet, serial, model, row, ts_raw, source, channel, base_var, rep, raw`` of every cell with a channel, row by row."""
    if re.search(r"(?i)\.(csv|txt|tsv)$", filename):
        lines = ragged(decoded(data), "\t" if filename.lower().endswith(".tsv") else None)
        tables = {"": lambda: iter(lines)}
    else:
        book = Workbook(data)
        tables = {n: partial(book.rows, n) for n in names.sheets(list(book.sheets))}
    for sheet, rows in tables.items():
        head = list(islice(rows(), HEAD))
        if not head:
            continue
        at, width, numbers = header_row(head), 0, set()
        for n, r in enumerate(rows()):
            width = max(width, len(r))
            if n > at:
                numbers.update(i for i, c in enumerate(r) if i not in numbers and _numeric(c))
        wide = lambda r: r + [""] * (width - len(r))  # noqa: E731, B023
        head = list(map(wide, head))
        columns = column_names(head, at)
        when = time_columns(columns, head[at + 1 :])
        if when is None:
            raise ValueError(f"{filename}: no time column found")
        serial, model = serial_in(head, filename, bool(sheet)), names.model_of([*columns, *head[0]])
        usable = {c: i in numbers for i, c in enumerate(columns) if i not in when}
        place = {c: i for i, c in enumerate(columns)}
        found = [(place[ch["source"]], (ch["source"], ch["channel"], ch["base_var"], ch["rep"])) for ch in names.channels(columns, usable, overrides, tuple(columns[i] for i in when))]
        for n, r in enumerate(islice(rows(), at + 1, None)):
            r = wide(r)
            ts = " ".join(r[w] for w in when)
            for i, told in found:
                yield sheet, serial, model, n, ts, *told, r[i]
