"""Text exports of loggers as a data source of Spark, ``spark.read.format("logger")`` and ``spark.readStream.format("logger")``.

Unlike ``logger_files``, which takes a file to a row, a file is cut into ranges of bytes (``rangeBytes``), so one export, however long,
is read by many tasks and none holds more than a piece of it. Each task reads the first lines of its file for the header and then its own
range: the lines that begin in it. ``RAW`` has a row for each cell. What needs the whole file (which columns have any number, and so which
channels there are; the one format of its times) is asked of Spark: ``cells`` counts by file and column, combined before the
shuffle, and gives the columns that ``logger_files.cells`` gives.

Options: ``path``, a folder or a pattern; ``rangeBytes``; ``filePattern``, a pattern of file names (csv, txt and tsv by default).
Filters on ``file`` leave files unread (``register`` turns on what Spark needs for that).

Defined results: a line is a row, so quotes do not span lines, and ``row`` is the byte at which it begins. A line is decoded by the first of the
known encodings that fits it; UTF-16 files are not cut. A file without a time column or that cannot be read gives a row with ``problem``
and does not stop the others; empty files give nothing. The stream takes files in order of their time of change and name,
so an export must be moved in whole, and one that keeps a time of change from before the last file taken is passed over: read such by batch.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from agrolith.functions import names
from agrolith.functions.expressions import number
from agrolith.session import ship
from agrolith.sources import parsing

RAW = "path string, file string, serial string, model string, row long, ts_raw string, place int, source string, raw string, problem string"
_SCHEMA = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[x.split()[1]]) for x in RAW.split(", ")])
#: Bytes of a range, of the part of a file in which its first lines are looked for, and of one read.
RANGE, HEAD_BYTES, READ = 32 << 20, 1 << 20, 1 << 20
_TEXTS = re.compile(r"(?i)\.(csv|txt|tsv)$")
_BATCH = 20_000


@dataclass
class Range(InputPartition):
    """The lines of ``path`` that begin at ``start`` or later and before ``end``."""

    path: str
    start: int
    end: int


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def listed(path: str, pattern: str | None = None) -> list[tuple[int, str, int]]:
    """Time of change in nanoseconds, path and size of each export under a folder or of a pattern, in that order."""
    from pyarrow.fs import FileSelector, FileType

    parts = path.rstrip("/").split("/")
    fixed = next((i for i, p in enumerate(parts) if set("*?[") & set(p)), len(parts))
    store, base = _store("/".join(parts[:fixed]) or "/")
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    host = path[len(scheme) :].split("/")[0] if scheme else ""
    info = store.get_file_info(base)
    found = [info] if info.type == FileType.File else store.get_file_info(FileSelector(base, recursive=True, allow_not_found=True))
    wanted = parts[fixed:]
    out = []
    for f in found:
        below = f.path[len(base) :].strip("/").split("/")
        fits = len(below) == len(wanted) and all(map(fnmatch, below, wanted)) if wanted else True
        named = fnmatch(f.base_name, pattern) if pattern else _TEXTS.search(f.base_name)
        hidden = any(b.startswith(("_", ".")) for b in below)
        if f.type == FileType.File and fits and named and not hidden:
            out.append((f.mtime_ns or 0, scheme + (f"{host}/{f.path.lstrip('/')}" if host and not f.path.startswith(host) else f.path), f.size))
    return sorted(out)


def ranges(files: Sequence[tuple[int, str, int]], most: int) -> list[Range]:
    """Files cut into ranges of at most ``most`` bytes."""
    return [Range(p, at, min(at + most, size)) for _, p, size in files for at in range(0, size, most)]


def _decoded(line: bytes) -> str:
    for e in parsing.ENCODINGS:
        if e != "utf-16":
            try:
                return line.decode(e)
            except UnicodeDecodeError:
                continue
    return line.decode("latin1")


def _lines(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Lines that begin in the range, with the byte at which each does. One that began before it is the range's before."""
    at = max(start - 1, 0)
    file.seek(at)
    while start:  # what is left of the line before
        block = file.read(READ)
        stop = block.find(b"\n")
        at += stop + 1 if stop >= 0 else len(block)
        if not block or at >= end:
            return
        if stop >= 0:
            file.seek(at)
            break
    held: list[bytes] = []  # the parts of a line that goes on
    while block := file.read(READ):
        first, *rest = block.split(b"\n")
        held.append(first)
        for p in rest:
            line = b"".join(held)
            yield at, line
            at, held = at + len(line) + 1, [p]
            if at >= end:
                return
    if held := b"".join(held):
        yield at, held


@dataclass
class Header:
    """What the first lines of an export say about all others."""

    separator: str
    columns: list[str]
    when: tuple[int, ...]
    begins: int
    serial: str | None
    model: str

    @classmethod
    def of(cls, head: list[tuple[int, str]], name: str) -> Header | None:
        """From the first lines, each with the byte where it begins; None if there are none."""
        rows = parsing.ragged("\n".join(x for _, x in head), "\t" if name.lower().endswith(".tsv") else None)
        if not rows:
            return None
        separator = "\t" if name.lower().endswith(".tsv") else parsing.separator([x for _, x in head])
        at = parsing.header_row(rows)
        columns = parsing.column_names(rows, at)
        when = parsing.time_columns(columns, rows[at + 1 :])
        if when is None:
            raise ValueError(f"{name}: no time column found")
        return cls(separator, columns, when, head[at][0], parsing.serial_in(rows, name, False), names.model_of([*columns, *rows[0]]))


def _pieces(at: int, line: bytes) -> Iterator[tuple[int, str]]:
    """The lines that are left within one, as by returns alone; blank ones are none."""
    for i, x in enumerate(_decoded(line).splitlines()):
        if x.strip():
            yield at + i, x


def _range_cells(part: Range) -> Iterator[tuple]:
    name = part.path.rsplit("/", 1)[-1]
    store, inside = _store(part.path)
    with store.open_input_file(inside) as file:
        mark = file.read(2)
        if mark in (b"\xff\xfe", b"\xfe\xff"):  # not cut: the first range has it all
            file.seek(0)
            text = file.read().decode("utf-16") if part.start == 0 else ""
            lines = [(i, x) for i, x in enumerate(text.splitlines()) if x.strip()]
            head, own = lines[: parsing.HEAD], iter(lines)
        else:
            head = []
            for at, line in _lines(file, 0, HEAD_BYTES):
                head += _pieces(at, line)
                if len(head) >= parsing.HEAD:
                    break
            head = head[: parsing.HEAD]
            own = (x for at, line in _lines(file, part.start, part.end) for x in _pieces(at, line))
        known = Header.of(head, name)
        if known is None:
            return
        width = len(known.columns)
        for at, text in own:
            if at <= known.begins:
                continue
            cells = [c.strip() for c in next(csv.reader([text], delimiter=known.separator), [])]
            cells += [""] * (width - len(cells))
            ts = " ".join(cells[w] for w in known.when)
            for i, c in enumerate(cells):
                if i not in known.when:
                    yield part.path, name, known.serial, known.model, at, ts, i, known.columns[i] if i < width else f"Unnamed_{i}", c, None


def _batches(part: Range) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    rows: list[tuple] = []
    try:
        for r in _range_cells(part):
            rows.append(r)
            if len(rows) == _BATCH:
                yield batch(rows)
                rows = []
    except (ValueError, UnicodeError, csv.Error) as e:  # the file's own fault, told once; a store that fails fails the task, which Spark tries again
        if part.start == 0:
            rows.append((part.path, part.path.rsplit("/", 1)[-1], *[None] * 7, f"{type(e).__name__}: {e}"[:300]))
    if rows:
        yield batch(rows)


class LoggerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "logger"

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> DataSourceReader:
        return LoggerReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LoggerStream(dict(self.options))


class _Options:
    def __init__(self, options: dict[str, str]):
        low = {k.lower(): v for k, v in options.items()}
        if not low.get("path"):
            raise ValueError("the logger source needs a path")
        self.path, self.pattern, self.most = low["path"], low.get("filepattern"), int(low.get("rangebytes", RANGE))
        if self.most <= 0:
            raise ValueError("rangeBytes must be positive")

    def files(self) -> list[tuple[int, str, int]]:
        return listed(self.path, self.pattern)


class LoggerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.wanted = _Options(options), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Files by their names; every filter is given back, since Spark's own test costs little."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("file",):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = found if self.wanted is None else self.wanted & found
            yield f

    def partitions(self) -> Sequence[InputPartition]:
        files = [f for f in self.options.files() if self.wanted is None or f[1].rsplit("/", 1)[-1] in self.wanted]
        return ranges(files, self.options.most) or [Range("", 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _batches(partition) if partition.path else iter(())


class LoggerStream(DataSourceStreamReader):
    """An offset is the last file taken, by time of change and name."""

    def __init__(self, options: dict[str, str]):
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        last = max(((t, p) for t, p, _ in self.options.files()), default=(-1, ""))
        return {"time": last[0], "path": last[1]}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        after, until = (start["time"], start["path"]), (end["time"], end["path"])
        return ranges([f for f in self.options.files() if after < f[:2] <= until], self.options.most)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _batches(partition)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> SparkSession:
    """The session, which knows the format ``logger`` from here on."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LoggerSource)
    return spark


def raw(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    return register(spark).read.format("logger").option("rangeBytes", range_bytes).load(path)


CHANNELS = "path string, place int, channel string, base_var string, rep int"


def channels(found: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """``path, place, channel, base_var, rep`` of the columns of each file that have any number: a row for each file and column is all that meets."""
    has = found.where("problem is null").groupBy("path", "place", "source").agg(F.max(number(F.col("raw")).isNotNull()).alias("usable"))
    files = has.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("place", "source", "usable"))).alias("columns"))

    def run(batches):
        for b in batches:
            rows = []
            for path, columns in zip(*(b.column(i).to_pylist() for i in range(2)), strict=True):
                place = {c["source"]: c["place"] for c in columns}
                for ch in names.channels(list(place), {c["source"]: c["usable"] for c in columns}, overrides):
                    rows.append((path, place[ch["source"]], ch["channel"], ch["base_var"], ch["rep"]))
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32()]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in CHANNELS.split(", ")])

    ship(found.sparkSession)
    return files.mapInArrow(run, CHANNELS)


def cells(found: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """What ``logger_files.cells`` gives, of ``RAW``; ``row`` is a long. ``found`` is read twice: it should be a table if files are many.

    ``path`` comes too, since files of one name may lie in several folders.
    """
    told = channels(found, overrides).withColumnsRenamed({"path": "_path", "place": "_place"})
    both = found.where("problem is null").join(told, (F.col("path") == F.col("_path")) & (F.col("place") == F.col("_place")))
    cols = ["path", "file", F.lit("").alias("sheet"), "serial", "model", "row", "ts_raw", "source", "channel", "base_var", "rep", "raw", "problem"]
    lost = found.where("problem is not null").withColumns({"channel": F.lit(None).cast("string"), "base_var": F.lit(None).cast("string"), "rep": F.lit(None).cast("int")})
    return both.select(*cols).unionByName(lost.select(*cols))
