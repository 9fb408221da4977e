"""Logger exports (csv, txt, tsv, xlsx) as readings in long form.

Spark's ``binaryFile`` source finds and reads the files, so they may lie in any store that Spark reads; each
file is one row and is taken apart in a task. A file that cannot be read gives a row in ``problems`` and does not
stop the others.
"""

from __future__ import annotations

from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.functions.expressions import KOREAN_FORMATS, TIME_FORMATS, is_error, number, time_by_format
from agrolith.session import ship, written
from agrolith.sources.parsing import Workbook, cells_of

CELLS = "file string, sheet string, serial string, model string, row int, ts_raw string, source string, channel string, base_var string, rep int, raw string, problem string"
_KINDS = [pa.string()] * 4 + [pa.int32()] + [pa.string()] * 4 + [pa.int32()] + [pa.string()] * 2
_NAMES = [x.split()[0] for x in CELLS.split(", ")]


def cells(spark: SparkSession, paths: str | list[str], overrides: dict[str, str] | None = None) -> DataFrame:
    """Every cell of every file (``CELLS``), batch by batch; problems have null cells."""
    files = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else paths)
    return taken_apart(files.select("path", "content", F.lit(0).cast("long").alias("load")), overrides).drop("load")


def taken_apart(files: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """``CELLS`` and ``load`` of files that a table has as rows: ``path, content, load``."""
    ship(files.sparkSession)

    def run(batches):
        for b in batches:
            for path, content, load in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                name, rows = path.rsplit("/", 1)[-1], []
                try:
                    for r in cells_of(content, name, overrides):
                        rows.append((name, *r, None, load))
                        if len(rows) == 50_000:
                            yield _batch(rows)
                            rows = []
                except Exception as e:  # one file's fault is reported as such
                    rows.append((name, *[None] * 10, f"{type(e).__name__}: {e}"[:300], load))
                if rows:
                    yield _batch(rows)

    return files.select("path", "content", "load").mapInArrow(run, f"{CELLS}, load long")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [*_KINDS, pa.int64()], strict=True)], names=[*_NAMES, "load"])


def problems(found: DataFrame) -> DataFrame:
    return found.where("problem is not null").select("file", "problem")


def time_formats(found: DataFrame, keys: list[str], raw: str = "ts_raw") -> DataFrame:
    """``keys, format, place, share``: the one format that most times of each file fit, of equally good ones the first; none where none fits any.

    One pass that counts what each format reads, combined before the shuffle: a file, however large, is a row.
    """
    formats = TIME_FORMATS + KOREAN_FORMATS
    has = F.col(raw).isNotNull() & (F.trim(F.col(raw)) != "")
    counts = found.where(has).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count(t).alias(f"f{i}") for i, t in enumerate(time_by_format(F.col(raw)))])
    best = F.array_max(F.array(*[F.struct(F.col(f"f{i}").alias("n"), F.lit(-i).alias("place"), F.lit(f).alias("format")) for i, f in enumerate(formats)]))
    voted = counts.select(*keys, "n", best.alias("b")).where("b.n > 0")
    return voted.select(*keys, F.col("b.format").alias("format"), (-F.col("b.place")).alias("place"), (F.col("b.n") / F.col("n")).alias("share"))


def timed(found: DataFrame, keys: list[str], raw: str = "ts_raw") -> DataFrame:
    """``found`` with ``ts``, each file's times read in its one format; what does not fit it is null."""
    votes = time_formats(found, keys, raw).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("place").alias("_place"))
    both = found.join(votes, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], "left")  # votes: a row for each file
    ts = None
    for i, t in enumerate(time_by_format(F.col(raw))):
        ts = F.when(F.col("_place") == i, t) if ts is None else ts.when(F.col("_place") == i, t)
    return both.select(*found.columns, ts.alias("ts"))


def readings(found: DataFrame, *more: str) -> DataFrame:
    """``file, serial, model, ts, channel, base_var, rep, source, value, is_error`` and ``more`` of cells whose time can be read.

    Times are read in one format for each file and sheet (and ``more``).
    """
    known = timed(found.where("problem is null"), ["file", "sheet", *more])
    typed = known.select(*more, "file", "serial", "model", "row", "ts", "channel", "base_var", "rep", "source", number(F.col("raw")).alias("value"), is_error(F.col("raw")).alias("is_error"))
    return typed.where("ts is not null")


def deduplicated(read: DataFrame, *more: str) -> DataFrame:
    """One reading for each logger, time and channel (and ``more``): the first by file, then by row."""
    from agrolith.operators.grid import keep_first

    return keep_first(read, ["serial", "ts", "channel", *more], ["file", "row"])


def growth(spark: SparkSession, path: str, date_column: str = "date") -> DataFrame:
    """A survey table (csv with a header, or a workbook's first sheet); it must have its date column."""
    df = grown(spark.read.format("binaryFile").load(path).select("content")) if path.lower().endswith(".xlsx") else spark.read.csv(path, header=True, inferSchema=False)
    if date_column not in df.columns:
        raise ValueError(f"{path} has no column {date_column!r}")
    keys = {date_column, "trt", "treatment", "note", "rep"}
    numbers = [number(F.col(c)).alias(c) if c not in keys else F.col(c) for c in df.columns]
    return df.select(*numbers).withColumn(date_column, F.to_date(F.substring(date_column, 1, 10)))


def _tables(batches):
    """The headings of each first sheet, once, and the cells of each row."""
    for b in batches:
        for content in b.column(0):
            book = Workbook(content.as_py())
            rows = book.rows(next(iter(book.sheets)))
            place: dict[str, int] = {}
            for i, c in enumerate(next(rows, [])):
                place.setdefault(c.strip(), i)
            place.pop("", None)
            headings = list(place)
            for r in rows:
                yield headings, [(k, r[i]) for k, i in place.items() if i < len(r) and r[i]]
                headings = None  # once for a sheet


def _survey_rows(batches):
    """``headings`` and ``cells`` in batches of many rows, which small workbooks share."""
    rows = _tables(batches)
    while some := list(islice(rows, 5_000)):
        headings, cells = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(headings, pa.list_(pa.string())), pa.array(cells, pa.map_(pa.string(), pa.string()))], names=["headings", "cells"])


def grown(books: DataFrame) -> DataFrame:
    """Survey tables in the first sheets of workbooks (``content``) as one table of texts, a row for each row and a column for each heading.

    Equal rows stay as many as they are; blank cells are null, columns without a heading are left out, and
    of headings that repeat in a sheet the first counts. Only the headings, which are few, come to the driver. Workbooks are read by row.
    """
    ship(books.sparkSession)

    found = written(books.select("content").mapInArrow(_survey_rows, "headings array<string>, cells map<string,string>"), "survey-tables")
    first = found.select(F.posexplode("headings").alias("n", "heading")).groupBy("heading").agg(F.min("n").alias("n"))
    headings = [r.heading for r in first.orderBy("n", "heading").collect()]
    return found.select(*[F.try_element_at("cells", F.lit(h)).alias(h) for h in headings])
