"""Column expressions: derived variables, snapping, numeric and time parsing, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a missing value, and what loggers write on an error.
MISSING_TOKENS = ["", "nan", "na", "n/a", "#n/a", "null", "none", "-"]
ERROR_TOKENS = ["#value!", "#div/0!", "#ref!", "#name?", "#null!", "#num!", "error", "err", "inf", "+inf", "-inf", "overrange", "underrange", "openc", "shortc"]
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Korean marks in time stamps, and the formats that are tried after their replacement.
KOREAN_MARKS = [("오전", "AM"), ("오후", "PM"), ("시", ":"), ("분", ":"), ("초", "")]
KOREAN_FORMATS = ["MM.dd.yyahh:mm:ss", "yyyy.MM.ddahh:mm:ss", "MM.dd.yyyyahh:mm:ss", "yy.MM.ddahh:mm:ss"]
GENERIC_FORMATS = [
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm",
    "yyyy.MM.dd HH:mm:ss", "yyyy.MM.dd HH:mm", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yy HH:mm:ss", "MM/dd/yy HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd",
]

#: What a file's times may all be written in, the first of equally good ones first; parts in brackets may lack.
TIME_FORMATS = [
    "yyyy-MM-dd[ HH:mm[:ss[.SSS]]]", "yyyy-MM-dd'T'HH:mm[:ss[.SSS]]", "yyyy/MM/dd[ HH:mm[:ss]]", "yyyy.MM.dd[ HH:mm[:ss]]",
    "MM/dd/yyyy[ HH:mm[:ss]]", "MM/dd/yy HH:mm[:ss]", "MM/dd/yyyy hh:mm[:ss] a", "MM/dd/yy hh:mm[:ss] a",
    "dd/MM/yyyy[ HH:mm[:ss]]", "dd/MM/yy HH:mm[:ss]", "dd.MM.yyyy[ HH:mm[:ss]]", "dd-MM-yyyy[ HH:mm[:ss]]",
]

# How exports name their logger.
SERIAL_PATTERNS = [r"차트\s*제목\s*[:：]\s*([\w\-]+)", r"(?i)plot\s*title\s*[:：]\s*([\w\-]+)", r"(?i)LGR\s*S/N\s*[:：]\s*([\w\-]+)", r"(?i)serial(?:\s*number)?\s*[:：]\s*([\w\-]+)", r"(?i)\b(z6-\d{4,6})\b"]


def vpd(temp: Column, rh: Column) -> Column:
    """Vapour pressure deficit in kPa, of one record."""
    return F.lit(0.6108) * F.exp(F.lit(17.27) * temp / (temp + F.lit(237.3))) * (F.lit(1.0) - rh / F.lit(100.0))


def snap(ts: Column, seconds: int) -> Column:
    """``ts`` on the grid of ``seconds`` since the epoch, halves to the even slot; integers only."""
    us, step = F.unix_micros(ts.cast("timestamp")), seconds * 1_000_000
    slot = F.floor(us / step).cast("long")
    rest = us - slot * step
    up = (2 * rest > step) | ((2 * rest == step) & (slot % 2 != 0))
    return F.timestamp_micros((slot + up.cast("long")) * step).cast("timestamp_ntz")


def trimmed(raw: Column) -> Column:
    return F.trim(F.coalesce(raw.cast("string"), F.lit("")))


def number(raw: Column) -> Column:
    """The number in a cell, or null; infinities and names of numbers are no numbers."""
    text = trimmed(raw)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def is_error(raw: Column) -> Column:
    """Whether a cell holds something that is neither a number nor a sign of a missing value."""
    text = F.lower(trimmed(raw))
    return text.isin(ERROR_TOKENS) | (~text.isin(MISSING_TOKENS) & ~text.rlike(NUMBER))


def normalised_key(name: Column) -> Column:
    """Lower case, only digits, Latin and Hangul letters."""
    return F.regexp_replace(F.lower(name), "[^0-9a-z가-힣]+", "")


def serial(text: Column) -> Column:
    """The first serial number that a known pattern finds, or null."""
    found = [F.regexp_extract(text, p, 1) for p in SERIAL_PATTERNS]
    return F.coalesce(*[F.when(f != "", F.trim(f)) for f in found])


def korean_time(text: Column) -> Column:
    """A time stamp's text with Korean marks replaced and blanks removed."""
    for mark, sign in KOREAN_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\s+", ""), ":+", ":"), ":+$", "")


def time_by_format(raw: Column) -> list[Column]:
    """The time in a cell by each of ``TIME_FORMATS`` and, Korean marks replaced, of ``KOREAN_FORMATS``; null where it does not fit."""
    text = F.regexp_replace(trimmed(raw), r"([-/.])\s+(?=\d)", "$1")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS]
    return [t.cast("timestamp_ntz") for t in tries + [F.try_to_timestamp(korean_time(trimmed(raw)), F.lit(f)) for f in KOREAN_FORMATS]]


def parse_time(raw: Column) -> Column:
    """The time in a cell by the first format that fits, or null."""
    text = F.regexp_replace(trimmed(raw), r"([-/.])\s+(?=\d)", "$1")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in GENERIC_FORMATS]
    tries += [F.try_to_timestamp(korean_time(trimmed(raw)), F.lit(f)) for f in KOREAN_FORMATS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def between_hours(hour: Column, first: int, end: int) -> Column:
    """``first`` <= hour < ``end``, over midnight if ``first`` is the larger."""
    return (hour >= first) | (hour < end) if first > end else (hour >= first) & (hour < end)


def level(value: Column, critical, warn, otherwise: str | None = None) -> Column:
    """CRITICAL, WARN or ``otherwise`` by two least values."""
    return F.when(value >= critical, "CRITICAL").when(value >= warn, "WARN").otherwise(F.lit(otherwise))
