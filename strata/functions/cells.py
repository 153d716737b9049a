"""Text of workbook cells (S3) as Column expressions: the text Python's
``str`` gives of the typed value a spreadsheet library returns with cached
formula values.

A cell is a struct ``col, kind, format, code, value``: kind ``text``,
``number``, ``bool`` or ``iso`` (a date stored as ISO text), the id of its
number format, the code of a custom one, and the stored text (a number as
``str`` of its int or float).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Built-in number formats that are dates or times, and the one
# of elapsed time ([h]:mm:ss).
DATE_FORMATS = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 47)
ELAPSED_FORMAT = 46
# Day 0 of a serial, of workbooks that count from 1904, and the
# first serial after the fictitious 1900-02-29.
DAY_ZERO, DAY_ZERO_1904 = "1899-12-30", "1904-01-01"
AFTER_LEAP_BUG = 60
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"

DAY_MS = 86_400_000
_LITERALS = r'\[[^\]]*\]|"[^"]*"|\\.'


def is_elapsed(cell: Column) -> Column:
    """A number under a format of elapsed time."""
    return F.coalesce(cell["code"].rlike(r"(?i)\[(h+|m+|s+)\]"), cell["format"] == ELAPSED_FORMAT, F.lit(False))


def is_date(cell: Column) -> Column:
    """A number under a date or time format: a custom code holds a date letter
    outside brackets, quotes and escapes."""
    code = cell["code"]
    letters = F.regexp_replace(code, _LITERALS, "").rlike("(?i)[dmyhs]") & (F.lower(code) != "general")
    return F.coalesce(letters, cell["format"].isin(*DATE_FORMATS), F.lit(False))


def _clock(ms: Column, pattern: str) -> Column:
    s, rest = F.floor(ms / 1000), F.pmod(ms, F.lit(1000))
    return F.concat(F.format_string(pattern, F.floor(s / 3600), F.floor(s / 60) % 60, s % 60),
                    F.when(rest != 0, F.format_string(".%03d000", rest)).otherwise(""))


def elapsed_text(value: Column) -> Column:
    """A number of days as ``str`` of a timedelta, to the millisecond."""
    ms = F.bround(value * DAY_MS).cast("long")
    days = F.floor(ms / DAY_MS)
    unit = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    return F.concat(F.when(days != 0, F.concat(days.cast("string"), unit)).otherwise(""),
                    _clock(F.pmod(ms, F.lit(DAY_MS)), "%d:%02d:%02d"))


def serial_text(value: Column, date1904: Column) -> Column:
    """A serial as ``str`` of its datetime, below 1 of its time of day; null
    where no year from 1 to 9999 fits."""
    whole = F.floor(value)
    ms = F.bround((value - whole) * DAY_MS).cast("long")
    clock = _clock(F.pmod(ms, F.lit(DAY_MS)), "%02d:%02d:%02d")
    early = F.when(~date1904 & (value > 0) & (value < AFTER_LEAP_BUG), 1).otherwise(0)
    days = F.when(F.abs(whole) < 10_000_000, whole + F.floor(ms / DAY_MS) + early).cast("int")
    zero = F.when(date1904, F.lit(DAY_ZERO_1904).cast("date")).otherwise(F.lit(DAY_ZERO).cast("date"))
    day = F.date_add(zero, days)
    return F.when((value >= 0) & (value < 1) & (ms < DAY_MS), clock) \
        .when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")),
              F.concat(day.cast("string"), F.lit(" "), clock))


def iso_text(value: Column) -> Column:
    """An ISO date as ``str`` of its datetime; null if it is none."""
    at = F.regexp_replace(value, "Z$", "").try_cast("timestamp_ntz")
    micros = F.date_format(at, "SSSSSS")
    return F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""))


def cell_text(cell: Column, date1904: Column) -> Column:
    """The cell's text. What its kind or format cannot read stays as stored."""
    kind, value = cell["kind"], cell["value"]
    number = F.when(kind == "number", value.try_cast("double"))
    return F.coalesce(
        F.when(kind == "bool", F.when(value.isin("1", "true"), "True").otherwise("False"))
        .when(kind == "iso", iso_text(value))
        .when((kind == "number") & is_elapsed(cell), elapsed_text(number))
        .when((kind == "number") & is_date(cell), serial_text(number, date1904)),
        value)
