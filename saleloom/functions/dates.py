"""Date functions: parsing with an explicit format list, date parts, date keys and period labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom import vocab

_CLOCKS = ("", " HH:mm", " HH:mm:ss", " HH:mm:ss.SSSSSS")
_T_CLOCKS = ("'T'HH:mm", "'T'HH:mm:ss", "'T'HH:mm:ss.SSSSSS", "'T'HH:mm:ssXXX", "'T'HH:mm:ss.SSSSSSXXX")
ISO_FORMATS = (*[f"yyyy-MM-dd{c}" for c in (*_CLOCKS, *_T_CLOCKS)], *[f"yyyy/M/d{c}" for c in _CLOCKS[:3]])
DAY_FIRST = tuple(f"d/M/yyyy{c}" for c in _CLOCKS[:3])
MONTH_FIRST = tuple(f"M/d/yyyy{c}" for c in _CLOCKS[:3])

# Tried in this order: the frequent shapes first. Where both orders of day and month are possible, the day is first;
# ``operators.date_formats.elect`` decides by the data of a whole column instead.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm:ss",
                *[f for f in (*ISO_FORMATS, *DAY_FIRST) if f not in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss")])


def _shape(date_format: str) -> str | None:
    """Regular expression of the texts that could fit a purely numeric format, else None."""
    parts = re.findall(r"'([^']*)'|(y+|M+|d+|H+|m+|s+|S+|XXX)|([A-Za-z]+)|([^A-Za-z']+)", date_format)
    if any(letters or len(field) > 2 and field[0] not in "ySX" for _, field, letters, _ in parts):
        return None

    def digits(field: str) -> str:
        if field == "XXX":
            return r"(?:Z|[+-]\d{2}:\d{2})"
        if field[0] == "S":
            return rf"\d{{1,{len(field)}}}"
        return r"\d{1,2}" if len(field) == 1 else rf"\d{{{len(field)}}}"

    return "^" + "".join(digits(field) if field else re.escape(quoted or other) for quoted, field, _, other in parts) + "$"


def _parsed(text: Column, date_format: str) -> Column:
    # A failed parse throws inside the JVM, which costs far more than looking at the text first.
    parsed, shape = F.try_to_timestamp(text, F.lit(date_format)), _shape(date_format)
    return F.when(text.rlike(shape), parsed) if shape else parsed


def parse_date(value: Column, dtype: T.DataType | None = None, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp from the first format that fits, else NULL. Date and timestamp columns pass."""
    if dtype is None or isinstance(dtype, T.StringType):
        text = F.trim(value)
        return F.coalesce(*[_parsed(text, f) for f in formats])
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp")
    # Bare numbers are no dates; guessing an epoch unit would invent data.
    return F.lit(None).cast("timestamp")


def date_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year_month": F.date_format(date, "yyyy-MM"),
    }


def date_key(date: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic rather than by formatting text."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def month_label(month: Column) -> Column:
    return F.concat(F.lit(vocab.MONTH_PREFIX), month.cast("string"))


def period_key(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
