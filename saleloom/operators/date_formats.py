"""Election of date formats: all rows of a column decide how its texts are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom.functions.dates import DAY_FIRST, ISO_FORMATS, MONTH_FIRST, parse_date


class Election(NamedTuple):
    """Formats of one column in the order to try them, and how its texts fare with them."""

    formats: tuple[str, ...]
    texts: int  # texts that are not blank
    only_day_first: int  # possible dates with the day first alone, such as 13/1/2024
    only_month_first: int
    either: int  # possible in both orders
    rejected: int  # texts that no format reads


def _text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def elect(df: DataFrame, columns: Sequence[str], iso: Sequence[str] = ISO_FORMATS, day_first: Sequence[str] = DAY_FIRST,
          month_first: Sequence[str] = MONTH_FIRST) -> dict[str, Election]:
    """One ``Election`` per text column of ``columns``; typed date columns need none.

    One scan counts, for all rows of all columns, the texts that only one order of day and month can read. The order with
    more of them is tried first, the day on a tie; the other one still reads the texts that only it can. Formats that
    start with the year are unambiguous. An empty column elects the day.
    """
    names = _text_columns(df, columns)
    if not names:
        return {}

    def fits(column: Column, formats: Sequence[str]) -> Column:
        return parse_date(column, formats=formats).isNotNull() if formats else F.lit(False)

    figures = []
    for i, name in enumerate(names):
        text = F.trim(F.col(f"`{name}`"))
        year, day, month = (fits(text, f) for f in (iso, day_first, month_first))
        known = text.isNotNull() & (text != "")
        tests = {"texts": known, "day": day & ~month, "month": month & ~day, "either": day & month, "rejected": known & ~year & ~day & ~month}
        figures += [F.count_if(c).alias(f"{n}_{i}") for n, c in tests.items()]
    row = df.agg(*figures).first()
    found = {}
    for i, name in enumerate(names):
        texts, day, month, either, rejected = (row[f"{n}_{i}"] for n in ("texts", "day", "month", "either", "rejected"))
        order = (*month_first, *day_first) if month > day else (*day_first, *month_first)
        found[name] = Election((*iso, *order), texts, day, month, either, rejected)
    return found


def election_report(df: DataFrame, elections: Mapping[str, Election]) -> DataFrame:
    """column_name, texts, only_day_first, only_month_first, either, rejected, day_first: one row per column."""
    schema = "column_name string, texts long, only_day_first long, only_month_first long, either long, rejected long, day_first boolean"
    rows = [(n, e.texts, e.only_day_first, e.only_month_first, e.either, e.rejected, e.only_month_first <= e.only_day_first)
            for n, e in elections.items()]
    return df.sparkSession.createDataFrame(rows, schema)
