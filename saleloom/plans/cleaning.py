"""Cleaning plans of the three sources, on canonical column names."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom import schemas, vocab
from saleloom.functions.dates import DATE_FORMATS, date_parts, parse_date
from saleloom.functions.numbers import parse_number
from saleloom.functions.text import clean_text, map_labels
from saleloom.operators.columns import require
from saleloom.operators.dedup import flag_duplicates, flag_later_copies, keep_last
from saleloom.operators.joins import lookup_join
from saleloom.operators.keys import INGEST
from saleloom.operators.work import freeze

ROW_ORDER = "row_order"


def typed(df: DataFrame, layout, date_formats: Sequence[str] = DATE_FORMATS, keep: Sequence[str] = ()) -> DataFrame:
    """The layout's columns, parsed: dates, numbers (bad ones 0) and cleaned text."""
    source = require(df, {**schemas.types(layout), **{c: df.schema[c].dataType for c in keep}})
    parse = {
        schemas.TS: lambda c, t: parse_date(c, t, date_formats),
        schemas.DBL: parse_number,
        schemas.STR: lambda c, t: clean_text(c),
    }
    parsed = [
        parse[dtype](F.col(name), source.schema[name].dataType).alias(name) for _, name, dtype in layout
    ]
    return source.select(*parsed, *keep)


def _labelled(df: DataFrame, vocabularies: Mapping[str, Mapping[str, str]]) -> DataFrame:
    return df.withColumns({c: map_labels(F.col(c), v, cleaned=True) for c, v in vocabularies.items()})


def _parsed(raw: DataFrame | Sequence[DataFrame], parse: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, bool]:
    """The parsed source, and whether it is stored: one that comes in portions is, one portion at a time."""
    if isinstance(raw, DataFrame):
        return parse(raw), False
    if len(raw) == 1:
        return parse(raw[0]), False
    return reduce(DataFrame.unionByName, [freeze(parse(df), "parsed", compact=True) for df in raw]), True


def _flagged(df: DataFrame, flag: bool, stored: bool = False) -> DataFrame:
    """With a position in the input all copies but the first are flagged; without one, any of them stays unflagged.

    Flags are set on the source's own columns, before others are derived from them: these are equal where those are.
    """
    if not flag:
        return df.withColumn("is_duplicate", F.lit(False))
    return flag_later_copies(df, INGEST) if INGEST in df.columns else flag_duplicates(df, stored=stored)


def _flag_last(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "is_duplicate"], "is_duplicate")


def _carried(raw: DataFrame) -> list[str]:
    return [INGEST] if INGEST in raw.columns else []


def clean_historical(
    raw: DataFrame | Sequence[DataFrame],
    *,
    channels: Mapping[str, str] = vocab.CHANNELS,
    product_groups: Mapping[str, str] = vocab.PRODUCT_GROUPS,
    customer_groups: Mapping[str, str] = vocab.CUSTOMER_GROUPS,
    returned: Mapping[str, str] = vocab.RETURNED,
    date_formats: Sequence[str] = DATE_FORMATS,
    flag: bool = True,
) -> DataFrame:
    """Historical sales: cost is not known here, so cost columns stay NULL and profit is as given.

    The derived month replaces the source's own month column. Without ``flag`` the duplicate flag, and
    its shuffle of rows, is left out. A source that does not fit the disk several times over is given as portions: each
    is parsed and stored before the next, and only rows whose hash occurs again are shuffled for the flag.
    """
    vocabularies = {
        "channel": channels,
        "product_group": product_groups,
        "customer_group": customer_groups,
        "returned": returned,
    }
    labelled, stored = _parsed(raw, lambda df: _labelled(typed(df, schemas.HISTORICAL, date_formats, _carried(df)), vocabularies))
    unknown = F.lit(None).cast("double")
    return _flag_last(
        _flagged(labelled, flag, stored).withColumns(
            {
                **date_parts(F.col("doc_date")),
                "period": F.lit(vocab.PERIOD_BEFORE),
                "data_source": F.lit(vocab.SOURCE_HISTORICAL),
                "unit_cost": unknown,
                "total_cost": unknown,
                "profit_recomputed": F.col("profit"),
                "has_cost": F.lit(False),
            }
        )
    )


def clean_cost(
    raw: DataFrame,
    *,
    product_groups: Mapping[str, str] = vocab.PRODUCT_GROUPS,
    order_by: Sequence[str] = (ROW_ORDER,),
) -> DataFrame:
    """Product cost, one row per product code: the last in ``order_by`` order is the valid one."""
    extra = [c for c in order_by if c not in schemas.columns(schemas.COST)]
    cleaned = _labelled(typed(raw, schemas.COST, keep=extra), {"std_group": product_groups})
    return keep_last(cleaned, "product_code", order_by).drop(*extra)


def enrich_cost(sales: DataFrame, cost: DataFrame) -> DataFrame:
    """Left join to the product cost and derive cost, profit and flags. No match means cost 0."""
    joined = lookup_join(sales, cost, "product_code").withColumn("unit_cost", parse_number(F.col("unit_cost"), schemas.DBL))
    has_return = F.col("return_value") > 0
    return joined.withColumn("total_cost", F.col("unit_cost") * F.col("quantity")).withColumns(
        {
            "profit_recomputed": F.col("net_revenue") - F.col("total_cost"),
            "profit": F.col("net_revenue") - F.col("total_cost"),
            "has_cost": F.col("unit_cost") > 0,
            "returned": F.when(has_return, vocab.HAS_RETURN).otherwise(vocab.NO_RETURN),
        }
    )


def clean_current(
    raw: DataFrame | Sequence[DataFrame],
    cost: DataFrame,
    *,
    channels: Mapping[str, str] = vocab.CHANNELS,
    product_groups: Mapping[str, str] = vocab.PRODUCT_GROUPS,
    customer_groups: Mapping[str, str] = vocab.CUSTOMER_GROUPS,
    date_formats: Sequence[str] = DATE_FORMATS,
    flag: bool = True,
) -> DataFrame:
    """Current sales with date parts, cost, profit, flags and provenance. Portions as in ``clean_historical``."""
    vocabularies = {"channel": channels, "product_group": product_groups, "customer_group": customer_groups}
    labelled, stored = _parsed(raw, lambda df: _labelled(typed(df, schemas.CURRENT, date_formats, _carried(df)), vocabularies))
    dated = _flagged(labelled, flag, stored).withColumns(date_parts(F.col("doc_date")))
    return _flag_last(
        enrich_cost(dated, cost).withColumns(
            {"period": F.lit(vocab.PERIOD_AFTER), "data_source": F.lit(vocab.SOURCE_CURRENT)}
        )
    )
