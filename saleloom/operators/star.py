"""Star schema: four dimensions with dense surrogate keys and the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom import vocab
from saleloom.functions.dates import date_key, month_label
from saleloom.operators.dedup import keep_first
from saleloom.operators.joins import lookup_join
from saleloom.operators.keys import INGEST, dense_keys, is_dense

# Without a position in the input: historical rows come first, within a source the document date decides.
SOURCE_ORDER = ("data_source", "doc_date")

CUSTOMER_ATTRS = ("customer_name", "customer_group")
PRODUCT_ATTRS = ("product_name", "product_group", "product_type")

# Columns of the published fact table, in table order.
FACT_COLUMNS = (
    "sales_id",
    "date_key",
    "customer_key",
    "product_key",
    "channel_key",
    "doc_no",
    "uom",
    "quantity",
    "weight_kg",
    "unit_price",
    "gross_sales",
    "discount",
    "net_revenue",
    "return_qty",
    "return_value",
    "unit_cost",
    "total_cost",
    "profit",
    "margin",
    "discount_rate",
    "return_rate",
    "returned",
    "period",
    "data_source",
    "branch",
    "region",
)


def dimension(
    sales: DataFrame,
    key: str,
    natural: str,
    attrs: Sequence[str] = (),
    order_by: Sequence[str] = (),
    prefer: str = "first",
) -> DataFrame:
    """Distinct natural keys sorted and numbered 1..n, with the attributes of their first row.

    The first row is the first in the input if the table carries its positions, else the first in ``SOURCE_ORDER``.

    A NULL natural key becomes the "unknown" label before the distinct, so it cannot yield a second
    unknown member. ``prefer="known"`` takes the first row whose name is a real one.
    """
    order_by = order_by or ((INGEST,) if INGEST in sales.columns else SOURCE_ORDER)
    attrs = [a for a in attrs if a in sales.columns]
    source = sales.withColumn(natural, F.coalesce(F.col(natural).cast("string"), F.lit(vocab.UNKNOWN)))
    if not attrs:
        members = source.select(natural).distinct()
    else:
        known = F.coalesce(F.col(attrs[0]) != vocab.NO_DATA, F.lit(False)) if prefer == "known" else None
        members = keep_first(source, natural, attrs, order_by, known)
    return dense_keys(members, key, [natural])


def dim_date(sales: DataFrame) -> DataFrame:
    """One row per distinct document date and its parts, in date order (no date last)."""
    parts = ("doc_date", "year", "month", "quarter", "year_month")
    return sales.select(*parts).distinct().orderBy(F.asc_nulls_last("doc_date")).select(
        date_key(F.col("doc_date")).alias("date_key"),
        "doc_date",
        "year",
        "quarter",
        "month",
        month_label(F.col("month")).alias("month_name"),
        "year_month",
    )


def dim_customer(sales: DataFrame, **options) -> DataFrame:
    return dimension(sales, "customer_key", "customer_code", CUSTOMER_ATTRS, **options)


def dim_product(sales: DataFrame, **options) -> DataFrame:
    return dimension(sales, "product_key", "product_code", PRODUCT_ATTRS, **options)


def dim_channel(sales: DataFrame) -> DataFrame:
    return dimension(sales, "channel_key", "channel")


def fact_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per sales line with its surrogate keys; ``sales_id`` counts in ``order_by`` order.

    Without an order it counts in input order if the table carries its positions. Unless rows were taken out, these are
    the numbers themselves, and no row is sorted or shuffled.
    """
    dense = not order_by and INGEST in sales.columns and is_dense(sales)
    if not order_by and INGEST in sales.columns:
        order_by = (INGEST,)
    fact = sales.withColumn("date_key", date_key(F.col("doc_date")))
    for dim, key, natural in (
        (customers, "customer_key", "customer_code"),
        (products, "product_key", "product_code"),
        (channels, "channel_key", "channel"),
    ):
        fact = lookup_join(fact, dim.select(natural, key), natural)
    if dense:
        return fact.withColumn("sales_id", F.col(INGEST) + 1).select(*FACT_COLUMNS)
    order = [c for c in order_by if c not in FACT_COLUMNS]
    narrow = fact.select(*FACT_COLUMNS[1:], *order)
    return dense_keys(narrow, "sales_id", order_by).select(*FACT_COLUMNS)


def star_schema(sales: DataFrame, order_by: Sequence[str] = (), prefer: str = "first") -> dict[str, DataFrame]:
    customers = dim_customer(sales, prefer=prefer)
    products = dim_product(sales, prefer=prefer)
    channels = dim_channel(sales)
    return {
        "fact_sales": fact_sales(sales, customers, products, channels, order_by),
        "dim_date": dim_date(sales),
        "dim_customer": customers,
        "dim_product": products,
        "dim_channel": channels,
    }
