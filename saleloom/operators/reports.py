"""Windowed and year-to-date reports. All windows run over aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleloom import vocab
from saleloom.functions.dates import period_key
from saleloom.functions.numbers import ratio, stable_sum
from saleloom.operators.work import freeze

BILLION = 1e9
YTD_MONTH = 5
PARETO_LIMIT = 0.8
PIVOT_COLUMNS = 1_000  # widest pivot


def year_to_date(sales: DataFrame, through_month: int = YTD_MONTH) -> DataFrame:
    """Rows of the first months of every year; rows without a date drop out."""
    return sales.filter(F.month("doc_date") <= through_month)


def pareto(groups: DataFrame, measure: str, ties: Sequence[str], year: str = "year") -> DataFrame:
    """Share of the yearly total, running share (largest first) and Pareto class.

    The running share is one division of running total by total, not a sum of rounded shares. The row that
    crosses the limit is in the rest, and so are rows without a year, which get no share.
    """
    yearly = Window.partitionBy(year)
    descending = yearly.orderBy(F.desc(measure), *[F.asc_nulls_last(t) for t in ties])
    running = descending.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = F.col(measure).try_cast("decimal(30,6)")
    has_year = F.col(year).isNotNull()
    total, so_far = F.sum(exact).over(yearly), F.sum(exact).over(running)
    # Infinite measures have no decimal form; their shares stay NULL.
    return groups.withColumns(
        {
            "revenue_share": F.when(has_year, ratio(F.col(measure), total)),
            "cumulative_share": F.when(has_year, ratio(so_far, total)),
        }
    ).withColumn(
        "pareto_class",
        F.when(F.col("cumulative_share") <= PARETO_LIMIT, vocab.PARETO_TOP).otherwise(vocab.PARETO_REST),
    )


def growth(yearly: DataFrame, measures: Sequence[str], year: str = "year", by: Sequence[str] = ()) -> DataFrame:
    """Year-over-year change of each measure as ``<measure>_yoy``; NULL for the first year or a zero base.

    A NULL measure is first replaced by the last known one. ``yearly`` has one row per year (and ``by``).
    """
    order = Window.partitionBy(*by).orderBy(F.asc_nulls_last(year))
    known = {m: F.last(m, ignorenulls=True).over(order) for m in measures}
    filled = yearly.withColumns({f"__{m}": c for m, c in known.items()})
    before = {m: F.lag(f"__{m}").over(order) for m in measures}
    return filled.withColumns(
        {f"{m}_yoy": ratio(F.col(f"__{m}") - before[m], before[m]) for m in measures}
    ).drop(*[f"__{m}" for m in measures])


def ytd_kpi(sales: DataFrame, through_month: int = YTD_MONTH) -> DataFrame:
    """KPIs per year up to ``through_month``, with growth and amounts in billions."""
    yearly = (
        year_to_date(sales, through_month)
        .groupBy("year")
        .agg(
            stable_sum("net_revenue").alias("net_revenue"),
            stable_sum("profit").alias("profit"),
            F.count_distinct("doc_no").alias("orders"),
            F.count_distinct("customer_code").alias("customers"),
            F.count_distinct("product_code").alias("products"),
        )
    )
    return growth(yearly, ["net_revenue", "profit"]).select(
        "year",
        "net_revenue",
        "profit",
        (F.col("net_revenue") / BILLION).alias("net_revenue_bn"),
        (F.col("profit") / BILLION).alias("profit_bn"),
        ratio(F.col("profit"), F.col("net_revenue")).alias("margin"),
        "net_revenue_yoy",
        "profit_yoy",
        "orders",
        "customers",
        "products",
        ratio(F.col("net_revenue"), F.col("orders")).alias("avg_order_value"),
    )


def ytd_channel(sales: DataFrame, through_month: int = YTD_MONTH) -> DataFrame:
    return (
        year_to_date(sales, through_month)
        .groupBy("year", "channel")
        .agg(
            stable_sum("net_revenue").alias("net_revenue"),
            stable_sum("profit").alias("profit"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .withColumn("margin", ratio(F.col("profit"), F.col("net_revenue")))
    )


def channel_pivot(by_channel: DataFrame, channels: Sequence[str] | None = None, most: int = PIVOT_COLUMNS) -> DataFrame:
    """Revenue per year with one column per channel, missing combinations 0; rows without a channel are left out.

    The columns are the channels of the aggregated table, at most ``most``: a wider pivot is an error. If a list is
    passed, it fixes the columns and their order, and a channel outside it is an error.
    """
    by_channel = freeze(by_channel, "channels")  # a small aggregate that is read three times
    found = by_channel.where(F.col("channel").isNotNull()).select("channel").distinct().orderBy("channel").limit(most + 1)
    names = [r[0] for r in found.collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} channels to pivot")
    if channels is not None:
        missed = sorted(set(names) - set(channels))
        if missed:
            raise ValueError(f"channels missing from the list: {missed}")
        names = list(channels)
    years = by_channel.select("year").distinct()
    if not names:
        return years
    known = by_channel.where(F.col("channel").isNotNull())
    wide = known.groupBy("year").pivot("channel", names).agg(F.sum("net_revenue"))
    return wide.na.fill(0.0, names)


def ytd_product_group(sales: DataFrame, through_month: int = YTD_MONTH) -> DataFrame:
    return (
        year_to_date(sales, through_month)
        .groupBy("year", "product_group")
        .agg(
            stable_sum("net_revenue").alias("net_revenue"),
            stable_sum("profit").alias("profit"),
            stable_sum("quantity").alias("quantity"),
            F.count_distinct("product_code").alias("products"),
        )
        .withColumn("margin", ratio(F.col("profit"), F.col("net_revenue")))
    )


def ytd_pareto(sales: DataFrame, through_month: int = YTD_MONTH) -> DataFrame:
    groups = (
        year_to_date(sales, through_month)
        .groupBy("year", "customer_group")
        .agg(stable_sum("net_revenue").alias("net_revenue"))
        .filter(F.col("year").isNotNull())
    )
    return pareto(groups, "net_revenue", ["customer_group"])


def monthly_trend(mart_time_month: DataFrame) -> DataFrame:
    return mart_time_month.select(
        "year",
        "month",
        period_key(F.col("year"), F.col("month")).alias("period_key"),
        "net_revenue",
        "profit",
        (F.col("net_revenue") / BILLION).alias("net_revenue_bn"),
        (F.col("profit") / BILLION).alias("profit_bn"),
        "margin",
    )


def ranked(report: DataFrame, measure: str, year: str = "year", ties: Sequence[str] = ()) -> DataFrame:
    """Display order: year ascending, measure descending, then the tie-break columns."""
    return report.orderBy(F.asc_nulls_last(year), F.desc(measure), *[F.asc_nulls_last(t) for t in ties])
