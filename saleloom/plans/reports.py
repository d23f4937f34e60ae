"""The report tables of the analysis, each in its display order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom import schemas
from saleloom.operators import outliers, quality, reports
from saleloom.operators.keys import dense_keys
from saleloom.operators.kpi import GRAINS, aggregate_kpi

POSITION = "position"

# Report -> display order; "-" marks a descending measure.
ORDERS = {
    "report_scope": ("year",),
    "report_nulls": ("-null_cells", "column_name"),
    "report_columns": ("column_name", "metric"),
    "report_kpi": ("year",),
    "report_month_trend": ("year", "month"),
    "report_channel": ("year", "-net_revenue", "channel"),
    "report_channel_pivot": ("year",),
    "report_product_group": ("year", "-net_revenue", "product_group"),
    "report_pareto": ("year", "-net_revenue", "customer_group"),
    "report_outliers": ("metric",),
    "report_outliers_by_group": ("metric", "group_name"),
    "report_box": ("product_group", "outlier_state"),
}


def ordered(report: DataFrame, order: Sequence[str]) -> DataFrame:
    """The report behind its ``position``, 1, 2, ... in display order (nulls last).

    Rows are range-partitioned and sorted, so the files of a published report follow each other in this order.
    """

    def rank(name: str) -> Column:
        return -F.col(name[1:]) if name.startswith("-") else F.col(name)

    return dense_keys(report, POSITION, [rank(n) for n in order])


def report_tables(sales: DataFrame, through_month: int = reports.YTD_MONTH) -> dict[str, DataFrame]:
    """All reports over the unified sales table, unordered."""
    channels = reports.ytd_channel(sales, through_month)
    flagged = outliers.flag_outliers(sales.select("net_revenue", "product_group"), ["net_revenue"])
    return {
        "report_scope": quality.scope_by_year(sales),
        "report_nulls": quality.null_profile(sales, top=len(sales.columns)),
        "report_columns": quality.column_profile(sales),
        "report_kpi": reports.ytd_kpi(sales, through_month),
        "report_month_trend": reports.monthly_trend(aggregate_kpi(sales, GRAINS["mart_time_month"])),
        "report_channel": channels,
        "report_channel_pivot": reports.channel_pivot(channels),
        "report_product_group": reports.ytd_product_group(sales, through_month),
        "report_pareto": reports.ytd_pareto(sales, through_month),
        "report_outliers": outliers.outlier_summary(sales),
        "report_outliers_by_group": outliers.outlier_summary(sales, by="product_group", factor=outliers.ROW_FACTOR),
        "report_box": outliers.box_stats(flagged),
    }


def ordered_reports(sales: DataFrame, through_month: int = reports.YTD_MONTH) -> dict[str, DataFrame]:
    """All reports in display order. The table is read once per report, so it should be a stored one."""
    sales = sales.select(*schemas.columns(schemas.SALES))
    return {name: ordered(df, ORDERS[name]) for name, df in report_tables(sales, through_month).items()}
