"""All marts of the star schema and the KPI block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.operators.kpi import GRAINS, PARETO_GRAIN, aggregate_kpi, kpi_cells, kpi_from_base
from saleloom.operators.reports import pareto, ranked
from saleloom.operators.star import star_schema


def pareto_mart(groups: DataFrame) -> DataFrame:
    return pareto(groups, "net_revenue", ["customer_group", "period"])


def customer_pareto(sales: DataFrame) -> DataFrame:
    return pareto_mart(aggregate_kpi(sales, PARETO_GRAIN))


def kpi_marts(sales: DataFrame) -> dict[str, DataFrame]:
    """The nine KPI marts and the Pareto mart, all from one reduced copy of the sales lines.

    The rows of a KPI mart are ordered by its grain, those of the Pareto mart by year and falling revenue.
    """
    base = kpi_cells(sales, [*GRAINS.values(), PARETO_GRAIN])
    marts = {name: kpi_from_base(base, grain).orderBy(*[F.asc_nulls_last(c) for c in grain]) for name, grain in GRAINS.items()}
    pareto_rows = pareto_mart(kpi_from_base(base, PARETO_GRAIN))
    return {**marts, "mart_pareto_customer_group": ranked(pareto_rows, "net_revenue", ties=["customer_group", "period"])}


def all_marts(sales: DataFrame, order_by: Sequence[str] = (), prefer: str = "first") -> dict[str, DataFrame]:
    """Five star tables and ten marts."""
    return {**star_schema(sales, order_by, prefer), **kpi_marts(sales)}
