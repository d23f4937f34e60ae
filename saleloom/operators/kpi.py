"""KPI block and the marts: sums, exact distinct counts and ratios of sums at any grain."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom.functions.numbers import ratio, stable_sum
from saleloom.operators.joins import lookup_join
from saleloom.operators.keys import dense_keys
from saleloom.operators.work import freeze

MEASURES = (
    "net_revenue",
    "profit",
    "total_cost",
    "gross_sales",
    "discount",
    "return_value",
    "quantity",
    "weight_kg",
)

# Distinct count -> counted column.
COUNTS = {"orders": "doc_no", "customers": "customer_code", "products": "product_code"}

# Mart -> grain.
GRAINS = {
    "mart_overview_year": ("year", "period"),
    "mart_time_month": ("year", "month", "year_month", "period"),
    "mart_time_quarter": ("year", "quarter", "period"),
    "mart_channel": ("year", "month", "channel", "period"),
    "mart_product_group": ("year", "month", "product_group", "period"),
    "mart_region": ("year", "month", "region", "period"),
    "mart_customer_group": ("year", "month", "customer_group", "period"),
    "mart_channel_product": ("year", "month", "channel", "product_group", "period"),
    "mart_quarter_channel": ("year", "quarter", "channel", "period"),
}
PARETO_GRAIN = ("year", "customer_group", "period")


def kpi_ratios() -> dict[str, Column]:
    net = F.col("net_revenue")
    return {
        "margin": ratio(F.col("profit"), net),
        "discount_rate": ratio(F.col("discount"), F.col("gross_sales")),
        "return_rate": ratio(F.col("return_value"), F.col("gross_sales")),
        "avg_order_value": ratio(net, F.col("orders")),
    }


def aggregate_kpi(sales: DataFrame, by: Sequence[str], approximate: bool = False) -> DataFrame:
    """The KPI block at one grain. NULL grain values form their own group.

    The distinct counts are exact unless ``approximate`` asks for sketches, which need no second shuffle. Exact ones are
    made apart from the sums (see ``kpi_base``), so no measure is repeated for them.
    """
    if not approximate:
        return kpi_from_base(kpi_base(sales, [by]), by)
    return (
        sales.groupBy(*by)
        .agg(
            *[stable_sum(m).alias(m) for m in MEASURES],
            *[F.approx_count_distinct(c).alias(n) for n, c in COUNTS.items()],
        )
        .withColumns(kpi_ratios())
    )


_KIND, _MEMBER = "kind", "member"


class KpiBase(NamedTuple):
    """Sums of all measures, and distinct documents, customers and products, per combination of all grain columns."""

    sums: DataFrame
    members: DataFrame


def kpi_base(sales: DataFrame, grains: Iterable[Sequence[str]]) -> KpiBase:
    """Reduced tables that answer the KPI block at every one of ``grains``, each from one scan of its own columns.

    The measures are summed without being repeated for the distinct counts. The counted columns are listed without any
    measure and made distinct once; distinct members of a coarser grain follow from those.
    """
    by = list(dict.fromkeys(c for g in grains for c in g))
    sums = sales.groupBy(*by).agg(*[stable_sum(m).alias(m) for m in MEASURES])
    listed = [F.struct(F.lit(n).alias(_KIND), F.col(c).cast("string").alias(_MEMBER)) for n, c in COUNTS.items()]
    members = sales.select(*by, F.inline(F.array(*listed))).where(F.col(_MEMBER).isNotNull()).distinct()
    return KpiBase(sums, members)


def with_distinct_counts(grouped: DataFrame, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``grouped`` (one row per ``by``) with the exact ``COUNTS`` of ``rows``, whose measures are not repeated for them."""
    listed = [F.struct(F.lit(n).alias(_KIND), F.col(c).cast("string").alias(_MEMBER)) for n, c in COUNTS.items()]
    members = rows.select(*by, F.inline(F.array(*listed))).where(F.col(_MEMBER).isNotNull()).distinct()
    return _joined_counts(grouped, members, by)


def _joined_counts(grouped: DataFrame, members: DataFrame, by: Sequence[str]) -> DataFrame:
    counted = members.groupBy(*[F.col(c).alias(f"__{c}") for c in by])
    counts = counted.agg(*[F.count(F.when(F.col(_KIND) == n, 1)).alias(f"__n_{n}") for n in COUNTS])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    found, zero = grouped.join(counts, same, "left"), F.lit(0).cast("long")
    return found.select(*grouped.columns, *[F.coalesce(f"__n_{n}", zero).alias(n) for n in COUNTS])


_CELL = "__cell"
_CELL_BITS = 63


class KpiCells(NamedTuple):
    """A ``KpiBase`` whose distinct members are counted already, for all grains at once.

    A cell is one combination of the grain columns, packed into a long: each column has some bits of it, so a coarser
    grain of a cell is the cell under a mask. ``counts`` holds (mask, cell, counts), ``sums`` the cell of each row.
    """

    sums: DataFrame
    counts: DataFrame
    masks: dict[str, int]


def kpi_cells(sales: DataFrame, grains: Iterable[Sequence[str]]) -> KpiCells | KpiBase:
    """Stored sums and distinct counts that answer the KPI block at every one of ``grains``.

    A line's document, customer and product travel once, with the line's cell. All cells of a member meet in one place,
    and there the member is counted once per cell of every grain, so no grain shuffles the members again. Grain columns
    with too many values for a long are left as a stored ``KpiBase``.
    """
    grains = [tuple(g) for g in grains]
    by = list(dict.fromkeys(c for g in grains for c in g))
    sums = freeze(sales.groupBy(*by).agg(*[stable_sum(m).alias(m) for m in MEASURES]), "kpi-sums")
    values = sums.select(F.inline(F.array(*[F.struct(F.lit(i).alias("__i"), F.col(c).cast("string").alias("__v")) for i, c in enumerate(by)])))
    numbered = dense_keys(values.distinct(), "__no", ["__i", "__v"])
    spans = {i: (first, n) for i, first, n in numbered.groupBy("__i").agg(F.min("__no"), F.count(F.lit(1))).collect()}
    masks, cell, shift = {}, F.lit(0).cast("long"), 0
    coded = sums
    for i, c in enumerate(by):
        first, n = spans.get(i, (0, 1))
        codes = numbered.where(F.col("__i") == i).select(F.col("__v").alias(f"__v{i}"), (F.col("__no") - first).alias(f"__c{i}"))
        coded = coded.join(codes, F.col(c).cast("string").eqNullSafe(F.col(f"__v{i}")), "left")
        bits = (n - 1).bit_length()
        masks[c] = ((1 << bits) - 1) << shift
        cell, shift = cell + F.shiftleft(F.col(f"__c{i}"), shift) if bits else cell, shift + bits
    if shift > _CELL_BITS:
        return KpiBase(sums, freeze(kpi_base(sales, grains).members, "kpi-members"))
    sums = freeze(coded.select(*sums.columns, cell.alias(_CELL)), "kpi-cells")
    placed = lookup_join(sales.select(*dict.fromkeys([*by, *COUNTS.values()])), sums.select(*by, _CELL), by)
    listed = [F.struct(F.lit(k).alias(_KIND), F.col(c).cast("string").alias(_MEMBER)) for k, c in enumerate(COUNTS.values())]
    members = placed.select(_CELL, F.inline(F.array(*listed))).where(F.col(_MEMBER).isNotNull())
    of_member = members.groupBy(_KIND, _MEMBER).agg(F.collect_set(_CELL).alias("__cells"))

    def at_grain(mask: int) -> Column:
        coarse = F.array_distinct(F.transform("__cells", lambda x: x.bitwiseAND(F.lit(mask).cast("long"))))
        return F.transform(coarse, lambda x: F.struct(F.lit(mask).cast("long").alias("__mask"), x.alias(_CELL)))

    wanted = sorted({_mask(masks, g) for g in grains})
    found = of_member.select(_KIND, F.inline(F.flatten(F.array(*[at_grain(m) for m in wanted]))))
    counted = found.groupBy("__mask", _CELL).agg(*[F.count(F.when(F.col(_KIND) == k, 1)).alias(n) for k, n in enumerate(COUNTS)])
    return KpiCells(sums, freeze(counted, "kpi-counts"), masks)


def _mask(masks: dict[str, int], by: Iterable[str]) -> int:
    return sum(masks[c] for c in dict.fromkeys(by))


def _kpi_from_cells(cells: KpiCells, by: Sequence[str]) -> DataFrame:
    mask = _mask(cells.masks, by)
    of_cell = F.min(F.col(_CELL).bitwiseAND(F.lit(mask).cast("long"))).alias(_CELL)
    sums = cells.sums.groupBy(*by).agg(*[stable_sum(m).alias(m) for m in MEASURES], of_cell)
    counts = cells.counts.where(F.col("__mask") == mask).select(F.col(_CELL).alias("__of"), *[F.col(n).alias(f"__n_{n}") for n in COUNTS])
    found, zero = sums.join(counts, F.col(_CELL) == F.col("__of"), "left"), F.lit(0).cast("long")
    return found.select(*by, *MEASURES, *[F.coalesce(f"__n_{n}", zero).alias(n) for n in COUNTS]).withColumns(kpi_ratios())


def kpi_from_base(base: KpiBase | KpiCells, by: Sequence[str]) -> DataFrame:
    """The KPI block at one grain of a ``kpi_base`` or of ``kpi_cells``; of the first, members are made distinct, then counted."""
    if isinstance(base, KpiCells):
        return _kpi_from_cells(base, by)
    same_grain = set(base.sums.columns) == {*by, *MEASURES}
    sums = base.sums if same_grain else base.sums.groupBy(*by).agg(*[stable_sum(m).alias(m) for m in MEASURES])
    members = base.members if same_grain else base.members.select(*by, _KIND, _MEMBER).distinct()
    return _joined_counts(sums.select(*by, *MEASURES), members, by).withColumns(kpi_ratios())
