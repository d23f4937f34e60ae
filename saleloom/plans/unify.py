"""One typed sales table from the two cleaned sources, with its derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom import schemas, vocab
from saleloom.functions.numbers import nan_to_null, ratio
from saleloom.functions.text import clean_text
from saleloom.operators.keys import INGEST

DERIVED = ("margin", "discount_rate", "return_rate", "avg_row_value")
ALIGNED = [c for c in schemas.columns(schemas.SALES) if c not in DERIVED]


def _aligned(df: DataFrame, overrides) -> DataFrame:
    dtypes = schemas.types(schemas.SALES)
    carried = [INGEST] if INGEST in df.columns else []
    aligned = [overrides.get(c, F.col(c) if c in df.columns else F.lit(None)).cast(dtypes[c]).alias(c) for c in ALIGNED]
    return df.select(*aligned, *carried)


def align_historical(hist: DataFrame) -> DataFrame:
    """No returns are recorded there; names, type, branch and region do not exist."""
    return _aligned(hist, {"return_qty": F.lit(0.0), "return_value": F.lit(0.0)})


def align_current(current: DataFrame) -> DataFrame:
    """Own product name, group and type first, else those of the cost table."""
    own = {"product_name": "std_name", "product_group": "std_group", "product_type": "std_type"}
    return _aligned(current, {c: F.coalesce(F.col(c), F.col(std)) for c, std in own.items()})


def unify_sales(hist: DataFrame, current: DataFrame) -> DataFrame:
    """Both sources in the 38-column layout; every input row is kept.

    If both carry their position in the input, so does the result: historical rows first, the current ones after them.
    """
    first, second = align_historical(hist), align_current(current)
    if INGEST in first.columns and INGEST in second.columns:
        before = hist.select(F.coalesce(F.max(INGEST) + 1, F.lit(0).cast("long"))).scalar()
        second = second.withColumn(INGEST, F.col(INGEST) + before)
    else:
        first, second = first.drop(INGEST), second.drop(INGEST)
    # Both sources were cleaned, and cleaning twice changes nothing.
    unified = add_analysis_columns(first.unionByName(second), clean=False)
    return unified.select(*schemas.columns(schemas.SALES), *[c for c in unified.columns if c == INGEST])


def add_analysis_columns(sales: DataFrame, clean: bool = True) -> DataFrame:
    """Labels, flags and measures of the unified table; ``clean`` cleans the text columns again first."""
    return derive_measures(fill_labels(sales, clean))


def fill_labels(sales: DataFrame, clean: bool = True) -> DataFrame:
    """Write a label where a text is null (after cleaning it); null flags become FALSE."""
    labels = {c: v for c, v in vocab.LABEL_DEFAULTS.items() if c in sales.columns}
    flags = [c for c in ("has_cost", "is_duplicate") if c in sales.columns]
    if clean:
        sales = sales.withColumns({c: clean_text(F.col(c)) for c in labels})
    filled = sales.na.fill(labels)
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})


def derive_measures(sales: DataFrame) -> DataFrame:
    """Cost back-fill from revenue and profit, recomputed profit, and the row ratios."""
    net, profit, quantity = F.col("net_revenue"), F.col("profit"), F.col("quantity")
    with_total = sales.withColumn("total_cost", F.coalesce(nan_to_null(F.col("total_cost")), net - profit))
    total = F.col("total_cost")
    return with_total.withColumns(
        {
            "unit_cost": F.coalesce(nan_to_null(F.col("unit_cost")), ratio(total, quantity)),
            "profit_recomputed": F.coalesce(net - total, profit),
            "margin": ratio(profit, net),
            "discount_rate": ratio(F.col("discount"), F.col("gross_sales")),
            "return_rate": ratio(F.col("return_value"), F.col("gross_sales")),
            "avg_row_value": net,
        }
    )
