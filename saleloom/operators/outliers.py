"""Interquartile-range outliers: thresholds, row flags, summary and box-plot figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom import vocab
from saleloom.functions.numbers import finite_or_null, ratio
from saleloom.operators.joins import lookup_join
from saleloom.operators.quantiles import exact_quantiles

METRICS = ("net_revenue", "profit", "quantity", "margin")
ROW_FACTOR = 1.5
REPORT_FACTOR = 3.0


def bounds(
    df: DataFrame, metrics: Sequence[str] = METRICS, by: str | None = None, factor: float = ROW_FACTOR
) -> DataFrame:
    """One row per group with ``<metric>_q1, _q3, _iqr, _low, _high``; missing metrics are skipped.

    NaN and infinite values take no part. All bounds are NULL where a group has no valid value.
    """
    metrics = [m for m in metrics if m in df.columns]
    group = [by] if by else []
    quartiles = exact_quantiles(df, metrics, (0.25, 0.75), group)
    figures = []
    for m in metrics:
        q1, q3 = F.col(m)[0], F.col(m)[1]
        iqr = q3 - q1
        figures += [
            q1.alias(f"{m}_q1"),
            q3.alias(f"{m}_q3"),
            iqr.alias(f"{m}_iqr"),
            (q1 - F.lit(factor) * iqr).alias(f"{m}_low"),
            (q3 + F.lit(factor) * iqr).alias(f"{m}_high"),
        ]
    return quartiles.select(*group, *figures)


def _with_bounds(df: DataFrame, limits: DataFrame, by: str | None) -> DataFrame:
    if by:
        return lookup_join(df, limits, by)
    # A single row of limits: scalar subqueries instead of a join.
    return df.withColumns({c: limits.select(c).scalar() for c in limits.columns})


def _side(metric: str) -> tuple[Column, Column]:
    value = finite_or_null(F.col(metric))
    low = F.coalesce(value < F.col(f"{metric}_low"), F.lit(False))
    high = F.coalesce(value > F.col(f"{metric}_high"), F.lit(False))
    return low, high


def flag_outliers(
    df: DataFrame, metrics: Sequence[str] = METRICS, by: str | None = None, factor: float = ROW_FACTOR
) -> DataFrame:
    """Add ``<metric>_outlier`` and ``<metric>_level`` for values strictly outside the bounds."""
    metrics = [m for m in metrics if m in df.columns]
    limited = _with_bounds(df, bounds(df, metrics, by, factor), by)
    flags = {}
    for m in metrics:
        low, high = _side(m)
        flags[f"{m}_outlier"] = low | high
        flags[f"{m}_level"] = (
            F.when(low, vocab.OUTLIER_LOW).when(high, vocab.OUTLIER_HIGH).otherwise(vocab.OUTLIER_NORMAL)
        )
    return limited.withColumns(flags).select(*df.columns, *flags)


def outlier_summary(
    df: DataFrame,
    metrics: Sequence[str] = METRICS,
    by: str | None = None,
    factor: float = REPORT_FACTOR,
    date: str = "doc_date",
) -> DataFrame:
    """Per metric and group: rows, valid rows, quartiles, bounds, outliers, their rate and date span.

    One aggregate over the rows answers all metrics.
    """
    metrics = [m for m in metrics if m in df.columns]
    limits = bounds(df, metrics, by, factor)
    limited = _with_bounds(df, limits, by)
    group = [by] if by else []
    figures = [F.count(F.lit(1)).alias("total_rows")]
    for m in metrics:
        low, high = _side(m)
        outlier = low | high
        figures += [
            F.count(finite_or_null(F.col(m))).alias(f"{m}_valid"),
            F.coalesce(F.sum(outlier.cast("long")), F.lit(0).cast("long")).alias(f"{m}_count"),
        ]
        span = F.when(outlier, F.col(date)) if date in df.columns else F.lit(None).cast("timestamp")
        figures += [F.min(span).alias(f"{m}_first"), F.max(span).alias(f"{m}_last")]
    totals = _with_bounds(limited.groupBy(*group).agg(*figures), limits, by)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            *[F.col(f"{m}_{c}").alias(c) for c in ("valid", "q1", "q3", "iqr", "low", "high", "count", "first", "last")],
        )
        for m in metrics
    ]
    name = F.col(by).cast("string") if by else F.lit(vocab.OUTLIER_ALL)
    return totals.select(name.alias("group_name"), "total_rows", F.inline(F.array(*rows))).select(
        "metric",
        "group_name",
        "total_rows",
        F.col("valid").alias("valid_rows"),
        "q1",
        "q3",
        "iqr",
        F.col("low").alias("lower_bound"),
        F.col("high").alias("upper_bound"),
        F.col("count").alias("outlier_rows"),
        ratio(F.col("count"), F.col("valid")).alias("outlier_rate"),
        F.col("first").alias("first_outlier_date"),
        F.col("last").alias("last_outlier_date"),
    )


def log_revenue(df: DataFrame) -> DataFrame:
    """Rows with positive revenue, their log10 and the label of the revenue outlier flag."""
    state = F.when(F.col("net_revenue_outlier"), vocab.STATE_OUTLIER).otherwise(vocab.STATE_NORMAL)
    return df.filter(F.col("net_revenue") > 0).withColumns(
        {"log_revenue": F.log10("net_revenue"), "outlier_state": state}
    )


def box_stats(flagged: DataFrame, group: str = "product_group") -> DataFrame:
    """Box-plot figures of log revenue per group and outlier state: quartiles, whiskers, fliers."""
    rows = log_revenue(flagged).select(group, "outlier_state", "log_revenue")
    by = [group, "outlier_state"]
    box = exact_quantiles(rows, ["log_revenue"], (0.25, 0.5, 0.75), by).select(
        *by,
        *[F.col("log_revenue")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    )
    limited = lookup_join(rows, box, by)
    value, reach = F.col("log_revenue"), F.lit(ROW_FACTOR) * (F.col("q3") - F.col("q1"))
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return limited.groupBy(*by, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("fliers"),
    )


def decade_range(rows: DataFrame) -> DataFrame:
    """Whole decades around the log revenue."""
    return rows.agg(
        F.floor(F.min("log_revenue")).cast("int").alias("decade_min"),
        F.ceil(F.max("log_revenue")).cast("int").alias("decade_max"),
    )
