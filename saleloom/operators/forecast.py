"""Monthly revenue base, features, backtest, forecast and comparison; correlation of indicators.

The forecasting code this replaces is not public: only the names of its inputs and outputs are known.
The features and the three models here are a design of this engine. All models are window and
regression expressions over the monthly table, per series, with no driver-side model.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleloom.functions.numbers import nan_to_null, ratio, stable_sum

HORIZON = 5
LAGS = (1, 2, 3, 12)
MODELS = ("seasonal_naive", "trailing_mean", "linear_trend")
MIN_HISTORY = 3  # months of a series that are not backtested, by default


def _series(by: Sequence[str]) -> list[Column]:
    # A constant when there is no series key: the monthly table is an aggregate, one row per month.
    return [F.col(c) for c in by] or [F.lit(1)]


def monthly_base(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per month [and series], with the months without sales filled with 0."""
    month = F.trunc("doc_date", "month").alias("month_start")
    months = (
        sales.filter(F.col("doc_date").isNotNull())
        .groupBy(*by, month)
        .agg(stable_sum("net_revenue").alias("net_revenue"))
    )
    whole = Window.partitionBy(*_series(by))
    following = F.lead("month_start").over(whole.orderBy("month_start"))
    last = F.add_months(F.coalesce("__next", F.add_months("month_start", 1)), -1)
    # Every row brings the empty months up to the next row, so no calendar table has to be joined.
    return months.withColumn("__next", following).withColumn("m", F.explode(F.sequence("month_start", last, F.expr("interval 1 month")))).select(
        *by,
        F.col("m").alias("month_start"),
        F.year("m").alias("year"),
        F.month("m").alias("month"),
        F.when(F.col("m") == F.col("month_start"), F.col("net_revenue")).otherwise(0.0).alias("net_revenue"),
    )


def monthly_features(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lags, trailing three-month mean, month of year and trend index, all from earlier months."""
    order = Window.partitionBy(*_series(by)).orderBy("month_start")
    return monthly.withColumns(
        {
            "trend": F.row_number().over(order),
            **{f"lag_{n}": F.lag("net_revenue", n).over(order) for n in LAGS},
            "trailing_mean": F.avg("net_revenue").over(order.rowsBetween(-3, -1)),
        }
    )


def backtest(features: DataFrame, by: Sequence[str] = (), min_history: int = MIN_HISTORY) -> DataFrame:
    """One-step-ahead predictions of every model from the months before each month.

    The first ``min_history`` months of a series have too little history and get no row.
    """
    past = Window.partitionBy(*_series(by)).orderBy("month_start").rowsBetween(Window.unboundedPreceding, -1)
    slope = F.regr_slope("net_revenue", "trend").over(past)
    start = F.regr_intercept("net_revenue", "trend").over(past)
    predictions = {
        "seasonal_naive": F.col("lag_12"),
        "trailing_mean": F.col("trailing_mean"),
        "linear_trend": slope * F.col("trend") + start,
    }
    wide = features.withColumns({m: p.cast("double") for m, p in predictions.items()}).filter(
        F.col("trend") > min_history
    )
    long = wide.unpivot(
        [*by, "month_start", "year", "month", "net_revenue"], list(MODELS), "model", "predicted"
    ).filter(F.col("predicted").isNotNull())
    return long.withColumn("error", F.col("predicted") - F.col("net_revenue"))


def model_metrics(backtested: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, root mean squared error and mean absolute percentage error per model."""
    error = F.col("error")
    return backtested.groupBy(*by, "model").agg(
        F.count(F.lit(1)).alias("months"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(ratio(F.abs(error), F.abs("net_revenue"))).alias("mape"),
    )


def forecast(monthly: DataFrame, by: Sequence[str] = (), horizon: int = HORIZON) -> DataFrame:
    """The months after the history: linear trend times the month's mean ratio to that trend."""
    indexed = monthly_features(monthly, by).select(*by, "month_start", "month", "net_revenue", "trend")
    whole = Window.partitionBy(*_series(by))
    fitted = indexed.withColumns(
        {
            "slope": F.regr_slope("net_revenue", "trend").over(whole),
            "start": F.regr_intercept("net_revenue", "trend").over(whole),
            "last_trend": F.max("trend").over(whole),
            "last_month": F.max("month_start").over(whole),
        }
    ).withColumn("line", F.col("slope") * F.col("trend") + F.col("start"))
    season = F.avg(ratio(F.col("net_revenue"), F.col("line"))).over(Window.partitionBy(*_series(by), "month"))
    steps = (
        fitted.withColumn("season", season)
        .withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("target", F.add_months("last_month", F.col("ahead")))
    )
    # The seasonal index of the target month is read from any history row of that month.
    return (
        steps.groupBy(*by, "ahead", "target")
        .agg(
            F.max(F.col("slope") * (F.col("last_trend") + F.col("ahead")) + F.col("start")).alias("line"),
            F.max(F.when(F.month("target") == F.col("month"), F.col("season"))).alias("season"),
        )
        .select(
            *by,
            F.col("target").alias("month_start"),
            F.year("target").alias("year"),
            F.month("target").alias("month"),
            (F.col("line") * F.coalesce(F.col("season"), F.lit(1.0))).alias("forecast"),
        )
    )


def forecast_vs_actual(predicted: DataFrame, sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Forecast months with the revenue that came in: error and share of the actual revenue."""
    actual = (
        sales.filter(F.col("doc_date").isNotNull())
        .groupBy(*by, F.trunc("doc_date", "month").alias("month_start"))
        .agg(stable_sum("net_revenue").alias("actual"))
        .withColumnsRenamed({c: f"a_{c}" for c in [*by, "month_start"]})
    )
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"a_{c}")) for c in [*by, "month_start"]])
    error = F.col("forecast") - F.col("actual")
    return predicted.join(actual, on, "left").select(
        *predicted.columns,
        "actual",
        error.alias("error"),
        ratio(error, F.col("actual")).alias("error_share"),
    )


def correlations(df: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Pairwise correlation of the indicators, over the rows where both have a value."""
    pairs = [(a, b) for i, a in enumerate(indicators) for b in indicators[i + 1 :]]
    clean = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in indicators])
    wide = clean.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("indicator_a"), F.lit(b).alias("indicator_b"), F.col(f"p{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))
