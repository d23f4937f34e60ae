"""Named queries over the test tables, one per operator or operator group."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleloom import vocab
from saleloom.checks import tables
from saleloom.functions.dates import date_key, date_parts, month_label, parse_date
from saleloom.functions.numbers import parse_number
from saleloom.functions.text import clean_text, map_labels, match_key
from saleloom.operators import forecast as fc
from saleloom.operators import kpi, outliers, quality, reports, star
from saleloom.operators.date_formats import elect, election_report
from saleloom.operators.dedup import flag_duplicates
from saleloom.operators.keys import INGEST
from saleloom.operators.work import freeze
from saleloom.plans.cleaning import clean_cost, clean_current, clean_historical
from saleloom.plans.marts import kpi_marts, pareto_mart
from saleloom.plans.reports import ORDERS, POSITION, ordered
from saleloom.plans.unify import align_current, align_historical, fill_labels, unify_sales
from saleloom.sources.readers import spread_small, union_tagged

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

KPI_INPUT = (*kpi.MEASURES, *kpi.COUNTS.values())
PARETO_COLUMNS = ("revenue_share", "cumulative_share")
HISTORY_END = datetime.date(2001, 1, 1)
FORECAST_KEYS = ("region",)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Fixed digits, so that two engines agree on floating-point results."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _digits(columns, n: int) -> dict[str, int]:
    return {c: n for c in columns}


KPI_DIGITS = {**_digits(kpi.MEASURES, 4), **_digits(("margin", "discount_rate", "return_rate"), 8)}


# Sources and set operations


@query
def source_union_tagged(spark, folder):
    """Two sheets with different columns, stacked by name."""
    early = tables.read(spark, folder, "orders").where("o_orderdate < TIMESTAMP '1998-01-01 00:00:00'")
    late = tables.read(spark, folder, "orders").where("o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
    return union_tagged(
        {
            "1995-1997": early.selectExpr("o_orderkey AS doc_no", "o_totalprice AS gross_sales"),
            "1998-2001": late.selectExpr("o_orderpriority AS channel", "o_orderkey AS doc_no", "o_totalprice AS gross_sales"),
        }
    )


# Text, number and date functions


def _documents(spark, folder):
    return spread_small(tables.read(spark, folder, "documents"), f"{folder}/documents.parquet")


@query
def clean_text_documents(spark, folder):
    docs = _documents(spark, folder)
    padded = F.concat(F.lit("  "), F.regexp_replace("text", " ", "   "), F.lit("\n"))
    lang = F.when(F.col("lang") == "de", "nan").otherwise(F.concat(F.lit(" "), "lang"))
    return docs.select("doc_id", clean_text(padded).alias("text"), clean_text(lang).alias("lang"))


@query
def accent_key(spark, folder):
    docs = _documents(spark, folder)
    return docs.select("doc_id", match_key(F.concat(F.lit(" Đồ  uống đặc biệt "), "text")).alias("key"))


@query
def vocab_map(spark, folder):
    raw = tables.raw_historical(spark, folder, ["channel", "product_group", "customer_group", "returned"])
    vocabularies = {
        "channel": vocab.CHANNELS,
        "product_group": vocab.PRODUCT_GROUPS,
        "customer_group": vocab.CUSTOMER_GROUPS,
        "returned": vocab.RETURNED,
    }
    mapped = raw.withColumns({c: map_labels(F.col(c), v) for c, v in vocabularies.items()})
    return mapped.groupBy(*vocabularies).agg(F.count(F.lit(1)).alias("row_count"))


@query
def label_defaults(spark, folder):
    raw = tables.raw_current(spark, folder, ["channel", "product_name", "product_type", "customer_code"])
    filled = fill_labels(raw)
    return filled.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("row_count"))


@query
def parse_numbers(spark, folder):
    """Number columns of both sources; the current one has no profit and typed quantities."""
    figures = ("gross_sales", "quantity", "profit")
    raw = tables.raw_historical(spark, folder, ["doc_no", "product_code", *figures])
    current = tables.raw_current(spark, folder, ["doc_no", "product_code", "gross_sales", "quantity"])
    both = raw.unionByName(current.withColumn("quantity", F.col("quantity").cast("string")), allowMissingColumns=True)
    return both.select("doc_no", "product_code", *[parse_number(F.col(c)).alias(c) for c in figures])


@query
def parse_dates(spark, folder):
    raw = tables.raw_historical(spark, folder, ["doc_date"]).unionByName(tables.raw_current(spark, folder, ["doc_date"]))
    parsed = raw.select(parse_date(F.col("doc_date")).alias("doc_date"))
    return parsed.groupBy("doc_date").agg(F.count(F.lit(1)).alias("row_count"))


@query
def date_election(spark, folder):
    """How the dates of both sources, written with the day first, with the month first and in mixed forms, elect their order."""
    raw = tables.raw_historical(spark, folder, ["doc_date"]).unionByName(tables.raw_current(spark, folder, ["doc_date"]))
    iso = F.to_date(F.when(F.col("doc_date").rlike(r"^\d{4}-"), F.col("doc_date")))
    df = raw.select("doc_date", F.date_format(iso, "M/d/yyyy").alias("month_first"), F.date_format(iso, "d/M/yyyy HH:mm").alias("day_first"))
    return election_report(df, elect(df, df.columns))


@query
def date_columns(spark, folder):
    date = F.col("o_orderdate")
    parts = date_parts(date)
    return tables.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("doc_no"),
        *[c.alias(n) for n, c in parts.items()],
        date_key(date).alias("date_key"),
        month_label(parts["month"]).alias("month_name"),
        reports.period_key(parts["year"], parts["month"]).alias("period_key"),
    )


# Cleaning, enrichment, unification


def _cost(spark, folder):
    return clean_cost(tables.raw_cost(spark, folder))


def _current(spark, folder, flag=False, ingest=False):
    return clean_current(tables.raw_current(spark, folder, ingest=ingest), _cost(spark, folder), flag=flag)


def _historical(spark, folder, flag=False, ingest=False):
    return clean_historical(tables.raw_historical(spark, folder, ingest=ingest), flag=flag)


def _portions(spark, folder):
    """Both raw sources in portions of the orders."""
    parts = list(tables.portions(spark, folder))
    return [tables.raw_historical(spark, folder, portion=p) for p in parts], [tables.raw_current(spark, folder, portion=p) for p in parts]


@query
def cost_latest(spark, folder):
    return _cost(spark, folder)


@query
def cost_enrichment(spark, folder):
    columns = ("doc_no", "product_code", "quantity", "net_revenue", "std_name", "list_price", "unit_cost", "total_cost")
    return _current(spark, folder).select(*columns, "profit", "profit_recomputed", "has_cost", "returned")


@query
def cost_match_rate(spark, folder):
    return rounded(quality.flag_rate(_current(spark, folder), "has_cost", "match_rate"), match_rate=8)


@query
def unified_sales(spark, folder):
    """All 38 columns of the unified table, duplicate flags included."""
    historical, current = _portions(spark, folder)
    return unify_sales(clean_historical(historical), clean_current(current, _cost(spark, folder)))


@query
def ingest_positions(spark, folder):
    """Position of every line of both sources in the input, and the flag of the later copies."""
    sales = unify_sales(_historical(spark, folder, True, True), _current(spark, folder, True, True))
    return sales.select(INGEST, "doc_no", "product_code", "quantity", "gross_sales", "data_source", "is_duplicate")


@query
def row_ratios(spark, folder):
    columns = ["doc_no", "product_code", "margin", "discount_rate", "return_rate", "unit_cost", "avg_row_value"]
    return tables.sales_view(spark, folder, columns)


@query
def canonical_fact_defaults(spark, folder):
    """Aligned rows of both sources with label defaults, counted per label combination."""
    aligned = align_historical(_historical(spark, folder)).unionByName(align_current(_current(spark, folder)))
    labels = ["product_group", "product_type", "channel", "customer_group", "region", "returned", "period", "data_source"]
    return fill_labels(aligned).groupBy(*labels, "has_cost").agg(F.count(F.lit(1)).alias("row_count"))


@query
def order_value_labels(spark, folder):
    """Positive-revenue lines with log10, unit scaling and the outlier label."""
    columns = ["doc_no", "product_code", "net_revenue", "return_value"]
    view = tables.sales_view(spark, folder, columns).withColumn("net_revenue_outlier", F.col("return_value") > 0)
    labelled = outliers.log_revenue(view).select(
        "doc_no", "product_code", "log_revenue", "outlier_state", (F.col("net_revenue") / reports.BILLION).alias("net_revenue_bn")
    )
    return rounded(labelled, log_revenue=8)


# Data quality


@query
def duplicate_flags(spark, folder):
    """Lines with the copies of lines that were sent twice, flagged."""
    raw = tables.raw_historical(spark, folder, ["doc_no", "product_code", "quantity", "gross_sales", "returned", "source_sheet"])
    return flag_duplicates(freeze(raw, "raw-historical"), stored=True)


@query
def duplicate_flag_count(spark, folder):
    raw = tables.raw_historical(spark, folder, ["doc_no", "customer_group", "channel", "source_sheet"])
    return flag_duplicates(raw).groupBy("source_sheet").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("is_duplicate").cast("long")).alias("flagged")
    )


def _clean_tables(spark, folder, raw_historical, raw_current):
    """The clean tables of the cleaning stage; both sources are cleaned and written once, as the stage does."""
    historical = freeze(clean_historical(raw_historical), "historical")
    current = freeze(clean_current(raw_current, _cost(spark, folder)), "current")
    return {
        "sales_historical_clean": historical,
        "sales_current_clean": current,
        "sales_final": unify_sales(historical, current),
    }


def _clean_portions(spark, folder, raw_historical, raw_current):
    """The same of sources in portions: what is stored are their parsed and flagged rows, and the current ones with their cost."""
    historical = clean_historical(raw_historical)
    current = freeze(clean_current(raw_current, _cost(spark, folder)), "current", compact=True)
    return {
        "sales_historical_clean": historical,
        "sales_current_clean": current,
        "sales_final": unify_sales(historical, current),
    }


@query
def quality_overview(spark, folder):
    """All tables of the cleaning stage; the raw sales are stored like its inputs, or, in portions, the lines they are made of."""
    parts = list(tables.portions(spark, folder))
    if len(parts) > 1:
        lines = [tables.stored_lines(spark, folder, p) for p in parts]
        historical = [tables.raw_historical(spark, folder, stored=df) for df in lines]
        current = [tables.raw_current(spark, folder, stored=df) for df in lines]
        raw_historical, raw_current = (reduce(DataFrame.unionByName, source) for source in (historical, current))
        cleaned = _clean_portions(spark, folder, historical, current)
    else:
        raw_historical = freeze(tables.raw_historical(spark, folder), "raw-historical")
        raw_current = freeze(tables.raw_current(spark, folder), "raw-current")
        cleaned = _clean_tables(spark, folder, raw_historical, raw_current)
    staged = {
        "raw_sales_historical": raw_historical,
        "raw_sales_current": raw_current,
        "raw_cost": tables.raw_cost(spark, folder).drop("row_order"),
        "cost_clean": _cost(spark, folder),
        **cleaned,
    }
    return quality.overviews(staged, quality.FLAGGED, stored=True)


@query
def duplicate_counts_with_flag(spark, folder):
    staged = _clean_tables(spark, folder, tables.raw_historical(spark, folder), tables.raw_current(spark, folder))
    return quality.duplicate_counts(staged, stored=True)


@query
def null_profile(spark, folder):
    return rounded(quality.null_profile(_current(spark, folder)), null_share=8)


@query
def scope_by_year(spark, folder):
    view = tables.sales_view(spark, folder, ["year", "doc_date", *kpi.COUNTS.values(), "net_revenue", "profit"])
    return rounded(quality.scope_by_year(view), net_revenue=4, profit=4, margin=8)


@query
def table_shape(spark, folder):
    return quality.shape(tables.sales_view(spark, folder, ["doc_date", "doc_no", "net_revenue"]))


@query
def column_profile(spark, folder):
    """Long profile of the orders table; numbers rounded as text."""
    orders = tables.read(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    profile = quality.column_profile(orders)
    number = F.col("metric").isin("mean", "std", "min", "max", "25%", "50%", "75%")
    value = F.when(number, F.round(F.col("value").try_cast("double"), 4)).otherwise(F.col("value").try_cast("double"))
    return profile.select("column_name", "metric", value.alias("number"), F.when(value.isNull(), F.col("value")).alias("label"))


# Star schema


STAR_COLUMNS = (
    "doc_date",
    "customer_code",
    "customer_name",
    "customer_group",
    "product_code",
    "product_name",
    "product_group",
    "product_type",
    "channel",
    "data_source",
)


@query
def dim_date(spark, folder):
    return star.dim_date(tables.sales_view(spark, folder, ["doc_date", "year", "month", "quarter", "year_month"]))


@query
def dim_customer(spark, folder):
    return star.dim_customer(tables.sales_view(spark, folder, ["doc_date", "data_source", "customer_code", *star.CUSTOMER_ATTRS]))


@query
def dim_customer_known(spark, folder):
    view = tables.sales_view(spark, folder, ["doc_date", "data_source", "customer_code", *star.CUSTOMER_ATTRS])
    return star.dim_customer(view, prefer="known")


@query
def dim_customer_ingest(spark, folder):
    """Attributes of each customer's first line in the input."""
    return star.dim_customer(tables.sales_view(spark, folder, ["customer_code", *star.CUSTOMER_ATTRS], ingest=True))


@query
def dim_product(spark, folder):
    return star.dim_product(tables.sales_view(spark, folder, ["doc_date", "data_source", "product_code", *star.PRODUCT_ATTRS]))


@query
def dim_channel(spark, folder):
    return star.dim_channel(tables.sales_view(spark, folder, ["channel"]))


@query
def fact_sales(spark, folder):
    columns = set(star.FACT_COLUMNS) - {"sales_id", "date_key", "customer_key", "product_key", "channel_key"}
    wanted = [*sorted(columns), *[c for c in STAR_COLUMNS if c not in columns]]
    view = tables.sales_view(spark, folder, wanted, spread=True, ingest=True)
    # The sales table is stored between the stages; each dimension then reads only its own columns.
    view = freeze(view, "sales")
    return star.fact_sales(view, star.dim_customer(view), star.dim_product(view), star.dim_channel(view))


# Marts


def _mart(name: str, grain) -> Query:
    def run(spark, folder):
        view = tables.sales_view(spark, folder, [*grain, *KPI_INPUT])
        return rounded(kpi.aggregate_kpi(view, grain), **KPI_DIGITS)

    run.__name__ = name
    return run


for _name, _grain in kpi.GRAINS.items():
    query(_mart(_name, _grain))


@query
def mart_pareto_customer_group(spark, folder):
    view = tables.sales_view(spark, folder, [*kpi.PARETO_GRAIN, *KPI_INPUT])
    mart = pareto_mart(kpi.aggregate_kpi(view, kpi.PARETO_GRAIN))
    return rounded(mart, **KPI_DIGITS, **_digits(PARETO_COLUMNS, 8))


@query
def marts_one_pass(spark, folder):
    """The ten marts as the mart stage builds them, from the stored sales table, stacked with their names."""
    columns = dict.fromkeys([*[c for g in kpi.GRAINS.values() for c in g], *kpi.PARETO_GRAIN, *KPI_INPUT])
    marts = kpi_marts(freeze(tables.sales_view(spark, folder, columns, spread=True), "sales"))
    named = [df.withColumn("mart", F.lit(name)) for name, df in marts.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return rounded(stacked, **KPI_DIGITS, **_digits(PARETO_COLUMNS, 8))


# Reports


@query
def ytd_kpi_yoy(spark, folder):
    view = tables.sales_view(spark, folder, ["year", "doc_date", *kpi.COUNTS.values(), "net_revenue", "profit"])
    digits = {**_digits(("net_revenue", "profit"), 4), **_digits(("net_revenue_bn", "profit_bn", "margin"), 8)}
    return rounded(reports.ytd_kpi(view), **digits, net_revenue_yoy=8, profit_yoy=8)


@query
def ytd_channel(spark, folder):
    view = tables.sales_view(spark, folder, ["year", "doc_date", "channel", "net_revenue", "profit"])
    return rounded(reports.ytd_channel(view), net_revenue=4, profit=4, margin=8)


@query
def ytd_channel_pivot(spark, folder):
    view = tables.sales_view(spark, folder, ["year", "doc_date", "channel", "net_revenue", "profit"])
    channels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return rounded(reports.channel_pivot(reports.ytd_channel(view), channels), **_digits(channels, 4))


@query
def ytd_product_group(spark, folder):
    columns = ["year", "doc_date", "product_group", "product_code", "net_revenue", "profit", "quantity"]
    report = reports.ytd_product_group(tables.sales_view(spark, folder, columns))
    return rounded(report, net_revenue=4, profit=4, quantity=4, margin=8)


@query
def ytd_pareto(spark, folder):
    view = tables.sales_view(spark, folder, ["year", "doc_date", "customer_group", "net_revenue"])
    return rounded(reports.ytd_pareto(view), net_revenue=4, **_digits(PARETO_COLUMNS, 8))


@query
def monthly_trend(spark, folder):
    grain = kpi.GRAINS["mart_time_month"]
    mart = kpi.aggregate_kpi(tables.sales_view(spark, folder, [*grain, *KPI_INPUT]), grain)
    trend = reports.monthly_trend(mart)
    return rounded(trend, net_revenue=4, profit=4, net_revenue_bn=8, profit_bn=8, margin=8)


@query
def report_positions(spark, folder):
    """Five reports as they are published, with the position of every row."""
    names = {"report_kpi": "year_month", "report_month_trend": "period_key", "report_channel": "channel",
             "report_product_group": "product_group", "report_pareto": "customer_group"}
    columns = ["year", "month", "year_month", "period", "doc_date", "channel", "product_group", "customer_group", *KPI_INPUT]
    view = freeze(tables.sales_view(spark, folder, columns, spread=True), "sales")
    found = {
        "report_kpi": reports.ytd_kpi(view).withColumn("year_month", F.lit(None).cast("string")),
        "report_month_trend": reports.monthly_trend(kpi.aggregate_kpi(view, kpi.GRAINS["mart_time_month"])),
        "report_channel": reports.ytd_channel(view),
        "report_product_group": reports.ytd_product_group(view),
        "report_pareto": reports.ytd_pareto(view),
    }
    stacked = [
        ordered(df, ORDERS[n]).select(F.lit(n).alias("report"), POSITION, "year", F.col(names[n]).alias("label"), "net_revenue")
        for n, df in found.items()
    ]
    return rounded(reduce(DataFrame.unionByName, stacked), net_revenue=4)


# Outliers


def _outlier_view(spark, folder, *more):
    """Stored like the sales table of the stages: quartiles and flags read it one after the other."""
    return freeze(tables.sales_view(spark, folder, ["doc_date", *outliers.METRICS, *more], spread=True), "sales")


# Eight digits: bounds of values with few decimals end after seven, so that none lies on a rounding tie.
SUMMARY_DIGITS = _digits(("q1", "q3", "iqr", "lower_bound", "upper_bound", "outlier_rate"), 8)


@query
def outlier_thresholds(spark, folder):
    limits = outliers.bounds(_outlier_view(spark, folder), factor=outliers.REPORT_FACTOR)
    return rounded(limits, **_digits(limits.columns, 8))


@query
def outlier_flags(spark, folder):
    """Flag and level of every line, for two metrics."""
    # Stored like the sales table of the stages: count, sketch, ranks and flags each read it.
    view = freeze(tables.sales_view(spark, folder, ["doc_no", "product_code", "net_revenue", "profit"], spread=True), "sales")
    flagged = outliers.flag_outliers(view, ["net_revenue", "profit"])
    return flagged.drop("net_revenue", "profit")


@query
def outlier_summary(spark, folder):
    return rounded(outliers.outlier_summary(_outlier_view(spark, folder)), **SUMMARY_DIGITS)


@query
def outlier_by_group(spark, folder):
    view = _outlier_view(spark, folder, "product_group")
    summary = outliers.outlier_summary(view, by="product_group", factor=outliers.ROW_FACTOR)
    return rounded(summary, **SUMMARY_DIGITS)


def _flagged_revenue(spark, folder):
    view = freeze(tables.sales_view(spark, folder, ["net_revenue", "product_group"], spread=True), "sales")
    return outliers.flag_outliers(view, ["net_revenue"])


@query
def revenue_box_stats(spark, folder):
    stats = outliers.box_stats(_flagged_revenue(spark, folder))
    return rounded(stats, **_digits(("q1", "median", "q3", "whisker_low", "whisker_high"), 8))


@query
def revenue_decades(spark, folder):
    return outliers.decade_range(outliers.log_revenue(_flagged_revenue(spark, folder)))


# Forecast (own design) and correlation


def _monthly(spark, folder):
    view = tables.sales_view(spark, folder, ["doc_date", "net_revenue", *FORECAST_KEYS])
    return view, fc.monthly_base(view, FORECAST_KEYS)


@query
def monthly_base(spark, folder):
    return rounded(_monthly(spark, folder)[1], net_revenue=4)


@query
def monthly_features(spark, folder):
    features = fc.monthly_features(_monthly(spark, folder)[1], FORECAST_KEYS)
    return rounded(features, net_revenue=4, trailing_mean=5, **{f"lag_{n}": 4 for n in fc.LAGS})


def _backtest(spark, folder):
    return fc.backtest(fc.monthly_features(_monthly(spark, folder)[1], FORECAST_KEYS), FORECAST_KEYS)


@query
def forecast_backtest(spark, folder):
    return rounded(_backtest(spark, folder), net_revenue=4, predicted=2, error=2)


@query
def forecast_metrics(spark, folder):
    return rounded(fc.model_metrics(_backtest(spark, folder), FORECAST_KEYS), mae=2, rmse=2, mape=6)


@query
def forecast_vs_actual(spark, folder):
    view, monthly = _monthly(spark, folder)
    history = monthly.filter(F.col("month_start") < F.lit(HISTORY_END))
    compared = fc.forecast_vs_actual(fc.forecast(history, FORECAST_KEYS), view, FORECAST_KEYS)
    return rounded(compared, forecast=2, actual=4, error=2, error_share=6)


@query
def indicator_corr(spark, folder):
    indicators = ["quantity", "gross_sales", "discount", "net_revenue", "profit"]
    return rounded(fc.correlations(tables.sales_view(spark, folder, indicators), indicators), correlation=6)
