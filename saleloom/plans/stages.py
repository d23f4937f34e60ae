"""Stage runners: cleaning, marts, forecast, bundle, and the whole run."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleloom import vocab
from saleloom.operators import forecast as fc
from saleloom.functions.dates import DATE_FORMATS
from saleloom.operators.date_formats import elect
from saleloom.operators.keys import INGEST
from saleloom.operators.quality import FLAGGED, overviews
from saleloom.operators.work import freeze
from saleloom.plans.cleaning import ROW_ORDER, clean_cost, clean_current, clean_historical
from saleloom.plans.marts import all_marts
from saleloom.plans.reports import ordered_reports
from saleloom.plans.unify import unify_sales
from saleloom.sources.files import children, require_inputs
from saleloom.sources.readers import load_cost, load_current, load_historical, load_sales, read_table
from saleloom.sources.writers import publish, publish_bundle, write_table

FORMAT_SUFFIXES = frozenset({"parquet", "csv", "orc", "json", "txt", "tsv", "avro"})


@dataclass(frozen=True)
class Layout:
    """Input and output locations. ``historical`` is a folder with one sub-folder or file per partition."""

    historical: str
    current: str
    cost: str
    output: str
    input_format: str = "parquet"
    output_format: str = "parquet"

    @property
    def staging(self) -> str:
        return f"{self.output}/staging"

    @property
    def clean(self) -> str:
        return f"{self.output}/clean"

    @property
    def mart(self) -> str:
        return f"{self.output}/mart"

    @property
    def model(self) -> str:
        return f"{self.output}/model"

    @property
    def report(self) -> str:
        return f"{self.output}/report"

    @property
    def bundle(self) -> str:
        return f"{self.output}/bundle"


def _stored(tables: Mapping[str, DataFrame], fmt: str) -> dict[str, DataFrame]:
    """Tables that are published in a text format are stored once first: every reader then finds typed, finished rows."""
    return dict(tables) if fmt == "parquet" else {n: freeze(df, n) for n, df in tables.items()}


def _republished(spark: SparkSession, paths: Mapping[str, str], tables: Mapping[str, DataFrame], fmt: str):
    """The tables as they were written: later stages read files instead of repeating the work."""
    if fmt != "parquet":
        return dict(tables)
    return {n: read_table(spark, paths[n], fmt).select(*tables[n].columns) for n in tables}


def sheet_paths(folder: str, names: Sequence[str]) -> dict[str, str]:
    """Sheet name -> path of the tables in ``folder``. Only a known format suffix is cut off; a clash is an error."""
    sheets: dict[str, str] = {}
    for name in names:
        if name.startswith(("_", ".")):
            continue
        stem, _, suffix = name.rpartition(".")
        sheet = stem if stem and suffix.lower() in FORMAT_SUFFIXES else name
        if sheet in sheets:
            raise ValueError(f"two inputs are named {sheet}: {sheets[sheet]} and {folder}/{name}")
        sheets[sheet] = f"{folder}/{name}"
    return sheets


def _formats(raw: DataFrame, date_formats: Sequence[str] | None) -> Sequence[str]:
    """The given date formats, else those that the document dates of the table elect."""
    if date_formats:
        return date_formats
    elected = elect(raw, ["doc_date"]) if "doc_date" in raw.columns else {}
    return elected["doc_date"].formats if elected else DATE_FORMATS


def run_cleaning(spark: SparkSession, layout: Layout, date_formats: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Read, clean, enrich, unify; publish three raw and three clean tables, the sales table, the overview.

    ``date_formats`` are tried in order; without them each source elects whether day or month comes first.

    Each published Parquet table is read back and feeds the next step, so nothing is cleaned twice and a
    lost executor costs one task.
    """
    fmt = layout.output_format
    require_inputs(spark, {"historical": layout.historical, "current": layout.current, "cost": layout.cost})
    sheets = sheet_paths(layout.historical, children(spark, layout.historical))
    cost_input = load_cost(spark, layout.cost, layout.input_format)
    raw = {
        "raw_sales_historical": load_historical(spark, sheets, layout.input_format, ingest=True),
        "raw_sales_current": load_current(spark, layout.current, layout.input_format, ingest=True),
        "raw_cost": cost_input.drop(ROW_ORDER),
    }
    raw |= _stored({"raw_sales_historical": raw["raw_sales_historical"]}, fmt)
    clean = {"sales_historical_clean": clean_historical(raw["raw_sales_historical"], date_formats=_formats(raw["raw_sales_historical"], date_formats)), "cost_clean": clean_cost(cost_input)}
    staged = _stored({**raw, **clean}, fmt)
    done = publish(spark, layout.staging, staged, fmt, also_keep=["sales_current_clean"])
    staged = _republished(spark, done, staged, fmt)
    current = _stored({"current": clean_current(
        staged["raw_sales_current"], staged["cost_clean"], date_formats=_formats(staged["raw_sales_current"], date_formats))}, fmt)["current"]
    current_path = f"{layout.staging}/sales_current_clean"
    write_table(current, current_path, fmt)
    staged |= _republished(spark, {"sales_current_clean": current_path}, {"sales_current_clean": current}, fmt)

    sales = unify_sales(staged["sales_historical_clean"], staged["sales_current_clean"])
    final = _stored({"sales_final": sales}, fmt)
    by = {"sales_final": ["year"]} if fmt == "parquet" else {}
    done = publish(spark, layout.clean, final, fmt, by, also_keep=["data_quality_overview"])
    final = _republished(spark, done, final, fmt)
    order = [
        "raw_sales_historical",
        "raw_sales_current",
        "raw_cost",
        "sales_historical_clean",
        "sales_current_clean",
        "cost_clean",
    ]
    quality = overviews({n: df.drop(INGEST) for n, df in {**{n: staged[n] for n in order}, **final}.items()}, FLAGGED, stored=True)
    quality_path = f"{layout.clean}/data_quality_overview"
    write_table(quality, quality_path, fmt)
    checked = _republished(spark, {"data_quality_overview": quality_path}, {"data_quality_overview": quality}, fmt)
    return {**staged, **final, **checked}


def _sales(spark: SparkSession, layout: Layout, sales: DataFrame | None) -> DataFrame:
    return load_sales(spark, f"{layout.clean}/sales_final", layout.output_format, ingest=True) if sales is None else sales


def run_marts(spark: SparkSession, layout: Layout, sales: DataFrame | None = None) -> dict[str, DataFrame]:
    """Publish the star schema and the marts, one table each."""
    fmt = layout.output_format
    marts = _stored(all_marts(_sales(spark, layout, sales)), fmt)
    paths = publish(spark, layout.mart, marts, fmt)
    return _republished(spark, paths, marts, fmt)


def run_reports(spark: SparkSession, layout: Layout, sales: DataFrame | None = None) -> dict[str, DataFrame]:
    """Publish the reports, each in its display order with a ``position``."""
    fmt = layout.output_format
    tables = ordered_reports(_sales(spark, layout, sales))
    paths = publish(spark, layout.report, tables, fmt)
    return _republished(spark, paths, tables, fmt)


def first_current_month(sales: DataFrame) -> datetime.date | None:
    """First month of the current source, if there is history before it; else None."""
    source, date = F.col("data_source"), F.col("doc_date")
    first = F.min(F.when(source == vocab.SOURCE_CURRENT, date)).alias("first")
    found = sales.agg(first, F.min(F.when(source == vocab.SOURCE_HISTORICAL, date)).alias("known")).first()
    if found["first"] is None or found["known"] is None:
        return None
    month = found["first"].date().replace(day=1)
    return month if found["known"].date() < month else None


def forecast_tables(
    sales: DataFrame, history_end: datetime.date | None = None, horizon: int = fc.HORIZON
) -> dict[str, DataFrame]:
    """Monthly base, features, backtest, metrics, forecast and comparison (see ``operators.forecast``).

    The forecast knows only the months before ``history_end``. By default history ends where the current source begins,
    so that the forecast months can be compared with their sales; with one source only, all months are known.
    """
    history_end = history_end or first_current_month(sales)
    # A small table that every later step reads.
    monthly = freeze(fc.monthly_base(sales), "monthly-base")
    features = fc.monthly_features(monthly)
    tested = fc.backtest(features)
    history = monthly.filter(F.col("month_start") < F.lit(history_end)) if history_end else monthly
    predicted = fc.forecast(history, horizon=horizon)
    return {
        "monthly_model_base": monthly,
        "monthly_model_data": features,
        "backtest_revenue": tested,
        "model_revenue_metrics": fc.model_metrics(tested),
        "forecast_revenue": predicted,
        "forecast_vs_actual": fc.forecast_vs_actual(predicted, sales),
    }


def run_forecast(
    spark: SparkSession,
    layout: Layout,
    sales: DataFrame | None = None,
    history_end: datetime.date | None = None,
    horizon: int = fc.HORIZON,
) -> dict[str, DataFrame]:
    """Publish the forecast tables; the comparison goes with the marts."""
    fmt = layout.output_format
    tables = _stored(forecast_tables(_sales(spark, layout, sales), history_end, horizon), fmt)
    comparison = {"forecast_vs_actual": tables["forecast_vs_actual"]}
    model = {n: df for n, df in tables.items() if n not in comparison}
    paths = publish(spark, layout.model, model, fmt)
    path = f"{layout.mart}/forecast_vs_actual"
    write_table(comparison["forecast_vs_actual"], path, fmt)
    return _republished(spark, {**paths, "forecast_vs_actual": path}, tables, fmt)


def run_all(
    spark: SparkSession, layout: Layout, history_end: datetime.date | None = None, date_formats: Sequence[str] | None = None
) -> dict[str, dict[str, DataFrame]]:
    """Clean, build marts, forecast, and publish everything but the fact as one bundle."""
    cleaning = run_cleaning(spark, layout, date_formats)
    marts = run_marts(spark, layout, cleaning["sales_final"])
    model = run_forecast(spark, layout, cleaning["sales_final"], history_end)
    bundle = {
        "data_quality": cleaning["data_quality_overview"],
        "sales_final": cleaning["sales_final"].drop(INGEST),
        **model,
        **marts,
    }
    publish_bundle(spark, layout.bundle, bundle, "csv")
    reports = run_reports(spark, layout, cleaning["sales_final"])
    return {"cleaning": cleaning, "marts": marts, "model": model, "reports": reports}
