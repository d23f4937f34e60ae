"""Source loaders: partitioned historical sales, current sales, product cost, published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom import schemas
from saleloom.functions.text import clean_text
from saleloom.operators.columns import existing, normalize_columns
from saleloom.operators.keys import INGEST
from saleloom.plans.cleaning import ROW_ORDER
from saleloom.sources.files import exists, size
from saleloom.sources.ingest import number_rows, placed

SMALL_BYTES_PER_CORE = 16 * 1024 * 1024


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    row_order: bool = False,
    **options: str,
) -> DataFrame:
    """One table of any Spark file format. CSV is read with its header, as text unless typed.

    ``row_order`` adds a sortable position in the input, for operators where the later row counts.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Quotes are doubled inside quoted fields. Pass multiLine=True for fields with line breaks; such
        # files cannot be split over tasks.
        reader = reader.options(header=True, escape='"')
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    if not row_order:
        return df
    inside = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    order = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), inside.alias("row")
    )
    return df.select("*", order.alias(ROW_ORDER))


def spread_small(df: DataFrame, path: str) -> DataFrame:
    """Spread the rows of a small input over all cores before costly work per row.

    One row group is read by one task, whatever the number of cores. An input with enough bytes for every
    core is left as it is: its files and row groups already make enough tasks.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size(spark, path) < SMALL_BYTES_PER_CORE * cores else df


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "source_sheet") -> DataFrame:
    """Stack tables by column name, columns missing on one side NULL, and name the part of each row."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _source(spark: SparkSession, path: str, fmt: str, layout, ingest: bool, rank: int, options: Mapping[str, str]) -> DataFrame:
    rows = read_table(spark, path, fmt, row_order=ingest, **options)
    return _named(spread_small(placed(rows, ROW_ORDER, rank) if ingest else rows, path), layout)


def load_historical(
    spark: SparkSession, partitions: Mapping[str, str], fmt: str = "parquet", ingest: bool = False, **options: str
) -> DataFrame:
    """Historical sales from several partitions (name -> path), e.g. one per year.

    ``ingest`` adds the position of every row in the input: partitions in the given order, then files by path.
    """
    parts = {
        name: _source(spark, path, fmt, schemas.HISTORICAL, ingest, rank, options)
        for rank, (name, path) in enumerate(partitions.items())
    }
    stacked = union_tagged(parts)
    return number_rows(stacked) if ingest else stacked


def load_current(spark: SparkSession, path: str, fmt: str = "parquet", ingest: bool = False, **options: str) -> DataFrame:
    """Current sales; ``ingest`` adds the position of every row in the input."""
    rows = _source(spark, path, fmt, schemas.CURRENT, ingest, 0, options)
    return number_rows(rows) if ingest else rows


def load_cost(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return _named(read_table(spark, path, fmt, row_order=True, **options), schemas.COST)


def _named(df: DataFrame, layout) -> DataFrame:
    return schemas.to_canonical(normalize_columns(df), layout)


def load_sales(spark: SparkSession, path: str, fmt: str = "parquet", ingest: bool = False) -> DataFrame:
    """The published unified sales table, typed, with its text columns cleaned again.

    ``ingest`` keeps the position of every row in the input, if the table was published with it.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} does not exist: run the cleaning stage first")
    names = schemas.columns(schemas.SALES)
    if fmt == "csv":
        # The file's own header may carry business names.
        raw = read_table(spark, path, fmt)
        df = schemas.to_canonical(raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns]), schemas.SALES)
        kept = [F.col(INGEST).cast("long").alias(INGEST)] if ingest and INGEST in df.columns else []
        df = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in schemas.types(schemas.SALES).items()], *kept)
    else:
        df = schemas.to_canonical(read_table(spark, path, fmt), schemas.SALES)
        df = df.select(*names, *([INGEST] if ingest and INGEST in df.columns else []))
    return df.withColumns({c: clean_text(F.col(c)) for c in schemas.names_of_type(schemas.SALES, schemas.STR)})


def load_mart(spark: SparkSession, root: str, name: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """One published mart."""
    df = read_table(spark, f"{root}/{name}", fmt)
    return existing(df, columns) if columns else df
