"""Dense 1-based surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleloom.operators.work import freeze

INGEST = "ingest_order"  # position of a row in its input, 0, 1, ...
_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition number, then row position


def partition_of(row_id: Column) -> Column:
    return F.shiftright(row_id, _POSITION_BITS)


def running_offsets(parts: DataFrame, by: Sequence[str], part: str, size: str, offset: str) -> DataFrame:
    """Rows before each partition. ``parts`` holds one row per partition, so one window task is enough."""
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(offset, F.coalesce(F.sum(size).over(before), F.lit(0).cast("long")))


def dense_keys(df: DataFrame, key: str, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Prepend ``key`` = 1..n in ``order_by`` order (nulls last); in partition order if there is none.

    Rows are range-partitioned and sorted inside their partitions, frozen, and numbered by adding the
    row count of all earlier partitions. Freezing is required: the range bounds come from a sample,
    and the offsets must belong to the same layout. Rows that tie on all order columns spread over
    neighbouring partitions by the number of the partition they came from.
    """
    order = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order_by]
    if order:
        tie = F.col("__from")
        placed = df.withColumn("__from", F.spark_partition_id())
        placed = placed.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop("__from")
    else:
        placed = df
    numbered = freeze(placed.withColumn("__at", F.monotonically_increasing_id()), key)
    part = partition_of(F.col("__at"))
    parts = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    offsets = running_offsets(parts, [], "__part", "__size", "__offset").select("__part", "__offset")
    position = F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One offset row per partition of the frozen table: a bounded broadcast.
    return numbered.join(F.broadcast(offsets), part == offsets["__part"]).select(
        (F.col("__offset") + position + 1).alias(key), *df.columns
    )


def is_dense(df: DataFrame, position: str = INGEST) -> bool:
    """Whether the positions are 0, 1, ..., n - 1. They are distinct by construction, so their ends tell."""
    low, high, known, rows = df.agg(F.min(position), F.max(position), F.count(position), F.count(F.lit(1))).first()
    return rows == 0 or (low == 0 and known == rows and high == rows - 1)
