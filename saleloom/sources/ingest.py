"""Position of every row in its input, carried from the reader to the published tables.

The order of the input decides which row of equal ones is the first, which attributes a dimension takes and which
``sales_id`` a line gets. It must not depend on cores, splits or task order, so it is derived from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.operators.joins import lookup_join
from saleloom.operators.keys import INGEST, running_offsets

_BLOCK = ("__rank", "__file", "__block")


def placed(df: DataFrame, place: str, rank: int = 0) -> DataFrame:
    """Replace ``place`` (file, block, row), as the reader gives it, by columns that ``number_rows`` understands."""
    parts = {"__rank": F.lit(rank), "__file": F.col(f"{place}.file"), "__block": F.col(f"{place}.block"), "__row": F.col(f"{place}.row")}
    return df.withColumns(parts).drop(place)


def number_rows(df: DataFrame, name: str = INGEST) -> DataFrame:
    """Number ``placed`` rows 0, 1, ... in input order: by rank, file path, block, then row.

    Rows keep their places. Only one figure per file block is computed and summed up, so nothing is sorted.
    """
    blocks = df.groupBy(*_BLOCK).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__size"))
    offsets = running_offsets(blocks.withColumn("__part", F.struct(*_BLOCK)), [], "__part", "__size", "__offset")
    numbered = lookup_join(df, offsets.select(*_BLOCK, "__first", "__offset"), list(_BLOCK))
    position = F.col("__offset") + F.col("__row") - F.col("__first")
    return numbered.withColumn(name, position).drop(*_BLOCK, "__row", "__first", "__offset")

