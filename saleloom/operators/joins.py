"""Left lookup join that survives a large lookup side and a hot key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 5_000_000


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows, measured: text by its length, every other column as 8 bytes."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    row = reduce(lambda a, b: a + b, text, F.lit(16 + 8 * len(df.columns))).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0).cast("long"))).first()[0]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: str | Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` left-joined to ``lookup`` (unique on ``keys``); a NULL key matches the NULL key.

    The lookup is broadcast only if its measured size is below ``broadcast_bytes``. Otherwise the join
    shuffles, and keys that own more than ``hot_rows`` rows are spread over several tasks by a salt.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in lookup.columns if c not in keys]
    right = lookup.withColumnsRenamed({k: f"__{k}" for k in keys})
    if measured_bytes(lookup) <= broadcast_bytes:
        right = F.broadcast(right)
    else:
        rows, right = _salted(rows, right, keys, hot_rows)
        if "__salt" in right.columns:
            keys = [*keys, "__row_salt"]
            right = right.withColumnRenamed("__salt", "____row_salt")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(right, on, "left").select(*[c for c in rows.columns if c != "__row_salt"], *values)


def _salted(rows: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Number both sides of the hot keys: rows get one salt each, lookup rows are repeated per salt."""
    # Every key that owns more than hot_rows rows: a table of at most rows / hot_rows lines.
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    hot = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.ceil(F.col("n") / hot_rows).alias("__salts"))
    if not hot.limit(1).count():
        return rows, right

    def with_salts(df: DataFrame, prefix: str) -> DataFrame:
        on = reduce(lambda a, b: a & b, [F.col(f"{prefix}{k}").eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
        return df.join(F.broadcast(hot), on, "left").drop(*[f"__hot_{k}" for k in keys])

    # The partition number tells equal rows apart and, unlike a random number, stays the same when a
    # lost task runs again.
    spread = F.xxhash64(*rows.columns, F.spark_partition_id())
    salts = F.coalesce(F.col("__salts"), F.lit(1).cast("long"))
    of_row = with_salts(rows, "").withColumn("__row_salt", F.pmod(spread, salts) + 1).drop("__salts")
    of_lookup = with_salts(right, "__").withColumn("__salt", F.explode(F.sequence(F.lit(1).cast("long"), salts)))
    return of_row, of_lookup.drop("__salts")
