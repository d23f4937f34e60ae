"""Exact quantiles with linear interpolation, for tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleloom.functions.numbers import finite_or_null
from saleloom.operators.joins import lookup_join
from saleloom.operators.keys import partition_of, running_offsets
from saleloom.operators.work import freeze

# Up to this many rows the built-in aggregate is used; it buffers the distinct values of a group.
SMALL_ROWS = 1_000_000
ACCURACY = 1_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """One row per group: for every column an array of its quantiles, NULL if it has no finite value.

    The result is computed here and stored, since callers read it several times.
    Above ``small_rows`` rows the answer comes from distributed passes. A sketch brackets each quantile;
    only values inside the bracket, about 0.4 % of the rows, are counted, range-sorted and ranked. The
    ranks are checked afterwards, so a bracket that missed its target is replaced by the whole range.
    """
    by, values = list(by), {c: finite_or_null(F.col(f"`{c}`").cast("double")) for c in columns}
    narrow = df.select(*by, *[v.alias(c) for c, v in values.items()])
    if narrow.count() <= small_rows:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        small = narrow.groupBy(*by).agg(*[F.percentile(F.col(f"`{c}`"), wanted).alias(c) for c in columns])
        return freeze(small, "quantiles")
    return _distributed(narrow, list(columns), list(probabilities), by)


def _distributed(df: DataFrame, columns: list[str], probabilities: list[float], by: list[str]) -> DataFrame:
    targets = [(i, j) for i in range(len(columns)) for j in range(len(probabilities))]
    # Names free of the caller's spelling: v0, v1, ... for the columns.
    df = df.select(*by, *[F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(columns)])
    margin = 2.0 / ACCURACY
    ends = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)]
    sketch = df.groupBy(*by).agg(
        *[F.count(f"__v{i}").alias(f"__n{i}") for i in range(len(columns))],
        *[F.percentile_approx(f"__v{i}", ends, ACCURACY).alias(f"__e{i}") for i in range(len(columns))],
    )
    brackets = freeze(sketch, "quantile-brackets")
    found = _rank(df, brackets, columns, probabilities, by, targets, lambda i, j: (F.col(f"__e{i}")[2 * j], F.col(f"__e{i}")[2 * j + 1]))
    if found.filter(F.col("__n").isNotNull() & (F.col("__n") > 0) & (F.col("__lo").isNull() | F.col("__hi").isNull())).limit(1).count():
        infinite = F.lit(float("inf"))
        found = _rank(df, brackets, columns, probabilities, by, targets, lambda i, j: (-infinite, infinite))
    one = {
        (i, j): F.max(F.when((F.col("__i") == i) & (F.col("__j") == j), F.col("__q"))) for i, j in targets
    }
    arrays = [F.array(*[one[i, j] for j in range(len(probabilities))]) for i in range(len(columns))]
    wide = found.groupBy(*by).agg(*[a.alias(f"__a{i}") for i, a in enumerate(arrays)])
    return wide.select(
        *by, *[F.when(F.col(f"__a{i}")[0].isNotNull(), F.col(f"__a{i}")).alias(c) for i, c in enumerate(columns)]
    )


def _rank(df, brackets, columns, probabilities, by, targets, bracket) -> DataFrame:
    """Per group and target the values at the two ranks around the quantile, and the quantile."""
    if by:
        rows = lookup_join(df, brackets, by)
    else:
        # One bracket row: its columns come in as scalar subqueries.
        rows = df.withColumns({c: brackets.select(c).scalar() for c in brackets.columns})
    inside, below = [], []
    for i, j in targets:
        low, high = bracket(i, j)
        value = F.col(f"__v{i}")
        inside.append(F.struct(F.lit(i).alias("__i"), F.lit(j).alias("__j"), F.when(value.between(low, high), value).alias("__v")))
        below.append(F.sum((value < low).cast("long")).alias(f"__b{i}_{j}"))
    smaller = rows.groupBy(*by).agg(*below)
    kept = rows.select(*by, F.inline(F.filter(F.array(*inside), lambda s: s["__v"].isNotNull())))
    counted = kept.groupBy(*by, "__i", "__j", "__v").agg(F.count(F.lit(1)).alias("__c"))
    group = [*by, "__i", "__j"]
    placed = counted.repartitionByRange(*group, "__v").sortWithinPartitions(*group, "__v")
    ranked = freeze(placed.withColumn("__part", partition_of(F.monotonically_increasing_id())), "quantile-values")
    sizes = ranked.groupBy(*group, "__part").agg(F.sum("__c").alias("__size"))
    offsets = running_offsets(sizes, group, "__part", "__size", "__offset").drop("__size")
    in_part = Window.partitionBy(*group, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = lookup_join(ranked.withColumn("__upto", F.sum("__c").over(in_part)), offsets, [*group, "__part"])
    counts = _targets_table(brackets, smaller, columns, probabilities, by, targets)
    placed_rows = lookup_join(running, counts, group).withColumn("__end", F.col("__below") + F.col("__offset") + F.col("__upto"))
    position = F.col("__p") * (F.col("__n") - 1)

    def at(rank: Column) -> Column:
        hit = (F.col("__end") - F.col("__c") <= rank) & (rank < F.col("__end"))
        return F.max(F.when(hit, F.col("__v")))

    values = placed_rows.groupBy(*group).agg(at(F.floor(position)).alias("__lo"), at(F.ceil(position)).alias("__hi"))
    result = lookup_join(counts, values, group)
    part = position - F.floor(position)
    quantile = F.when(part == 0, F.col("__lo")).otherwise(F.col("__lo") + (F.col("__hi") - F.col("__lo")) * part)
    return freeze(result.select(*group, "__n", "__lo", "__hi", quantile.alias("__q")), "quantiles")


def _targets_table(brackets, smaller, columns, probabilities, by, targets) -> DataFrame:
    """One row per group and target: valid rows, rows below the bracket, probability."""
    figures = lookup_join(brackets, smaller, by) if by else brackets.withColumns({c: smaller.select(c).scalar() for c in smaller.columns})
    rows = [
        F.struct(
            F.lit(i).alias("__i"),
            F.lit(j).alias("__j"),
            F.col(f"__n{i}").alias("__n"),
            F.coalesce(F.col(f"__b{i}_{j}"), F.lit(0).cast("long")).alias("__below"),
            F.lit(float(probabilities[j])).alias("__p"),
        )
        for i, j in targets
    ]
    return figures.select(*by, F.inline(F.array(*rows)))
