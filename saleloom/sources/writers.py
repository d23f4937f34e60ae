"""Table sinks and stage publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from saleloom import schemas
from saleloom.sources.files import claim_stage, drop_stale

BYTE_ORDER_MARK = "\ufeff"
BUNDLE_NAME_LENGTH = 31


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    business_names: bool = False,
) -> None:
    """Overwrite one table. CSV gets a header with a byte-order mark, as spreadsheet tools expect.

    Partitioned tables are first rebalanced on the partition columns, which splits a partition that owns
    most of the rows, so that files are neither tiny nor huge.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if business_names:
        df = schemas.to_business(df)
        partition_by = [schemas.UNIFIED_NAMES.get(c, c) for c in partition_by]
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        df = df.toDF(BYTE_ORDER_MARK + df.columns[0], *df.columns[1:])
        writer = df.write.mode("overwrite").options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    fmt: str = "parquet",
    partition_by: Mapping[str, Sequence[str]] | None = None,
    business_names: bool = False,
    also_keep: Sequence[str] = (),
) -> dict[str, str]:
    """Write each table to ``root/name`` and drop tables of an earlier run that are not written now."""
    claim_stage(spark, root)
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}"
        write_table(df, paths[name], fmt, (partition_by or {}).get(name, ()), business_names)
    drop_stale(spark, root, [*tables, *also_keep])
    return paths


def bundle_names(names: Sequence[str], short: bool = True) -> dict[str, str]:
    """Names in the result bundle, cut to the length spreadsheet tools accept. A clash is an error."""
    cut = {n: n[:BUNDLE_NAME_LENGTH] if short else n for n in names}
    clashes = sorted({c for c in cut.values() if list(cut.values()).count(c) > 1})
    if clashes:
        raise ValueError(f"bundle names collide: {', '.join(clashes)}")
    return cut


def publish_bundle(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    fmt: str = "csv",
    short_names: bool = True,
    business_names: bool = False,
) -> dict[str, str]:
    """All result tables but the fact under one folder."""
    chosen = {n: df for n, df in tables.items() if n != "fact_sales"}
    names = bundle_names(list(chosen), short_names)
    return publish(spark, root, {names[n]: df for n, df in chosen.items()}, fmt, business_names=business_names)
