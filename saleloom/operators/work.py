"""Materialised intermediate tables in the shared work folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = 7 << 19  # for whole texts: a batch is held several times on its way to the Python worker


def work_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="saleloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def freeze(df: DataFrame, name: str, arrow_bytes: int | None = None, compact: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    This cuts the lineage, survives the loss of executors, and fixes values that another evaluation
    could produce differently (partition numbers). Readers still prune columns. With ``arrow_bytes`` the Python workers
    of this write get Arrow batches of about so many bytes. ``compact`` is for tables that would fill the disk: they are
    stored with zstd, and the shuffle files of the write go when it is done, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/saleloom/{name}-{uuid.uuid4().hex}"
    wanted = {} if arrow_bytes is None else {ARROW_SETTING: str(arrow_bytes)}
    if compact:
        wanted[CLEANUP_SETTING] = "true"
    usual = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        (df.write.option("compression", "zstd") if compact else df.write).parquet(path)
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def freeze_texts(df: DataFrame, name: str) -> DataFrame:
    """``freeze`` for steps whose Python workers get whole texts, in Arrow batches of ``ARROW_BYTES``."""
    return freeze(df, name, ARROW_BYTES)
