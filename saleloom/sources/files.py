"""Hadoop file-system helpers: the same code for a local disk and for object stores."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    hadoop, fs = _path(spark, path)
    return fs.getContentSummary(hadoop).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, sorted; empty if it does not exist."""
    hadoop, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def require_inputs(spark: SparkSession, inputs: Mapping[str, str]) -> dict[str, str]:
    """All inputs must exist; the error names every one that does not."""
    missing = [f"{name}: {path}" for name, path in inputs.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")
    return dict(inputs)


MARKER = "_saleloom_stage"


def claim_stage(spark: SparkSession, root: str) -> None:
    """Mark ``root`` as an output folder of this engine. A folder with other content is refused."""
    hadoop, fs = _path(spark, f"{root}/{MARKER}")
    if fs.exists(hadoop):
        return
    if children(spark, root):
        raise ValueError(f"{root} holds files that this engine did not write")
    fs.mkdirs(hadoop.getParent())
    fs.create(hadoop, False).close()


def drop_stale(spark: SparkSession, root: str, keep: Iterable[str]) -> list[str]:
    """Delete the tables in a claimed output folder that are not in ``keep``."""
    if not exists(spark, f"{root}/{MARKER}"):
        raise ValueError(f"{root} is not an output folder of this engine")
    stale = [n for n in children(spark, root) if n not in set(keep) and not n.startswith(("_", "."))]
    for name in stale:
        hadoop, fs = _path(spark, f"{root}/{name}")
        fs.delete(hadoop, True)
    return stale
