"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

A logistic model on character and word statistics gives each document a likelihood ratio. The expected number of good
documents of each path is summed up, then of each host; a host's posterior share is shrunk towards the global one, a
path's towards its host's. How strongly is estimated from the spread between the sites: a site with few documents
follows its parent, one with many follows its own. A document's final log odds are its likelihood ratio plus the prior
log odds of its path, computed without the document itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom.llm.chunks import slices
from saleloom.llm.shingles import word_hashes
from saleloom.operators.work import ARROW_BYTES, freeze

LABELLED = 20_000  # bound of the labelled sample that the model is fitted on
BROADCAST_SITES = 200_000  # the table of paths is broadcast up to so many rows
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "$%&*#!|@^~_=+<>{}[]\\/"]] = True
_KINDS = {
    "symbol": _SYMBOLS,
    "upper": np.isin(np.arange(256), np.arange(65, 91)),
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "blank": np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]),
    "stop": np.isin(np.arange(256), [ord("."), ord(","), ord(";"), ord(":"), ord("?")]),
    "high": np.arange(256) >= 128,
}
FEATURES = (*_KINDS, "repeated", "adjacent", "top_word", "word_length", "words", "few_words")


def features(texts: pa.Array) -> np.ndarray:
    """Statistics of each whole text (texts x FEATURES); an empty text has zeros."""
    words, bounds = word_hashes(texts)
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)
    size = np.maximum(np.diff(offsets), 1)
    columns = []
    for flags in _KINDS.values():
        total = np.append(0, np.cumsum(flags[data[offsets[0] : offsets[-1]]]))
        columns.append((total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]) / size)
    rest = np.zeros((len(texts), len(FEATURES) - len(columns)))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        n = b - a
        if n:
            own = words[a:b]
            _, times = np.unique(own, return_counts=True)
            # Word repetition grows with length even in good prose: compare it with a text of the same length.
            rest[i, 0] = np.log(n / len(times)) / np.log(n + 10.0)
            rest[i, 1] = (own[1:] == own[:-1]).mean() if n > 1 else 0.0
            rest[i, 2] = times.max() / (n + 10.0)
            rest[i, 3] = np.log1p(size[i] / n) / 3
            rest[i, 4] = np.log1p(n) / 10
            rest[i, 5] = 1.0 / (1.0 + n / 8.0)
    return np.column_stack([*columns, rest])


def fit(inputs: np.ndarray, good: np.ndarray, penalty: float = 1.0, steps: int = 30) -> dict:
    """Ridge logistic regression by Newton steps on standardised features."""
    mean, scale = inputs.mean(axis=0), np.maximum(inputs.std(axis=0), 1e-6)
    x = np.column_stack([np.ones(len(inputs)), (inputs - mean) / scale])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(hessian, x.T @ (good - p) - ridge * weights)
        weights += move
        if np.abs(move).max() < 1e-6:
            break
    share = float(np.clip(good.mean(), 1e-3, 1 - 1e-3))
    return {"mean": mean, "scale": scale, "weights": weights, "prior": float(np.log(share / (1 - share)))}


def train(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> dict:
    """Model from at most ``bound`` labelled documents, those with the least hash of their id.

    Rows without a label, id or text are left out. Only features of the sample reach the driver. Without labels of
    both kinds the model has no evidence and every document keeps the prior.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).cast("double").alias("good"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = pa.array(list(features(batch.column(1))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["good", "features"])

    sample = rows.join(chosen, "doc_id").select("good", "text").mapInArrow(measure, "good double, features array<double>")
    found = sample.limit(2 * bound).collect()
    good = np.array([r["good"] for r in found])
    if not len(good) or good.min() == good.max():
        n = len(FEATURES)
        share = float(np.clip(good.mean() if len(good) else 0.5, 0.01, 0.99))
        return {"mean": np.zeros(n), "scale": np.ones(n), "weights": np.append(np.log(share / (1 - share)), np.zeros(n)), "prior": float(np.log(share / (1 - share)))}
    return fit(np.array([r["features"] for r in found]), good)


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _shrinkage(sites: DataFrame, parent: Column) -> float:
    """Prior weight, in documents, of a parent's share: by moments, from the spread of the sites around it."""
    share, n = F.col("good") / F.col("n"), F.col("n")
    row = sites.select(
        F.sum(n * (share - parent) * (share - parent)).alias("between"), F.sum(n).alias("n"),
        F.count(F.lit(1)).alias("sites"), F.avg(parent * (1 - parent)).alias("within")).first()
    if not row["n"] or row["sites"] < 2 or not row["within"]:
        return 10.0
    # n * variance of a site's share is within + (n - 1) * between-site variance.
    spread = max(row["between"] / row["sites"] - row["within"], 0.0) / max(row["n"] / row["sites"] - 1.0, 1.0)
    return float(np.clip(row["within"] / spread - 1.0, 1.0, 1e4)) if spread > 0 else 1e4


def with_evidence(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and evidence double, the log likelihood ratio of each whole text. No shuffle."""
    columns = [c for c in docs.columns if c != "evidence"]
    weights, mean, scale, prior = model["weights"], model["mean"], model["scale"], model["prior"]
    at = columns.index(text_col)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(0).field(at).cast(pa.string()).fill_null("")
            found = weights[0] + ((features(texts) - mean) / scale) @ weights[1:] - prior
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(found, -20, 20))], ["doc", "evidence"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    weighed = packed.mapInArrow(weigh, T.StructType([packed.schema["doc"], T.StructField("evidence", T.DoubleType())]))
    return weighed.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns], "evidence")


def combine(weighed: DataFrame, prior: float, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """``weighed`` (a stored table with evidence) with host_share, path_share, quality and keep.

    Sites are summed with map-side combination, paths first and hosts from their paths; only the two prior weights and
    the global share reach the driver. The table of paths is broadcast up to ``BROADCAST_SITES`` rows.
    """
    added = ("host_share", "path_share", "quality", "keep")
    columns = [c for c in weighed.columns if c not in added]
    own = _sigmoid(F.col("evidence") + prior)
    rows = weighed.select(*columns).withColumns({
        "__host": F.coalesce(host.cast("string"), F.lit("")), "__path": F.coalesce(path.cast("string"), F.lit("")), "__own": own})
    paths = freeze(rows.groupBy("__host", "__path").agg(F.sum("__own").alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("__host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    share = float(whole["good"] / whole["n"]) if whole["n"] else 0.5
    host_weight = _shrinkage(hosts, F.lit(share))
    named = hosts.select("__host", F.col("good").alias("__host_good"), F.col("n").alias("__host_n"))
    sites = paths.select("__host", "__path", F.col("good").alias("__path_good"), F.col("n").alias("__path_n")).join(named, "__host")
    parent = (host_weight * share + F.col("__host_good")) / (host_weight + F.col("__host_n"))
    path_weight = _shrinkage(sites.select(F.col("__path_good").alias("good"), F.col("__path_n").alias("n"), parent.alias("parent")), F.col("parent"))
    if paths.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    # Without the document itself.
    host_share = (host_weight * share + F.col("__host_good") - F.col("__own")) / (host_weight + F.col("__host_n") - 1)
    path_share = (path_weight * F.col("host_share") + F.col("__path_good") - F.col("__own")) / (path_weight + F.col("__path_n") - 1)
    joined = rows.join(sites, ["__host", "__path"]).withColumn("host_share", host_share).withColumn("path_share", path_share)
    return joined.withColumn("quality", _sigmoid(F.col("evidence") + _logit(F.col("path_share")))).select(
        *columns, "host_share", "path_share", "quality", (F.col("quality") >= threshold).alias("keep"))


def score(docs: DataFrame, model: dict, host: Column, path: Column, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with evidence, host_share, path_share, quality (posterior probability) and keep (boolean).

    Every row and column stays; input columns of those names are replaced. A null host or path counts as a site of its
    own. A null text or one without words is never kept: there is nothing in it to train on.
    """
    wordless = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.withColumn("__wordless", wordless)
    found = combine(freeze(with_evidence(marked, model, text_col), "evidence", ARROW_BYTES), model["prior"], host, path, threshold)
    return found.withColumn("keep", F.col("keep") & ~F.col("__wordless")).drop("__wordless")
