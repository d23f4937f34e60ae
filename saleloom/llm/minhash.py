"""MinHash document fingerprints: universal hash permutations in numpy, bands joined in Spark, Jaccard verified.

A fingerprint has ``PERMUTATIONS`` lanes. Lane i is the least value of ``(a_i * x + b_i mod 2**64) >> 32`` over a text's
shingle hashes x; the share of equal lanes estimates the Jaccard likeness of two shingle sets. Fingerprints are stored
as hexadecimal text, the low 16 bits of each lane; a text without words has the empty fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.llm import set_join
from saleloom.llm.chunks import slices
from saleloom.llm.shingles import mix, shingle_hashes
from saleloom.operators.work import freeze

WIDTH = 5  # words of a shingle
PERMUTATIONS = 256
BAND_ROWS = 4  # lanes of a band: at likeness 0.8, 64 bands miss a pair with probability 3e-15
BUCKETS_PER_PARTITION = 4
_FIRST = -(1 << 63)  # stands for a null id in the order of documents
_COLUMNS = 4096  # shingles hashed at a time

_random = np.random.default_rng(20240229)
_A = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.int64).astype(np.uint64)


def lanes(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Lanes (texts x permutations, 32-bit values) and the number of shingles of each text."""
    hashes, bounds = shingle_hashes(texts, width)
    lowest = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    for start in range(0, len(hashes), _COLUMNS):
        part, whose = hashes[start : start + _COLUMNS], owner[start : start + _COLUMNS]
        first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        values = _A[:, None] * part[None, :]
        values += _B[:, None]
        values >>= np.uint64(32)
        least = np.minimum.reduceat(values, first, axis=1)
        rows = whose[first]
        lowest[rows] = np.minimum(lowest[rows], least.T)
    return lowest, np.diff(bounds)


def fingerprint_texts(texts: pa.Array, width: int = WIDTH) -> list[str]:
    """Fingerprint of each text. Equal texts have equal fingerprints."""
    lowest, number = lanes(texts, width)
    packed = (lowest & np.uint64(0xFFFF)).astype(">u2")
    return [row.tobytes().hex() if n else "" for row, n in zip(packed, number.tolist(), strict=True)]


def likeness(one: str, other: str) -> float:
    """Share of equal lanes; two empty fingerprints are alike, an empty and another one are not."""
    if not one or not other:
        return float(one == other)
    a, b = (np.frombuffer(bytes.fromhex(x), dtype=">u2") for x in (one, other))
    return float((a == b).mean())


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint string: one row per row, no shuffle. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(fingerprint_texts(batch.column(1), width), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fingerprint"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = WIDTH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, component_id: documents linked by a shared band and a verified Jaccard of ``percent`` or more.

    Members of a band bucket are linked through hubs and components (see ``set_join``), never pair by pair. Texts
    without words link with nothing, null ids keep their row, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, lowest = set_join.class_rows(batch.column(1), width), lanes(batch.column(1), width)[0]
            bands = lowest.reshape(len(lowest), -1, BAND_ROWS)
            key = np.zeros(bands.shape[:2], dtype=np.uint64) + np.arange(bands.shape[1], dtype=np.uint64)
            for i in range(BAND_ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
            offsets = pa.array((np.arange(len(key) + 1) * bands.shape[1]).astype(np.int32))
            listed = pa.ListArray.from_arrays(offsets, pa.array(key.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *sets, listed], ["doc_id", "n_shingles", "class", "keys"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, n_shingles long, class long, keys array<long>"
    sketch = freeze(texts.mapInArrow(run, schema), "bands")
    return set_join.link(sketch, texts, width, percent, lambda size: F.lit(1)).select("doc_id", "component_id")


def _with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, copy, key, doc_id, text), each bucket in one partition, in order, with the row that follows it.

    Buckets are ranges of ids. The first row of each bucket is also put, as a copy, behind the last row of the bucket
    before it (that of the first bucket behind the last one), so that every row's successor is in its partition.
    Only one id per bucket reaches the driver.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc_id = F.col(id_col).cast("long")
    key = F.coalesce(doc_id, F.lit(_FIRST))
    ids = docs.select(key.alias("key")).repartitionByRange(partitions * BUCKETS_PER_PARTITION, "key")
    lows = ids.groupBy(F.spark_partition_id()).agg(F.min("key").alias("low")).collect()
    bounds = np.array(sorted({r["low"] for r in lows}), dtype=np.int64)
    rows = docs.select(key.alias("key"), doc_id.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(bounds, keys, side="right") - 1
            first = np.flatnonzero(keys == bounds[bucket])
            for copy, at, where in ((False, np.arange(len(keys)), bucket), (True, first, (bucket[first] - 1) % len(bounds))):
                if len(at):
                    columns = batch.take(pa.array(at)).columns if copy else batch.columns
                    head = [pa.array(where.astype(np.int32)), pa.array(np.full(len(at), copy))]
                    yield pa.RecordBatch.from_arrays([*head, *columns], ["bucket", "copy", "key", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "bucket int, copy boolean, key long, doc_id long, text string")
    return dealt.repartition(partitions, "bucket").sortWithinPartitions("bucket", "copy", "key", "text")


def fingerprint_edits(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the start of the next document.

    doc_id, n_chars long, edited_sha256, fingerprint, edited_fingerprint string, near_edited, near_next double. The
    last floor(n_chars / 2) code points are replaced by as many of the next document's first (or all it has), in
    ascending id order, null ids first, equal ids by text; the last document's next is the first. Null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row seen: bucket, copy, doc_id, text, fingerprint
        for batch in slices(batches):
            found = fingerprint_texts(batch.column(4), width)
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            rows = held + list(zip(*columns, found, strict=True))
            pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[1] and a[0] == b[0]]
            held = rows[-1:]
            edited = [a[3][: len(a[3]) - len(a[3]) // 2] + b[3][: len(a[3]) // 2] for a, b in pairs]
            changed = fingerprint_texts(pa.array(edited, pa.string()), width)
            out = [
                pa.array([a[2] for a, _ in pairs], pa.int64()),
                pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited], pa.string()),
                pa.array([a[4] for a, _ in pairs], pa.string()),
                pa.array(changed, pa.string()),
                pa.array([likeness(a[4], c) for (a, _), c in zip(pairs, changed, strict=True)], pa.float64()),
                pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return _with_next(docs, id_col, text_col).mapInArrow(run, schema)
