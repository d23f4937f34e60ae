"""Inverted lists of shingle sets, rarest shingle first: the prefixes that an exact set join has to scan.

All shingles stand in one order: by the number of sets that hold them, then by value. A set of n shingles that must
share m of them with a partner lists its first n - m + 1 shingles; the smallest common shingle of two linked sets is in
the lists of both. Shingles of templates that many sets hold come last, so sets that resemble each other without
linking list shingles of their own and never meet.

Counting takes one shuffle of the shingles as packed arrays, dealt by value to buckets whose number grows with the
data. Shingles that only one set holds end there; the others travel to their set in a second one. Shingles are named by
48 bits here: two that share a name only share a place in the order, which keeps the lists complete. Shingles that at
least 1 in ``HEAD_SHARE`` sets of a slice hold, and so many of all sets, are broadcast (at most ``HEAD_SHARE`` times the
mean set size of them), counted as the most frequent and not gathered in a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.shingles import mix, shingle_hashes
from saleloom.operators.work import freeze

NAME_BITS = 48
BUCKET_SHINGLES = 1_000_000
HEAD_SHARE = 100
SLICE_ROWS, SLICE_BYTES = 4096, 4 << 20
HASHED_BYTES = 1 << 20
LEAST_SETS = 16  # sets of a slice that hold a shingle before it is reported as frequent
_SHIFT = np.uint64(64 - NAME_BITS)
_HEAD = (1 << 62)  # count that puts the head behind all others


def flat_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending in each text, and the n + 1 bounds of each text's shingles.

    Hashing takes some 50 bytes of arrays for each byte of text, so texts are hashed ``HASHED_BYTES`` at a time.
    """
    ends = np.cumsum(pc.binary_length(texts.cast(pa.large_binary())).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // HASHED_BYTES)) + 1).tolist(), len(texts)]
    found = []
    for start, end in pairwise(cuts):
        hashes, bounds = shingle_hashes(texts.slice(start, end - start), width)
        found += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return flat, np.append(0, np.cumsum([len(s) for s in found])).astype(np.int64)


def _named(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, name) of the distinct names of each set."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    name = flat >> _SHIFT
    first = np.ones(len(name), dtype=bool)
    first[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    return owner[first], name[first]


def set_classes(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each whole set."""
    sums = np.append(np.uint64(0), np.cumsum(mix(flat), dtype=np.uint64))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def frequent_names(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names that many sets of a slice hold, and in how many."""
    names, count = np.unique(_named(flat, bounds)[1], return_counts=True)
    often = count >= max(LEAST_SETS, -(-(len(bounds) - 1) // HEAD_SHARE))
    return names[often], count[often]


def name_counts(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.bincount(_named(flat, bounds)[0], minlength=len(bounds) - 1)


def _packed(texts: DataFrame, width: int, smallest: int, buckets: int, head: np.ndarray) -> DataFrame:
    """bucket, names binary, owners binary, classes array<long>: the names of a slice that fall into one bucket.

    Names of the head go to the buckets from ``buckets`` on, dealt by class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_ROWS, SLICE_BYTES):
            flat, bounds = flat_sets(batch.column(0), width)
            classes = set_classes(flat, bounds)
            size = np.diff(bounds)
            once = np.zeros(len(size), dtype=bool)
            once[np.unique(classes, return_index=True)[1]] = True
            owner, name = _named(flat, bounds)
            wanted = (once & (size >= smallest))[owner]
            owner, name = owner[wanted], name[wanted]
            bucket = (mix(name) % np.uint64(buckets)).astype(np.int64)
            if len(head):
                at = np.minimum(np.searchsorted(head, name), len(head) - 1)
                bucket = np.where(head[at] == name, buckets + (classes[owner] % np.uint64(buckets)).astype(np.int64), bucket)
            order = np.argsort(bucket, kind="stable")
            owner, name, bucket = owner[order], name[order], bucket[order]
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)] if len(bucket) else [0]
            rows = []
            for a, b in pairwise(cuts):
                own, place = np.unique(owner[a:b], return_inverse=True)
                high, low = (name[a:b] >> np.uint64(32)).astype(np.uint16), (name[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows.append((bucket[a], low.tobytes() + high.tobytes(), place.astype(np.uint32).tobytes(), classes[own].view(np.int64)))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()),
                 pa.array(columns[3], pa.list_(pa.int64()))], ["bucket", "names", "owners", "classes"])

    return texts.select("text").mapInArrow(run, "bucket long, names binary, owners binary, classes array<long>")


def _count(buckets: int):
    """Of one bucket the (class, name, sets) of all names that more than one class holds."""

    def run(table: pa.Table) -> pa.Table:
        names, classes = [], []
        for names_of, owners_of, listed in zip(table["names"].to_pylist(), table["owners"].to_pylist(), table["classes"], strict=True):
            owners = np.frombuffer(owners_of, np.uint32)
            low = np.frombuffer(names_of, np.uint32, len(owners)).astype(np.uint64)
            high = np.frombuffer(names_of, np.uint16, len(owners), 4 * len(owners)).astype(np.uint64)
            names.append(high << np.uint64(32) | low)
            classes.append(listed.values.to_numpy()[owners])
        name, owner = np.concatenate(names), np.concatenate(classes)
        del names, classes
        order = np.lexsort((owner, name))
        name, owner = name[order], owner[order]
        del order
        new = np.append(True, name[1:] != name[:-1])
        first = new | np.append(True, owner[1:] != owner[:-1])
        name, owner = name[first], owner[first]
        starts = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        count = np.repeat(np.diff(np.append(starts, len(name))), np.diff(np.append(starts, len(name))))
        if table["bucket"][0].as_py() >= buckets:
            count[:] = _HEAD
        keep = count > 1
        return pa.table({"class": owner[keep], "name": name[keep].astype(np.int64), "sets": count[keep].astype(np.int64)})

    return run


def rare_lists(texts: DataFrame, sizes: DataFrame, frequent: DataFrame, width: int, percent: int, smallest: int) -> DataFrame:
    """(class, key, place, n_shingles): the list of each set of at least ``smallest`` shingles, without names of one set.

    ``texts`` has the column text, ``sizes`` (stored) class, n_shingles, n_names, ``frequent`` name and sets, the frequent
    names of slices. ``place`` is the number of the set's names before the key.
    """
    large = sizes.where(F.col("n_shingles") >= smallest)
    total, shingles = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_names"), F.lit(0))).first()
    often = frequent.groupBy("name").agg(F.sum("sets").alias("sets")).where(F.col("sets") * HEAD_SHARE >= total)
    head = np.sort(np.array([r["name"] for r in often.select("name").collect()], dtype=np.uint64))
    buckets = 1 + shingles // BUCKET_SHINGLES
    packed = _packed(texts, width, smallest, buckets, head).repartition(2 * buckets, "bucket")
    shared = packed.groupBy("bucket").applyInArrow(_count(buckets), "class long, name long, sets long")
    by_class = Window.partitionBy("class")
    found = shared.withColumns({
        "n": F.count(F.lit(1)).over(by_class),
        "nth": F.row_number().over(by_class.orderBy("sets", "name")),
    })
    found = found.join(large.hint("merge"), "class").withColumn("place", F.col("n_names") - F.col("n") + F.col("nth") - 1)
    least = F.ceil(F.col("n_shingles") * percent / 100)
    kept = found.where(F.col("place") <= F.col("n_shingles") - least)
    return kept.select("class", F.col("name").alias("key"), "place", "n_shingles")
