"""Importance resampling of documents towards a target corpus, on hashed runs of one and two words.

A feature is a word or two consecutive words joined by a space; its bucket is the crc32 of its bytes modulo the number
of buckets. A first pass finds frequent words and frequent pairs of them, at most ``HEAD_WORDS`` and ``HEAD_PAIRS``. They
are broadcast with their crc32 states and buckets. All other features take a direct crc32, pairs from the state of their
first word on. Both give the same buckets, so the vocabulary changes the cost of the totals and never their values.

In every batch the words and pairs are dictionary-encoded by Arrow; hashing works on the distinct ones, in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.operators.keys import dense_keys
from saleloom.operators.work import freeze

HEAD_WORDS, HEAD_PAIRS = 1 << 15, 1 << 17
LONG_WORD = 64  # longer words are not in the vocabulary, and are hashed one by one
BATCH_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


class Words:
    """The words of a batch of texts: distinct ones, their number at each place, and the bounds of each text."""

    def __init__(self, texts: pa.Array):
        raw = texts.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = _LOWER[np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]]
        edge = offsets - offsets[0]
        inside = _WORD[data]
        fresh = np.zeros(len(data) + 1, dtype=bool)
        fresh[1:-1] = ~inside[:-1]
        fresh[edge] = True  # a word never runs on from one text into the next
        first = np.flatnonzero(inside & fresh[:-1])
        kept = np.append(0, np.cumsum(inside))
        ends = np.append(kept[first], kept[-1])
        values = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
        coded = values.dictionary_encode()
        self.distinct = coded.dictionary
        self.number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.bounds = np.searchsorted(first, edge)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs (first word * distinct words + second), their number at each place, and the bounds of each text."""
        last = np.zeros(len(self.number), dtype=bool)
        last[self.bounds[1:][np.diff(self.bounds) > 0] - 1] = True
        at = np.flatnonzero(~last)
        coded = pa.array(self.number[at] * len(self.distinct) + self.number[at + 1]).dictionary_encode() if len(at) else None
        count = np.maximum(np.diff(self.bounds) - 1, 0)
        bounds = np.append(0, np.cumsum(count))
        if coded is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), bounds
        return coded.dictionary.to_numpy(), coded.indices.to_numpy(zero_copy_only=False), bounds


class Vocabulary:
    """Frequent words with their crc32, and buckets of frequent pairs of them."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.states = {w: (k, crc32(w)) for k, w in enumerate(words)}
        found = [(self.states[a][0] * len(words) + self.states[b][0], crc32(b" " + b, self.states[a][1]) % buckets)
                 for a, b in pairs if a in self.states and b in self.states]
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_buckets = table[:, 0].copy(), table[:, 1].copy()

    def hashed(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """crc32 of each distinct word, and its place in the vocabulary (-1: none)."""
        get = self.states.get
        found = [get(w) or (-1, crc32(w)) for w in words.distinct.to_pylist()]
        both = np.array(found, dtype=np.int64).reshape(-1, 2)
        return both[:, 1].astype(np.uint32), both[:, 0]

    def pair_bucket(self, words: Words, pairs: np.ndarray, states: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Bucket of each distinct pair."""
        first, second = np.divmod(pairs, max(len(words.distinct), 1))
        key = head[first] * len(self.states) + head[second]
        out = np.empty(len(pairs), dtype=np.int64)
        at = np.searchsorted(self.pair_keys, key)
        hit = (head[first] >= 0) & (head[second] >= 0) & (at < len(self.pair_keys))
        hit[hit] = self.pair_keys[at[hit]] == key[hit]
        out[hit] = self.pair_buckets[at[hit]]
        rest = np.flatnonzero(~hit)
        out[rest] = direct_crc(states[first[rest]], words.distinct, second[rest]) % self.buckets
        return out


def direct_crc(states: np.ndarray, distinct: pa.Array, second: np.ndarray) -> np.ndarray:
    """crc32 states carried on over a space and the word ``second`` of each."""
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)
    size = np.diff(offsets)[second]
    order = np.argsort(-size, kind="stable")
    second, size = second[order], size[order]
    crc = states[order] ^ np.uint32(0xFFFFFFFF)
    crc = _CRC[(crc ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    long = int(np.searchsorted(-size, -LONG_WORD, side="left"))  # longer words stand first
    for k in range(long):
        word = data[offsets[second[k]] : offsets[second[k] + 1]].tobytes()
        crc[k] = crc32(word, int(crc[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    start = offsets[second]
    for step in range(int(size[long]) if long < len(size) else 0):
        active = slice(long, int(np.searchsorted(-size, -step, side="left")))  # those longer than step
        letter = data[start[active] + step]
        crc[active] = _CRC[(crc[active] ^ letter) & np.uint32(0xFF)] ^ (crc[active] >> np.uint32(8))
    out = np.empty(len(crc), dtype=np.int64)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _frequent(distinct_words: int, distinct_pairs: int) -> Callable:
    """Arrow function: words and pairs with at least their share of a batch.

    What holds a share of the whole input holds it in some batch, so no such word or pair is missed; and a batch has at
    most so many words and pairs of that share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=100_000, size=BATCH_BYTES):
            words = Words(batch.column(0))
            pairs, number, _ = words.pairs()
            count = np.bincount(words.number, minlength=len(words.distinct))
            short = pa.compute.binary_length(words.distinct).to_numpy(zero_copy_only=False) <= LONG_WORD
            often = np.flatnonzero(short & (count * distinct_words >= len(words.number)))
            pair_count = np.bincount(number, minlength=len(pairs))
            first, second = np.divmod(pairs, max(len(words.distinct), 1))
            good = np.flatnonzero((pair_count * distinct_pairs >= len(number)) & short[first] & short[second])
            take = words.distinct.take
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([take(pa.array(often)), take(pa.array(first[good]))]).cast(pa.binary()),
                pa.concat_arrays([pa.nulls(len(often), pa.binary()), take(pa.array(second[good])).cast(pa.binary())]),
                pa.array(np.append(count[often], pair_count[good])),
            ], ["first", "second", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([len(words.number)])],
                                             ["first", "second", "n"])

    return run


def vocabulary(docs: DataFrame, buckets: int, text_col: str = "text", head_words: int = HEAD_WORDS,
               head_pairs: int = HEAD_PAIRS) -> Vocabulary:
    """Words that make up at least 1 / ``head_words`` of all words, and pairs of at least 1 / ``head_pairs``.

    Not more than so many can, so what the driver gets is bounded at any size of the corpus.
    """
    rows = _texts(docs, text_col).mapInArrow(_frequent(head_words, head_pairs), "first binary, second binary, n long")
    counts = freeze(rows.groupBy("first", "second").agg(F.sum("n").alias("n")), "frequent")
    total = counts.where("first is null").agg(F.sum("n")).first()[0] or 0
    share = F.when(F.col("second").isNull(), F.lit(head_words)).otherwise(F.lit(head_pairs))
    head = counts.where("first is not null").where(F.col("n") * share >= total).select("first", "second").collect()
    words = sorted(bytes(r[0]) for r in head if r[1] is None)
    return Vocabulary(words, sorted((bytes(r[0]), bytes(r[1])) for r in head if r[1] is not None), buckets)


def bucket_totals(docs: DataFrame, known: Vocabulary, text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket. Every task adds its own up before they meet: ``buckets`` rows a task."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        total = np.zeros(vocab.buckets, dtype=np.int64)
        for batch in slices(batches, rows=100_000, size=BATCH_BYTES):
            words = Words(batch.column(0))
            states, head = vocab.hashed(words)
            count = np.bincount(words.number, minlength=len(words.distinct))
            np.add.at(total, states.astype(np.int64) % vocab.buckets, count)
            pairs, number, _ = words.pairs()
            count = np.bincount(number, minlength=len(pairs))
            np.add.at(total, vocab.pair_bucket(words, pairs, states, head), count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = _texts(docs, text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(known.buckets, dtype=np.int64)
    for row in rows.collect():  # at most one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: 1000 times the logarithm of its share in the target over that in the source, smoothed by 1."""
    n = len(source)
    s, t = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t)))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weigh(docs: DataFrame, known: Vocabulary, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight long: the floored mean gain of each text's features (none: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast((known, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, gain = shared.value
        for batch in slices(batches, rows=100_000, size=BATCH_BYTES):
            words = Words(batch.column(1))
            states, head = vocab.hashed(words)
            of_word = gain[states.astype(np.int64) % vocab.buckets]
            pairs, number, bounds = words.pairs()
            of_pair = gain[vocab.pair_bucket(words, pairs, states, head)]
            one = np.append(0, np.cumsum(of_word[words.number]))
            two = np.append(0, np.cumsum(of_pair[number]))
            total = np.diff(one[words.bounds]) + np.diff(two[bounds])
            n_words = np.diff(words.bounds)
            n = n_words + np.diff(bounds)
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000, seed: int = 7,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", head_words: int = HEAD_WORDS,
             head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_features, weight, score, rank long: every row, ranked if it is among the ``percent`` drawn.

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) with the highest score are drawn, the
    highest first; ties go to the smaller id (null last), then to any of the equal rows. The score is the weight plus
    Gumbel noise from the seed and the id, so rows of one id have one noise; a null id counts as an empty string in it.
    Null texts have no words; so has an empty corpus or target, and each bucket's gain then comes from the smoothing.
    """
    known = vocabulary(docs, buckets, text_col, head_words, head_pairs)
    gain = gains(bucket_totals(docs, known, text_col), bucket_totals(target, known, target_col))
    weighed = weigh(docs, known, gain, id_col, text_col)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = freeze(weighed.withColumn("score", F.col("weight") + noise), "scores")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ranked = dense_keys(scored.where(able), "rank", order_by=[-F.col("score"), "doc_id", "weight", "n_features"])
    place = F.when(F.col("rank") <= drawn, F.col("rank"))
    names = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*names, place.alias("rank")).union(scored.where(~able).select(*names, F.lit(None).cast("long")))
