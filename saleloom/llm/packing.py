"""Packing of token pieces into sequences: the histogram goes to the configuration LP, the rows stay distributed."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.config_lp import Pattern, solve
from saleloom.llm.library_ids import library_ids
from saleloom.operators.work import ARROW_BYTES, freeze

SLICE_ROWS = 64  # rows encoded at once: their chunks and ids are Python objects
BUCKET_ROWS = 50_000  # pieces of one length are numbered in buckets of about so many rows


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id",
               text_col: str = "text", spaces_matter: bool = False, compact: bool = False) -> DataFrame:
    """Encode every whole text, append ``end_id`` and cut it into pieces of at most ``capacity`` ids; stored once.

    Returns row_id long (one per input row), doc_id, piece int, start long, length long, ids binary (little-endian
    unsigned 32 bit). Null text counts as empty: one piece that holds the end id. Repeated rows are kept.
    ``compact``: workers remember fewer chunks, for executors whose memory earlier steps have taken.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_ids(tokenizer, spaces_matter, compact)
        end = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in slices(batches, SLICE_ROWS):
            at, piece, start, length, ids = [], [], [], [], []
            for i, text_ids in enumerate(encoder.encode(batch.column(2).to_pylist())):
                whole = np.frombuffer(text_ids, dtype=encoder.dtype).astype("<u4").tobytes() + end
                for k, begin in enumerate(range(0, len(whole), step)):
                    part = whole[begin : begin + step]
                    at.append(i)
                    piece.append(k)
                    start.append(begin // 4)
                    length.append(len(part) // 4)
                    ids.append(part)
            rows = batch.select([0, 1]).take(pa.array(at, pa.int64()))
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            columns = [*rows.columns, *columns, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row_id", "doc_id", "piece", "start", "length", "ids"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"), text.alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"row_id long, doc_id {kind}, piece int, start long, length long, ids binary"
    return freeze(rows.mapInArrow(cut, schema), "pieces", ARROW_BYTES)


def _slots(plan: dict[Pattern, int]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first slot, end slot, first sequence, offset, slots per sequence) of each length in each pattern."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan.items():
        offset = 0
        for length, n in pattern:
            first = used.get(length, 0)
            used[length] = first + n * times
            rows.append((length, first, first + n * times, sequence, offset, n))
            offset += length * n
        sequence += times
    return rows


def place(pieces: DataFrame, capacity: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pieces`` (row_id, piece, length and further columns) with sequence_id and offset.

    Only the histogram, at most ``capacity`` rows, reaches the driver. Pieces of a length are numbered 0..n-1: inside
    buckets by a window, across buckets by the bucket counts, so that a length which a third of all rows have is never
    in one task. A piece's number then selects its slot in the plan. The plan has one row per length and pattern; its
    size depends on ``capacity`` alone and it is broadcast.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    schema = "length long, first_slot long, end_slot long, first_sequence long, first_offset long, per_sequence long"
    plan = F.broadcast(spark.createDataFrame(_slots(solve(counts, capacity)), schema).coalesce(1))

    buckets = max(1, math.ceil(int(counts.sum()) / bucket_rows))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_id", "piece"), F.lit(buckets)))
    group = Window.partitionBy("length", "bucket")
    numbered = dealt.withColumn("number", F.row_number().over(group.orderBy("row_id", "piece")) - 1)
    sizes = pieces.select("length", F.pmod(F.xxhash64("row_id", "piece"), F.lit(buckets)).alias("bucket"))
    sizes = sizes.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    slot = F.col("number") + F.col("before")
    ranked = numbered.join(before, ["length", "bucket"]).withColumn("slot", slot)
    hit = (ranked["length"] == plan["length"]) & (ranked["slot"] >= plan["first_slot"])
    placed = ranked.join(plan, hit & (ranked["slot"] < plan["end_slot"])).drop(plan["length"])
    nth = F.col("slot") - F.col("first_slot")
    placed = placed.withColumn("sequence_id", F.col("first_sequence") + F.floor(nth / F.col("per_sequence")))
    placed = placed.withColumn("offset", F.col("first_offset") + nth % F.col("per_sequence") * F.col("length"))
    return placed.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id",
                   text_col: str = "text", compact: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id long, offset long: one row per piece.

    Sequences hold at most ``capacity`` ids and are gapless from offset 0. Null and empty texts are packed as their end
    id; null and repeated ids are kept; an empty table gives no rows; other columns are ignored. ``compact``: less memory
    in the workers, more time (see ``cut_pieces``).
    """
    pieces = cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, compact=compact)
    placed = place(pieces.select("row_id", "piece", "length"), capacity)
    return pieces.join(placed.drop("length"), ["row_id", "piece"]).drop("row_id")
