"""Token counts by rank-synchronous merging of ragged numpy arrays.

The distinct pre-tokens of a batch are held as one flat array of symbols with segment numbers. In each round every
segment applies its lowest-rank pair, all segments at once; a segment without a mergeable pair leaves the arrays and
its surviving symbols are counted. Ranks order the merged pieces by score; equal ranks are taken from the left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.piece_model import PieceChunks, PieceModel

_NONE = np.iinfo(np.int32).max


class MergeTable:
    """Merges of a model as arrays: pair key -> rank and merged symbol."""

    def __init__(self, model: PieceModel):
        chars = sorted({c for piece in model.id for c in piece} | {p for p in model.id if len(p) == 1})
        symbols = chars + sorted(p for p in model.id if len(p) > 1)
        number = {s: i for i, s in enumerate(symbols)}
        self.other = len(symbols)  # a character that no piece holds
        self.base = len(symbols) + 1
        order = {s: r for r, s in enumerate(sorted(set(model.score.values()), reverse=True))}
        found = []
        safe = np.ones(self.base, dtype=bool)
        alone = np.unique(list(model.score.values()), return_counts=True)
        shared = set(alone[0][alone[1] > 1].tolist())
        for piece, score in model.score.items():
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is None or right is None:
                    continue
                found.append((left * self.base + right, order[score], number[piece]))
                for part in (piece[:cut], piece[cut:]):
                    if model.score.get(part, np.inf) <= score:
                        safe[number[part]] = False
        # A merge is safe to repeat within a round if no merge of its result comes before the next equal one.
        for piece, score in model.score.items():
            if score in shared:
                safe[number[piece]] = False
        self.safe = safe
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        self.of_char = np.full(0x110000, self.other, dtype=np.int32)
        self.of_char[[ord(c) for c in chars]] = np.arange(len(chars))
        # A symbol that is no piece is spelled in bytes.
        self.tokens = np.ones(self.base, dtype=np.int64)
        self.tokens[: len(chars)] = [1 if c in model.id else len(c.encode("utf-8")) for c in chars]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], 0)

    def count(self, chunks: Sequence[str]) -> list[int]:
        """Number of tokens of each chunk."""
        lengths = np.array([len(c) for c in chunks], dtype=np.int64)
        total = np.zeros(len(chunks), dtype=np.int64)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(points):
            return total.tolist()
        symbol = self.of_char[points]
        weight = np.where(symbol == self.other, 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), 0)
        segment = np.repeat(np.arange(len(chunks)), lengths)
        rank, merged = np.full(len(symbol), _NONE, dtype=np.int32), np.zeros(len(symbol), dtype=np.int32)
        inner = np.flatnonzero(segment[:-1] == segment[1:])
        rank[inner], merged[inner] = self.look_up(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            size = np.diff(np.append(first, len(symbol)))
            lowest = np.minimum.reduceat(rank, first)
            ended = lowest == _NONE
            if ended.any():
                over = np.repeat(ended, size)
                value = np.where(symbol == self.other, weight, self.tokens[symbol])
                np.add.at(total, segment[over], value[over])
                left = ~over
                symbol, weight, segment = symbol[left], weight[left], segment[left]
                rank, merged, lowest, size = rank[left], merged[left], lowest[~ended], size[~ended]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # In a run of overlapping pairs the first, third, ... merge; only the first of all if that is not safe.
            breaks = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
            nth = np.arange(len(at)) - np.repeat(breaks, np.diff(np.append(breaks, len(at))))
            leads = np.concatenate([[True], segment[at][1:] != segment[at][:-1]])
            at = at[leads | self.safe[merged[at]] & (nth % 2 == 0)]
            symbol[at] = merged[at]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            # The pair a merged symbol forms with its right neighbour, and the one its left neighbour forms with it.
            moved = np.cumsum(keep) - 1
            symbol, weight, segment, rank, merged = symbol[keep], weight[keep], segment[keep], rank[keep], merged[keep]
            at = moved[at]
            for pairs in (at, at[at > 0] - 1):
                pairs = pairs[pairs + 1 < len(symbol)]
                same = segment[pairs] == segment[pairs + 1]
                rank[pairs[~same]] = _NONE
                pairs = pairs[same]
                rank[pairs], merged[pairs] = self.look_up(symbol[pairs], symbol[pairs + 1])
            if len(at) and at[-1] == len(symbol) - 1:
                rank[-1] = _NONE
        return total.tolist()


@lru_cache(maxsize=2)
def _counter(model: str) -> PieceChunks:
    """The counter of this worker process: its chunk memo serves all tasks that the process runs."""
    pieces = PieceModel.load(model)
    return PieceChunks(pieces, MergeTable(pieces).count, sum)


def count_tokens(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes long (UTF-8), n_tokens long, over_limit boolean (n_tokens > limit), one row per row.

    Null and empty texts have no token. Ids may be null or repeated; other columns are ignored. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _counter(model)
        for batch in slices(batches):
            tokens = chunks.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], names)

    names = ["doc_id", "n_bytes", "n_tokens"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n"))
    kind = dict(rows.dtypes)["doc_id"]
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
