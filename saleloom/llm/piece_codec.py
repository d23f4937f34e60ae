"""SentencePiece encoding with a score-ordered agenda of adjacent symbol pairs, and decoding.

Each distinct chunk of a text is encoded by an agenda: a heap of mergeable neighbours, best score first, leftmost
first among equals; a popped pair is skipped if one of its symbols has changed since. Every Arrow batch is then encoded
by the sentencepiece library as well, and a difference raises an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.piece_model import PieceChunks, PieceModel


class Agenda:
    """Encoder of single chunks."""

    def __init__(self, model: PieceModel):
        self.model = model

    def encode(self, chunk: str) -> list[int]:
        known = self.model.id.get(chunk)
        if known is not None and len(chunk) == 1:
            return [known]
        score = self.model.score
        symbols: list[str] = list(chunk)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            piece = symbols[i] + symbols[i + 1]
            if piece in score:
                agenda.append((-score[piece], i, i + 1, piece))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # Emptied or grown symbols no longer spell the pair that was put on the agenda.
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, ""
            nearest = after[right]
            after[left] = nearest
            if nearest < n:
                before[nearest] = left
                joined = piece + symbols[nearest]
                if joined in score:
                    heapq.heappush(agenda, (-score[joined], left, nearest, joined))
            previous = before[left]
            if previous >= 0:
                joined = symbols[previous] + piece
                if joined in score:
                    heapq.heappush(agenda, (-score[joined], previous, left, joined))
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.model.id.get(symbol)
                if known is not None:
                    ids.append(known)
                else:
                    ids.extend(self.model.bytes[b] for b in symbol.encode("utf-8"))
        return ids

    def encode_all(self, chunks: Sequence[str]) -> list[list[int]]:
        return [self.encode(c) for c in chunks]


def _joined(parts: list[list[int]]) -> list[int]:
    return list(chain.from_iterable(parts))


@lru_cache(maxsize=2)
def _coder(model: str) -> tuple[PieceModel, PieceChunks]:
    """The encoder of this worker process: its chunk memo serves all tasks that the process runs."""
    pieces = PieceModel.load(model)
    return pieces, PieceChunks(pieces, Agenda(pieces).encode_all, _joined)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> (with the end id), decoded string: one row per row, no shuffle.

    Null and empty texts give the end id alone and an empty decoded text. Ids may be null or repeated; other columns
    are ignored. A text whose ids differ from the library's ends the job with an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces, chunks = _coder(model)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            found = chunks.encode(texts)
            for ids, expected in zip(found, library.encode(texts, num_threads=1), strict=True):
                if ids != expected:
                    raise ValueError("encoding differs from the sentencepiece library")
                ids.append(pieces.end_id)
            decoded = pa.array(library.decode(found, num_threads=1), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), decoded], names)

    names = ["doc_id", "ids", "decoded"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, decoded string")
