"""Vocabulary of a merge-type (BPE) SentencePiece model file, and its cuts into independent chunks."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from saleloom.llm.chunks import Memo, core_of, cuts_cleanly, encode_texts

SPACE = "▁"
# Piece types of the model format.
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_BPE = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """Pieces that can take part in merges, by text; ids of the 256 byte pieces; id of the end symbol."""

    score: dict[str, float] = field(default_factory=dict)
    id: dict[str, int] = field(default_factory=dict)
    bytes: dict[int, int] = field(default_factory=dict)
    end_id: int = -1

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Read a model. Only what this engine encodes exactly is accepted: BPE, byte fallback, identity
        normalisation with a space put first, and no user-defined or unused pieces."""
        with open(path, "rb") as file:
            data = file.read()
        model, trainer, normaliser, n = cls(), {}, {}, 0
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                text, kind = piece[1].decode("utf-8"), piece.get(3, _NORMAL)
                if kind == _NORMAL:
                    model.score[text] = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                    model.id[text] = n
                elif kind == _BYTE:
                    model.bytes[int(text[3:-1], 16)] = n
                elif kind in (_USER_DEFINED, _UNUSED):
                    raise ValueError("user-defined and unused pieces are not supported")
                elif kind == _CONTROL and text == "</s>":
                    model.end_id = n
                n += 1
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        plain = normaliser.get(1) == b"identity" and normaliser.get(3, 1) == 1 and normaliser.get(4, 1) == 0
        if trainer.get(3) != _BPE or len(model.bytes) != 256 or not plain or trainer.get(24, 0):
            raise ValueError("not a BPE model with byte fallback and identity normalisation")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in model.id):
            raise ValueError("pieces that cross a space or hold a line feed are not supported")
        return model


_CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


class PieceChunks:
    """Encode texts chunk by chunk: no piece crosses the start of a run of spaces, or a line feed.

    ``encode`` maps chunks (spaces already replaced) to values, ``join`` makes a text's value from its chunks' values.
    """

    def __init__(self, model: PieceModel, encode: Callable[[Sequence[str]], Sequence[object]],
                 join: Callable[[list], object]):
        self._encode, self._join = encode, join
        joined = {piece[i : i + 2] for piece in model.id for i in range(len(piece) - 1)}
        self.words = Memo(self._encode_words, join, lambda a, b: a + b not in joined)
        self.runs = Memo(encode)

    def _encode_words(self, keys: Sequence[str]) -> list[object | None]:
        values: list[object | None] = [None] * len(keys)
        at, chunks = [], []
        for i, key in enumerate(keys):
            core, spaced = core_of(key)
            if cuts_cleanly(core) and SPACE not in core:
                at.append(i)
                chunks.append(SPACE + core if spaced else core)
        for i, value in zip(at, self._encode(chunks), strict=True):
            values[i] = value
        return values

    def _whole(self, text: str) -> object:
        chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return self._join(self.runs.look_up([chunks])[0])

    def encode(self, texts: Sequence[str]) -> list[object]:
        return encode_texts(texts, self.words, self._whole, self._join, start="")
