"""Token ids of the ``tokenizers`` library as little-endian arrays, chunk by chunk (see ``chunks``)."""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from saleloom.llm.chunks import GLUED, Memo, core_of, cuts_cleanly, encode_texts


# Pre-tokenizers that leave a word of letters whole: CLIP's, which drops spaces, and GPT-2's, which spells a space as Ġ.
CLIP_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
CLIP_SPLIT = {"type": "Split", "pattern": {"Regex": CLIP_WORDS}, "behavior": "Removed", "invert": True}
LETTER_KEEPERS = ("NFC", "NFKC", "Lowercase")  # normalizers that change no letter of LETTERS but its case
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def letters_model(spec: dict, spaces_matter: bool) -> tuple[str, bool] | None:
    """(prefix, lower case) with which the model alone encodes a word of ``LETTERS`` like the whole tokenizer; else None.

    ``spec`` is a tokenizer file. Only pre-tokenizers known to leave such a word whole are accepted.
    """
    def parts(step: dict | None, within: str) -> list[dict]:
        return [] if step is None else step[within] if step["type"] == "Sequence" else [step]

    normalizers = parts(spec.get("normalizer"), "normalizers")
    for n in normalizers:
        spaces = n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
        if n["type"] not in LETTER_KEEPERS and not spaces:
            return None
    cutters = [{k: v for k, v in c.items() if k != "trim_offsets"} for c in parts(spec.get("pre_tokenizer"), "pretokenizers")]
    bytes_only = {"type": "ByteLevel", "add_prefix_space": False}
    lower = any(n["type"] == "Lowercase" for n in normalizers)
    if not spaces_matter and cutters == [CLIP_SPLIT, bytes_only | {"use_regex": False}]:
        return "", lower
    if spaces_matter and cutters == [bytes_only | {"use_regex": True}]:
        return "\u0120", lower
    return None


def letter_table(lower: bool) -> dict[int, str]:
    """Each of ``LETTERS`` that a byte-level tokenizer spells otherwise: in lower case if asked, a character per byte."""
    def spelled(byte: int) -> str:  # bytes without a printable character of their own follow from U+0100 on
        rest = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
        return chr(0x100 + rest.index(byte)) if byte in rest else chr(byte)

    letters = [chr(n) for n in range(0x100) if LETTERS.fullmatch(chr(n))]
    return {ord(c): "".join(map(spelled, (c.lower() if lower else c).encode())) for c in letters}


def ends_in_letter(char: str, mark: str) -> bool:
    """Both kinds of pre-tokenizer cut between a letter and punctuation, if normalizers leave it a letter at its end."""
    return char.isalpha() and (char <= "\u00ff" or unicodedata.normalize("NFC", char).lower().isalpha())


MEMO_KEYS = 600_000  # of each generation of a worker's memo, up to some 250 MB
COMPACT_KEYS, COMPACT_SLOTS = 100_000, 524_309  # of a compact memo: some 30 MB of recurring chunks and 25 MB of others


class LibraryIds:
    """Encoder for one tokenizer file; ids take two bytes (``dtype``) if the vocabulary allows it, else four.

    ``spaces_matter=False``: the tokenizer drops white space, so that every space is a cut; otherwise a space belongs
    to the word after it (byte-level pre-tokenization). ``compact``: a memo of a fifth of the memory, for more time."""

    def __init__(self, path: str, spaces_matter: bool, compact: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaces_matter = spaces_matter
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = letters_model(json.loads(self.tokenizer.to_str()), spaces_matter)
        self.model = self.tokenizer.model
        self.table = letter_table(self.letters[1]) if self.letters else {}
        self.memo = Memo(self._encode_chunks, b"".join, ends_in_letter, *((COMPACT_KEYS, COMPACT_SLOTS) if compact else (MEMO_KEYS,)))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def _bytes(self, ids: list[int]) -> bytes:
        if sys.byteorder == "little":
            return array(self.code, ids).tobytes()
        return np.array(ids, dtype=self.dtype).tobytes()

    def _library(self, texts: Sequence[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _encode_chunks(self, keys: Sequence[str]) -> list[bytes | None]:
        """Ids of each chunk; a word of ``LETTERS`` goes to the tokenizer's model alone."""
        values: list[bytes | None] = [None] * len(keys)
        others = []
        if self.letters:
            prefix, table, letters = self.letters[0], self.table, LETTERS.fullmatch
            tokenize, as_bytes = self.model.tokenize, self._bytes
            for i, key in enumerate(keys):
                glued = key.startswith(GLUED)
                word = key[1:] if glued else key
                if letters(word):
                    word = word.translate(table)
                    values[i] = as_bytes([t.id for t in tokenize(word if glued else prefix + word)])
                else:
                    others.append(i)
        else:
            others = list(range(len(keys)))
        # A key of letters alone is a word behind a space.
        before = " " if self.spaces_matter else ""
        spelled = {i: before + keys[i] if keys[i].isalpha() else self._spelled(keys[i]) for i in others}
        clean = {i: s for i, s in spelled.items() if s is not None}
        for i, ids in zip(clean, self._library(list(clean.values())), strict=True):
            values[i] = ids
        return values

    def _spelled(self, key: str) -> str | None:
        """The characters to encode for a chunk; None if its text must be encoded whole."""
        core, spaced = core_of(key)
        if not self.spaces_matter:
            return core
        return (" " + core if spaced else core) if cuts_cleanly(core) else None

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each whole text, equal to the library's ``encode(text, add_special_tokens=False)``."""
        return encode_texts(texts, self.memo, lambda t: self._library([t])[0], b"".join, self.special)


@lru_cache(maxsize=2)
def library_ids(path: str, spaces_matter: bool, compact: bool = False) -> LibraryIds:
    """The encoder of this worker process: its chunk memo serves all tasks that the process runs."""
    return LibraryIds(path, spaces_matter, compact)
