"""Whole texts as chunks that a tokenizer treats independently, each chunk encoded once per worker.

A byte-pair tokenizer first cuts a text into pre-tokens and never merges across them. Cutting a text at a single
space between two other characters, or around a single line feed, is always such a cut, so the encoding of a text is
the concatenation of the encodings of its chunks. Frequent chunks are then looked up instead of encoded again. Texts
with any other white space around a cut take the slow path: the whole text is encoded at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import compress
from operator import not_

import pyarrow as pa

GLUED = "\x01"  # marks a chunk that follows a line feed or the start of the text: no space before it

Encode = Callable[[Sequence[str]], Sequence[object]]
TAILS = ",.;:!?"  # punctuation that is cut off behind a word where the tokenizer allows it
_TAIL_ENDS = frozenset(TAILS)
SLOT_BYTES = 48  # of a key and its value in ``Slots``, with two bytes for their sizes
KEPT_CHARS = 64  # longer keys (texts without spaces) are encoded each time, so that entries bound the memory


class Slots:
    """A table of fixed size from keys to bytes: a key's hash names its slot, and the key put last has the slot.

    An entry takes ``SLOT_BYTES``, a third of what it takes in a dict, so that the many keys which do not soon come
    again are held cheaply. Keys are compared as a whole.
    """

    def __init__(self, slots: int):
        self.slots = slots
        self.table = bytearray(slots * SLOT_BYTES)  # its pages take memory when first written

    def get(self, key: str) -> bytes | None:
        raw, table = key.encode(), self.table
        at = hash(key) % self.slots * SLOT_BYTES
        if table[at] != len(raw) or not table.startswith(raw, at + 2):
            return None
        end = at + 2 + len(raw)
        return bytes(table[end : end + table[at + 1]]) or None

    def put(self, key: str, value: bytes | None) -> bool:
        """False if there is no value or the entry is too long for a slot."""
        raw = key.encode()
        if not value or len(raw) + len(value) + 2 > SLOT_BYTES:
            return False
        entry = bytes((len(raw), len(value))) + raw + value
        at = hash(key) % self.slots * SLOT_BYTES
        self.table[at : at + len(entry)] = entry
        return True


class Memo:
    """Bounded map from chunk key to encoded value: two generations, the older is dropped when the newer is full.

    ``encode`` maps keys to values (None: the text must be encoded whole). If ``separable(a, b)`` says that a tokenizer
    never joins the characters a and b, a word with punctuation behind it is looked up as word and punctuation. With
    ``slots`` (values must be bytes) a key goes to the generations when it comes again; before, it is in a table of
    ``slots`` slots.
    """

    def __init__(self, encode: Encode, join: Callable[[list], object] | None = None,
                 separable: Callable[[str, str], bool] | None = None, limit: int = 600_000, slots: int = 0):
        self.encode, self.join, self.separable, self.limit = encode, join, separable, limit
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.tails: dict[str, object] = {}
        self.slots = Slots(slots) if slots else None

    def _cut(self, key: str) -> str:
        base = key.rstrip(TAILS)
        if not base or base == GLUED or not self.separable(base[-1], key[len(base)]):
            return key
        return base

    def _in_slot(self, key: str) -> bool:
        """Whether the key is in the table; it has come again then and moves to the generations."""
        value = self.slots.get(key)
        if value is not None:
            self.new[key] = value
        return value is not None

    def _keep(self, found: dict[str, object]) -> None:
        if self.slots:
            put = self.slots.put
            found = {key: value for key, value in found.items() if not put(key, value)}
        self.new.update(found)

    def _encode_cut(self, missing: list[str]) -> dict[str, object]:
        bases = [self._cut(key) if key[-1:] in _TAIL_ENDS else key for key in missing]
        cut = [(base, key) for base, key in zip(bases, missing, strict=True) if base is not key]
        tails = {key[len(base) :] for base, key in cut} - self.tails.keys()
        new, old = self.new, self.old
        if self.slots:
            for base, _ in cut:
                if base not in new and base not in old:
                    self._in_slot(base)
        wanted = [base for base in dict.fromkeys(bases) if base not in new and base not in old]
        values = self.encode([*wanted, *(GLUED + tail for tail in tails)])
        found = dict(zip(wanted, values, strict=False))
        self.tails.update(zip(tails, values[len(wanted) :], strict=True))
        for base, key in cut:
            value = found[base] if base in found else new[base] if base in new else old[base]
            found[key] = None if value is None else self.join([value, self.tails[key[len(base) :]]])
        return found

    def fill(self, wanted: Iterable[str]) -> dict[str, object]:
        """Encode those of the distinct keys ``wanted`` that have no place; values that are not in ``new`` are returned."""
        new, old, missing, passing, found = self.new, self.old, [], [], {}
        for key in wanted:
            if key not in new:
                if key in old:
                    new[key] = old[key]
                elif len(key) > KEPT_CHARS:
                    passing.append(key)
                elif not self.slots or not self._in_slot(key):
                    missing.append(key)
        if missing:
            found = self._encode_cut(missing) if self.separable else dict(zip(missing, self.encode(missing), strict=True))
            self._keep(found)
        if passing:
            found |= zip(passing, self.encode(passing), strict=True)
        return found

    def look_up(self, texts: Sequence[Sequence[str] | None]) -> list[list[object] | None]:
        """Values of the keys of each text; None for a text without keys or with a key that has no value."""
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        get = self.new.get
        found = [None if keys is None else list(map(get, keys)) for keys in texts]
        gaps = {}  # places without a value, or with an empty one or 0
        for n, parts in enumerate(found):
            if parts and not all(parts):
                gaps[n] = list(compress(range(len(parts)), map(not_, parts)))
        passing = self.fill({texts[n][i] for n, places in gaps.items() for i in places})
        for n, places in gaps.items():
            parts, keys = found[n], texts[n]
            for i in places:
                value = get(keys[i])
                if value is None:
                    value = passing.get(keys[i])
                    if value is None:
                        found[n] = None
                        break
                parts[i] = value
        return found


def keys_of(text: str, start: str = GLUED) -> list[str]:
    """Chunk keys of a text; ``core_of`` gives back the characters of a key. ``start=""``: as if a space came first."""
    return (start + text.replace("\n", " \n " + GLUED)).split(" ")


def core_of(key: str) -> tuple[str, bool]:
    """The characters of a chunk and whether a space stands before them."""
    if key == "\n":
        return key, False
    return (key[1:], False) if key.startswith(GLUED) else (key, True)


def cuts_cleanly(core: str) -> bool:
    """False for an empty chunk or white space next to a cut: the text must then be encoded whole."""
    return core == "\n" or bool(core) and not (core[0].isspace() or core[-1].isspace() or GLUED in core)


def encode_texts(texts: Sequence[str], memo: Memo, whole: Callable[[str], object], join: Callable[[list], object],
                 unsafe: Sequence[str] = (), start: str = GLUED) -> list[object]:
    """Encode each text from its chunks, or by ``whole`` if a chunk is None or the text holds an ``unsafe`` string."""
    unsafe = (GLUED, *unsafe)
    keys = [None if any(s in text for s in unsafe) else keys_of(text, start) if text else [] for text in texts]
    found = memo.look_up(keys)
    return [whole(text) if parts is None else join(parts) for text, parts in zip(texts, found, strict=True)]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Smaller batches of at most ``rows`` rows and about ``size`` bytes (a single longer row stays whole)."""
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(rows, size // per_row))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
