"""Vectorised words of Arrow text columns: byte tables and offsets, no Python object per word.

The word patterns used here separate at single ASCII bytes only, and UTF-8 never uses ASCII bytes inside a
longer character, so byte positions give exactly the words of the code-point patterns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once; a longer single document makes a chunk of its own.
CHUNK_BYTES = 3 << 20

_bytes = np.arange(256, dtype=np.uint8)
#: Lower-cases A-Z and nothing else.
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
#: First bytes of characters: there are as many as code points.
CHAR_START = (_bytes & 0xC0) != 0x80


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 document offsets of a string array; null counts as empty."""
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    _, offsets, data = arr.buffers()
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``limit`` bytes, whole documents each; nothing is left out."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    _, off = flat(arr)
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield arr.slice(at, to - at)
        at = to


class Words:
    """Words of a chunk: ``starts``/``ends`` (bytes of the chunk), ``doc`` (row of the chunk) and ``first``
    (position of each document's first word, with one more at the end)."""

    def __init__(self, arr: pa.Array, keep: np.ndarray, lower: bool):
        raw, self.off = flat(arr)
        self.n_docs = len(arr)
        self.data = LOWER[raw] if lower else raw
        mask = keep[self.data]
        before = np.empty_like(mask)
        before[:1] = False
        before[1:] = mask[:-1]
        begins = self.off[:-1]
        before[begins[begins < len(mask)]] = False
        self.starts = np.flatnonzero(mask & ~before)
        after = np.empty_like(mask)
        after[-1:] = False
        after[:-1] = mask[1:]
        stops = self.off[1:]
        after[stops[stops > 0] - 1] = False
        self.ends = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.starts, self.off)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        self.mask = mask

    def __len__(self) -> int:
        return len(self.starts)

    def array(self) -> pa.Array:
        """The words as a binary Arrow array."""
        off = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=off[1:])
        kept = np.ascontiguousarray(self.data[self.mask])
        return pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(off), pa.py_buffer(kept)])

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """An id for each word and the distinct words by id."""
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def counts(self) -> np.ndarray:
        """Words of each document."""
        return np.diff(self.first)


def per_doc(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of a 0/1 array (or integers) over each document's range ``off[i]:off[i+1]``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For byte positions: how many characters start before each (one more at the end), and at each document."""
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(CHAR_START[data], out=before[1:])
    return before, before[off]
