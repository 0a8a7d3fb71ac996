"""Texts as sequences of pieces that tokenizers encode independently of each other, and ragged arrays of results.

A text is cut before a space whose neighbours are no white space. No match of a byte-level tokenizer's pattern
crosses such a place (a match takes a space only in front of what follows it), and no vocabulary piece of a
sentence-piece model does either (checked when the model is loaded; a text with the model's own mark for a space,
U+2581, is another matter: its bytes never come back, which the alignment finds out). So the tokens of a text are those of its
pieces in order, and each distinct piece has to be encoded once only. The test for white space is conservative:
places next to characters that share a first byte with Unicode spaces are not cut.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyspark.llm.text import flat

#: Bytes that may follow the space of a cut: no ASCII white space, no first byte of a Unicode space.
_AFTER = np.ones(256, bool)
_AFTER[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False


class Ragged:
    """Rows of different lengths: ``values`` and where each row begins (one more at the end)."""

    def __init__(self, values: np.ndarray, edge: np.ndarray):
        self.values, self.edge = values, edge

    @classmethod
    def of(cls, rows: list, dtype) -> Ragged:
        edge = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) for r in rows], out=edge[1:])
        values = np.fromiter((x for r in rows for x in r), dtype, int(edge[-1]))
        return cls(values, edge)

    def __len__(self) -> int:
        return len(self.edge) - 1

    def lengths(self) -> np.ndarray:
        return np.diff(self.edge)

    def positions(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values`` of the given rows, one after the other, and where each begins among them."""
        n = self.lengths()[rows]
        edge = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(n, out=edge[1:])
        return np.repeat(self.edge[rows] - edge[:-1], n) + np.arange(edge[-1]), edge

    def take(self, rows: np.ndarray) -> Ragged:
        if self.values.ndim > 1 or not len(self):
            at, edge = self.positions(rows)
            return Ragged(self.values[at], edge)
        # as byte strings, which Arrow copies row by row
        size, kind = self.values.itemsize, self.values.dtype
        whole = pa.Array.from_buffers(pa.large_binary(), len(self), [
            None, pa.py_buffer(np.ascontiguousarray(self.edge * size)), pa.py_buffer(np.ascontiguousarray(self.values))])
        _, edge, data = whole.take(pa.array(rows)).buffers()
        edge = np.frombuffer(edge, np.int64)[:len(rows) + 1] if len(rows) else np.zeros(1, np.int64)
        values = np.frombuffer(data, np.uint8)[:edge[-1]] if data is not None else np.empty(0, np.uint8)
        return Ragged(values.view(kind), edge // size)

    def append(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate([self.values, other.values]),
                      np.concatenate([self.edge, self.edge[-1] + other.edge[1:]]))


class Pieces:
    """Pieces of a chunk of texts: ``names`` (distinct), ``codes`` (name of each piece) and ``first`` (position of
    each text's first piece, one more at the end). With ``strip`` the space that begins all but a text's first
    piece is left out: the pieces are those of a space and the text, each without its space."""

    def __init__(self, arr: pa.Array, strip: bool):
        raw, off = flat(arr)
        cut = np.zeros(len(raw), bool)
        space = raw == 0x20
        cut[1:-1] = space[1:-1] & ~space[:-2] & _AFTER[raw[2:]]
        full = np.flatnonzero(np.diff(off))
        cut[off[full + 1] - 1] = False
        cut[off[full]] = True
        begin = np.flatnonzero(cut)
        edge, kept = np.append(begin, len(raw)), raw
        if strip:
            cut[off[full]] = False
            kept = raw[~cut]
            gone = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(cut, out=gone[1:])
            edge = edge - gone[edge]
        array = pa.Array.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(np.ascontiguousarray(edge)), pa.py_buffer(np.ascontiguousarray(kept))])
        coded = array.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.names, self.first = coded.dictionary, np.searchsorted(begin, off)

    def docs(self) -> np.ndarray:
        """The text of each piece."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Store:
    """Results of pieces, kept by a worker process from chunk to chunk (a cache of at most ``most`` pieces beside
    those of the chunk at hand; it only saves time)."""

    def __init__(self, make: Callable[[pa.Array], dict[str, Ragged]], most: int):
        self.make, self.most = make, most
        self.names, self.used = pa.array([], pa.large_binary()), np.zeros(0, np.int32)
        self.found: dict[str, Ragged] = {}

    def rows(self, names: pa.Array) -> np.ndarray:
        """The row of each of the distinct names in ``found``; new names are made first."""
        if len(self.names) > self.most:
            self._forget()
        at = pc.index_in(names, value_set=self.names)
        new = names.filter(at.is_null())
        place = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            made = self.make(new)
            self.found = {k: self.found[k].append(v) for k, v in made.items()} if self.found else made
            place[place < 0] = len(self.names) + np.arange(len(new))
            self.names = pa.concat_arrays([self.names, new])
            self.used = np.append(self.used, np.zeros(len(new), np.int32))
        self.used[place] += 1
        return place

    def _forget(self) -> None:
        """Keep the pieces that more than one chunk had, unless they are too many as well."""
        kept = np.flatnonzero(self.used > 1)
        if len(kept) > self.most // 2:
            kept = kept[:0]
        self.names, self.used = self.names.take(pa.array(kept)), np.zeros(len(kept), np.int32)
        self.found = {k: v.take(kept) for k, v in self.found.items()} if len(kept) else {}


def library_ids(tokenizer, texts: list[str], step: int = 10_000) -> Ragged:
    """Ids of the tokenizers library for each text."""
    done, edge = [np.empty(0, np.int64)], np.zeros(len(texts) + 1, np.int64)
    for at in range(0, len(texts), step):
        rows = [e.ids for e in tokenizer.encode_batch_fast(texts[at:at + step], add_special_tokens=False)]
        edge[at + 1:at + 1 + len(rows)] = [len(r) for r in rows]
        done.append(np.array(list(chain.from_iterable(rows)), np.int64))
    return Ragged(np.concatenate(done), np.cumsum(edge))


def token_bytes(tokenizer) -> np.ndarray:
    """How many bytes of text each id of a byte-level tokenizer stands for; 0 for numbers that are no ids."""
    size = np.zeros(1 + max(tokenizer.get_vocab().values(), default=-1), np.int64)
    for token, k in tokenizer.get_vocab(with_added_tokens=False).items():
        size[k] = len(token)  # a character stands for a byte
    for k, token in tokenizer.get_added_tokens_decoder().items():
        size[k] = len(token.content.encode())
    return size


def joined_ids(tokenizer, size: np.ndarray, names: pa.Array, step: int = 16 << 10, together: int = 32) -> Ragged:
    """``library_ids`` of pieces, many in one text of about ``step`` bytes: where pieces follow each other as the text
    of them would be cut, their tokens are those of the text, and the bytes of the ids (``size``, see ``token_bytes``)
    tell whose each one is. Pieces that can't follow another one, and those of a text in which a token does not end
    with a piece, are encoded one by one."""
    strings = names.cast(pa.large_string())
    raw, off = flat(strings)
    fits = np.diff(off) > 1
    begin, end = off[:-1][fits], off[1:][fits]
    fits[fits] = (raw[begin] == 0x20) & _AFTER[raw[begin + 1]] & (raw[end - 1] != 0x20)
    where = np.flatnonzero(fits)
    raw, off = flat(strings.filter(pa.array(fits)))
    marks = np.append(np.unique(np.searchsorted(off, np.arange(0, len(raw), step))), len(where)) if len(where) else [0]
    spans = list(zip(marks[:-1], marks[1:]))
    done, n = [np.empty(0, np.int64)], np.zeros(len(where), np.int64)
    for i in range(0, len(spans), together):
        some = spans[i:i + together]
        texts = [raw[off[a]:off[b]].tobytes().decode() for a, b in some]
        for (a, b), coded in zip(some, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(coded.ids, np.int64)
            upto, ends = np.cumsum(size[ids]), off[a + 1:b + 1] - off[a]
            last = np.searchsorted(upto, ends)
            if len(ids) and upto[-1] == ends[-1] and size[ids].all() and (upto[last] == ends).all():
                n[a:b] = np.diff(last, prepend=-1)
                done.append(ids)
    fits[where[n == 0]] = False  # a piece that fits has an id at least
    found = Ragged(np.concatenate(done), np.concatenate([[0], np.cumsum(n[n > 0])]))
    found = found.append(library_ids(tokenizer, strings.filter(pa.array(~fits)).to_pylist()))
    place = np.empty(len(fits), np.int64)
    place[np.concatenate([np.flatnonzero(fits), np.flatnonzero(~fits)])] = np.arange(len(fits))
    return found.take(place)
