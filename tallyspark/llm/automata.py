"""Weighted acyclic automata over symbol sequences, built from sorted sequences a whole level at a time.

``Paths`` are the sorted sequences as levels of a trie: each node has a parent in the level before, a symbol (place
in the sorted ``names``) and a weight (0: only a prefix). ``pack`` freezes them, deepest level first, into a minimal
automaton: states with equal weight and equal arcs become one, by a register of the states so far; equal hashes are
compared arc by arc. ``unpack`` reads the paths again. ``union`` merges many and sums the weights, ``ranges`` cuts
paths at splitter sequences, and ``compose`` gives the weights that one has for another's paths.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from tallyspark.llm.pieces import Ragged

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Paths:
    """Sorted sequences: ``names`` (sorted symbols) and for each level ``parent``, ``symbol`` and ``weight``."""

    def __init__(self, names: pa.Array, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.names, self.levels = names, levels

    def __len__(self) -> int:
        return sum(len(x[0]) for x in self.levels)

    def children(self, d: int) -> np.ndarray:
        """Where the children of each node of level ``d`` begin in the next level (one more at the end)."""
        n = len(self.levels[d][0])
        if d + 1 == len(self.levels):
            return np.zeros(n + 1, np.int64)
        return np.concatenate([[0], np.cumsum(np.bincount(self.levels[d + 1][0], minlength=n))])

    def weights(self) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int64), *[x[2] for x in self.levels]])

    def slice(self, begin: list[int], end: list[int]) -> Paths:
        """The nodes ``begin[d]:end[d]`` of each level; nodes before them are kept as prefixes where needed."""
        start = list(begin)
        for d in range(len(self.levels) - 2, -1, -1):
            if end[d + 1] > start[d + 1]:
                start[d] = min(start[d], int(self.levels[d + 1][0][start[d + 1]]))
        levels = []
        for d, (parent, symbol, weight) in enumerate(self.levels):
            a, b = start[d], max(end[d], start[d])
            if d + 1 < len(self.levels) and end[d + 1] > start[d + 1]:
                b = max(b, int(self.levels[d + 1][0][end[d + 1] - 1]) + 1)
            w = weight[a:b].copy()
            w[: begin[d] - a] = 0
            w[max(0, end[d] - a):] = 0
            levels.append((parent[a:b] - (start[d - 1] if d else 0), symbol[a:b], w))
        return Paths(self.names, levels)

    def keep(self, wanted: list[np.ndarray]) -> Paths:
        """Only the wanted nodes (a mask for each level) and the prefixes of them; other weights become 0."""
        levels, masks = [], [w.copy() for w in wanted]
        for d in range(len(masks) - 1, 0, -1):
            masks[d - 1][self.levels[d][0][masks[d]]] = True
        place = None
        for (parent, symbol, weight), mask, want in zip(self.levels, masks, wanted):
            up = parent[mask] if place is None else place[parent[mask]]
            levels.append((up, symbol[mask], np.where(want, weight, 0)[mask]))
            place = np.cumsum(mask) - 1
        return Paths(self.names, levels)


def distinct(parent: np.ndarray, symbol: np.ndarray, weight: np.ndarray, symbols: int, how=np.add):
    """Sorted distinct (parent, symbol), their weights combined by ``how``, and the node of each given entry."""
    if not len(parent):
        return (parent, symbol, weight), np.empty(0, np.int64)
    if int(parent.max() + 1) * symbols < 1 << 62:
        key = parent * symbols + symbol
        order = np.argsort(key)
        new = np.concatenate([[True], np.diff(key[order]) != 0])
    else:
        order = np.lexsort((symbol, parent))
        new = np.concatenate([[True], (np.diff(parent[order]) != 0) | (np.diff(symbol[order]) != 0)])
    at = np.flatnonzero(new)
    node = np.empty(len(order), np.int64)
    node[order] = np.cumsum(new) - 1
    first = order[at]
    return (parent[first], symbol[first], how.reduceat(weight[order], at)), node


def of_rows(names: pa.Array, rows: np.ndarray, weight: np.ndarray, how=np.add) -> tuple[Paths, np.ndarray]:
    """Paths of the sequences in ``rows`` (symbols, -1 behind the end), and for each row the place of its last node
    among the nodes of all levels."""
    levels, last = [], np.zeros(len(rows), np.int64)
    live, node, before = np.arange(len(rows)), np.zeros(len(rows), np.int64), 0
    for d in range(rows.shape[1]):
        here = rows[live, d] >= 0
        live, node = live[here], node[here]
        ends = np.ones(len(live), bool) if d + 1 == rows.shape[1] else rows[live, d + 1] < 0
        level, node = distinct(node, rows[live, d], np.where(ends, weight[live], 0), len(names), how)
        last[live[ends]] = before + node[ends]
        before += len(level[0])
        levels.append(level)
    return Paths(names, levels), last


def rows_of(paths: Paths, d: int, nodes: np.ndarray, width: int) -> np.ndarray:
    """The sequences (symbols, -1 behind the end) of nodes of level ``d``."""
    out = np.full((len(nodes), width), -1, np.int64)
    for k in range(d, -1, -1):
        parent, symbol, _ = paths.levels[k]
        out[:, k] = symbol[nodes]
        nodes = parent[nodes]
    return out


def _planes(x: np.ndarray) -> bytes:
    width = 4 if not len(x) or int(x.max()) < 1 << 32 else 8
    body = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return struct.pack("<BQ", width, len(x)) + body


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Register:
    """States so far: weight, arcs (symbol, target) and a hash of both."""

    def __init__(self):
        self.weight, self.hash = np.empty(0, np.int64), np.empty(0, np.uint64)
        self.arcs = Ragged(np.empty((0, 2), np.int64), np.zeros(1, np.int64))

    def add(self, weight: np.ndarray, arcs: Ragged) -> np.ndarray:
        """The state of each node with these weights and arcs; equal nodes get one state."""
        each = _mixed(arcs.values[:, 0].astype(np.uint64) * _MIX + arcs.values[:, 1].astype(np.uint64) + np.uint64(1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        h = _mixed(weight.astype(np.uint64) + _MIX) + total[arcs.edge[1:]] - total[arcs.edge[:-1]]
        _, first, code = np.unique(h, return_index=True, return_inverse=True)
        wrong = ~_equal(weight, arcs, np.arange(len(h)), weight, arcs, first[code])
        # nodes whose hash is that of a different node stay states of their own
        rep = np.where(wrong, np.arange(len(h)), first[code])
        own = np.unique(rep)
        known = np.full(len(own), -1, np.int64)
        if len(self.hash):
            order = np.argsort(self.hash, kind="stable")
            at = np.minimum(np.searchsorted(self.hash[order], h[own]), len(order) - 1)
            hit = self.hash[order][at] == h[own]
            known[hit] = order[at[hit]]
            hit[hit] = _equal(weight, arcs, own[hit], self.weight, self.arcs, known[hit])
            known[~hit] = -1
        new = known < 0
        known[new] = len(self.weight) + np.arange(new.sum())
        picked = own[new]
        self.weight, self.hash = np.append(self.weight, weight[picked]), np.append(self.hash, h[picked])
        self.arcs = self.arcs.append(arcs.take(picked))
        return known[np.searchsorted(own, rep)]


def _equal(weight: np.ndarray, arcs: Ragged, rows: np.ndarray, weight2: np.ndarray, arcs2: Ragged, rows2: np.ndarray) -> np.ndarray:
    """Whether rows of one and rows of the other agree in weight and arcs."""
    same = (weight[rows] == weight2[rows2]) & (arcs.lengths()[rows] == arcs2.lengths()[rows2])
    k = np.flatnonzero(same)
    mine, theirs = arcs.take(rows[k]), arcs2.take(rows2[k])
    differ = np.concatenate([[0], np.cumsum((mine.values != theirs.values).any(axis=1))])
    same[k] = differ[mine.edge[1:]] == differ[mine.edge[:-1]]
    return same


def _used(paths: Paths) -> np.ndarray:
    mark = np.zeros(len(paths.names), bool)
    for _, symbol, _ in paths.levels:
        mark[symbol] = True
    return np.flatnonzero(mark)


def bytes_of(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each name (large binary, no nulls) begins, one more at the end, and the bytes of all; no object per name."""
    if not len(names):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, edge, data = names.buffers()
    edge = np.frombuffer(edge, np.int64)[names.offset:names.offset + len(names) + 1]
    body = np.frombuffer(data, np.uint8)[edge[0]:edge[-1]] if data is not None else np.empty(0, np.uint8)
    return edge - edge[0], body


def pack(paths: Paths) -> bytes:
    """The minimal automaton of ``paths`` as bytes, with the symbols that it uses."""
    used = _used(paths)
    names = paths.names.take(pa.array(used))
    register = _Register()
    below = np.empty(0, np.int64)
    for d in range(len(paths.levels) - 1, -2, -1):
        if d + 1 < len(paths.levels):
            symbols = np.searchsorted(used, paths.levels[d + 1][1])
            values = np.column_stack([symbols, below])
            edge = paths.children(d) if d >= 0 else np.array([0, len(symbols)])
        else:
            values, edge = np.empty((0, 2), np.int64), np.zeros(len(paths.levels[d][0]) + 1, np.int64)
        below = register.add(paths.levels[d][2] if d >= 0 else np.zeros(1, np.int64), Ragged(values, edge))
    edge, body = bytes_of(names)
    parts = [struct.pack("<BQ", len(paths.levels), int(below[0]))]
    for x in (np.diff(edge), register.weight, register.arcs.lengths(), register.arcs.values[:, 0], register.arcs.values[:, 1]):
        parts.append(_planes(x))
    parts.append(body.tobytes())
    return zstandard.compress(b"".join(parts), 3)


def unpack(block: bytes) -> Paths:
    """The paths of an automaton."""
    raw = zstandard.decompress(block)
    depth, root = struct.unpack_from("<BQ", raw)
    at, found = 9, []
    for _ in range(5):
        width, n = struct.unpack_from("<BQ", raw, at)
        plane = np.frombuffer(raw, np.uint8, width * n, at + 9).reshape(width, n)
        found.append(np.ascontiguousarray(plane.T).view(f"<u{width}").ravel().astype(np.int64))
        at += 9 + width * n
    lengths, weight, n_arcs, symbol, target = found
    edge = np.concatenate([[0], np.cumsum(lengths)])
    names = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(edge), pa.py_buffer(raw[at:])])
    arcs = Ragged(np.arange(len(symbol)), np.concatenate([[0], np.cumsum(n_arcs)]))
    state, levels = np.array([root]), []
    for _ in range(depth):
        own = arcs.take(state)
        parent = np.repeat(np.arange(len(state)), own.lengths())
        state = target[own.values]
        levels.append((parent, symbol[own.values], weight[state]))
    return Paths(names, levels)


def pack_levels(paths: Paths) -> bytes:
    """The paths level by level as bytes, without looking for equal states: larger than ``pack``, and faster."""
    used = _used(paths)
    names = paths.names.take(pa.array(used))
    place = np.zeros(len(paths.names), np.int64)
    place[used] = np.arange(len(used))
    edge, body = bytes_of(names)
    parts = [struct.pack("<B", len(paths.levels)), _planes(np.diff(edge))]
    for d, (parent, symbol, weight) in enumerate(paths.levels):
        children = np.diff(paths.children(d - 1)) if d else np.array([len(parent)])
        parts += [_planes(children), _planes(place[symbol]), _planes(weight)]
    parts.append(body.tobytes())
    return zstandard.compress(b"".join(parts), 1)


def unpack_levels(block: bytes) -> Paths:
    raw = zstandard.decompress(block)
    at = 1

    def numbers() -> np.ndarray:
        nonlocal at
        width, n = struct.unpack_from("<BQ", raw, at)
        plane = np.frombuffer(raw, np.uint8, width * n, at + 9).reshape(width, n)
        at += 9 + width * n
        return np.ascontiguousarray(plane.T).view(f"<u{width}").ravel().astype(np.int64)

    lengths, levels = numbers(), []
    for _ in range(raw[0]):
        children, symbol, weight = numbers(), numbers(), numbers()
        levels.append((np.repeat(np.arange(len(children)), children), symbol, weight))
    edge = np.concatenate([[0], np.cumsum(lengths)])
    names = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(edge), pa.py_buffer(raw[at:])])
    return Paths(names, levels)


def sorted_names(arrays: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """Sorted distinct names of all arrays (byte order), and the place of each array's names."""
    coded = pa.concat_arrays([a.cast(pa.large_binary()) for a in arrays]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = rank[coded.indices.to_numpy(zero_copy_only=False)]
    return coded.dictionary.take(pa.array(order)), np.split(place, np.cumsum([len(a) for a in arrays])[:-1])


def union(many: list[Paths]) -> Paths:
    """One set of paths with the sums of the weights."""
    if len(many) == 1:
        return many[0]
    names, places = sorted_names([p.names for p in many])
    levels, nodes = [], None
    for d in range(max(len(p.levels) for p in many)):
        parts = [p.levels[d] for p in many]
        up = [x[0] if nodes is None else own[x[0]] for x, own in zip(parts, nodes or [None] * len(many))]
        level, node = distinct(np.concatenate(up), np.concatenate([place[x[1]] for x, place in zip(parts, places)]),
                               np.concatenate([x[2] for x in parts]), max(1, len(names)))
        levels.append(level)
        nodes = np.split(node, np.cumsum([len(x[0]) for x in parts])[:-1])
    return Paths(names, levels)


def ranges(paths: Paths, splitters: list[list[bytes]]) -> list[tuple[list[int], list[int]]]:
    """For each range between sorted splitter sequences: where its nodes begin and end in each level. A sequence
    belongs to the range after the last splitter that is not beyond it; prefixes come before longer sequences."""
    names, n = paths.names, len(paths.levels)
    flat = pa.array([s for one in splitters for s in one], pa.large_binary())
    together, (place, wanted) = sorted_names([names, flat])
    have = np.zeros(len(together) + 1, np.int64)
    have[place + 1] = 1
    below = np.cumsum(have)  # names of the paths that are less
    down = [paths.children(d) for d in range(n)]
    bounds, at = [[0] * n], 0
    for one in splitters:
        spot = wanted[at:at + len(one)]
        at += len(one)
        bound, lo, hi, exact = [], 0, len(paths.levels[0][0]), True
        for d in range(n):
            if not exact:
                lo = hi = int(down[d - 1][bound[-1]])
                bound.append(lo)
                continue
            s = int(spot[d])
            symbol = int(below[s])
            k = lo + int(np.searchsorted(paths.levels[d][1][lo:hi], symbol))
            exact = bool(have[s + 1]) and k < hi and int(paths.levels[d][1][k]) == symbol and d + 1 < len(one)
            bound.append(k + 1 if exact else k)
            if exact:
                lo, hi = int(down[d][k]), int(down[d][k + 1])
        bounds.append(bound)
    bounds.append([len(x[0]) for x in paths.levels])
    return list(zip(bounds[:-1], bounds[1:]))


def compose(paths: Paths, wanted: Paths) -> list[np.ndarray]:
    """For each level of ``wanted``: the node of ``paths`` with the same sequence, or -1."""
    _, (mine, theirs) = sorted_names([paths.names, wanted.names])
    out, before = [], None
    for d, (parent, symbol, _) in enumerate(wanted.levels):
        up = np.zeros(len(parent), np.int64) if before is None else before[parent]
        at = np.full(len(parent), -1, np.int64)
        own_parent, own_symbol, _ = paths.levels[d]
        live = np.flatnonzero(up >= 0)
        if len(live) and len(own_parent):
            size = int(max(mine.max(initial=0), theirs.max(initial=0))) + 1
            key, want = own_parent * size + mine[own_symbol], up[live] * size + theirs[symbol[live]]
            k = np.minimum(np.searchsorted(key, want), len(key) - 1)
            at[live] = np.where(key[k] == want, k, -1)
        before = at
        out.append(at)
    return out
