r"""Byte-level BPE encoding and decoding (4) with DuckDB recursive queries inside the tasks.

A text is cut into pieces (``pieces.py``) and these into matches of the tokenizer's pattern. Each task gathers the
distinct matches of its texts, and a recursive query contracts them: token-position rows meet the merge table, and
each word's leftmost pair of least rank becomes one row, until no pair is left. An ordered aggregation then joins the
bytes of each word's tokens; a text decodes to its words' bytes in order. Ids from elsewhere are cut before tokens
that begin with a space (any cut decodes alike) and joined by the same aggregation.

The merge table comes from the rank file (two tokens merge if their joined bytes are a token), about 50,000
ranks, broadcast after a check of its size. Pieces and matches already encoded stay in bounded stores of the worker
process, which only save time. No shuffle; a lost task starts again from its own rows.

Words over ``SHORT`` bytes are contracted in blocks of that size, and the seams between blocks mended: a row of
tokens is a word's encoding exactly if each two neighbours, contracted by themselves, stay these two tokens (a first
merge across the border of two such neighbours would also happen in the contraction of the two alone). So each seam
is tested by a contraction of its two tokens; where it does not hold, the tokens around it are contracted again
together, and the borders of that window become seams. The work grows with the length of the word.

Defined results: null and empty texts have no tokens and decode to no bytes; ids outside the vocabulary raise;
other columns, null ids and repeated rows stay as they are.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Callable
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.pieces import Pieces, Ragged, Store
from tallyspark.llm.storage import fresh, of_process, release
from tallyspark.llm.text import chunks

#: Entries that a rank file may have at most to be broadcast.
MAX_RANKS = 1_000_000
#: Texts handled together, words contracted together (bytes), longest word of the plain query, entries of a store.
TEXT_BYTES, WORD_BYTES, SHORT, KEPT = 8 << 20, 600_000, 64, 500_000
#: Tokens before a seam that are contracted again with it, rounds in which all seams of a word are mended at once.
BEFORE, ROUNDS = 4, 4

_CONTRACT = """
WITH RECURSIVE state(w, p, t, q, n, m, best) AS (
    SELECT w, p, t, q, n, m, min(CASE WHEN m IS NOT NULL THEN m::BIGINT * 4294967296 + p END) OVER (PARTITION BY w)
    FROM (SELECT a.*, k.m
          FROM (SELECT w, p, t, lead(p) OVER word AS q, lead(t) OVER word AS n
                FROM tokens WINDOW word AS (PARTITION BY w ORDER BY p)) a
          LEFT JOIN merges k ON k.l = a.t AND k.r = a.n)
    UNION ALL
    SELECT *, min(CASE WHEN m IS NOT NULL THEN m::BIGINT * 4294967296 + p END) OVER (PARTITION BY w)
    FROM (SELECT x.*, k.m
          FROM (SELECT s.w, s.p,
                       CASE WHEN s.p = c.p THEN c.m ELSE s.t END AS t,
                       CASE WHEN s.p = c.p THEN c.next_p ELSE s.q END AS q,
                       CASE WHEN s.p = c.p THEN c.next_t WHEN s.q = c.p THEN c.m ELSE s.n END AS n
                FROM state s
                JOIN (SELECT a.w, a.p, a.q, a.m, b.q AS next_p, b.n AS next_t
                      FROM state a JOIN state b ON a.w = b.w AND a.q = b.p
                      WHERE a.best = a.m::BIGINT * 4294967296 + a.p) c ON s.w = c.w
                WHERE s.p <> c.q) x
          LEFT JOIN merges k ON k.l = x.t AND k.r = x.n)
)
SELECT w, p, t FROM state WHERE best IS NULL ORDER BY w, p
"""

_JOIN_BYTES = """
SELECT string_agg(v.hex, '' ORDER BY k.p) AS hex FROM pieces k JOIN vocabulary v ON v.t = k.t GROUP BY k.w ORDER BY k.w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file on the driver: base-64 bytes and rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"{path} has {len(ranks)} ranks; at most {MAX_RANKS} are broadcast")
    return ranks


class Codec:
    """The merge table and vocabulary in DuckDB, for the texts of one worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = KEPT):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = {r: t for t, r in ranks.items()}
        self.matches, self.pieces = Store(self._coded_matches, kept), Store(self._coded_pieces, kept)
        rows = []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    rows.append((a, b, rank))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        table = np.array(rows, np.int32).reshape(-1, 3)
        self._load("merges", pa.table({"l": table[:, 0], "r": table[:, 1], "m": table[:, 2]}))
        self._load("vocabulary", pa.table({"t": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        spaces = np.zeros(max(ranks.values()) + 1, bool)
        spaces[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.begins = spaces

    def _load(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _query(self, sql: str, name: str, table: pa.Table) -> dict[str, np.ndarray]:
        self.db.register(name, table)
        try:
            return self.db.execute(sql).fetchnumpy()
        finally:
            self.db.unregister(name)

    def contract(self, words: list[bytes]) -> Ragged:
        """The ids of each word."""
        whole, at, short, long = [], [], [], []
        for k, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                whole.append(rank)
                at.append(k)
            elif len(word) > SHORT:
                long.append(k)
            elif word:
                short.append(k)
        # words of a length end together, so that no round runs for a few words only
        short.sort(key=lambda k: len(words[k]))
        parts = self._contracted([words[k] for k in short])
        w = [np.array(at, np.int64), np.repeat(np.array(short, np.int64), parts.lengths())]
        ids = [np.array(whole, np.int32), parts.values]
        for k, found in zip(long, self._long([words[k] for k in long])):
            w.append(np.full(len(found), k))
            ids.append(found)
        w, ids = np.concatenate(w), np.concatenate(ids)
        return Ragged(ids[np.argsort(w, kind="stable")], np.searchsorted(np.sort(w), np.arange(len(words) + 1)))

    def _contracted(self, words: list[bytes]) -> Ragged:
        """The ids that merges alone make of each word."""
        lens = np.array([len(x) for x in words], np.int64)
        upto = np.concatenate([[0], np.cumsum(lens)])
        raw = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ids, n, at = [np.empty(0, np.int32)], np.zeros(len(words) + 1, np.int64), 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + WORD_BYTES, "right")) - 1)
            w = np.repeat(np.arange(to - at, dtype=np.int32), lens[at:to])
            p = np.arange(len(w)) - np.repeat(upto[at:to] - upto[at], lens[at:to])
            got = self._query(_CONTRACT, "tokens", pa.table({"w": w, "p": p.astype(np.int32), "t": raw[upto[at]:upto[to]]}))
            ids.append(np.asarray(got["t"], np.int32))
            n[at + 1:to + 1] = np.bincount(got["w"], minlength=to - at)
            at = to
        return Ragged(np.concatenate(ids), np.cumsum(n))

    def _long(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words of any length: blocks, and their seams mended until all hold."""
        if not words:
            return []
        cut = [[x[k:k + SHORT] for k in range(0, len(x), SHORT)] for x in words]
        blocks = {b: None for c in cut for b in c}
        found = self._contracted(list(blocks))
        ids_of = {b: found.values[x:y] for b, x, y in zip(blocks, found.edge[:-1].tolist(), found.edge[1:].tolist())}
        out, seams = [], []
        for c in cut:
            parts = [ids_of[b] for b in c]
            out.append(np.concatenate(parts))
            seams.append(np.cumsum([len(p) for p in parts])[:-1].tolist())
        holds: dict[tuple[int, int], bool] = {}
        turn, reach, left = 0, [BEFORE] * len(words), [-1] * len(words)
        while any(seams):
            pairs = {(int(ids[i - 1]), int(ids[i])): None for ids, own in zip(out, seams) for i in own}
            new = [p for p in pairs if p not in holds]
            if new:
                tested = self._contracted([self.tokens[a] + self.tokens[b] for a, b in new])
                for p, x, y in zip(new, tested.edge[:-1].tolist(), tested.edge[1:].tolist()):
                    holds[p] = tuple(tested.values[x:y].tolist()) == p
            windows: list[list[tuple[int, int]]] = []
            for k, (ids, own) in enumerate(zip(out, seams)):
                open_ = [i for i in own if not holds[int(ids[i - 1]), int(ids[i])]]
                # a shift that runs through the word is followed from its start, else all shifts would move at once
                mended = open_ if turn < ROUNDS else open_[:1]
                # a window that began too late begins earlier, twice as far each time
                reach[k] = reach[k] * 2 if open_[:1] == [left[k]] else BEFORE
                spans: list[tuple[int, int]] = []
                for i in mended:
                    a, b, size = max(0, i - reach[k]), i, 0
                    while b < len(ids) and size < SHORT:
                        size += len(self.tokens[int(ids[b])])
                        b += 1
                    if spans and a <= spans[-1][1]:
                        a = spans.pop()[0]
                    spans.append((a, b))
                seams[k] = [i for i in open_ if not any(a < i < b for a, b in spans)]
                windows.append(spans)
            texts = [b"".join(self.tokens[t] for t in out[k][a:b].tolist()) for k, spans in enumerate(windows) for a, b in spans]
            made = self._contracted(texts)
            at = 0
            for k, spans in enumerate(windows):
                if not spans:
                    continue
                ids, parts, places, last, shift = out[k], [], [], 0, 0
                moved = []
                for a, b in spans:
                    new_ids = made.values[made.edge[at]:made.edge[at + 1]]
                    at += 1
                    parts += [ids[last:a], new_ids]
                    moved.append((b, len(new_ids) - (b - a)))
                    places += [a + shift, a + shift + len(new_ids)]
                    shift += len(new_ids) - (b - a)
                    last = b
                left[k] = places[0]
                parts.append(ids[last:])
                out[k] = np.concatenate(parts)
                seams[k] = sorted({i for i in [*_shifted(seams[k], moved), *places] if 0 < i < len(out[k])})
            turn += 1
        return out

    def _coded_matches(self, names: pa.Array) -> dict[str, Ragged]:
        ids = self.contract(names.to_pylist())
        return {"ids": ids, "bytes": self._joined(ids)}

    def _coded_pieces(self, names: pa.Array) -> dict[str, Ragged]:
        split = self.pattern.findall
        parts = [split(x) for x in names.cast(pa.large_string()).to_pylist()]
        edge = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        coded = pa.array(list(chain.from_iterable(parts)), pa.large_string()).cast(pa.large_binary()).dictionary_encode()
        rows = self.matches.rows(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        out = {}
        for name in ("ids", "bytes"):
            own = self.matches.found[name].take(rows) if len(rows) else Ragged(np.empty(0, np.int32), np.zeros(1, np.int64))
            out[name] = Ragged(own.values, own.edge[edge])
        return out

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The ids of a chunk of texts (flat, and where each text's ids begin) and the decoded bytes."""
        p = Pieces(arr, strip=False)
        if not len(p.codes):
            return np.empty(0, np.int32), np.zeros(len(arr) + 1, np.int64), pa.array([b""] * len(arr), pa.large_binary())
        rows = self.pieces.rows(p.names)[p.codes]
        ids, joined = (self.pieces.found[name].take(rows) for name in ("ids", "bytes"))
        return ids.values, ids.edge[p.first], pa.Array.from_buffers(
            pa.large_binary(), len(arr), [None, pa.py_buffer(joined.edge[p.first]), pa.py_buffer(joined.values)])

    def _joined(self, ids: Ragged) -> Ragged:
        """The bytes of each row of ids, by the ordered aggregation."""
        n = ids.lengths()
        hexes, size, at = [], np.zeros(len(ids) + 1, np.int64), 0
        while at < len(ids):
            to = max(at + 1, int(np.searchsorted(ids.edge, ids.edge[at] + 2 * WORD_BYTES, "right")) - 1)
            t = np.asarray(ids.values[ids.edge[at]:ids.edge[to]], np.int32)
            w = np.repeat(np.arange(to - at, dtype=np.int32), n[at:to])
            got = self._query(_JOIN_BYTES, "pieces", pa.table({"w": w, "p": np.arange(len(t), dtype=np.int32), "t": t}))["hex"].tolist()
            hexes += got
            size[at + 1 + np.flatnonzero(n[at:to])] = [len(x) // 2 for x in got]
            at = to
        return Ragged(np.frombuffer(bytes.fromhex("".join(hexes)), np.uint8), np.cumsum(size))

    def join(self, pieces: list[bytes]) -> list[bytes]:
        """The bytes of each piece of ids (int32, little-endian)."""
        edge = np.concatenate([[0], np.cumsum([len(p) // 4 for p in pieces])]).astype(np.int64)
        raw = self._joined(Ragged(np.frombuffer(b"".join(pieces), "<i4"), edge))
        whole = raw.values.tobytes()
        return [whole[a:b] for a, b in zip(raw.edge[:-1].tolist(), raw.edge[1:].tolist())]

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id row."""
        cut: list[list[bytes]] = []
        for ids in rows:
            if not len(ids):
                cut.append([])
                continue
            if ids.min() < 0 or ids.max() >= len(self.begins):
                raise ValueError("an id is outside the vocabulary")
            raw = ids.tobytes()
            edge = np.flatnonzero(self.begins[ids]) * 4
            edge = [0, *edge[edge > 0].tolist(), len(raw)]
            cut.append([raw[a:b] for a, b in zip(edge, edge[1:])])
        pieces: dict[bytes, bytes] = dict.fromkeys((p for c in cut for p in c), b"")
        known = dict(zip(pieces, self.join(list(pieces)))).__getitem__
        return [b"".join(map(known, c)) for c in cut]


def _shifted(places: list[int], moved: list[tuple[int, int]]) -> list[int]:
    """Places after windows that end at the given positions have become longer or shorter by the given numbers."""
    ends, by = [b for b, _ in moved], np.cumsum([d for _, d in moved]).tolist()
    out = []
    for i in places:
        k = bisect.bisect_right(ends, i)
        out.append(i + (by[k - 1] if k else 0))
    return out


class Tokenizer:
    """Encoding and decoding columns for one rank file and pattern.

    ``kept`` (cache entries of a worker process), ``chunk`` (bytes of text encoded together) and ``stay`` (whether a
    worker keeps its tables and cache for its next task) trade memory for time; results are the same.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, kept: int = KEPT, chunk: int = TEXT_BYTES,
                 stay: bool = True):
        self.ranks, self.pattern, self.kept, self.chunk = spark.sparkContext.broadcast(read_ranks(path)), pattern, kept, chunk
        self.stay = stay
        self.name = f"bpe {path} {pattern} {kept}"

    def encode(self, docs: DataFrame, text: str, add: str, then: Callable[[pa.Array, np.ndarray, np.ndarray, pa.Array], dict]) \
            -> DataFrame:
        """``docs`` with the columns ``add`` (DDL) that ``then`` makes of each chunk: its texts, flat ids,
        where each text's ids begin, and decoded bytes. Chunks are a few MB of text, whatever the batches are."""
        ranks, pattern, name, at = self.ranks, self.pattern, self.name, docs.columns.index(text)
        kept, size, stay = self.kept, self.chunk, self.stay

        def bpe_encode(batches):
            codec = of_process(name, lambda: Codec(ranks.value, pattern, kept))
            for batch in batches:
                start = 0
                for c in chunks(batch.column(at).cast(pa.large_string()), size):
                    own = batch.slice(start, len(c))
                    start += len(c)
                    new = then(c, *codec.encode(c))
                    yield pa.RecordBatch.from_arrays([*own.columns, *new.values()], names=[*own.schema.names, *new])
                release(keep=True)
            if not stay:
                del codec
                release()

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        return docs.mapInArrow(bpe_encode, f"{schema}, {add}")

    def decode(self, ids: Column) -> Column:
        """Bytes (binary) of a column of ids."""
        ranks, pattern, name = self.ranks, self.pattern, self.name

        def bpe_decode(rows: pa.Array) -> pa.Array:
            codec = of_process(name, lambda: Codec(ranks.value, pattern))
            out, at, step = [], 0, 512
            while at < len(rows):
                part = rows.slice(at, step)
                out += codec.decode(_id_rows(part))
                at += step
            return pa.array(out, pa.binary())

        return arrow_udf(bpe_decode, "binary")(ids)


def _id_rows(part: pa.Array) -> list[np.ndarray]:
    """Each list of ids as a numpy array; null counts as empty."""
    off = part.offsets.to_numpy()
    values = part.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
    live = part.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else values[:0] for a, b, ok in zip(off[:-1], off[1:], live)]


def id_lists(ids: np.ndarray, edge: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32()))


def sha256_of_ids(ids: np.ndarray, edge: np.ndarray) -> pa.Array:
    """SHA-256 (hex) of each text's decimal ids, joined by one space."""
    if not len(ids):
        return pa.array([hashlib.sha256().hexdigest()] * (len(edge) - 1), pa.string())
    names = pa.array([f"{x} " for x in range(int(ids.max()) + 1)], pa.large_string())
    _, off, data = names.take(pa.array(ids)).buffers()
    at = np.frombuffer(off, np.int64)[edge].tolist()
    raw = memoryview(data)
    return pa.array([hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:])], pa.string())


def sha256_of_bytes(rows: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(r.as_buffer()).hexdigest() for r in rows], pa.string())


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with two last columns: ``ids`` (array of int) and ``decoded`` (binary, joined from the ids)."""
    ids, decoded = fresh(docs, "ids", "decoded")
    return Tokenizer(docs.sparkSession, path, pattern).encode(
        docs, text, f"{ids} array<int>, {decoded} binary",
        lambda texts, flat, edge, joined: {ids: id_lists(flat, edge), decoded: joined.cast(pa.binary())})


def encode_checked(docs: DataFrame, path: str, pattern: str, text: str = "text", **options) -> DataFrame:
    """``docs`` with three last columns: ``ids``, ``n_tokens`` and ``round_trip``, whether the ids decode to the
    text; the decoded bytes stay in the tasks."""
    ids, n, ok = fresh(docs, "ids", "n_tokens", "round_trip")

    def check(texts, flat, edge, joined):
        same = [(t.as_py() or "").encode() == j.as_py() for t, j in zip(texts, joined)]
        return {ids: id_lists(flat, edge), n: pa.array(np.diff(edge), pa.int64()), ok: pa.array(same, pa.bool_())}

    return Tokenizer(docs.sparkSession, path, pattern, **options).encode(
        docs, text, f"{ids} array<int>, {n} bigint, {ok} boolean", check)


def encode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and the SHA-256 of the ids and of the decoded bytes, made of the same ids and
    bytes beside them, so that the ids of all texts need not leave the tasks."""
    n, of_ids, of_bytes = fresh(docs, "n_tokens", "ids_sha256", "decoded_sha256")
    return Tokenizer(docs.sparkSession, path, pattern).encode(
        docs, text, f"{n} bigint, {of_ids} string, {of_bytes} string",
        lambda texts, flat, edge, joined: {n: pa.array(np.diff(edge), pa.int64()), of_ids: sha256_of_ids(flat, edge),
                                           of_bytes: sha256_of_bytes(joined)})
