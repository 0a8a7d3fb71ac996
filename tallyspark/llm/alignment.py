"""Cross-tokenizer alignment (13): groups of tokens of two tokenizers that cover the same bytes, by interval coalescing.

A is a tokenizers-library file (byte-level BPE) that encodes a space and the text, B a sentence-piece model that
adds the space itself. The tokens of many pieces of text lie on one byte axis: all A and B tokens are lexsorted by
start, ``maximum.accumulate`` runs over their ends, and a group breaks where a start reaches the running maximum.
Overlaps expand within a group: each A token meets each B token of its group, in blocks of bounded size.

Texts are taken as pieces (``pieces.py``) at whose borders both tokenizers end a token, so a group never leaves its
piece, and each distinct piece is encoded, aligned and expanded once. A text with a piece whose joined bytes differ
from the text is encoded and aligned again as a whole; if its bytes still differ, it has no tokens.

Counting runs in Spark: a task writes, for each chunk of texts, its distinct id pairs with the numbers of documents,
and its documents' pairs as a compressed block. The pairs of all chunks are exchanged once by pair, where their
document counts are summed over a window, and once back by chunk, where each task works out its documents' sums.
A pair has one row for each chunk, however often it occurs. The highest count of each A id, at most one row for
each id of A's vocabulary, is broadcast.

Defined results: texts that are null, empty or whose bytes differ have zeros and ''; null ids and repeated rows stay,
and each row counts as a document; an empty table gives no rows; other columns stay, the text goes.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.pieces import Pieces, Ragged, Store, library_ids
from tallyspark.llm.storage import cut, fresh, of_process, release
from tallyspark.llm.text import chunks, per_doc

#: Text of a chunk, pieces that a worker keeps aligned, pairs expanded at once, pieces of documents handled at once.
TEXT_BYTES, KEPT, PAIRS, STEP = 8 << 20, 200_000, 2_000_000, 150_000
#: Marks of the written groups.
COMMA, BAR, END, NONE = (pa.scalar(x, pa.large_string()) for x in (",", "|", ";", ""))
#: Columns that every document gets, in order.
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Both tokenizers in a task, with the bytes of each token."""

    def __init__(self, a_file: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        vocabulary, of_char = json.loads(a_file)["model"]["vocab"], _byte_of_char()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in of_char for c in token):
                a_bytes[i] = bytes(of_char[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("the model has pieces with an inner space, so texts can't be cut at spaces")
        b_bytes = [bytes([int(n[1:-1], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                   for i, n in enumerate(names)]
        self.a_bytes, self.b_bytes = Ragged.of(a_bytes, np.uint8), Ragged.of(b_bytes, np.uint8)
        self.numbers = pa.array([str(i) for i in range(max(len(a_bytes), len(b_bytes)))])

    def align(self, names: pa.Array) -> dict[str, Ragged]:
        """Of each name: ``sums`` (whether the bytes agree, then COUNTS), ``keys`` (a << 32 | b) and ``times`` of its
        distinct id pairs, and ``groups`` (text, each group ended by a semicolon)."""
        texts = names.cast(pa.large_string()).to_pylist()
        a = library_ids(self.a, [f" {x}" for x in texts])
        b = Ragged.of(self.b.encode(texts, num_threads=1), np.int64)
        want = Ragged.of([], np.uint8)
        if len(texts):
            spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), names, pa.scalar(b"", pa.large_binary()))
            _, edge, data = spaced.buffers()
            edge = np.frombuffer(edge, np.int64)[: len(texts) + 1]
            want = Ragged(np.frombuffer(data, np.uint8)[: edge[-1]], edge)
        ok = self._agrees(a, self.a_bytes, want) & self._agrees(b, self.b_bytes, want)
        return self._groups(a, b, ok)

    @staticmethod
    def _agrees(ids: Ragged, table: Ragged, want: Ragged) -> np.ndarray:
        raw = table.take(ids.values)
        edge = raw.edge[ids.edge]
        ok = np.diff(edge) == want.lengths()
        rows = np.flatnonzero(ok)
        mine, theirs = Ragged(raw.values, edge).take(rows), want.take(rows)
        ok[rows] = per_doc(mine.values != theirs.values, mine.edge) == 0
        return ok

    def _groups(self, a: Ragged, b: Ragged, ok: np.ndarray) -> dict[str, Ragged]:
        n, rows = len(ok), np.flatnonzero(ok)
        a, b = a.take(rows), b.take(rows)
        ends = [np.cumsum(t.lengths()[x.values]) for t, x in ((self.a_bytes, a), (self.b_bytes, b))]
        starts = [np.concatenate([[0], e[:-1]]) if len(e) else e for e in ends]
        start, end = np.concatenate(starts), np.concatenate(ends)
        side = np.repeat([0, 1], [len(a.values), len(b.values)])
        order = np.lexsort((side, start))
        start, top, side = start[order], np.maximum.accumulate(end[order]), side[order]
        group = np.zeros(len(order), np.int64)
        np.cumsum(start[1:] >= top[:-1], out=group[1:])
        total = int(group[-1]) + 1 if len(group) else 0
        group_a, group_b = group[side == 0], group[side == 1]
        n_a, n_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
        edge_a, edge_b = (np.concatenate([[0], np.cumsum(x)]) for x in (n_a, n_b))
        # groups of each of the rows: its first A token's group is its first group
        first = np.append(group_a, total)[a.edge]
        sums = np.zeros((n, 5), np.int64)
        sums[rows] = np.column_stack([np.ones(len(rows), np.int64), a.lengths(), b.lengths(), np.diff(first), per_doc(n_a * n_b, first)])
        piece, keys, times = self._pairs(a, b, group_a, n_b, edge_b)
        at = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(rows[piece], minlength=n), out=at[1:])
        joined = [pc.binary_join(pa.LargeListArray.from_arrays(pa.array(e), self.numbers.take(pa.array(x.values)).cast(pa.large_string())), COMMA)
                  for e, x in ((edge_a, a), (edge_b, b))]
        text = pc.binary_join_element_wise(*joined, BAR)
        edge = np.zeros(n + 1, np.int64)
        edge[rows + 1] = np.diff(first)
        lists = pa.LargeListArray.from_arrays(pa.array(np.cumsum(edge)), text)
        whole = pc.binary_join(lists, END)
        whole = pc.if_else(pa.array(ok), pc.binary_join_element_wise(whole, NONE, END), NONE)
        _, off, data = whole.buffers()
        off = np.frombuffer(off, np.int64)[: n + 1]
        groups = Ragged(np.frombuffer(data, np.uint8)[: off[-1]] if data is not None else np.empty(0, np.uint8), off)
        return {"sums": Ragged(sums.ravel(), 5 * np.arange(n + 1)), "keys": Ragged(keys, at),
                "times": Ragged(times, at), "groups": groups}

    @staticmethod
    def _pairs(a: Ragged, b: Ragged, group_a: np.ndarray, n_b: np.ndarray, edge_b: np.ndarray):
        """Distinct (row, key) with their numbers of occurrences, sorted; blocks of A tokens bound the memory."""
        row = np.repeat(np.arange(len(a)), a.lengths())
        partners = n_b[group_a]
        upto = np.concatenate([[0], np.cumsum(partners)])
        done = [(np.empty(0, np.int64),) * 3]
        at = 0
        while at < len(row):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, "right")) - 1)
            n = partners[at:to]
            other = np.repeat(edge_b[group_a[at:to]] - (upto[at:to] - upto[at]), n) + np.arange(n.sum())
            key = np.repeat(a.values[at:to] << 32, n) | b.values[other]
            done.append(_summed(np.repeat(row[at:to], n), key, np.ones(len(key), np.int64)))
            at = to
        if len(done) == 2:
            return done[1]
        return _summed(*(np.concatenate(x) for x in zip(*done)))


def _summed(row: np.ndarray, key: np.ndarray, times: np.ndarray):
    """Distinct (row, key), sorted, with the sums of ``times``."""
    if not len(row):
        return row, key, times
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    first = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])
    return row[first], key[first], np.add.reduceat(times[order], np.flatnonzero(first))


def _packed(*arrays: np.ndarray) -> bytes:
    """Non-negative arrays as compressed byte planes of 4-byte numbers."""
    parts = [np.array([len(x) for x in arrays], "<u4").tobytes()]
    parts += [np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for x in arrays]
    return zstandard.compress(b"".join(parts), 1)


def _unpacked(block: bytes, arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(block), np.uint8)
    at, out = 4 * arrays, []
    for n in raw[:at].view("<u4").tolist():
        out.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<u4").ravel().astype(np.int64))
        at += 4 * n
    return out


def _documents(found: dict[str, Ragged], codes: np.ndarray, first: np.ndarray):
    """Sums (documents x COUNTS), digests, and the documents' pairs as (document, place in ``found``, times)."""
    n = len(first) - 1
    each = found["sums"].values.reshape(-1, 5)[:, 1:]
    sums = np.column_stack([per_doc(each[codes, k], first) for k in range(4)]) if n else np.zeros((0, 4), np.int64)
    digests, pairs, at = [], [], 0
    keys, inverse = np.unique(found["keys"].values, return_inverse=True)
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(first, first[at] + STEP, "right")) - 1))
        own, edge = codes[first[at]:first[to]], first[at:to + 1] - first[at]
        text = found["groups"].take(own)
        stop = text.edge[edge].tolist()
        raw = memoryview(np.ascontiguousarray(text.values))
        digests += [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(stop, stop[1:])]
        place, where = found["keys"].positions(own)
        doc = np.repeat(np.arange(at, to), np.diff(where[edge]))
        pairs.append(_summed(doc, inverse[place], found["times"].values[place]))
        at = to
    doc, place, times = (np.concatenate(x) for x in zip((np.empty(0, np.int64),) * 3, *pairs))
    return sums, digests, doc, place, times, keys


def align_documents(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with last columns n_a, n_b, n_groups, n_links, n_best, count_sum (bigint) and
    groups_sha256 (named apart from those that ``docs`` has). The model files are read on the driver."""
    spark: SparkSession = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        models = spark.sparkContext.broadcast((f.read(), g.read()))
    own = [c for c in docs.columns if c != text]
    names = [*COUNTS, "n_best", "count_sum", "groups_sha256", "chunk", "k", "block", "keys", "docs_with"]
    new = dict(zip(names, fresh(docs, *names)))
    name = f"align {a_path} {b_path}"
    texts = docs.select(*own, F.col(text).alias(fresh(docs, "whole_text")[0]))
    added = [*COUNTS, "groups_sha256", "chunk", "k", "block", "keys", "docs_with"]
    kinds = {"groups_sha256": "string", "chunk": "string", "k": "int", "block": "binary", "keys": "array<bigint>", "docs_with": "array<int>"}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1]]
                       + [f"`{new[c]}` {kinds.get(c, 'bigint')}" for c in added])

    def read(batches):
        import uuid

        pair = of_process(name, lambda: Pair(*models.value))
        store = of_process(f"{name} pieces", lambda: Store(pair.align, KEPT))

        def rows(batch, found, codes, first):
            sums, digests, doc, place, times, keys = _documents(found, codes, first)
            chunk, n = uuid.uuid4().hex, batch.num_rows
            with_key = np.bincount(place, minlength=len(keys))
            seen = np.flatnonzero(with_key)
            local = np.cumsum(with_key > 0) - 1
            edge = np.searchsorted(doc, np.arange(n + 1))
            block = _packed(edge, local[place], times)
            nothing = {"block": None, "keys": None, "docs_with": None}
            values = {c: pa.array(sums[:, k]) for k, c in enumerate(COUNTS)} | {
                "groups_sha256": pa.array(digests, pa.string()), "chunk": pa.array([chunk] * n, pa.string()), "k": pa.array(np.arange(n), pa.int32())}
            types = {"block": pa.binary(), "keys": pa.list_(pa.int64()), "docs_with": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[values[c] if c in values else pa.nulls(n, types[c]) for c in added]],
                names=[*batch.schema.names, *[new[c] for c in added]])
            if len(seen):
                last = {"chunk": chunk, "k": -1, "block": block, "keys": keys[seen], "docs_with": with_key[seen]}
                kind = {**types, "chunk": pa.string(), "k": pa.int32(), "groups_sha256": pa.string()}
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1, f.type) for f in batch.schema],
                     *[pa.array([last.get(c)], kind.get(c, pa.int64())) for c in added]],
                    names=[*batch.schema.names, *[new[c] for c in added]])

        def aligned(batch, texts):
            p = Pieces(texts, strip=True)
            at = store.rows(p.names)
            found = {k: v.take(at) for k, v in store.found.items()} if len(at) else pair.align(p.names)
            bad = np.flatnonzero(per_doc(found["sums"].values[::5][p.codes] == 0, p.first))
            if not len(bad):
                yield from rows(batch, found, p.codes, p.first)
                return
            good = np.setdiff1d(np.arange(len(texts)), bad)
            of = Ragged(p.codes, p.first).take(good)
            yield from rows(batch.take(pa.array(good)), found, of.values, of.edge)
            whole = pair.align(texts.take(pa.array(bad)).cast(pa.large_binary()))
            yield from rows(batch.take(pa.array(bad)), whole, np.arange(len(bad)), np.arange(len(bad) + 1))

        def chunk_of(parts):
            batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            column = batch.column(batch.num_columns - 1).cast(pa.large_string()).fill_null("")
            return batch.select(batch.schema.names[:-1]), column

        held, size = [], 0
        for batch in batches:
            at = 0
            for c in chunks(batch.column(batch.num_columns - 1), TEXT_BYTES):
                part = batch.slice(at, len(c))
                at += len(c)
                long = pc.sum(pc.binary_length(c)).as_py() or 0
                if held and size + long > TEXT_BYTES:
                    yield from aligned(*chunk_of(held))
                    release(keep=True)
                    held, size = [], 0
                held.append(part)
                size += long
        if held and sum(x.num_rows for x in held):
            yield from aligned(*chunk_of(held))
        release(keep=True)

    table = cut(texts.mapInArrow(read, schema), "aligned")
    pairs = table.where(F.col(new["k"]) < 0).select(
        F.col(new["chunk"]).alias("chunk"), F.posexplode(F.arrays_zip(F.col(new["keys"]).alias("key"), F.col(new["docs_with"]).alias("n"))).alias("place", "x"))
    pairs = pairs.select("chunk", "place", F.col("x.key").alias("key"), F.col("x.n").cast("bigint").alias("n"))
    a_id = F.shiftright("key", 32)
    counts = pairs.groupBy("key").agg(F.sum("n").alias("n"))
    best = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("best"))  # at most A's vocabulary
    counted = pairs.withColumn("count", F.sum("n").over(Window.partitionBy("key"))).withColumn("a", a_id).join(
        F.broadcast(best), "a").select("chunk", "place", "count", (F.col("count") == F.col("best")).alias("is_best"))
    marked = table.select(*[F.col(f"`{c}`") for c in own], *[new[c] for c in (*COUNTS, "groups_sha256", "chunk", "k", "block")])
    out = [*own, *[new[c] for c in (*COUNTS, "n_best", "count_sum", "groups_sha256")]]
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    n_own, k_chunk = len(own), len(own) + 5

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        k = left.column(k_chunk + 1).to_numpy()
        rows = left.filter(pa.array(k >= 0))
        k = k[k >= 0]
        n_best, count_sum = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        block = [x for x in left.column(k_chunk + 2).to_pylist() if x is not None]
        if block:
            place = right.column("place").to_numpy()
            count, top = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
            count[place], top[place] = right.column("count").to_numpy(), right.column("is_best").to_numpy(zero_copy_only=False)
            edge, local, times = _unpacked(block[0], 3)
            n_best, count_sum = per_doc(times * top[local], edge)[k], per_doc(times * count[local], edge)[k]
        columns = rows.columns[:n_own + 4] + [pa.array(n_best), pa.array(count_sum), rows.columns[n_own + 4]]
        return pa.Table.from_arrays(columns, names=out)

    schema = ", ".join([f"`{c}` {kind[c]}" for c in own] + [f"`{c}` bigint" for c in out[n_own:-1]] + [f"`{out[-1]}` string"])
    return marked.groupBy(new["chunk"]).cogroup(counted.groupBy("chunk")).applyInArrow(sums, schema)
