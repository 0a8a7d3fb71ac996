"""Token-ID binary output (12): documents as independent zstandard frames in files with a trailing seek table.

A file is a row of frames, one for each document that has ids, in the order of the documents: the ids as
little-endian unsigned integers of 2 bytes, or of 4 if the vocabulary needs them. Behind them come two skippable
frames, so that any zstandard decoder reads the whole file as the ids alone:

- the index (magic 0x184D2A50): ``TOKENIDX``, bytes of an id, number of rows, then for each row the document's id
  (int64; rows without an id come first and are marked), its frame or -1, and its number of ids;
- the seek table of the public seekable format (magic 0x184D2A5E): compressed and decompressed size and checksum
  (low 32 bits of XXH64 of the decompressed bytes) of each frame, and the footer with the number of frames.

A reader loads the end of a file, finds a document's frame by the sums of the sizes, and reads and decompresses
that frame alone; a wrong checksum raises.

``write_documents``: tasks encode whole texts and compress each document's frame; the small rows of frames are cut
to a table in the shared folder, go through one range exchange by document id, and each task writes one file. File
names are unique for each attempt, and the manifest, written by Spark's own commit, lists those of the attempts
that succeeded: a lost executor leaves at most an unlisted file. Files lie below ``spark.checkpoint.dir`` or the
given folder, reached by the file system that its address names. Ranges are cut by (id, hash of the row's place),
so repeated ids, however many, spread over files. A task holds one file's frames, about ``file_bytes``.

Defined results: null and empty texts have no ids of their own (the end id, if asked for, is still appended); null
document ids come first; repeated rows are all written, in no fixed order among themselves; an empty table gives
no file; other columns are not part of the files.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.pieces import Pieces, Ragged, Store, joined_ids, token_bytes
from tallyspark.llm.storage import cut, file_system, of_process, release, shared_dir
from tallyspark.llm.text import chunks

#: Fixed values of the public formats: skippable frames, seek table footer.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: First bytes of an index.
NAME = b"TOKENIDX"
#: Text encoded together, compressed bytes of a file, pieces that a worker keeps encoded.
TEXT_BYTES, FILE_BYTES, KEPT = 8 << 20, 64 << 20, 500_000

_INDEX = np.dtype([("doc", "<i8"), ("null", "u1"), ("frame", "<i8"), ("n", "<u8")])
_SEEK = np.dtype([("compressed", "<u4"), ("raw", "<u4"), ("checksum", "<u4")])
_FOOTER, _FOOTER_BYTES = "<IBI", 9


def checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


def file_bytes(frames: list[bytes], seek: np.ndarray, index: np.ndarray, width: int) -> list[bytes]:
    """The parts of a file in order."""
    head = NAME + struct.pack("<BQ", width, len(index)) + index.tobytes()
    table = seek.tobytes() + struct.pack(_FOOTER, len(seek), 0x80, FOOTER_MAGIC)
    return [*frames, struct.pack("<II", INDEX_MAGIC, len(head)), head,
            struct.pack("<II", SEEK_MAGIC, len(table)), table]


class Reader:
    """Random access to the documents of one file (an open binary file that can seek)."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        end = _FOOTER_BYTES
        n, flags, magic = struct.unpack(_FOOTER, self._at(size - end, end))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - end - n * _SEEK.itemsize
        self.seek = np.frombuffer(self._at(table, n * _SEEK.itemsize), _SEEK)
        if struct.unpack("<II", self._at(table - 8, 8)) != (SEEK_MAGIC, n * _SEEK.itemsize + end):
            raise ValueError("damaged seek table")
        self.edge = np.concatenate([[0], np.cumsum(self.seek["compressed"], dtype=np.int64)])
        start = int(self.edge[-1])
        magic, long = struct.unpack("<II", self._at(start, 8))
        head = self._at(start + 8, long)
        if magic != INDEX_MAGIC or head[:8] != NAME or start + 8 + long != table - 8:
            raise ValueError("damaged index")
        self.width, rows = struct.unpack_from("<BQ", head, 8)
        self.index = np.frombuffer(head, _INDEX, rows, 17)
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def ids(self, row: int) -> np.ndarray:
        """The ids (uint32) of a row of the index."""
        k = int(self.index["frame"][row])
        if k < 0:
            return np.empty(0, "<u4")
        raw = self.unpack.decompress(self._at(int(self.edge[k]), int(self.seek["compressed"][k])),
                                     max_output_size=int(self.seek["raw"][k]))
        if checksum(raw) != self.seek["checksum"][k]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def rows_of(self, docs: np.ndarray) -> np.ndarray:
        """Rows of the index whose document is one of ``docs`` (sorted)."""
        at = np.searchsorted(docs, self.index["doc"])
        hit = np.zeros(len(self.index), bool)
        near = at < len(docs)
        hit[near] = docs[at[near]] == self.index["doc"][near]
        return np.flatnonzero(hit & (self.index["null"] == 0))


class Encoder:
    """Ids of whole texts by a file of the tokenizers library, distinct pieces once. The file is read on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.size = Tokenizer.from_str(content).get_vocab_size()
        self.content, self.name = spark.sparkContext.broadcast(content), f"token ids {path}"

    def in_task(self):
        content, name = self.content, self.name

        def make():
            from tokenizers import Tokenizer

            # a task has one core: the library's own threads would take those of the other tasks
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            tokenizer = Tokenizer.from_str(content.value)
            size = token_bytes(tokenizer)
            return Store(lambda new: {"ids": joined_ids(tokenizer, size, new)}, KEPT)

        def encode(texts: pa.Array) -> Ragged:
            store = of_process(name, make)
            p = Pieces(texts, strip=False)
            flat = store.rows(p.names)[p.codes]
            ids = store.found["ids"].take(flat) if len(flat) else Ragged(np.empty(0, np.int64), np.zeros(1, np.int64))
            return Ragged(ids.values, ids.edge[p.first])

        return encode


def frames_of(docs: DataFrame, encoder: Encoder, end_id: int | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, frame, raw, checksum): a frame for each row of ``docs``; no frame where there are no ids."""
    width = 2 if max(encoder.size, (end_id or 0) + 1) <= 1 << 16 else 4
    encode = encoder.in_task()

    def pack(batches):
        zstd = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in batches:
            start = 0
            for c in chunks(batch.column(1), TEXT_BYTES):
                ids = encode(c)
                if end_id is not None:
                    ids = Ragged(np.insert(ids.values, ids.edge[1:], end_id), ids.edge + np.arange(len(ids.edge)))
                count, raw = ids.lengths(), memoryview(ids.values.astype(f"<u{width}").tobytes())
                edge = (ids.edge * width).tolist()
                frames, sums = [], []
                for a, b in zip(edge[:-1], edge[1:]):
                    frames.append(zstd.compress(raw[a:b]) if a < b else None)
                    sums.append(checksum(raw[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(c)).cast(pa.int64()), pa.array(count), pa.array(frames, pa.binary()),
                     pa.array(count * width), pa.array(sums, pa.int64())],
                    names=["doc", "n", "frame", "raw", "checksum"])
                start += len(c)
            release(keep=True)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).mapInArrow(
        pack, "doc bigint, n bigint, frame binary, raw bigint, checksum bigint")


def write_documents(docs: DataFrame, path: str, end_id: int | None = None, folder: str | None = None,
                    doc_id: str = "doc_id", text: str = "text", file_bytes_target: int = FILE_BYTES) -> DataFrame:
    """Write the ids of ``docs`` and return the manifest: (file, part, first_doc, last_doc, rows, tokens), ``part``
    numbering the files in the order of the documents."""
    spark = docs.sparkSession
    encoder = Encoder(spark, path)
    folder = folder or f"{shared_dir(spark)}/llm/token-ids-{uuid.uuid4().hex}"
    width = 2 if max(encoder.size, (end_id or 0) + 1) <= 1 << 16 else 4
    frames = cut(frames_of(docs, encoder, end_id, doc_id, text), "frames")
    # 40 bytes a row for index and seek table
    size = frames.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("frame"), F.lit(0)) + F.lit(40)), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // file_bytes_target))
    placed = frames.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    if parts > 1:
        placed = placed.repartitionByRange(parts, F.col("doc").asc_nulls_first(), "place")
    else:
        placed = placed.coalesce(1)
    ordered = placed.sortWithinPartitions(F.col("doc").asc_nulls_first(), "place").select(
        F.spark_partition_id().alias("part"), "doc", "n", "frame", "raw", "checksum")

    def write(batches):
        frames, seek, index = [], [], []
        part = at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            doc, n, frame, raw, sums = batch.columns[1:]
            own = np.zeros(batch.num_rows, _INDEX)
            own["doc"], own["null"] = doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False)
            own["n"] = n.to_numpy()
            has = frame.is_valid().to_numpy(zero_copy_only=False)
            own["frame"] = np.where(has, at + np.cumsum(has) - 1, -1)
            at += int(has.sum())
            new = [f.as_py() for f in frame.filter(pa.array(has))]
            table = np.zeros(len(new), _SEEK)
            table["compressed"] = [len(f) for f in new]
            table["raw"], table["checksum"] = raw.to_numpy()[has], sums.to_numpy()[has]
            frames += new
            seek.append(table)
            index.append(own)
        if not index:
            return
        index, seek = np.concatenate(index), np.concatenate(seek)
        name = f"{folder}/ids-{part:06d}-{uuid.uuid4().hex}.zst"
        fs, where = file_system(name)
        fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(where, compression=None) as out:
            for x in file_bytes(frames, seek, index, width):
                out.write(x)
        docs = index["doc"][index["null"] == 0]
        ends = [None, None] if not len(docs) else [int(docs[0]), int(docs[-1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in ends),
             pa.array([len(index)], pa.int64()), pa.array([int(index["n"].sum())], pa.int64())],
            names=["file", "part", "first_doc", "last_doc", "rows", "tokens"])

    made = ordered.mapInArrow(write, "file string, part int, first_doc bigint, last_doc bigint, rows bigint, tokens bigint")
    return cut(made, "token-id-files")


def read_documents(manifest: DataFrame, then, schema: str) -> DataFrame:
    """Every document of the files in order: ``then(doc, null, n, start, ids)`` makes a record batch (``schema``) of
    some documents: arrays of their ids, marks of null ids, numbers of token ids, places of their first token id
    among those of all documents, and their token ids (Ragged, uint32)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"), "part")

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, where = file_system(name)
                with fs.open_input_file(where) as file:
                    r = Reader(file)
                    n = r.index["n"].astype(np.int64)
                    begin = start + np.concatenate([[0], np.cumsum(n)])[:-1]
                    at = 0
                    while at < len(n):
                        to = max(at + 1, int(np.searchsorted(begin, begin[at] + (1 << 21), "right")) - 1)
                        to = min(to, len(n)) if to < len(n) - 1 else len(n)
                        rows = [r.ids(k) for k in range(at, to)]
                        edge = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
                        own = r.index[at:to]
                        yield then(own["doc"], own["null"] == 1, n[at:to], begin[at:to],
                                   Ragged(np.concatenate(rows), edge))
                        at = to
            release(keep=True)

    return spread(files).mapInArrow(read, schema)


def spread(files: DataFrame) -> DataFrame:
    """A row of the manifest stands for a whole file: each goes to a task of its own."""
    n = files.agg(F.max("part")).first()[0] or 0
    return files.repartitionById(n + 1, "part").drop("part")


def pick_documents(manifest: DataFrame, docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<bigint>) of the wanted documents, once for each time a document was written: only their
    frames are read and decompressed. The spans of the files, a few numbers for each file, go to the tasks."""
    spans = manifest.where("first_doc IS NOT NULL").orderBy("part").select("file", "first_doc", "last_doc").collect()
    names = [s.file for s in spans]
    low, high = (np.array([s[k] for s in spans], np.int64) for k in (1, 2))

    def place(batches):
        for batch in batches:
            d = batch.column(0).to_numpy()
            at, to = np.searchsorted(high, d, "left"), np.searchsorted(low, d, "right")
            n = np.maximum(to - at, 0)
            file = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in file], pa.string()), pa.array(np.repeat(d, n))],
                                             names=["file", "d"])

    def read(batches):
        for batch in batches:
            for name, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, where = file_system(name)
                with fs.open_input_file(where) as file:
                    r = Reader(file)
                    for k in r.rows_of(np.sort(np.array(d, np.int64))).tolist():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(r.index["doc"][k])], pa.int64()),
                             pa.array([r.ids(k).astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    wanted = docs.select(F.col(doc_id).cast("bigint").alias("d")).where("d IS NOT NULL").distinct()
    # the wanted ids of a file are read in up to 64 parts
    lists = wanted.mapInArrow(place, "file string, d bigint").groupBy("file", F.pmod(F.xxhash64("d"), F.lit(64))).agg(
        F.collect_list("d").alias("d"))
    return lists.select("file", "d").mapInArrow(read, "doc_id bigint, ids array<bigint>")


def digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, read back from them."""

    def then(doc, null, n, start, ids):
        crc = [zlib.crc32(ids.values[a:b].astype("<u4").tobytes()) for a, b in zip(ids.edge[:-1].tolist(), ids.edge[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc.astype(np.int64), pa.int64(), mask=np.asarray(null)), pa.array(start.astype(np.int64)), pa.array(n),
             pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_documents(manifest, then, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
