"""Counts of symbol sequences over all texts, dealt out by ranges of the sequences (used by 8 and 11).

A task counts the sequences of a shard of texts; the counts, sorted, are cut at splitter sequences into one block for
each range, and a range's blocks meet in the task of its own number. Splitters may lie inside a frequent prefix, so
no range grows with one symbol. They come from a bounded sample of the texts, which only balances the work.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyspark.llm import automata
from tallyspark.llm.automata import Paths
from tallyspark.llm.storage import release

#: Text of a shard, text of a range, sequences sampled for each range, nodes united at once.
SHARD_BYTES, RANGE_BYTES, SAMPLED, NODES = 8 << 20, 8 << 20, 64, 1_000_000


def shards_of(batches, limit: int, text: str):
    """Record batches of about ``limit`` bytes of text, whole rows each."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(text).cast(pa.large_string()).fill_null("")
        off = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))])
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit - size, "right")) - 1)
            held.append(batch.slice(at, to - at))
            size += int(off[to] - off[at])
            at = to
            if size >= limit or at < len(column):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    return batch.column(text).cast(pa.large_string()).fill_null("")


def cells(paths: Paths, splitters: list[list[bytes]], pack: Callable[[Paths], bytes] = automata.pack):
    """(range, block) of each range that holds nodes of ``paths``."""
    for r, (begin, end) in enumerate(automata.ranges(paths, splitters)):
        if any(a < b for a, b in zip(begin, end)):
            yield r, pack(paths.slice(begin, end))


def united(blocks, unpack: Callable[[bytes], Paths] = automata.unpack) -> Paths | None:
    """The union of many blocks, a bounded number of nodes at a time."""
    done, waiting, size = None, [], 0
    for block in blocks:
        waiting.append(unpack(block))
        size += len(waiting[-1])
        if size > max(NODES, len(done) if done else 0):
            done, waiting, size = automata.union([*([done] if done else []), *waiting]), [], 0
    if waiting:
        done = automata.union([*([done] if done else []), *waiting])
    return done


def sample_splitters(docs: DataFrame, parts: int, rows: int, text: str, count: Callable[[pa.RecordBatch], Paths]) -> list[list[bytes]]:
    """At most ``parts - 1`` sequences that cut the sequences of a sample into even ranges."""
    wanted = SAMPLED * parts

    def pick(batches):
        for batch in shards_of(batches, SHARD_BYTES // 4, text):
            paths = count(batch)
            names, width = paths.names.to_pylist(), len(paths.levels)
            each = max(1, min(SAMPLED, 2 * wanted // max(1, min(rows, wanted)))) * batch.num_rows
            for d in range(min(1, width - 1), width):
                n = len(paths.levels[d][0])
                nodes = np.unique(np.linspace(0, n - 1, min(n, -(-each // max(1, width - 1)))).astype(np.int64)) if n else np.empty(0, np.int64)
                found = [[names[s] for s in row if s >= 0] for row in automata.rows_of(paths, d, nodes, width).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], names=["path"])
            del paths, names
            release()

    some = docs.sample(False, min(1.0, wanted / max(1, rows)), seed=11)
    found = sorted({tuple(r[0]) for r in some.mapInArrow(pick, "path array<binary>").collect()})
    spots = sorted({len(found) * k // parts for k in range(1, parts)})
    return [[bytes(s) for s in found[k]] for k in spots if 0 < k < len(found)]
