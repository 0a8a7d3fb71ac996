"""Sharding (6) by histogram sort: near-equal bytes in every shard, one exchange. DataFrame functions only.

Every row gets a 63-bit key: 32 bits of the text's crc32, so equal texts lie side by side, then bits of the id
and of the row, so a group of copies of any size can be cut. Rounds of exact histograms count the bytes and
rows below candidate boundaries (key prefixes): each round looks only into the prefixes that still hold a
wanted splitter, with 64 finer probes each, until the bytes in doubt are within the tolerance. The driver gets
at most 64 counts a splitter. The boundaries cut each shard into ranges of near-equal rows; rows are
exchanged once by range, numbered inside it, and the counts of earlier ranges give gapless slots. No task holds
a whole shard.

Defined results: null text has no bytes (size 1, crc32 of nothing); null and repeated ids are rows like others;
an empty table gives no rows. The shards follow key order: equal texts share a shard except where a boundary
must cut their group.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.storage import cut

KEY_BITS, FIRST_BITS, STEP_BITS = 63, 10, 6
#: Rows that one range should hold, and ranges at most (larger data make larger ranges).
RANGE_ROWS, MAX_RANGES = 100_000, 2048


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(text)
    key = F.shiftleft(crc, 31).bitwiseOR(F.shiftleft(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 16)), 15)) \
        .bitwiseOR(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 15)))
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       crc.alias("crc"), key.alias("key"))


def find_splitters(rows: DataFrame, targets: list[tuple[str, int]], tolerance: int) -> list[int]:
    """The key boundary below which each target lies: (measure, amount), measure ``size`` or ``n``."""
    at = {"size": 0, "n": 1}
    bits, active = FIRST_BITS, {0: list(range(len(targets)))}
    prefix_bits, before = 0, {0: (0, 0)}
    found: dict[int, int] = {}
    while active:
        prefix = F.shiftright("key", KEY_BITS - prefix_bits)
        live = rows if not prefix_bits else rows.where(prefix.isin(list(active)))
        hist = live.groupBy(F.shiftright("key", KEY_BITS - bits).alias("b")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        buckets: dict[int, list] = {}
        for b, size, n in sorted(hist):
            buckets.setdefault(b >> (bits - prefix_bits), []).append((b, (size, n)))
        nxt: dict[int, list[int]] = {}
        below_next: dict[int, tuple[int, int]] = {}
        for p, wanted in active.items():
            below = before[p]
            todo = sorted(wanted, key=lambda t: (at[targets[t][0]], targets[t][1]))
            cums = []
            for b, amounts in buckets.get(p, []):
                cums.append((b, below, amounts))
                below = (below[0] + amounts[0], below[1] + amounts[1])
            for t in todo:
                m, amount = at[targets[t][0]], targets[t][1]
                for b, low, amounts in cums:
                    if low[m] + amounts[m] >= amount:
                        break
                else:
                    found[t] = (p + 1) << (KEY_BITS - prefix_bits)
                    continue
                if amounts[0] <= tolerance or amounts[1] == 1 or bits == KEY_BITS:
                    nearer_end = low[m] + amounts[m] - amount <= amount - low[m]
                    found[t] = (b + nearer_end) << (KEY_BITS - bits)
                else:
                    nxt.setdefault(b, []).append(t)
                    below_next[b] = low
        active, before, prefix_bits = nxt, below_next, bits
        bits = min(KEY_BITS, bits + STEP_BITS)
    return [found[t] for t in range(len(targets))]


def range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at or below the key: one array look-up by the key's first bits, then the few
    splitters that share them."""
    width = 12
    base, own = [0] * (1 << width), [[] for _ in range(1 << width)]
    for s in splitters:
        if s >> KEY_BITS == 0:
            own[s >> (KEY_BITS - width)].append(s)
    for b in range(1, 1 << width):
        base[b] = base[b - 1] + len(own[b - 1])
    at = F.shiftright(key, KEY_BITS - width).cast("int") + 1
    bases = F.from_json(F.lit(json.dumps(base)), "array<int>")
    owns = F.from_json(F.lit(json.dumps(own)), "array<array<bigint>>")
    return F.element_at(bases, at) + F.size(F.filter(F.element_at(owns, at), lambda s: s <= key))


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = 1e-3) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row: shard sizes differ by about ``tolerance`` of a shard."""
    rows = cut(keyed(docs, id_col, text_col), "keyed")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = min(MAX_RANGES, max(4 * shards, -(-n // RANGE_ROWS)))
    targets = [("size", total * j // shards) for j in range(1, shards)]
    fine = [("n", n * j // ranges) for j in range(1, ranges)]
    found = find_splitters(rows, targets + fine, int(total / shards * tolerance)) if n else []
    shard_ends, splitters = found[: shards - 1], sorted(set(found))
    ranged = rows.withColumn("range", range_of(F.col("key"), splitters))
    # a range starts at a splitter; its shard is the number of shard boundaries up to there
    starts = [0, *splitters]
    shard = [sum(e <= s for e in shard_ends) for s in starts]
    counts = dict(ranged.groupBy("range").count().collect())
    offset, done = [], dict.fromkeys(range(shards), 0)
    for r in range(len(starts)):
        offset.append(done[shard[r]])
        done[shard[r]] += counts.get(r, 0)
    shard_col = F.element_at(F.from_json(F.lit(json.dumps(shard)), "array<int>"), F.col("range") + 1)
    offset_col = F.element_at(F.from_json(F.lit(json.dumps(offset)), "array<bigint>"), F.col("range") + 1)
    place = F.row_number().over(Window.partitionBy("range").orderBy("key", "id", "size"))
    return ranged.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                         shard_col.alias("shard"), (offset_col + place - 1).alias("slot"))
