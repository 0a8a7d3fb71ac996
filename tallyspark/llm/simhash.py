"""SimHash near-dedup (9): 64-bit fingerprints of word shingles, linked at a small Hamming distance.

Two fingerprints within ``distance`` bits differ by at most ``distance // blocks`` bits in one of ``blocks``
bit blocks. The Hamming distance on a block is a metric, so each block gets a vantage-point tree of its own,
with that small radius: on every level a vantage fingerprint splits the space at the median distance, and a
fingerprint lives in one leaf. A leaf is a shard; a fingerprint is sent to its own shard and to those behind a
boundary that its ball overlaps: the triangle bound says when no boundary is near, else the leaves of the ball's
block values are looked up, at most 22 of them for radius 1, however deep the trees. In a shard one
more vantage point sorts the members by full distance, branches beyond the triangle bound are skipped, and the
rest is compared exactly. The depth follows the exact number of distinct fingerprints, so shards keep
their size while the data grows. Shards that come out large (dense groups) are split into blocks of members and
blocks of visitors, which meet pair by pair in tasks of their own.

Equal fingerprints are one member. A task emits a spanning forest, never all pairs of a group, and components
come from star contraction over these links in shuffles; no link list reaches the driver.

Defined results: null and empty texts have no words, hence fingerprint zero, linked like any other; a text of
fewer words than a shingle is one shingle; rows with null ids take part (the component id ignores nulls and is
null if the component has no id at all); repeated rows get the same component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.storage import cut, fresh, release
from tallyspark.llm.text import NOT_SPACE, Words, chunks
from tallyspark.operators.joins import MAX_BROADCAST_ROWS, bounded_broadcast

#: Fingerprints a shard should hold, and members of one block of a larger shard.
LEAF, BLOCK = 1024, 4096


def chunk_fingerprints(arr: pa.Array, size: int = 4, seed: int = 42) -> np.ndarray:
    """Fingerprints (uint64) of a chunk of texts."""
    w = Words(arr, NOT_SPACE, lower=True)
    out = np.zeros(w.n_docs, np.uint64)
    if not len(w):
        return out
    # the words of all documents, each followed by one space: a shingle is a slice
    lens = w.ends - w.starts
    stop = np.cumsum(lens + 1)
    start = stop - lens - 1
    buf = np.full(int(stop[-1]), 0x20, np.uint8)
    inside = np.ones(len(buf), bool)
    inside[stop - 1] = False
    buf[inside] = w.data[w.mask]
    n = w.counts()
    last = w.first[1:][w.doc] - 1
    at = np.arange(len(w))
    heads = (at + size - 1 <= last) | ((at == w.first[:-1][w.doc]) & (n[w.doc] < size))
    head = at[heads]
    tail = np.minimum(head + size - 1, last[head])
    raw = buf.tobytes()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], seed) for a, b in zip(start[head].tolist(), (stop[tail] - 1).tolist())),
                         np.uint64, len(head))
    shingles = np.bincount(w.doc[head], minlength=w.n_docs)
    live = np.flatnonzero(shingles)
    begin = np.concatenate([[0], np.cumsum(shingles[live])[:-1]])
    little = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.empty((len(live), 64), np.int64)
    for k in range(8):
        bits = np.unpackbits(little[:, k : k + 1], axis=1, bitorder="little")
        sums[:, 8 * k : 8 * k + 8] = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    set_bits = 2 * sums > shingles[live][:, None]
    out[live] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint(text: Column, size: int = 4, seed: int = 42) -> Column:
    """The fingerprint as a signed long column."""

    @arrow_udf("bigint")
    def simhash(arr: pa.Array) -> pa.Array:
        parts = [chunk_fingerprints(c, size, seed).view(np.int64) for c in chunks(arr)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())

    return simhash(text)


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of bits that cover the 64 bits."""
    edge = [round(64 * k / blocks) for k in range(blocks + 1)]
    return [((1 << edge[k + 1]) - 1) ^ ((1 << edge[k]) - 1) for k in range(blocks)]


def distance_to(fps: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((fps ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def vantage_tree(fps: DataFrame, n: int, blocks: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """For each block (block, mask, levels): a vantage fingerprint and the median distance on each level.

    The medians come from an exact histogram of distances: blocks x levels x 65 counts at most.
    """
    masks = block_masks(blocks)
    # a block has no more values than its bits tell apart
    depth = min(max(0, math.ceil(math.log2(max(1, n) / LEAF))), min(m.bit_count() for m in masks))
    if not depth:
        return [(b, m, []) for b, m in enumerate(masks)]
    points = [r[0] & ((1 << 64) - 1) for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(depth * blocks).collect()]
    points += [(points[k] * 0x9E3779B97F4A7C15) & ((1 << 64) - 1) for k in range(depth * blocks - len(points))]
    probes = [(b, m, points[b * depth + k]) for b, m in enumerate(masks) for k in range(depth)]
    dist = F.array(*[F.struct(F.lit(i).alias("i"), F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(v))).bitwiseAND(
        F.lit(_signed(m)))).alias("d")) for i, (_, m, v) in enumerate(probes)])
    hist = fps.select(F.explode(dist).alias("p")).groupBy("p.i", "p.d").count().collect()
    counts = np.zeros((len(probes), 65), np.int64)
    for i, d, c in hist:
        counts[i, d] = c
    median = [int(np.searchsorted(np.cumsum(c), c.sum() / 2)) for c in counts]
    return [(b, m, [(points[b * depth + k], median[b * depth + k]) for k in range(depth)])
            for b, m in enumerate(masks)]


def ball(mask: int, radius: int) -> np.ndarray:
    """Every change of at most ``radius`` of the mask's bits."""
    bits = [1 << k for k in range(64) if mask >> k & 1]
    return np.array([sum(c) for r in range(radius + 1) for c in combinations(bits, r)], np.uint64)


def leaves(fps: np.ndarray, mask: int, levels: list[tuple[int, int]], radius: int):
    """(row, leaf, home) of every fingerprint: its own leaf, and later leaves that hold a value of its ball.

    Two near fingerprints of different leaves meet in the later one, so earlier leaves need no visit.
    """
    own, near = np.zeros(len(fps), np.int64), np.zeros(len(fps), bool)
    for vantage, median in levels:
        d = distance_to(fps, vantage, mask)
        # no value within the radius lies on the other side unless the boundary is that near
        near |= (d - radius <= median) & (d + radius > median)
        own = own * 2 + (d > median)
    rows = np.flatnonzero(near)
    values = fps[rows][:, None] ^ ball(mask, radius)[None, 1:]
    there = np.zeros(values.shape, np.int64)
    for vantage, median in levels:
        there = there * 2 + (distance_to(values, vantage, mask) > median)
    row = np.repeat(rows, values.shape[1])
    leaf = there.ravel()
    later = leaf > own[row]
    visits = np.unique(np.stack([row[later], leaf[later]], axis=1), axis=0)
    home = np.arange(len(fps))
    return np.concatenate([home, visits[:, 0]]), np.concatenate([own, visits[:, 1]]), np.arange(len(home) + len(visits)) < len(home)


def assign_shards(fps: DataFrame, tree, radius: int) -> DataFrame:
    def spread(batches):
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for b, mask, levels in tree:
                for at in range(0, len(x), 20_000):
                    part = x[at : at + 20_000]
                    row, leaf, home = leaves(part, mask, levels, radius)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[row].view(np.int64)), pa.array(np.full(len(row), b, np.int32)), pa.array(leaf),
                         pa.array(home)], names=["fp", "block", "leaf", "home"])

    return fps.mapInArrow(spread, "fp bigint, block int, leaf bigint, home boolean")


def forest(a: np.ndarray, b: np.ndarray, n: int, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest connected member of each of ``n`` members, over the links ``a``-``b`` and those in ``label``."""
    lab = np.arange(n) if label is None else label
    while True:
        x, y = lab[a], lab[b]
        open_ = x != y
        if not open_.any():
            return lab
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up


def near_links(left: np.ndarray, right: np.ndarray, distance: int, within: bool) -> np.ndarray:
    """A spanning forest (pairs of values) of the links between ``left`` and ``right``, and inside ``left``."""
    both = np.concatenate([left, right]) if len(right) else left
    n = len(both)
    if n < 2 or not len(left):
        return np.empty((0, 2), np.uint64)
    d = np.bitwise_count(both ^ left[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    v, dd = both[order], d[order]
    is_left = order < len(left)
    label = np.arange(n)
    step = max(1, (1 << 21) // n)
    rows = np.flatnonzero(is_left)
    for at in range(0, len(rows), step):
        q = rows[at : at + step]
        # triangle bound: only members whose distance to the vantage point is as near can be near
        lo, hi = np.searchsorted(dd, dd[q[0]] - distance, "left"), np.searchsorted(dd, dd[q[-1]] + distance, "right")
        near = np.bitwise_count(v[q][:, None] ^ v[None, lo:hi]) <= distance
        if not within:
            near &= ~is_left[lo:hi][None, :]
        i, j = np.nonzero(near)
        i, j = q[i], j + lo
        open_ = label[i] != label[j]
        if open_.any():
            label = forest(i[open_], j[open_], n, label)
    linked = np.flatnonzero(label != np.arange(n))
    return np.stack([v[linked], v[label[linked]]], axis=1)


def links(fps: DataFrame, distance: int = 4, blocks: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span the same components as all pairs within
    ``distance`` bits."""
    n = fps.count()
    placed = assign_shards(fps, vantage_tree(fps, n, blocks), distance // blocks)
    count = placed.groupBy("block", "leaf").agg(F.count(F.when(F.col("home"), 1)).alias("own"), F.count(F.when(~F.col("home"), 1)).alias("other"))
    large = count.where(F.greatest("own", "other") > 2 * BLOCK).select("block", "leaf", *[
        F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int").alias(p) for c, p in (("own", "parts"), ("other", "visits"))])
    large = cut(large, "large-shards")
    placed = placed.join(bounded_broadcast(large, large.limit(MAX_BROADCAST_ROWS + 1).count()), ["block", "leaf"], "left")
    parts, visits = F.coalesce("parts", F.lit(1)), F.coalesce("visits", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), F.when(F.col("home"), parts).otherwise(visits)).cast("int")

    def task(i: Column, j: Column, v: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), v.alias("v"))

    # a block of members meets each block of visitors (i = j, v), and each other block of members (i < j, v = -1)
    others = F.transform(F.filter(F.sequence(F.lit(0), parts - 1), lambda k: k != mine),
                         lambda k: task(F.least(mine, k), F.greatest(mine, k), F.lit(-1)))
    meet = F.when(F.col("home"), F.concat(others, F.transform(F.sequence(F.lit(0), visits - 1), lambda v: task(mine, mine, v)))) \
        .otherwise(F.transform(F.sequence(F.lit(0), parts - 1), lambda k: task(k, k, mine)))
    tasks = placed.select("fp", "block", "leaf", "home", mine.alias("part"), F.explode(meet).alias("t")) \
        .select("fp", "block", "leaf", "home", "part", F.col("t.i").alias("i"), F.col("t.j").alias("j"), F.col("t.v").alias("v"))

    def meet_all(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        home, part = group.column("home").to_numpy(), group.column("part").to_numpy()
        i, j, v = (group.column(c)[0].as_py() for c in "ijv")
        if i == j:
            # the members meet one another beside the first visitors only
            pairs = near_links(fp[home], fp[~home], distance, within=v == 0)
        else:
            pairs = near_links(fp[part == i], fp[part == j], distance, within=False)
        release()
        pairs = pairs.view(np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return tasks.groupBy("block", "leaf", "i", "j", "v").applyInArrow(meet_all, "a bigint, b bigint")


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): alternating large-star and small-star rounds.

    Each round is a few shuffles with map-side minima; the edges are written to the shared folder between
    rounds, and the loop ends when a round changes nothing.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
                "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .unionByName(small_low.select("a", F.col("m").alias("b"))).distinct()
        edges = cut(small, "links")
        state = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def groups(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``prints``; the root is some fingerprint of its component."""
    distinct = cut(prints.select("fp").distinct(), "fingerprints")
    roots = star_components(links(distinct, distance))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
                    distance: int = 4) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``."""
    prints = cut(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), size).alias("fp")), "prints")
    low = prints.groupBy("fp").agg(F.min("id").alias("low"))
    member = groups(prints, distance).join(low, "fp")
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    member = member.join(least, "root").select("fp", "component_id")
    return prints.join(member, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
             distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (nulls last), one of repeated rows."""
    fp, rid = fresh(docs, "fp", "rid")
    marked = docs.withColumn(fp, fingerprint(F.col(text_col), size)).withColumn(rid, F.monotonically_increasing_id())
    marked = cut(marked, "documents")
    key = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), F.col(rid).alias("rid"))
    rows = marked.select(F.col(fp).alias("fp"), key.alias("key"))
    member = groups(rows, distance).join(rows.groupBy("fp").agg(F.min("key").alias("low")), "fp")
    best = member.groupBy("root").agg(F.min("low").alias("best"))
    keep = member.join(best, "root").select("fp", "best")
    # most rows stay; only those of other members leave, so the documents meet a small table
    gone = rows.join(keep, "fp").where(F.col("key.rid") != F.col("best.rid")).select(F.col("key.rid").alias("gone"))
    return marked.join(gone, marked[rid] == gone["gone"], "left_anti").select(*docs.columns)
