r"""Phrase collocation mining (11): weighted acyclic automata count phrases and look up their parts.

Texts (A-Z lower-cased) are split at `[.,;:!?\x0A-\x0D]` into pieces and those at space and tab into words. Each
task counts all phrases of up to ``max_words`` words of a shard of texts, sorted, as sequences (lang, word, ...), and
freezes them, cut into ranges of the sequences, into minimal count transducers (``automata.py``). One exchange
brings the transducers of a range together, where their union sums the weights; phrases below ``least`` go. The
parts that candidates need (first words, rest, and phrases inside) are themselves packed by range as automata,
sent to the transducer of their range, composed with it, and the counts come back in the same order. With them goes
the highest count of a longer candidate around each phrase, for the rule of dropped candidates.

Ranges are cut inside hot words and phrases: splitters come from a bounded sample of the texts (about 64 phrases a
range), which only balances the work. Each range is the task of its own number, no hash collisions; a shard's
counts are summed before they move, so a hot phrase is one entry of each shard. The best phrases are ranked
in two steps, at most 64 times ``top`` rows for each lang in the last one.

Defined results: null and empty texts have no words; a null lang is ``und``; repeated rows count each; an empty
table gives no rows; scores are exact integers; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm import automata
from tallyspark.llm.automata import Paths
from tallyspark.llm.sequence_ranges import RANGE_BYTES, SHARD_BYTES, cells, sample_splitters, shards_of, texts_of, united
from tallyspark.llm.storage import cut, release
from tallyspark.llm.text import Words

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_PIECE_END
_IN_WORD[[0x20, 0x09]] = False


def count_phrases(lang: pa.Array, texts: pa.Array, max_words: int) -> Paths:
    """All phrases of the texts with their numbers of occurrences: level 0 is the lang with its words, level n the
    phrases of n words."""
    words = Words(texts, _IN_WORD, lower=True)
    word, names = words.ids()
    langs = lang.fill_null("und").dictionary_encode()
    names, (place, lang_place) = automata.sorted_names([names, langs.dictionary])
    word = place[word]
    of_doc = lang_place[langs.indices.to_numpy(zero_copy_only=False)]
    ends = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_PIECE_END[words.data], out=ends[1:])
    # the number of words from each one to the end of its piece
    n = len(word)
    last = np.ones(n, bool)
    last[:-1] = (words.doc[1:] != words.doc[:-1]) | (ends[words.starts[1:]] != ends[words.ends[:-1]])
    stop = np.flatnonzero(last)
    left = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n) + 1 if n else np.empty(0, np.int64)
    level, node = automata.distinct(np.zeros(n, np.int64), of_doc[words.doc], np.ones(n, np.int64), len(names))
    levels, at = [level], np.arange(n)
    for k in range(max_words):
        long = left[at] > k
        at, node = at[long], node[long]
        level, node = automata.distinct(node, word[at + k], np.ones(len(at), np.int64), max(1, len(names)))
        levels.append(level)
    return Paths(names, levels)


class Candidates:
    """Candidates of a range and the sequences whose counts they need."""

    def __init__(self, paths: Paths):
        width = len(paths.levels)
        self.paths = paths
        rows, count, words = [], [], []
        for d in range(2, width):
            nodes = np.flatnonzero(paths.levels[d][2])
            rows.append(automata.rows_of(paths, d, nodes, width))
            count.append(paths.levels[d][2][nodes])
            words.append(np.full(len(nodes), d))
        self.rows = np.concatenate([np.empty((0, width), np.int64), *rows])
        self.count, self.words = (np.concatenate([np.empty(0, np.int64), *x]) for x in (count, words))
        need, weight, at = [], [], []
        for d in range(2, width):
            own = np.flatnonzero(self.words == d)
            spans = {(0, 0)} | {(0, k) for k in range(1, d)} | {(k, d) for k in range(1, d)}
            spans |= {(i, j) for i in range(d) for j in range(i + 2, d + 1) if j - i < d}
            for i, j in sorted(spans):
                part = np.full((len(own), width), -1, np.int64)
                part[:, 0] = self.rows[own, 0]
                part[:, 1:j - i + 1] = self.rows[own, i + 1:j + 1]
                need.append(part)
                # the count of the longer candidate goes along to phrases; 1 marks an asked sequence
                weight.append(self.count[own] + 1 if j - i >= 2 else np.ones(len(own), np.int64))
                at.append((d, i, j, own))
        parts = np.concatenate([np.empty((0, width), np.int64), *need])
        weight = np.concatenate([np.empty(0, np.int64), *weight])
        self.asked, last = automata.of_rows(paths.names, parts, weight, np.maximum)
        self.place, k = {}, 0
        for d, i, j, own in at:
            self.place[d, i, j] = last[k:k + len(own)]
            k += len(own)

    def asked_of(self, splitters: list[list[bytes]]):
        """(range, paths, place of its nodes among all asked nodes, in the order of the answers)."""
        before = np.concatenate([[0], np.cumsum([len(x[0]) for x in self.asked.levels])])
        for r, (begin, end) in enumerate(automata.ranges(self.asked, splitters)):
            nodes = [np.arange(a, b) for a, b in zip(begin, end)]
            nodes = [before[d] + x[self.asked.levels[d][2][x] > 0] for d, x in enumerate(nodes)]
            if any(len(x) for x in nodes):
                yield r, self.asked.slice(begin, end), np.concatenate(nodes)


def _best(candidates: Candidates, found: np.ndarray, longer: np.ndarray, share: int, top: int):
    """The best kept candidates of each lang: (lang, phrase, a, l, r, n, score)."""
    names = candidates.paths.names.to_pylist()
    out: dict[int, list] = {}
    for d in sorted(set(candidates.words.tolist())):
        own = np.flatnonzero(candidates.words == d)
        own_kept = own[100 * longer[own] < share * candidates.count[own]]
        mark = np.isin(own, own_kept)
        a = candidates.count[own_kept].tolist()
        n = found[candidates.place[d, 0, 0][mark]].tolist()
        cuts = [(found[candidates.place[d, 0, k][mark]].tolist(), found[candidates.place[d, k, d][mark]].tolist()) for k in range(1, d)]
        rows = candidates.rows[own_kept].tolist()
        for i, f in enumerate(a):
            # Python integers: the products may pass 64 bits
            score, _, left, right = min((1_000_000 * f * f // (x[i] * y[i]), k, x[i], y[i]) for k, (x, y) in enumerate(cuts))
            phrase = b" ".join(names[s] for s in rows[i][1:] if s >= 0)
            out.setdefault(rows[i][0], []).append((-score, -f, phrase, left, right, n[i]))
    for lang, rows in out.items():
        for score, f, phrase, left, right, n in heapq.nsmallest(top, rows):
            yield names[lang].decode(), phrase.decode(), -f, left, right, n, -score


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 3, least: int = 10,
                 share: int = 50, top: int = 2000, range_bytes: int = RANGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang of 2 to ``max_words`` words with
    ``least`` occurrences or more, without those that a longer one contains in ``share`` percent of them or more."""
    docs = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-int(size) // range_bytes))

    def phrases(batch):
        return count_phrases(batch.column("lang").cast(pa.large_string()), texts_of(batch, "text"), max_words)

    splitters = sample_splitters(docs, parts, rows, "text", phrases) if parts > 1 else []
    parts = len(splitters) + 1

    def count(batches):
        for batch in shards_of(batches, shard_bytes, "text"):
            paths = phrases(batch)
            for r, block in cells(paths, splitters):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([block], pa.binary())], names=["range", "block"])
            del paths
            release()

    def unite(batches):
        r = None

        def blocks():
            nonlocal r
            for batch in batches:
                for k, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    r = k
                    yield block

        whole = united(blocks())
        if whole is not None:
            wanted = [whole.levels[0][2] > 0] + [x[2] >= least for x in whole.levels[1:]]
            block = automata.pack(whole.keep(wanted))
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([block], pa.binary())], names=["range", "block"])
        release()

    dealt = docs.mapInArrow(count, "range int, block binary")
    counted = cut(dealt.repartitionById(parts, "range").mapInArrow(unite, "range int, block binary"), "phrase-counts")

    def ask(batches):
        for batch in batches:
            for r, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for to, part, _ in Candidates(automata.unpack(block)).asked_of(splitters):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([to], pa.int32()), pa.array([r], pa.int32()), pa.array([automata.pack(part)], pa.binary())],
                        names=["range", "other", "block"])

    def answer(batches):
        own, r, longer = None, None, None
        for batch in batches:
            for r, other, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if other < 0:
                    own = automata.unpack(block)
                    longer = [np.zeros(len(x[0]), np.int64) for x in own.levels]
                    continue
                wanted, found = automata.unpack(block), []
                for d, nodes in enumerate(automata.compose(own, wanted)):
                    weight = wanted.levels[d][2]
                    asked = weight > 0
                    nodes, weight = nodes[asked], weight[asked]
                    if (nodes < 0).any():
                        raise AssertionError("a part of a candidate has no count")
                    found.append(own.levels[d][2][nodes])
                    np.maximum.at(longer[d], nodes, weight - 1)
                yield _row(other, r, np.concatenate(found))
        if own is not None:
            # for the candidates of the range itself, in their order
            yield _row(r, -2, np.concatenate([np.empty(0, np.int64), *[x[own.levels[d][2] > 0] for d, x in enumerate(longer) if d >= 2]]))

    def rank(batches):
        candidates, found, places, longer = None, None, {}, None
        for batch in batches:
            for other, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if other == -1:
                    candidates = Candidates(automata.unpack(block))
                    found = np.zeros(len(candidates.asked), np.int64)
                    places = {to: place for to, _, place in candidates.asked_of(splitters)}
                elif other == -2:
                    longer = np.frombuffer(block, "<i8")
                else:
                    found[places[other]] = np.frombuffer(block, "<i8")
        if candidates is not None:
            best = list(_best(candidates, found, longer, share, top))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in best], pa.string() if k < 2 else pa.int64()) for k in range(7)],
                                             names=["lang", "phrase", "a", "l", "r", "n", "score"])

    def _row(to: int, other: int, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([to], pa.int32()), pa.array([other], pa.int32()), pa.array([numbers.astype("<i8").tobytes()], pa.binary())],
            names=["range", "other", "block"])

    schema = "range int, other int, block binary"
    mine = counted.select("range", F.lit(-1).alias("other"), "block")

    def together(more: DataFrame) -> DataFrame:
        return mine.unionByName(more).repartitionById(parts, "range").sortWithinPartitions("other")

    asked = counted.mapInArrow(ask, schema)
    # -1 (the range's automaton) has to come before all others in both steps; -2 is first where it is present
    answers = together(asked).mapInArrow(answer, schema)
    ranked = together(answers).mapInArrow(rank, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    first = Window.partitionBy("lang", "part").orderBy(*order)
    last = Window.partitionBy("lang").orderBy(*order)
    some = ranked.withColumn("part", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(last).cast("bigint")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
