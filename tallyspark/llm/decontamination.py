"""Benchmark decontamination (1): a generalised suffix automaton of the test items, streamed over with documents.

The automaton holds every run of item words. Reading a document's words one by one gives the longest match
that ends at each word; a match of ``window`` words, or of a whole shorter item, marks its words as hit.
A match never spans a word that no item has, so only runs of item vocabulary that are long enough are read;
the rest of a chunk is passed over in vectorised steps.

An automaton is built from at most ``MAX_BYTES`` of item text and broadcast; more items are dealt over several
automata by a hash, one pass over the documents each, and the passes' spans are merged. Documents are never
shuffled: one Arrow pass beside the scan.

Defined results: words are lower-cased (A-Z); null texts and null items have no words; items without words and
an empty benchmark match nothing; an item id that is null marks words but is not listed; repeated items count
once; rows of documents stay one by one with all their columns.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.storage import cut, fresh, release
from tallyspark.llm.text import ALNUM, Words, chunks, code_points

#: Item text that one automaton holds at most.
MAX_BYTES = 4 << 20

SPAN_TYPE = "array<struct<word_from:bigint,word_to:bigint,start:bigint,end:bigint>>"
MATCH_TYPE = f"struct<n_words:bigint,n_hit:bigint,longest:bigint,items:array<string>,spans:{SPAN_TYPE}>"


def build_automaton(items: list[tuple[str | None, str | None]], window: int) -> dict:
    """The automaton of (id, text) items as plain lists, to be broadcast.

    ``step`` has the transitions, ``link`` and ``length`` the suffix links; ``wide`` maps a state to the state
    of its last ``window`` words; ``short`` lists whole shorter items that end there as (words, ids), and
    ``chain`` is the nearest state with such items along the suffix links (-1: none).
    """
    words = Words(pa.array([t for _, t in items], pa.large_string()), ALNUM, lower=True) if items else None
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    if words is None or not len(words):
        return {"vocabulary": [], "step": step, "link": link, "length": length, "least": 0}
    ids, vocabulary = words.ids()

    def extend(last: int, w: int) -> int:
        q = step[last].get(w)
        if q is not None and length[q] == length[last] + 1:
            return q
        cur = -1
        if q is None:
            cur = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and w not in step[p]:
                step[p][w] = cur
                p = link[p]
            if p < 0:
                return cur
            q = step[p][w]
            if length[q] == length[p] + 1:
                link[cur] = q
                return cur
        else:
            p = last
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = copy
            p = link[p]
        link[q] = copy
        if cur < 0:
            return copy
        link[cur] = copy
        return cur

    texts = [ids[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
    for text in texts:
        last = 0
        for w in text:
            last = extend(last, w)
    n = len(step)
    wide: list[int] = [-1] * n
    for s in sorted(range(1, n), key=length.__getitem__):
        if length[s] >= window:
            wide[s] = s if length[link[s]] < window else wide[link[s]]
    owners: dict[int, set] = {}
    short: dict[int, dict[int, set]] = {}
    for (item, _), text in zip(items, texts):
        owner = {item} - {None}
        s = 0
        for at, w in enumerate(text, 1):
            s = step[s][w]
            if at >= window:
                owners.setdefault(wide[s], set()).update(owner)
        if 0 < len(text) < window:
            while length[link[s]] >= len(text):
                s = link[s]
            short.setdefault(s, {}).setdefault(len(text), set()).update(owner)
    chain = [-1] * n
    for s in sorted(range(1, n), key=length.__getitem__):
        chain[s] = s if s in short else chain[link[s]]
    return {
        "vocabulary": vocabulary.to_pylist(), "step": step, "link": link, "length": length, "wide": wide,
        "owners": {s: sorted(o) for s, o in owners.items()}, "chain": chain,
        "short": {s: [(k, sorted(o)) for k, o in x.items()] for s, x in short.items()},
        "least": min([window, *(len(t) for t in texts if t)]),
    }


def scan(auto: dict, ids: list[int], window: int) -> tuple[list[tuple[int, int]], int, set]:
    """Hit ranges (first word, end), longest match and items of one run of item vocabulary."""
    step, link, length = auto["step"], auto["link"], auto["length"]
    wide, owners, chain, short = auto["wide"], auto["owners"], auto["chain"], auto["short"]
    hits: list[tuple[int, int]] = []
    items: set = set()
    s = size = longest = 0
    for at, w in enumerate(ids, 1):
        t = step[s].get(w)
        while t is None and s:
            s = link[s]
            size = length[s]
            t = step[s].get(w)
        if t is None:
            size = 0
            continue
        s, size = t, size + 1
        longest = max(longest, size)
        if size >= window:
            hits.append((at - window, at))
            items.update(owners[wide[s]])
        c = chain[s]
        while c >= 0:
            for k, found in short[c]:
                if k <= size:
                    hits.append((at - k, at))
                    items.update(found)
            c = chain[link[c]] if link[c] >= 0 else -1
    return hits, longest, items


def merged(ranges: list[tuple]) -> list[tuple]:
    """Ranges (word_from, word_to, start, end) with touching ones joined."""
    out: list[list] = []
    for a, b, start, end in sorted(ranges):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1][1], out[-1][3] = b, end
        else:
            out.append([a, b, start, end])
    return [tuple(x) for x in out]


def chunk_matches(arr: pa.Array, auto: dict, vocabulary: pa.Array, window: int, before: list | None) -> list[dict]:
    """The match of every text of a chunk; ``before`` has the matches of earlier automata."""
    words = Words(arr, ALNUM, lower=True)
    n_words = words.counts().tolist()
    out = [{"n_words": n, "n_hit": 0, "longest": 0, "items": [], "spans": []} for n in n_words]
    if before is not None:
        for o, b in zip(out, before):
            if b is not None:
                o.update(b)
    if not len(words) or not len(vocabulary):
        return out
    ids, distinct = words.ids()
    known = pc.index_in(distinct, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
    ids = known[ids]
    inside = ids >= 0
    # runs of item vocabulary inside one document
    edge = np.ones(len(ids) + 1, bool)
    edge[1:-1] = (inside[1:] != inside[:-1]) | (words.doc[1:] != words.doc[:-1])
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    run = inside[begin] & (end - begin >= auto["least"])
    if not run.any():
        return out
    chars, doc_chars = code_points(words.data, words.off)
    found: dict[int, list] = {}
    for a, b in zip(begin[run].tolist(), end[run].tolist()):
        hits, longest, items = scan(auto, ids[a:b].tolist(), window)
        d = int(words.doc[a])
        out[d]["longest"] = max(out[d]["longest"], longest)
        if hits:
            got = found.setdefault(d, [[], set()])
            base, at = int(words.first[d]), int(doc_chars[d])
            got[0] += [(a + i - base, a + j - base, int(chars[words.starts[a + i]]) - at,
                        int(chars[words.ends[a + j - 1]]) - at) for i, j in set(hits)]
            got[1] |= items
    for d, (ranges, items) in found.items():
        o = out[d]
        old = [(x["word_from"], x["word_to"], x["start"], x["end"]) for x in o["spans"]]
        spans = merged(old + ranges)
        o["spans"] = [dict(zip(("word_from", "word_to", "start", "end"), x)) for x in spans]
        o["n_hit"] = sum(x[1] - x[0] for x in spans)
        o["items"] = sorted(items.union(o["items"]))
    return out


_MATCH_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("word_from", "word_to", "start", "end")])))])


def _matcher(auto, window: int):
    @arrow_udf(MATCH_TYPE)
    def match_texts(texts: pa.Array, before: pa.Array) -> pa.Array:
        model = auto.value
        vocabulary = pa.array(model["vocabulary"], pa.large_binary())
        rows, at = [], 0
        for c in chunks(texts):
            old = before.slice(at, len(c)).to_pylist() if before.null_count < len(before) else None
            rows += chunk_matches(c, model, vocabulary, window, old)
            at += len(c)
        release()
        return pa.array(rows, _MATCH_ARROW)

    return match_texts


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text",
                 item_id: str = "item_id", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with a last column ``match``: words, hit words, longest match, items (as text) and spans
    (word range; start and end in code points) of every text."""
    spark = docs.sparkSession
    match, part = fresh(docs, "match", "part")
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col("text").alias("t")).where("t IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 64), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / max_bytes))
    out = docs
    for k in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("id", "t"), F.lit(parts)) == k)
        auto = spark.sparkContext.broadcast(build_automaton([tuple(r) for r in mine.collect()], window))

        match_texts = _matcher(auto, window)
        before = F.lit(None).cast(MATCH_TYPE) if not k else F.col(match)
        out = out.withColumn(part, match_texts(F.col(text), before)).drop(match).withColumnRenamed(part, match) \
            if k else out.withColumn(match, match_texts(F.col(text), before))
        if parts > 1:
            out = cut(out, "matches")
    return out


def contaminated(match: Column, share: int = 20) -> Column:
    """Whether hit words are at least one in ``share`` of the words."""
    return (match["n_hit"] > 0) & (share * match["n_hit"] >= match["n_words"])


def without_spans(text: Column, match: Column, least: int = 1) -> Column:
    """The text without its matched spans of ``least`` words or more."""
    spans = F.filter(match["spans"], lambda s: s["word_to"] - s["word_from"] >= least)
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.char_length(text).cast("bigint")))
    rest = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda z: F.substr(
        text, (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int")))
    return F.when(F.size(spans) > 0, F.concat_ws("", rest)).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                  max_span: int | None = None) -> DataFrame:
    """The documents that are not contaminated (coverage limit: one hit word in ``share``), with their own columns.
    With ``max_span`` (length limit) matched spans of that many words or more are taken out of the texts that stay,
    and ``n_chars``, if there, counted again."""
    found = find_matches(docs, benchmark, window)
    match = F.col(found.columns[-1])
    kept = found.where(~contaminated(match, share))
    if max_span is not None:
        kept = kept.withColumn("text", without_spans(F.col("text"), match, max_span))
        if "n_chars" in docs.columns:
            cut_ = F.exists(match["spans"], lambda s: s["word_to"] - s["word_from"] >= max_span)
            kept = kept.withColumn("n_chars", F.when(cut_, F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)
