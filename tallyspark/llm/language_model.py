"""LM scoring (8): a back-off n-gram model in Elias-Fano tries, one for each range of n-grams.

Tokens are words (lower-cased A-Z, cut at ASCII white space) and one end token for each text; a start symbol stands
before the first. Every n-gram of up to ``order`` symbols of every training text is counted, whatever its count and
whatever the size of the corpus: tasks count shards of texts, and one exchange brings the sorted counts of each range
together (``sequence_ranges.py``). Probabilities are interpolated with absolute discounts, estimated from the corpus
(n1 / (n1 + 2 n2) for each order): p(w|h) = max(c(hw) - D, 0) / c(h) + D T(h) / c(h) p(w|h'), T(h) being the number of
different followers of h, and unigrams smoothed by half a count; each context's distribution sums to one.

Each range's task writes its n-grams as trie levels below the shared folder: Elias-Fano pointers and context-relative
words, discounted probabilities and back-off weights quantised to 8 bits by one fixed code book, unigram counts exact.
Only contexts cut by a range border, at most ``order`` for each range, have their totals put together on the driver.

Scoring goes the same way back: a shard's distinct n-grams are sent to the task of their range, which maps the
range's file into memory and finds them by successor search inside their context; the codes found return to a file
for each shard. The shard's task adds up its documents from them. Texts are read once, and no task holds more than a
shard or a range; what moves grows with the distinct n-grams.

Defined results: null and empty texts are one end token; a null id counts as empty text for the hold-out; with
no training text every probability is that of an unseen word; an empty table gives no rows; other columns stay, and
result columns are named apart from them.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import automata
from tallyspark.llm.alignment import _packed, _unpacked
from tallyspark.llm.automata import Paths
from tallyspark.llm.elias_fano import Level, mapped, saved
from tallyspark.llm.sequence_ranges import SHARD_BYTES, cells, sample_splitters, shards_of, texts_of, united
from tallyspark.llm.storage import cut, file_system, fresh, release, shared_dir
from tallyspark.llm.text import NOT_SPACE, Words, per_doc

#: Longest n-gram; text of a range; nodes of queries that are looked up together.
ORDER, RANGE_BYTES, LOOKED_UP = 2, 16 << 20, 500_000
#: The end token (no word is empty) and the start symbol (no word has a space).
END, START = b"", b" "
#: The code book of quantised probabilities: 0 is absent, code k stands for 10 ** (-(k - 1) * STEP).
STEP = 0.04
BOOK = np.concatenate([[0.0], 10.0 ** (-STEP * np.arange(255))])


def quantised(p: np.ndarray) -> np.ndarray:
    """8-bit codes of probabilities; 0 and less are absent."""
    with np.errstate(divide="ignore", invalid="ignore"):
        code = np.clip(np.rint(-np.log10(p) / STEP) + 1, 1, 255)
    return np.where(p > 0, code, 0).astype(np.uint8)


def ngrams(texts: pa.Array, order: int):
    """All n-grams of the texts with their numbers; for each level the places where its n-grams begin (in the row of
    all symbols) and their nodes; and where each text's symbols begin."""
    words = Words(texts, NOT_SPACE, lower=True)
    ids, names = words.ids()
    names, (place, marks) = automata.sorted_names([names, pa.array([START, END], pa.large_binary())])
    first = words.first + 2 * np.arange(words.n_docs + 1)
    seq = np.empty(int(first[-1]), np.int64)
    inside = np.ones(len(seq), bool)
    seq[first[:-1]], seq[first[1:] - 1] = marks
    inside[first[:-1]] = inside[first[1:] - 1] = False
    seq[inside] = place[ids]
    del words, ids, inside, place
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(seq))
    at, node = np.arange(len(seq)), np.zeros(len(seq), np.int64)
    levels, found = [], []
    for k in range(order):
        long = left[at] > k
        at, node = at[long], node[long]
        level, node = automata.distinct(node, seq[at + k], np.ones(len(at), np.int64), len(names))
        levels.append(level)
        found.append((at, node))
    return Paths(names, levels), found, first


def followers_of(paths: Paths, d: int) -> np.ndarray:
    """How many n-grams of the next level begin with each node of level ``d``; prefixes of other ranges' are none."""
    n = len(paths.levels[d][0])
    if d + 1 == len(paths.levels):
        return np.zeros(n, np.int64)
    parent, _, weight = paths.levels[d + 1]
    return np.bincount(parent[weight > 0], minlength=n)


def fit(docs: DataFrame, order: int = ORDER, range_bytes: int = RANGE_BYTES, shard_bytes: int = SHARD_BYTES) -> dict:
    """The model of the training texts (columns text, train): totals, splitters and the table of the ranges' files."""
    train = docs.where("train").select("text")
    rows, size = train.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-int(size) // range_bytes))

    def counted(batch):
        return ngrams(texts_of(batch, "text"), order)[0]

    splitters = sample_splitters(train, parts, rows, "text", counted) if parts > 1 else []
    parts = len(splitters) + 1

    def count(batches):
        for batch in shards_of(batches, shard_bytes, "text"):
            for r, block in cells(counted(batch), splitters, automata.pack_levels):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([block], pa.binary())], names=["range", "block"])
            release()

    border = pa.struct([("depth", pa.int32()), ("path", pa.list_(pa.binary())), ("c", pa.int64()), ("followers", pa.int64())])
    numbers = [f"{n}_{d}" for d in range(1, order) for n in ("once", "twice")]

    def unite(batches):
        r = None

        def blocks():
            nonlocal r
            for batch in batches:
                for k, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    r = k
                    yield block

        paths = united(blocks(), automata.unpack_levels)
        if paths is None:
            return
        names = paths.names
        _, symbol, weight = paths.levels[0]
        real = symbol != pc.index(names, pa.scalar(START, names.type)).as_py()
        sums = {"tokens": int(weight[real].sum()), "kinds": int((weight[real] > 0).sum())}
        for d in range(1, order):
            sums |= {f"once_{d}": int((paths.levels[d][2] == 1).sum()), f"twice_{d}": int((paths.levels[d][2] == 2).sum())}
        borders = []
        for d in range(order - 1):
            n, children = len(paths.levels[d][0]), followers_of(paths, d)
            for k in sorted({0, n - 1} if n else set()):
                (row,) = automata.rows_of(paths, d, np.array([k]), d + 1).tolist()
                borders.append({"depth": d, "path": [names[s].as_py() for s in row], "c": int(paths.levels[d][2][k]), "followers": int(children[k])})
        yield pa.RecordBatch.from_arrays(
            [pa.array([r], pa.int32()), pa.array([automata.pack_levels(paths)], pa.binary()), pa.array([borders], pa.list_(border)),
             *[pa.array([sums[x]], pa.int64()) for x in ("tokens", "kinds", *numbers)]],
            names=["range", "block", "borders", "tokens", "kinds", *numbers])
        release()

    spark = docs.sparkSession
    schema = "range int, block binary, borders array<struct<depth:int,path:array<binary>,c:bigint,followers:bigint>>, " \
        + ", ".join(f"{x} bigint" for x in ("tokens", "kinds", *numbers))
    dealt = train.mapInArrow(count, "range int, block binary").repartitionById(parts, "range")
    united_ = cut(dealt.mapInArrow(unite, schema), "ngram-counts")
    sums = united_.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tokens", "kinds", *numbers)]).first()
    discount = [0.0] + [sums[f"once_{d}"] / max(1, sums[f"once_{d}"] + 2 * sums[f"twice_{d}"]) for d in range(1, order)]
    # where every n-gram occurs once or none does, the estimate is 1 or 0
    discount = [min(0.95, max(0.1, x)) for x in discount]
    # contexts at the ranges' borders: a few for each range
    totals: dict[tuple, list[int]] = {}
    for (borders,) in united_.select("borders").collect():
        for b in borders:
            t = totals.setdefault(tuple(bytes(x) for x in b.path), [0, 0])
            t[0] += b.c
            t[1] += b.followers
    shared = spark.sparkContext.broadcast(totals)
    folder = f"{shared_dir(spark)}/llm/ngrams-{uuid.uuid4().hex}"

    def build(batches):
        for batch in batches:
            for r, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{folder}/range-{r}-{uuid.uuid4().hex}"
                _write(name, saved(trie(automata.unpack_levels(block), discount, shared.value)))
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([name])], names=["range", "file"])
                release()

    files = cut(united_.select("range", "block").mapInArrow(build, "range int, file string"), "ngram-files")
    return {"total": int(sums["tokens"]), "kinds": int(sums["kinds"]), "order": order, "discount": discount,
            "splitters": splitters, "files": files, "shard_bytes": shard_bytes}


def trie(paths: Paths, discount: list[float], totals: dict[tuple, list[int]]) -> dict[str, np.ndarray]:
    """The arrays of a range's trie; ``totals`` has (count, followers) of the contexts at borders."""
    names, order = paths.names, len(paths.levels)
    edge, body = automata.bytes_of(names)
    out = {"names.edge": edge, "names.bytes": body, "counts": paths.levels[0][2]}
    before = np.empty(0)
    for d, (parent, symbol, weight) in enumerate(paths.levels):
        c, followers = weight.astype(float), followers_of(paths, d).astype(float)
        n = len(parent)
        for k in {0, n - 1} if n and d < order - 1 else ():
            (row,) = automata.rows_of(paths, d, np.array([k]), d + 1).tolist()
            c[k], followers[k] = totals[tuple(names[s].as_py() for s in row)]
        codes = {}
        if d:
            codes["p"] = quantised(np.where(weight > 0, (weight - discount[d]) / before[parent], 0))
        if d < order - 1:
            codes["back"] = quantised(np.divide(discount[d + 1] * followers, c, out=np.zeros(n), where=c > 0))
        out |= Level.of(parent, symbol, len(before) if d else 1, codes, {}).arrays(str(d))
        before = c
    return out


def _write(name: str, parts: list[bytes]) -> None:
    """A file that is there whole or not at all."""
    fs, where = file_system(name)
    fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
    draft = f"{where}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft, compression=None) as out:
        for x in parts:
            out.write(x)
    fs.move(draft, where)


def _map(name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the folder is mounted."""
    fs, where = file_system(name)
    if fs.type_name == "local":
        return mapped(pa.memory_map(where).read_buffer())
    with fs.open_input_file(where) as file:
        return mapped(file.read_buffer())


class Trie:
    """A range's file, for queries."""

    def __init__(self, arrays: dict[str, np.ndarray], order: int):
        edge = arrays["names.edge"]
        self.names = pa.Array.from_buffers(pa.large_binary(), len(edge) - 1, [
            None, pa.py_buffer(np.ascontiguousarray(edge)), pa.py_buffer(np.ascontiguousarray(arrays["names.bytes"]))])
        self.counts = arrays["counts"]
        self.levels = [Level.load(arrays, str(d), {}) for d in range(order)]

    def look_up(self, many: list[Paths]) -> list[bytes]:
        """For the asked nodes (with a weight) of each of the queries: counts of level 0, codes of the others."""
        names = pc.index_in(pa.concat_arrays([q.names for q in many]), value_set=self.names).fill_null(-1)
        places = np.split(names.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([len(q.names) for q in many])[:-1])
        out: list[list[np.ndarray]] = [[] for _ in many]
        up = [np.zeros(1, np.int64) for _ in many]
        for d, level in enumerate(self.levels):
            parts = [q.levels[d] for q in many]
            context = np.concatenate([own[x[0]] for own, x in zip(up, parts)])
            word = np.concatenate([place[x[1]] for place, x in zip(places, parts)])
            up = np.split(level.find(context, word), np.cumsum([len(x[0]) for x in parts])[:-1])
            for k, (node, part) in enumerate(zip(up, parts)):
                asked = node[part[2] > 0]
                hit = asked >= 0
                if d == 0:
                    c = np.zeros(len(asked), np.int64)
                    c[hit] = self.counts[asked[hit]]
                    out[k].append(c)
                for kind in ("p", "back"):
                    if kind in level.codes:
                        code = np.zeros(len(asked), np.uint8)
                        code[hit] = level.codes[kind][asked[hit]]
                        out[k].append(code)
        return [b"".join(saved({str(i): x for i, x in enumerate(xs)})) for xs in out]


def score_documents(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` without the text, with last columns n_tokens, n_known (bigint), base_score and score (double)."""
    spark, order, splitters, total, kinds = docs.sparkSession, model["order"], model["splitters"], model["total"], model["kinds"]
    own = [c for c in docs.columns if c != text]
    result = fresh(docs.select(*own), "n_tokens", "n_known", "base_score", "score")
    (whole,) = fresh(docs, "whole_text")
    texts = docs.select(*own, F.col(text).alias(whole))
    kind = [f"`{f.name}`:{f.dataType.simpleString()}" for f in texts.schema.fields[:-1]]
    struct = "struct<" + ",".join([*kind, "`n tokens`:bigint"]) + ">"
    folder, shard_bytes = f"{shared_dir(spark)}/llm/answers-{uuid.uuid4().hex}", model["shard_bytes"]

    def read(batches):
        for batch in shards_of(batches, shard_bytes, whole):
            paths, found, first = ngrams(texts_of(batch, whole), order)
            # the longest n-gram that ends at each token: that of the full order, or one that begins at the start
            before = np.concatenate([[0], np.cumsum([len(x[0]) for x in paths.levels])])
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            starts = np.zeros(len(doc_of), bool)
            starts[first[:-1]] = True
            docs_, nodes = [], []
            for d, (at, node) in enumerate(found):
                mine = np.ones(len(at), bool) if d == order - 1 and d else starts[at] & (d > 0)
                if order == 1:
                    mine = ~starts[at]
                docs_.append(doc_of[at[mine]])
                nodes.append(before[d] + node[mine])
            doc, node = np.concatenate(docs_), np.concatenate(nodes)
            key = doc * before[-1] + node
            del found, docs_, nodes, doc, node, starts, doc_of, at, mine
            key.sort()
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            times = np.diff(np.append(new, len(key)))
            doc, node = np.divmod(key[new], before[-1])
            del key, new
            edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            gap = np.diff(node, prepend=0)
            heads = edge[:-1][edge[:-1] < edge[1:]]
            gap[heads] = node[heads]
            # a query asks for every node, whatever its number
            asked = Paths(paths.names, [(up, symbol, np.ones(len(up), np.int64)) for up, symbol, _ in paths.levels])
            rows = pa.StructArray.from_arrays([*batch.columns[:-1], pa.array(np.diff(first) - 1, pa.int64())], names=[*own, "n tokens"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                 pa.array([automata.pack_levels(asked)], pa.binary()), pa.array([_packed(edge, gap, times)], pa.binary())],
                names=["shard", "rows", "paths", "pairs"])
            release()

    shards = cut(texts.mapInArrow(read, f"shard string, rows array<{struct}>, paths binary, pairs binary"), "scored-shards")

    def ask(batches):
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for r, cell in cells(automata.unpack_levels(block), splitters, automata.pack_levels):
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([shard]), pa.array([cell], pa.binary()), pa.array([None], pa.string())],
                                                     names=["range", "shard", "block", "file"])

    def answer(batches):
        trie_, r, held, size = None, None, [], 0

        def answers():
            found = trie_.look_up([x[1] for x in held]) if trie_ else [b""] * len(held)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.string()), pa.array([r] * len(held), pa.int32()), pa.array(found, pa.binary())],
                                              names=["shard", "range", "block"])

        for batch in batches:
            for r, shard, block, file in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if shard is None:
                    trie_ = Trie(_map(file), order)
                    continue
                held.append((shard, automata.unpack_levels(block)))
                size += len(held[-1][1])
                if size >= LOOKED_UP:
                    yield answers()
                    held, size = [], 0
        if held:
            yield answers()
        release()

    def keep(batches):
        now, parts = None, []

        def write():
            edge = np.concatenate([[0], np.cumsum([len(b) for _, b in parts])])
            _write(f"{folder}/{now}", saved({"range": np.array([r for r, _ in parts], np.int64), "edge": edge,
                                             "data": np.frombuffer(b"".join(b for _, b in parts), np.uint8)}))
            return pa.RecordBatch.from_arrays([pa.array([now])], names=["shard"])

        for batch in batches:
            for shard, r, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if shard != now and parts:
                    yield write()
                    parts = []
                now = shard
                parts.append((r, block))
        if parts:
            yield write()

    parts = len(splitters) + 1
    asked = shards.select("shard", "paths").mapInArrow(ask, "range int, shard string, block binary, file string")
    tries = model["files"].select("range", F.lit(None).cast("string").alias("shard"), F.lit(None).cast("binary").alias("block"), "file")
    met = asked.unionByName(tries).repartitionById(parts, "range").sortWithinPartitions(F.col("shard").asc_nulls_first())
    answers_ = met.mapInArrow(answer, "shard string, range int, block binary")
    cut(answers_.repartition("shard").sortWithinPartitions("shard", "range").mapInArrow(keep, "shard string"), "answered-shards")

    def score(batches):
        for batch in batches:
            for i, shard in enumerate(batch.column(0).to_pylist()):
                rows = batch.column(1).slice(i, 1).flatten()
                paths, pairs = automata.unpack_levels(batch.column(2)[i].as_py()), _unpacked(batch.column(3)[i].as_py(), 3)
                base, p, known = probabilities(paths, _map(f"{folder}/{shard}"), splitters, total, kinds)
                edge, gap, times = pairs
                n = np.diff(edge)
                upto = np.concatenate([[0], np.cumsum(gap)])
                node = upto[1:] - np.repeat(upto[edge[:-1]], n)
                values = [per_doc(times * known[node], edge)]
                for x in (base, p):
                    s = np.concatenate([[0.0], np.cumsum(times * np.log10(x[node]))])
                    values.append(s[edge[1:]] - s[edge[:-1]])
                fields = rows.flatten()
                yield pa.RecordBatch.from_arrays([*fields, *map(pa.array, values)], names=[*own, *result])
            release()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1]]
                       + [f"`{result[0]}` bigint, `{result[1]}` bigint, `{result[2]}` double, `{result[3]}` double"])
    return shards.mapInArrow(score, schema)


def probabilities(paths: Paths, answers: dict[str, np.ndarray], splitters: list[list[bytes]], total: int, kinds: int):
    """Of all nodes of a shard's n-grams, level by level: base and model probability of the last symbol, and whether it
    occurs in the training texts."""
    order = len(paths.levels)
    sizes = [len(x[0]) for x in paths.levels]
    count, codes = np.zeros(sizes[0], np.int64), {(d, k): np.zeros(n, np.uint8) for d, n in enumerate(sizes) for k in ("p", "back")}
    blocks = {int(r): answers["data"][a:b] for r, a, b in zip(answers["range"], answers["edge"][:-1], answers["edge"][1:])}
    for r, (begin, end) in enumerate(automata.ranges(paths, splitters)):
        if not any(a < b for a, b in zip(begin, end)):
            continue
        block = blocks[r]
        if not len(block):
            continue  # no training n-gram lies in this range
        found = iter(mapped(block.tobytes()).values())
        for d, (a, b) in enumerate(zip(begin, end)):
            if d == 0:
                count[a:b] = next(found)
            else:
                codes[d, "p"][a:b] = next(found)
            if d < order - 1:
                codes[d, "back"][a:b] = next(found)
    one = (count + 0.5) / (total + 0.5 * (kinds + 1))
    base, p, known, last = [one], [one], [count > 0], one
    shorter = None
    for d in range(1, order):
        parent, symbol, _ = paths.levels[d]
        if d == 1:
            suffix = np.searchsorted(paths.levels[0][1], symbol)
        else:
            up, own, _ = paths.levels[d - 1]
            suffix = np.searchsorted(up * len(paths.names) + own, shorter[parent] * len(paths.names) + symbol)
        back = BOOK[codes[d - 1, "back"]]
        last = BOOK[codes[d, "p"]] + np.where(back > 0, back, 1.0)[parent] * last[suffix]
        base.append(base[-1][suffix])
        known.append(known[-1][suffix])
        p.append(last)
        shorter = suffix
    return np.concatenate(base), np.concatenate(p), np.concatenate(known)
