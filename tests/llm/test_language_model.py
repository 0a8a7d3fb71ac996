"""The n-gram model against a plain version, whatever the shards and ranges."""

import math
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from tallyspark.llm import automata, elias_fano, language_model, queries  # noqa: E402
from tallyspark.llm.calibration import id_remainder  # noqa: E402

SF = "/root/testdata/sf0.001"


def symbols(text):
    return [" ", *brute.WORD.findall(brute.low(text)), ""]


def plain_scores(train, texts, order):
    """(n_tokens, n_known, base_score, score) with the model's quantised numbers."""
    count, followers, once = Counter(), defaultdict(set), Counter()
    for t in train:
        s = symbols(t)
        for n in range(1, order + 1):
            count.update(tuple(s[i:i + n]) for i in range(len(s) - n + 1))
    for g, c in count.items():
        followers[g[:-1]].add(g[-1])
        once[len(g), c] += 1
    discount = {n: min(0.95, max(0.1, once[n, 1] / max(1, once[n, 1] + 2 * once[n, 2]))) for n in range(2, order + 1)}
    total = sum(c for g, c in count.items() if len(g) == 1 and g != (" ",))
    kinds = sum(len(g) == 1 and g != (" ",) for g in count)

    def coded(x):
        return float(language_model.BOOK[language_model.quantised(np.array([x]))[0]])

    def p(g):
        if len(g) == 1:
            return (count[g] + 0.5) / (total + 0.5 * (kinds + 1))
        h = g[:-1]
        own = coded((count[g] - discount[len(g)]) / count[h]) if count[g] else 0.0
        back = coded(discount[len(g)] * len(followers[h]) / count[h]) if count[h] else 1.0
        return own + back * p(g[1:])

    out = []
    for t in texts:
        s = symbols(t)
        grams = [tuple(s[max(0, i - order + 1):i + 1]) for i in range(1, len(s))]
        out.append((len(grams), sum(count[g[-1:]] > 0 for g in grams), sum(math.log10(p(g[-1:])) for g in grams), sum(math.log10(p(g)) for g in grams)))
    return out


@pytest.mark.parametrize("order, range_bytes, shard_bytes", [(2, 1 << 30, 1 << 30), (2, 20_000, 30_000), (3, 1 << 30, 50_000), (3, 15_000, 50_000), (1, 40_000, 40_000)])
def test_scores_equal_the_plain_model(spark, raw, edge, order, range_bytes, shard_bytes):
    rows = [(i, t, i is not None and i % 5 == 1) for i, t in raw[:120] + [(r.doc_id, r.text) for r in edge.collect()]]
    rows += [(900, "the the the the a b", False), (901, "x" * 5000 + " " + "y " * 400, False), (902, "the the the", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    model = language_model.fit(docs.withColumn("train", ~F.col("held")), order, range_bytes, shard_bytes)
    assert range_bytes > 1 << 20 or len(model["splitters"]) > 3
    clash = docs.withColumn("known", F.lit("mine")).withColumn("RID", F.lit(5)).withColumn("score", F.lit(7))
    got = language_model.score_documents(clash, model)
    assert got.columns == ["doc_id", "held", "known", "RID", "score", "n_tokens", "n_known", "base_score", "_score"]
    want = plain_scores([t for _, t, h in rows if not h], [t for _, t, _ in rows], order)
    have = sorted(got.collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    plain = sorted(zip([i for i, _, _ in rows], want), key=lambda x: (str(x[0]), x[1][0]))
    assert len(have) == len(plain)
    for r, (i, w) in zip(have, plain):
        assert (r.doc_id, r.known, r.RID, r.score) == (i, "mine", 5, 7)
        assert (r.n_tokens, r.n_known) == w[:2] and abs(r.base_score - w[2]) < 1e-6 * abs(w[2]) and abs(r._score - w[3]) < 1e-6 * abs(w[3])


def test_a_model_of_copies_is_the_same_kind_of_model(spark, docs):
    """Ten copies of the corpus: every n-gram is still there, none is cut by its count."""
    one = docs.select("doc_id", "text").withColumn("train", F.lit(True))
    ten = one.crossJoin(spark.range(10)).drop("id")
    sizes = []
    for d in (one, ten):
        files = language_model.fit(d)["files"].collect()
        sizes.append(sum(len(language_model._map(f.file)["1.code.p"]) for f in files))
    assert sizes[0] == sizes[1] > 10_000


def test_texts_of_the_corpus_score_higher(spark):
    scored = queries.op8_language_model(spark, "/root/testdata/sf0.01")
    rows = scored.select("held_out", (F.col("score") - F.col("base_score")).alias("gain"), "n_tokens").where("n_tokens > 30").collect()
    mean = [np.mean([r.gain / r.n_tokens for r in rows if r.held_out == h]) for h in (False, True)]
    assert mean[0] > mean[1] + 0.3


def test_model_of_nothing(spark, edge):
    for train in (edge.limit(0), edge.where("doc_id IS NULL")):
        model = language_model.fit(train.select("text", F.lit(True).alias("train")))
        rows = language_model.score_documents(edge, model).collect()
        assert len(rows) == edge.count() and all(r.score <= 0 for r in rows)
    assert language_model.score_documents(edge.limit(0), model).count() == 0


def test_files_are_mapped(tmp_path):
    arrays = {"a": np.arange(5), "b": np.array([], np.uint8), "c": np.array([1, 2, 255], np.uint8)}
    (tmp_path / "f").write_bytes(b"".join(elias_fano.saved(arrays)))
    back = elias_fano.mapped(pa.memory_map(str(tmp_path / "f")).read_buffer())
    assert list(back) == list(arrays) and all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in arrays.items())


class Names:
    """Names of paths that must not become Python objects all at once."""

    def __init__(self, own):
        self.own, self.offset = own, own.offset

    def __len__(self):
        return len(self.own)

    def __getitem__(self, k):
        return self.own[k]

    def buffers(self):
        return self.own.buffers()

    def take(self, at):
        return Names(self.own.take(at))

    def to_pylist(self):
        raise AssertionError("an object for each name")


def test_names_go_to_blocks_and_tries_as_buffers():
    paths, _, _ = language_model.ngrams(pa.array(["b a b ä", "", "a c漢 b", None], pa.large_string()), 2)
    names = paths.names
    used = automata.Paths(Names(names), paths.levels)
    for pack, unpack in ((automata.pack_levels, automata.unpack_levels), (automata.pack, automata.unpack)):
        back = unpack(pack(used))
        assert back.names.equals(names)
        assert all((x == y).all() for mine, own in zip(back.levels, paths.levels) for x, y in zip(mine, own))
    n = len(paths.levels[0][0])
    totals = {(names[int(paths.levels[0][1][k])].as_py(),): [1, 1] for k in (0, n - 1)}
    arrays = language_model.trie(used, [0.0, 0.5], totals)
    edge, data = arrays["names.edge"], arrays["names.bytes"].tobytes()
    assert [data[a:b] for a, b in zip(edge[:-1], edge[1:])] == names.to_pylist()


@pytest.mark.parametrize("values", [[], [b""], [b"", b"a", b"", b"\xff\x00c"]])
def test_bytes_of_names(values):
    padded = pa.array([b"before", *values, b"behind"], pa.large_binary())
    for names in (pa.array(values, pa.large_binary()), padded.slice(1, len(values))):
        edge, body = automata.bytes_of(names)
        assert [body[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])] == values
        assert edge[0] == 0 and edge[-1] == len(body)
