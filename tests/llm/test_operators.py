"""Each operator against a brute-force version, on the small tables and on edge rows."""

import hashlib
import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from tallyspark.llm import (byte_bpe, decontamination, elias_fano, quality_classifier, quality_rules,  # noqa: E402
                            queries, secret_scan, sharding, simhash, surrogates, toxicity)

SF = "/root/testdata/sf0.001"


def all_texts(raw, edge):
    return raw + [(r.doc_id, r.text) for r in edge.collect()]


def test_decontamination(spark, docs, edge, raw):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    extra = [(900, "quick brown"), (901, "the"), (902, None), (903, ""), (None, "fox jumps"), (900, "x")]
    bench = spark.createDataFrame([tuple(r) for r in items] + extra, "item_id long, text string")
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    want = brute.contamination([t for _, t in all_texts(raw, edge)], [(i, t) for i, t in bench.collect()])
    want = Counter((n, h, tuple(x for x in f if x != "None")) for n, h, f in want)
    for limit in (decontamination.MAX_BYTES, 5000):
        got = decontamination.find_matches(both, bench, max_bytes=limit).select("match").collect()
        assert Counter((m.n_words, m.n_hit, tuple(m["items"])) for (m,) in got) == want
    none = decontamination.find_matches(edge, bench.limit(0)).collect()
    assert len(none) == edge.count() and all(r.match.n_hit == 0 for r in none)
    cleaned = decontamination.decontaminate(both, bench.where("item_id < 100"), share=2, max_span=1)
    assert decontamination.find_matches(cleaned, bench.where("item_id < 100")).where("match.n_hit > 0").count() == 0


def test_quality_rules(docs, edge, labels, raw):
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    got = both.select(quality_rules.text_stats(F.col("text")).alias("s")).select("s.*").collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(brute.stats(t) for _, t in all_texts(raw, edge))
    rules = quality_rules.fit_rules(docs, labels)
    judged = quality_rules.apply_rules(docs, rules).join(labels, "doc_id").where("rule IS NULL")
    assert judged.where("quality = 0").count() == 0 and judged.where("quality = 1").count() > 60
    assert quality_rules.fit_rules(docs, labels.limit(0)) == []
    assert quality_rules.keep_good(edge, labels).columns == edge.columns
    assert quality_rules.keep_good(edge.limit(0), labels).count() == 0


def test_simhash(spark, docs, edge, raw):
    prints = {i: brute.fingerprint(t) for i, t in raw}
    root = brute.components(prints)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{prints[i]:016x}", root[i]) for i in prints}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(root.values())
    assert Counter(r.doc_id for r in simhash.keep_one(edge).collect()) == Counter([1, 2, 5, 6, 7])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("leaf, block", [(8, 4), (64, 16)])
def test_vantage_trees_find_all_pairs(spark, monkeypatch, leaf, block):
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flip = lambda x: x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64))
    values = {int(np.int64(x.view(np.int64))) for x in [*base, *[flip(x) for x in base], *[flip(base[0]) for _ in range(150)]]}
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "BLOCK", block)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in simhash.star_components(simhash.links(fps)).collect()}
    want = brute.components({v: v & (2**64 - 1) for v in values})
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert groups({v: roots.get(v, v) for v in values}) == groups(want)


def test_secret_scan(docs, edge, raw):
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    got = secret_scan.scan(both).select("spans").collect()
    assert Counter(tuple(tuple(s) for s in r.spans) for r in got) == Counter(
        tuple(brute.base_spans(t)) for _, t in all_texts(raw, edge))
    body = "a1B2" * 7 + "Zz"
    good, bad = "ghp_" + body + secret_scan.base62_crc(body), "ghp_" + body + "000000"
    rows = edge.sparkSession.createDataFrame([(f"é {good} {bad} x",)], "text string")
    assert [tuple(s) for s in secret_scan.scan(rows).first().spans] == [("github", 2, 42)]
    red = secret_scan.redact(edge).where("doc_id = 7").first()
    assert red.text == "[SECRET] [SECRET] [SECRET] a@b.example.com" and red.spans == "g"


def test_byte_bpe(docs, edge, raw):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    got = byte_bpe.encode_documents(both, path, public_tokenizers.PATTERN)
    want = [(enc.encode_ordinary(t or ""), (t or "").encode()) for _, t in all_texts(raw, edge)]
    assert Counter((tuple(r.ids), bytes(r.decoded)) for r in got.collect()) == Counter((tuple(i), b) for i, b in want)
    tok = byte_bpe.Tokenizer(docs.sparkSession, path, public_tokenizers.PATTERN)
    again = got.select((tok.decode(F.col("ids")) == F.col("decoded")).alias("ok")).collect()
    assert all(r.ok for r in again)
    dig = byte_bpe.encode_digests(both, path, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert Counter((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in dig) == Counter(
        (len(i), sha(" ".join(map(str, i)).encode()), sha(b)) for i, b in want)


def test_sharding(docs, edge):
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    rows = sharding.shard_by_bytes(both, shards=4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in both.collect())
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in rows)
    for s in range(4):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_by_bytes(both.limit(0)).count() == 0


def test_hot_text_is_cut(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("copy")).otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    n = [r["count"] for r in sharding.shard_by_bytes(rows, shards=16).groupBy("shard").agg(
        F.sum("size").alias("count")).collect()]
    assert len(n) == 16 and max(n) - min(n) <= 20


def test_surrogates(spark, edge, docs):
    texts = [(1, "Mr. John Smith and Frau Anna, 4111 1111 1111 1111; a@b.co, c@b.co"), (2, "Frau Anna! Госпожа Иванова 10.1.2.3"),
             (3, "+1 (687) 555-9292 or 123-45-6789"), (None, None), (4, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("kinds", F.lit("own"))
    out = {r.doc_id: r for r in surrogates.replace_pii(df, "k").collect()}
    new = surrogates.replace_pii(df, "k")
    assert new.columns == ["doc_id", "text", "kinds", "_kinds"] and out[4].text == "" and out[None].text is None
    for old in ("John", "Anna", "4111", "a@b", "Иванова", "10.1.2.3", "687", "123-45"):
        assert all(old not in (r.text or "") for r in out.values())
    anna = out[2].text.split("!")[0]
    assert anna in out[1].text and anna.startswith("Frau ") and anna.endswith("a")
    table = surrogates.surrogate_table(spark.createDataFrame([(f"{c}@{d}.co",) for c in "abcdefghij" for d in "xyz"],
                                                             "entity string"), "k").collect()
    assert len(table) == 30 == len({r.surrogate for r in table}) and not {r.surrogate for r in table} & {r.entity for r in table}
    whole = surrogates.replace_pii(docs, "k")
    same = whole.join(docs.select("doc_id", F.col("text").alias("o")), "doc_id")
    assert same.where(~F.col("o").rlike(surrogates.ANY) & (F.col("o") != F.col("text"))).count() == 0
    assert same.where(F.col("o").rlike(surrogates.ANY) & (F.col("o") == F.col("text"))).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, u in ((1, 5), (10, 3), (1000, 10**6), (3000, 10)):
        v = np.sort(rng.integers(0, u, n))
        e = elias_fano.EliasFano.of(v)
        assert (e.get(np.arange(n)) == v).all()
        x, b = rng.integers(0, u + 3, 300), rng.integers(0, n, 300)
        end = np.minimum(n, b + rng.integers(0, n + 1, 300))
        want = [next((j for j in range(b[k], end[k]) if v[j] >= x[k]), end[k]) for k in range(300)]
        assert e.successor(x, b, end).tolist() == want


def test_language_model(spark, docs, edge, raw):
    rows = queries.op8_language_model(spark, SF).collect()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in raw}
    tokens = {i: brute.WORD.findall(brute.low(t)) + [""] for i, t in raw}
    c = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total = sum(c.values())
    for r in rows:
        w = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(c[x] > 0 for x in w), total)
        base = sum(math.log10((c[x] + 0.5) / (total + 0.5 * (len(c) + 1))) for x in w)
        assert abs(base - r.base_score) < 1e-6 * abs(base) and r.score < 0
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("op, label, part, out", [(queries.op2_quality_classifier, "quality", 3, 1),
                                                  (queries.op10_toxicity, "toxic", 4, 2)])
def test_classifiers(spark, labels, op, label, part, out):
    sf = "/root/testdata/sf0.01"
    got = op(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % part == out) and 0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == r[label] for r in held) > 0.88 * len(held)


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_classifiers_on_edge_rows(edge, labels, module, label):
    model = module.fit(edge, labels.limit(0), where=F.lit(True))
    assert module.score_documents(edge, model).where("score BETWEEN 0 AND 1").count() == edge.count()
    two = edge.sparkSession.createDataFrame([(1, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    assert module.score_documents(edge, module.fit(edge, two, where=F.lit(True))).count() == edge.count()


def test_pipeline(spark, raw):
    import corpus_pipeline

    names = ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "byte_level_bpe"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    rows = corpus_pipeline.run(spark, SF).collect()
    texts = dict(raw)
    prints = {r.doc_id: brute.fingerprint(texts[r.doc_id]) for r in rows}
    assert len(brute.components(prints)) == len(set(brute.components(prints).values())) == len(rows)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(20 * h < n or not h for n, h, _ in brute.contamination([r.text for r in rows], items))
    assert all(not brute.base_spans(r.text) and r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert all(brute.stats(r.text)[0] >= 45 for r in rows)
