"""Very long texts, in time that grows with their length; the tokenizer against the public library."""

import random
import sys
import time
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from tallyspark.llm import byte_bpe, secret_scan, simhash, surrogates  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


RNG = random.Random(5)
LONG = {"acgt": "".join(RNG.choices("acgt", k=100_000)), "letters": "".join(RNG.choices("abcdefghijklmnopqrstuvwxyzABCDEF", k=40_000)),
        "same": "a" * 5001, "kana": "ー" * 2001, "han": "漢字かな交じり文" * 700, "pairs": "-=" * 1500, "odd run": "-" * 4097,
        "mixed": "".join(RNG.choices("abéあ一\U0001f600", k=6000)), "spaces": " " * 3000 + "x"}


@pytest.mark.parametrize("name", LONG)
def test_long_words(codec, library, name):
    began = time.time()
    ids, edge, decoded = codec.encode(pa.array([LONG[name], "", "a b"]))
    assert ids[edge[0]:edge[1]].tolist() == library.encode_ordinary(LONG[name]) and edge[1] == edge[2]
    assert decoded[0].as_py().decode() == LONG[name]
    assert time.time() - began < 60


def test_seams_of_every_block_length(codec, library, monkeypatch):
    words = ["".join(RNG.choices("ethaonsr", k=n)) for n in range(1, 130, 7)] + ["ing" * 40, "the" * 50, "ü" * 90]
    for size in (3, 8, 20):
        monkeypatch.setattr(byte_bpe, "SHORT", size)
        fresh = byte_bpe.Codec(codec.ranks, public_tokenizers.PATTERN)
        ids = fresh.contract([w.encode() for w in words])
        for k, w in enumerate(words):
            assert ids.values[ids.edge[k]:ids.edge[k + 1]].tolist() == library.encode_ordinary(w), (size, w)


def test_digests_beside_columns_of_the_same_name(spark, edge):
    got = byte_bpe.encode_digests(edge.withColumn("n_tokens", F.lit("mine")), PATH, public_tokenizers.PATTERN)
    assert got.columns[-4:] == ["n_tokens", "_n_tokens", "ids_sha256", "decoded_sha256"] and got.where("n_tokens = 'mine'").count() == edge.count()
    assert byte_bpe.encode_digests(edge.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_surrogates_of_long_texts(spark):
    texts = ["a@" + "b." * 50_000, "x" * 1_000_000, "aZ0_-" * 200_000, "a.b" * 100_000 + "@c.de", "mail a.b@c.example.org, " * 2000,
             "x-a@b.co1 a@b.com.x1 (q@w.er)"]
    began = time.time()
    rows = surrogates.replace_pii(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "key").collect()
    assert time.time() - began < 120
    out = {r.doc_id: (r.text, dict(r.kinds)) for r in rows}
    assert all(out[i] == (texts[i], {}) for i in range(4))
    assert out[4][1] == {"email": 2000} and "a.b@c.example.org" not in out[4][0]
    assert out[5][1] == {"email": 3} and out[5][0].startswith("x-") is False or "a@b.co1" not in out[5][0]


def test_secrets_of_long_texts():
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc"
    began = time.time()
    texts = ["eyJ" * 350_000, "eyJ" * 5000 + ".eyJ.x" * 2000, "eyJ" * 40 + " " + token + " eyJ", "-----BEGIN PRIVATE KEY-----A:" * 20_000, token + "." + token]
    found = secret_scan.chunk_spans(pa.array(texts), secret_scan.keyword_automaton())
    assert time.time() - began < 30
    assert not found[0] and not found[3] and found[2] == [("jwt", 121, 121 + len(token))]
    assert [s for s in found[4] if s[0] == "jwt"] == [("jwt", 0, len(token)), ("jwt", len(token) + 1, 2 * len(token) + 1)]


def test_leaves_of_the_ball_find_every_near_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    x = np.concatenate([base, base ^ (np.uint64(1) << rng.integers(0, 21, 400).astype(np.uint64))])
    mask = simhash.block_masks(3)[0]
    levels = [(int(v), 10) for v in rng.integers(0, 2**63, 9)]
    row, leaf, home = simhash.leaves(x, mask, levels, 1)
    at = {}
    for r, l, h in zip(row.tolist(), leaf.tolist(), home.tolist()):
        at.setdefault(r, set()).add((l, h))
    assert max(len(v) for v in at.values()) <= 22 and all(sum(h for _, h in v) == 1 for v in at.values())
    for i in range(400):
        a, b = at[i], at[i + 400]
        homes = {l for l, h in a if h} | {l for l, h in b if h}
        assert any(l in {k for k, _ in a} and l in {k for k, _ in b} for l in homes)
