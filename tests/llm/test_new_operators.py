"""Collocations (11), binary output (12) and alignment (13) against plain versions, and on edge rows."""

import hashlib
import io
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from tallyspark.llm import alignment, automata, binary_output, collocations, oracles, pieces, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b   c", "x\n\n y \t z  ", "▁under▁ score", "a　b  c", "<|endoftext|> x <s> <0x41>", "\x00 \x1c q",
       "word " * 300, "acgt" * 20_000, "ß" * 3000 + " 漢字かな交じり文 \U0001f600\U0001f600 " + "é", "a<|endoftext|>b", " lead", "trail ", "tab\t tab"]


# ---------------------------------------------------------------- 11

def plain_collocations(rows, max_words, least, share, top):
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in count.items():
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in cand.items():
            if any(len(t) > len(g) and 100 * b >= share * a and any(t[i:i + len(g)] == g for i in range(len(t) - len(g) + 1))
                   for t, b in cand.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for i, (score, a, g, left, right) in enumerate(sorted(found)[:top]):
            out.add((lang, i + 1, g.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("max_words, least, share, top, range_bytes, shard_bytes",
                         [(3, 2, 50, 2000, 300, 500), (4, 2, 70, 20, 150, 200), (2, 3, 50, 5, 1 << 20, 1 << 20)])
def test_collocations(spark, max_words, least, share, top, range_bytes, shard_bytes):
    rng = np.random.default_rng(max_words)
    words = ["the", "of", "Über", "a", "b", "x\x01", "New", "York", "\U0001f600", "zz"]
    rows = [(str(rng.choice(["en", "de"])), " ".join(rng.choice(words, 30, p=[.3, .2, .1, .1, .1, .05, .05, .05, .03, .02])) + ". New York\tcity!")
            for _ in range(60)]
    rows += [(None, "a b a b a b"), ("und", "a b, a\nb a b"), ("en", None), ("en", ""), (None, None), ("", "a b a b a b a b"), ("de", "x " * 400)]
    docs = spark.createDataFrame([(i, t, la, "s") for i, (la, t) in enumerate(rows)], "doc_id long, text string, lang string, rank string").repartition(4)
    got = collocations.collocations(docs, max_words=max_words, least=least, share=share, top=top, range_bytes=range_bytes, shard_bytes=shard_bytes)
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, max_words, least, share, top)


def test_collocations_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duck.sql(oracles.OP11_COLLOCATIONS)
    got = queries.QUERIES["op11_collocations"](spark, SF)
    assert got.columns == want.columns
    assert {tuple(r) for r in got.collect()} == set(want.fetchall())


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits():
    names, _ = automata.sorted_names([pa.array([b"a", b"b", b"en"], pa.large_binary())])
    big = 3_000_000_019
    rows = np.array([[2, -1, -1], [2, 0, -1], [2, 1, -1], [2, 0, 1]])
    paths, _ = automata.of_rows(names, rows, np.array([9 * big, big + 7, big + 1, big]))
    c = collocations.Candidates(paths)
    found = np.concatenate([paths.levels[d][2][x] for d, x in enumerate(automata.compose(paths, c.asked))])
    (row,) = collocations._best(c, found, np.zeros(1, np.int64), 50, 10)
    assert row == ("en", "a b", big, big + 7, big + 1, 9 * big, 1_000_000 * big * big // ((big + 7) * (big + 1)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"ab", b"b", b"\xff", b"", b"c"]), min_size=1, max_size=4), max_size=60),
       st.lists(st.lists(st.sampled_from([b"a", b"ab", b"b", b"\xff", b"0", b"z"]), min_size=1, max_size=4), max_size=4))
def test_automata_keep_sequences(seqs, cuts):
    symbols, _ = automata.sorted_names([pa.array([b"a", b"ab", b"b", b"\xff", b"", b"c"], pa.large_binary())])
    of = {n: i for i, n in enumerate(symbols.to_pylist())}

    def paths_of(some):
        rows = np.array([[*[of[x] for x in s], *[-1] * (4 - len(s))] for s in some], np.int64).reshape(-1, 4)
        return automata.of_rows(symbols, rows, np.ones(len(some), np.int64))[0]

    def counted(paths):
        out, names = Counter(), paths.names.to_pylist()
        for d in range(len(paths.levels)):
            nodes = np.flatnonzero(paths.levels[d][2])
            for row, w in zip(automata.rows_of(paths, d, nodes, 4).tolist(), paths.levels[d][2][nodes].tolist()):
                out[tuple(names[s] for s in row if s >= 0)] += w
        return out

    want = Counter(tuple(s) for s in seqs)
    half = [automata.unpack(automata.pack(paths_of(x))) for x in (seqs[::2], seqs[1::2])]
    whole = automata.union(half)
    assert counted(whole) == want
    splitters = sorted({tuple(c) for c in cuts})
    spread = Counter()
    for r, (begin, end) in enumerate(automata.ranges(whole, [list(c) for c in splitters])):
        cell = counted(automata.unpack(automata.pack(whole.slice(begin, end))))
        assert all(sum(c <= s for c in splitters) == r for s in cell)
        spread += cell
    assert spread == want
    asked = paths_of(seqs[::3])
    for d, found in enumerate(automata.compose(whole, asked)):
        need = asked.levels[d][2] > 0
        assert (found[need] >= 0).all()


# ---------------------------------------------------------------- 12

def test_binary_output_equals_the_library(spark, docs, edge):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None)]
    both = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    t = Tokenizer.from_file(A_PATH)
    manifest = binary_output.write_documents(both, A_PATH, end_id=2, file_bytes_target=40_000)
    assert manifest.count() > 3
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in binary_output.digests(manifest).collect()}
    start, ids_of = 0, {}
    for i, x in sorted(rows):
        ids_of[i] = t.encode(x or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids_of[i]), zlib.crc32(np.array(ids_of[i], "<u4").tobytes())), (i, (x or "")[:40])
        start += len(ids_of[i])
    assert len(got) == len(rows)
    wanted = spark.createDataFrame([(3,), (10_009,), (10_009,), (5,), (99_999,), (None,)], "doc_id long")
    picked = {r.doc_id: r.ids for r in binary_output.pick_documents(manifest, wanted).collect()}
    assert picked == {i: ids_of[i] for i in (3, 5, 10_009)}


def test_files_are_plain_zstandard_and_only_wanted_frames_are_read(spark):
    manifest = binary_output.write_documents(spark.createDataFrame([(2, "b b b"), (1, "a"), (None, "n")], "doc_id long, text string"), A_PATH)
    (row,) = manifest.collect()
    data = Path(row.file.replace("file:", "").replace("//", "/", 1) if row.file.startswith("file:") else row.file).read_bytes()
    t = Tokenizer.from_file(A_PATH)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    ids = [t.encode(x, add_special_tokens=False).ids for x in ("n", "a", "b b b")]
    assert np.frombuffer(whole, "<u2").tolist() == sum(ids, [])

    class Counting(io.BytesIO):
        places = []

        def read(self, n=-1):
            self.places.append((self.tell(), n))
            return super().read(n)

    file = Counting(data)
    reader = binary_output.Reader(file)
    file.places.clear()
    assert reader.ids(2).tolist() == ids[2] and file.places == [(int(reader.edge[2]), int(reader.seek["compressed"][2]))]
    broken = bytearray(data)
    broken[int(reader.edge[2]) - 1] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        binary_output.Reader(io.BytesIO(bytes(broken))).ids(1)
    with pytest.raises(ValueError):
        binary_output.Reader(io.BytesIO(data[:-1]))


class Counted:
    """A tokenizer that counts the texts given to it."""

    def __init__(self, tokenizer):
        self.own, self.texts = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.own, name)

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **more)


def test_pieces_are_encoded_together_with_the_ids_of_each():
    words = [f"{w}{k}" for k in range(400) for w in ("word", "漢字", "\u00a0x\u00a0", "a\n", "\x1c", "<|endoftext|>", "don't ")]
    names = pieces.Pieces(pa.array([*ODD, " ".join(words), "", "first " + " ".join(reversed(words))]), strip=False).names
    t = Counted(Tokenizer.from_file(A_PATH))
    want = [t.own.encode(x.decode(), add_special_tokens=False).ids for x in names.to_pylist()]
    size = pieces.token_bytes(t)
    for step in (1, 50, 16 << 10):
        t.texts = 0
        got = pieces.joined_ids(t, size, names, step)
        assert [got.values[a:b].tolist() for a, b in zip(got.edge[:-1], got.edge[1:])] == want
    assert t.texts < len(names) / 4
    # where the bytes of the ids do not tell whose they are, pieces are encoded one by one
    got = pieces.joined_ids(t, size * 0, names)
    assert [got.values[a:b].tolist() for a, b in zip(got.edge[:-1], got.edge[1:])] == want
    got = pieces.joined_ids(t, size, names.slice(0, 0))
    assert len(got) == 0 and not len(got.values)


def test_encoder_of_tasks_gives_the_library_few_texts(spark, monkeypatch):
    import tokenizers

    made = []

    class Loaded:
        @staticmethod
        def from_str(content):
            made.append(Counted(Tokenizer.from_str(content)))
            return made[-1]

    encoder = binary_output.Encoder(spark, A_PATH)
    encoder.name = "token ids of this test"
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "false")
    monkeypatch.setattr(tokenizers, "Tokenizer", Loaded)
    texts = [" ".join(f"number{k}" for k in range(i, i + 300)) for i in range(0, 3000, 300)]
    got = encoder.in_task()(pa.array(texts, pa.large_string()))
    want = [made[0].own.encode(x, add_special_tokens=False).ids for x in texts]
    assert [got.values[a:b].tolist() for a, b in zip(got.edge[:-1], got.edge[1:])] == want
    assert made[0].texts < 100


def test_binary_output_of_edge_rows(spark, edge):
    manifest = binary_output.write_documents(edge, A_PATH)
    got = Counter((r.doc_id, r.n_tokens == 0) for r in binary_output.digests(manifest).collect())
    assert got == Counter([(1, False), (2, True), (None, True), (3, True), (4, False), (4, False), (5, False), (6, False), (7, False)])
    assert binary_output.digests(binary_output.write_documents(edge.limit(0), A_PATH)).count() == 0


def test_repeated_ids_spread_over_files(spark):
    same = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    manifest = binary_output.write_documents(same, A_PATH, end_id=0, file_bytes_target=6000)
    rows = [r.rows for r in manifest.collect()]
    assert sum(rows) == 400 and len(rows) > 2 and max(rows) < 300
    assert binary_output.pick_documents(manifest, same.limit(1)).count() == 400


# ---------------------------------------------------------------- 13

def plain_alignment(rows):
    t, sp = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    t.encode_special_tokens = True
    chars = alignment._byte_of_char()
    a_bytes = {i: bytes(chars[c] for c in k) for k, i in t.get_vocab().items() if all(c in chars for c in k)}

    def b_bytes(i):
        return bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    out, pairs, count = [], [], Counter()
    for text in rows:
        own, want = Counter(), (0, 0, 0, 0, "")
        if text:
            a, b, raw = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text), (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) == raw == b"".join(map(b_bytes, b)):
                ends_a, ends_b = np.cumsum([len(a_bytes[i]) for i in a]), np.cumsum([len(b_bytes(i)) for i in b])
                groups, i, j = [], 0, 0
                for c in np.intersect1d(ends_a, ends_b):
                    x, y = np.searchsorted(ends_a, c, "right"), np.searchsorted(ends_b, c, "right")
                    groups.append((a[i:x], b[j:y]))
                    i, j = x, y
                for x, y in groups:
                    own.update((p, q) for p in x for q in y)
                text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
                want = (len(a), len(b), len(groups), sum(own.values()), hashlib.sha256(text_of.encode()).hexdigest())
        out.append(want)
        pairs.append(own)
        count.update(own.keys())
    best = defaultdict(int)
    for (a, _), c in count.items():
        best[a] = max(best[a], c)
    return [(*w[:4], sum(m for k, m in p.items() if count[k] == best[k[0]]), sum(m * count[k] for k, m in p.items()), w[4])
            for w, p in zip(out, pairs)]


@pytest.mark.parametrize("chunk, block", [(alignment.TEXT_BYTES, alignment.PAIRS), (20_000, 50)])
def test_alignment(spark, docs, monkeypatch, chunk, block):
    monkeypatch.setattr(alignment, "TEXT_BYTES", chunk)
    monkeypatch.setattr(alignment, "PAIRS", block)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()][:80]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(5000, None), (None, "null id"), (None, "null id")]
    both = spark.createDataFrame([(i, t, f"x{i}") for i, t in rows], "doc_id long, text string, chunk string").repartition(3)
    got = alignment.align_documents(both, A_PATH, B_PATH)
    assert got.columns == ["doc_id", "chunk", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter((i, f"x{i}", *w) for (i, _), w in zip(rows, plain_alignment([t for _, t in rows])))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_alignment_of_edge_rows(spark, edge):
    got = alignment.align_documents(edge, A_PATH, B_PATH)
    assert got.columns[:2] == ["doc_id", "spans"]
    assert Counter((r.doc_id, r.groups_sha256 == "") for r in got.collect()) == Counter(
        [(1, False), (2, True), (None, True), (3, True), (4, False), (4, False), (5, False), (6, False), (7, False)])
    assert alignment.align_documents(edge.limit(0), A_PATH, B_PATH).count() == 0
    clash = edge.withColumn("n_a", F.lit(1)).withColumn("K", F.lit(2))
    assert alignment.align_documents(clash, A_PATH, B_PATH).where("n_a = 1 AND k = 2 AND _n_a >= 0").count() == edge.count()


# ---------------------------------------------------------------- pieces

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab '  \t\n 　é漢▁<|>s1!")), max_size=30), min_size=1, max_size=4))
def test_pieces_have_the_tokens_of_their_texts(texts):
    t, sp = _tokenizers()
    p = pieces.Pieces(pa.array(texts), strip=False)
    names = p.names.cast(pa.large_string()).to_pylist()
    for k, text in enumerate(texts):
        own = [names[c] for c in p.codes[p.first[k]:p.first[k + 1]]]
        assert "".join(own) == text
        assert sum((t.encode(x, add_special_tokens=False).ids for x in own), []) == t.encode(text, add_special_tokens=False).ids
    p = pieces.Pieces(pa.array(texts), strip=True)
    names = p.names.cast(pa.large_string()).to_pylist()
    for k, text in enumerate(texts):
        own = [names[c] for c in p.codes[p.first[k]:p.first[k + 1]]]
        assert "".join(f" {x}" for x in own) == (f" {text}" if text else "")
        assert "▁" in text or sum((sp.encode(x) for x in own), []) == sp.encode(text)
        whole = t.encode(f" {text}", add_special_tokens=False).ids if text else []
        assert sum((t.encode(f" {x}", add_special_tokens=False).ids for x in own), []) == whole


_kept = []


def _tokenizers():
    if not _kept:
        _kept.extend([Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)])
    return _kept
