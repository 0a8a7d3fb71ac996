"""The registered forms, column by column, against plain versions on the small tables."""

import hashlib
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers
import tiktoken

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from tallyspark.llm import byte_bpe, queries, quality_rules, secret_scan  # noqa: E402

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(spark, raw):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i: w for (i, _), w in zip(raw, brute.contamination([t for _, t in raw], items))}
    for r in queries.op1_decontamination(spark, SF).collect():
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(found), sha(",".join(found)), hit > 0 and 20 * hit >= n)


def test_op3_applies_its_rules_in_order(spark, docs, labels, raw):
    rules = quality_rules.fit_rules(docs.select("doc_id", "text"), labels)
    texts = dict(raw)
    got = queries.op3_quality_rules(spark, SF).collect()
    assert len(got) == len(raw)
    for r in got:
        s = brute.stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
        assert r.base_failed == (s[0] < 50 or 100 * s[4] > 50 * s[0])
        assert r.kept == (r.rule is None) and (r.kept is False or not r.base_failed)
    assert rules and len({r.rule for r in got}) > 2


def test_op4(spark, raw):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = dict(raw)
    for r in queries.op4_byte_bpe(spark, SF).collect():
        ids = t.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r.doc_id] or ""))


def test_op5_hides_what_an_independent_reading_finds(spark, raw):
    """E-mail addresses, numbers and titled names of the texts are gone, one surrogate for one entity, format kept."""
    texts = dict(raw)
    email = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
    card = re.compile(r"(?<![\w.-])(?:\d{4}[ -]){3}\d{4}(?![\w-])")
    of, back = {}, {}
    n = 0
    for r in queries.op5_surrogates(spark, SF).collect():
        before = texts[r.doc_id] or ""
        for pattern in (email, card):
            old, new = pattern.findall(before), pattern.findall(r.text or "")
            assert len(old) == len(new) and not set(map(str.lower, old)) & set(map(str.lower, new))
            for a, b in zip(old, new):
                n += 1
                key, value = re.sub(r"[ -]", "", a.lower()) if pattern is card else a.lower(), re.sub(r"[ -]", "", b.lower()) if pattern is card else b.lower()
                assert of.setdefault(key, value) == value and back.setdefault(value, key) == key
                assert [len(x) for x in re.split(r"[ -]", a)] == [len(x) for x in re.split(r"[ -]", b)] or pattern is email
    assert n >= 5


def test_op6_has_one_law(spark, raw):
    got = {r.doc_id: r for r in queries.op6_sharding(spark, SF).collect()}
    texts = dict(raw)
    total = Counter()
    slots: dict[int, list[int]] = {}
    for i, r in got.items():
        data = (texts[i] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None) and 0 <= r.shard < 16
        total[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(raw) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in got.values())
    mean = sum(total.values()) / 16
    assert max(total.values()) <= mean + largest and min(total.values()) >= mean - 2 * largest


def test_op7(spark, raw):
    texts = dict(raw)
    for r in queries.op7_secret_scan(spark, SF).collect():
        base = brute.base_spans(texts[r.doc_id])
        count = Counter(k for k, _, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(count[k] for k in secret_scan.BASE_KINDS)
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert [s for s in spans if s[0] in secret_scan.BASE_KINDS] == [[k, str(a), str(b)] for k, a, b in base]
        assert [int(s[1]) for s in spans] == sorted(int(s[1]) for s in spans)
