r"""Secret scans (7): Aho-Corasick keyword prefilter, anchored patterns near hits, checksum validation.

One automaton over all keywords reads a chunk of lower-cased texts; only where it reports a keyword is the
pattern of that keyword tried, anchored at the hit. Runs of hex digits have no keyword; their prefilter is the
run length over the bytes. Kinds with an embedded checksum (access tokens with a base-62 CRC32, signed tokens
whose header must decode) are kept only if it holds; the base kinds stay in any case.

Kinds, in order: assign (name = value, value of 8 or more characters), access (AKIA..., 16 or more), hex
(32 or more), github, npm, jwt, pem. Spans are in code points, end exclusive, leftmost and non-overlapping
within a kind (a value that is too short still takes its place).

One Arrow pass beside the scan, no shuffle. Defined results: null and empty texts have no spans; repeated rows
get equal spans; other columns stay as they are.
"""

from __future__ import annotations

import base64
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.storage import fresh, release
from tallyspark.llm.text import LOWER, Words, chunks, code_points, flat

KINDS = ["assign", "access", "hex", "github", "npm", "jwt", "pem"]
BASE_KINDS = KINDS[:3]
SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"

_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Keywords (lower case) of each kind but hex.
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "jwt": ["eyj"],
    "pem": ["-----begin "],
}

PATTERNS = {
    "assign": re.compile(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    # header lines ("Name: value", up to 32 of 200 characters) may stand before the body; possessive, as no part can
    # match otherwise
    "pem": re.compile(r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?)-----\s*+"
                      r"(?:[A-Za-z][A-Za-z0-9-]{0,60}+:[^\n]{0,200}+\n\s*+){0,32}+[A-Za-z0-9+/=\s]*+-----END \1-----"),
}

#: A signed token: its header is the end of a run of base-64 characters; payload and signature follow.
_RUN, _REST = re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
#: Longest header of a signed token.
HEADER = 4096


def base62_crc(body: str) -> str:
    """CRC32 of ``body`` as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def _json_object(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except ValueError:
        return False


def valid(kind: str, m: re.Match) -> bool:
    """Length rules of the base kinds, checksum rules of the others."""
    if kind == "assign":
        return len(m[1]) >= 8
    if kind == "access":
        return len(m[0]) >= 16
    if kind in ("github", "npm"):
        return base62_crc(m[1][:30]) == m[1][30:]
    return True


def signed_tokens(text: str, starts: list[int]):
    """(start, end) of the signed tokens that begin at some of the sorted starts.

    A run is read once for all starts inside it, and what follows it once; so long runs of starts cost no more.
    """
    done, end, rest = 0, -1, None
    for start in starts:
        if start < done:
            continue
        if start >= end:
            m, rest = _RUN.match(text, start), None
            if m is None:
                continue
            end = m.end()
        if not 4 <= end - start <= HEADER or not text.startswith(".", end) or not text.startswith("eyJ", start) \
                or not _json_object(text[start:end]):
            continue
        if rest is None:
            m = _REST.match(text, end)
            rest = m.end() if m and _json_object(m[1]) else 0
        if rest:
            yield start, rest
            done = rest


def keyword_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def chunk_spans(arr: pa.Array, automaton) -> list[list[tuple[str, int, int]]]:
    """Spans of every text of a chunk, by start, then kind as listed."""
    raw, off = flat(arr)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(arr))]
    if not len(raw):
        return out
    chars, doc_chars = code_points(raw, off)
    hits: dict[tuple[int, str], list[int]] = {}
    for end, (kind, size) in automaton.iter(LOWER[raw].tobytes().decode()):
        start = end - size + 1
        d = int(np.searchsorted(doc_chars, start, "right")) - 1
        if end < doc_chars[d + 1]:
            hits.setdefault((d, kind), []).append(start - int(doc_chars[d]))
    for (d, kind), starts in hits.items():
        text, done = arr[d].as_py(), 0
        if kind == "jwt":
            out[d] += [(kind, *span) for span in signed_tokens(text, sorted(starts))]
            continue
        for start in sorted(starts):
            if start >= done and (m := PATTERNS[kind].match(text, start)):
                # a failed checksum does not take the place of a later match
                if ok := valid(kind, m):
                    out[d].append((kind, start, m.end()))
                done = m.end() if ok or kind in BASE_KINDS else done
    runs = Words(arr, _HEX, lower=False)
    long = np.flatnonzero(runs.ends - runs.starts >= 32)
    for k in long.tolist():
        d = int(runs.doc[k])
        out[d].append(("hex", int(chars[runs.starts[k]] - doc_chars[d]), int(chars[runs.ends[k]] - doc_chars[d])))
    for spans in out:
        if len(spans) > 1:
            spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _spans(texts: pa.Array) -> pa.Array:
    automaton = keyword_automaton()
    rows = [spans for c in chunks(texts) for spans in chunk_spans(c, automaton)]
    release()
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in rows], _SPANS_ARROW)


def secret_spans(text: Column) -> Column:
    """Kind, start and end of every secret of a text column."""
    return arrow_udf(_spans, SPANS_TYPE)(text)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``spans``: kind, start and end of every secret."""
    (name,) = fresh(docs, "spans")
    return docs.withColumn(name, secret_spans(F.col(text)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each secret replaced; overlapping spans are replaced once."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        new = s["start"] >= acc["at"]
        gap = F.substr(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        parts = F.when(new, F.concat(acc["parts"], F.array(gap, F.lit(mark)))).otherwise(acc["parts"])
        return F.struct(parts.alias("parts"), F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc):
        rest = F.substr(text, (acc["at"] + 1).cast("int"), F.char_length(text))
        return F.concat_ws("", acc["parts"], F.array(rest))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced and ``n_chars`` counted again where a text changed."""
    found = scan(docs)
    spans = F.col(found.columns[-1])
    out = found.withColumn("text", redacted(F.col("text"), spans))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
