"""Quality rules (3): word statistics of whole texts and a learned decision list over them.

Sequential covering: while bad rows remain, a conjunction of threshold conditions is grown on two thirds of
the labelled statistics by information gain, pruned on the other third, and kept if it is precise there. The
rules become one ordered ``CASE WHEN`` of Spark columns; rows that no rule meets are kept.

The statistics of all rows are made in one Arrow pass next to the scan: no shuffle, and only the text column
goes to Python. The list is learned from at most ``max_rows`` labelled rows (in order of a hash of the id),
so the driver gets a bounded table of numbers.

Defined results: null text counts as empty; an empty text has no words and fails the base rules; without
labels of both kinds no rule is learned, and only the base rules reject; null or repeated ids and extra
columns stay as they are; several labels of one id count by their mean.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.storage import fresh, release
from tallyspark.llm.text import CHAR_START, NOT_SPACE, Words, chunks, per_doc

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punct",
         "n_digits", "n_distinct"]
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in STATS) + ">"

_b = np.arange(256)
_SYMBOL = np.isin(_b, list(b"#*$%&|<>"))
_UPPER = (_b >= 65) & (_b <= 90)
_DIGIT = (_b >= 48) & (_b <= 57)
_PUNCT = (_b > 32) & (_b < 127) & ~_UPPER & ~_DIGIT & ~((_b >= 97) & (_b <= 122))
_NOT_NEWLINE = _b != 10

#: Labelled rows that the list is learned from at most.
MAX_ROWS = 20_000
#: Text whose statistics are made together: they take some 60 bytes a byte of text.
STATS_BYTES = 1 << 20


def _narrow(key: np.ndarray) -> tuple[np.ndarray, int]:
    codes, distinct = pd.factorize(key)
    return codes.astype(np.int64), max(1, len(distinct))


def repeated_words(ids: np.ndarray, doc: np.ndarray, first: np.ndarray, n_docs: int, size: int = 3) -> np.ndarray:
    """Per document: words inside windows of ``size`` words that the document has twice or more."""
    n = len(ids)
    if n < size:
        return np.zeros(n_docs, np.int64)
    width = int(ids.max()) + 1
    key, at = ids[: n - size + 1], np.arange(n - size + 1)
    whole = doc[at] == doc[at + size - 1]
    for k in range(1, size):
        key = _narrow(key * width + ids[k : n - size + 1 + k])[0]
    twice = np.zeros(n, bool)
    rows = at[whole]
    both, _ = _narrow(key[rows] * n_docs + doc[rows])
    hit = rows[pd.Series(both).duplicated(keep=False).to_numpy()]
    for k in range(size):
        twice[hit + k] = True
    return per_doc(twice, first)


def chunk_stats(arr: pa.Array) -> dict[str, np.ndarray]:
    """The ``STATS`` of every text of a chunk."""
    words = Words(arr, NOT_SPACE, lower=False)
    ids, _ = words.ids()
    lines = Words(arr, _NOT_NEWLINE, lower=False)
    line_ids, _ = lines.ids()
    seen = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(words.mask, out=seen[1:])
    real = seen[lines.ends] > seen[lines.starts]
    again = pd.Series(line_ids * words.n_docs + lines.doc).duplicated().to_numpy() & real
    data, off = words.data, words.off
    distinct = pd.Series(ids * words.n_docs + words.doc).duplicated().to_numpy()
    return {
        "n_words": words.counts(),
        "word_chars": per_doc(words.mask & CHAR_START[data], off),
        "n_symbols": per_doc(_SYMBOL[data], off),
        "n_dup_lines": per_doc(again, lines.first),
        "n_repeat_words": repeated_words(ids, words.doc, words.first, words.n_docs),
        "n_lines": per_doc(real, lines.first),
        "n_upper": per_doc(_UPPER[data], off),
        "n_punct": per_doc(_PUNCT[data], off),
        "n_digits": per_doc(_DIGIT[data], off),
        "n_distinct": per_doc(~distinct, words.first),
    }


def _stats(text: pa.Array) -> pa.Array:
    parts = [chunk_stats(c) for c in chunks(text, STATS_BYTES)]
    release()
    cols = [np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64) for c in STATS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=STATS)


def text_stats(text: Column) -> Column:
    """The ``STATS`` of a text column, as a struct."""
    return arrow_udf(_stats, STATS_TYPE)(text)


#: What the conditions compare, from a struct of ``STATS``: amounts for each word, character or line.
RATIOS = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "punct_share": ("n_punct", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
}


def ratio(stats: Column, name: str) -> Column:
    top, bottom = RATIOS[name]
    value = stats[top].cast("double")
    return value if bottom is None else value / F.greatest(stats[bottom], F.lit(1)).cast("double")


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self, stats: Column) -> Column:
        c = ratio(stats, self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    m = np.ones(n, bool)
    for c in rule:
        m &= c.mask(x)
    return m


def _best_condition(x, bad, live) -> tuple[float, Condition | None]:
    """The condition with the most information gain over the live rows."""
    p0, n0 = int((bad & live).sum()), int((~bad & live).sum())
    start = math.log2(p0 / (p0 + n0)) if p0 else 0.0
    best: tuple[float, Condition | None] = (0.0, None)
    for name, values in x.items():
        v, y = values[live], bad[live]
        order = np.argsort(v, kind="stable")
        v, y = v[order], y[order]
        below = np.cumsum(y)
        cuts = np.flatnonzero(v[1:] != v[:-1])
        if not len(cuts):
            continue
        if len(cuts) > 256:
            cuts = cuts[np.linspace(0, len(cuts) - 1, 256).astype(int)]
        lo_p, lo_all = below[cuts], cuts + 1
        for above, p, total in ((False, lo_p, lo_all), (True, p0 - lo_p, p0 + n0 - lo_all)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - start), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                mid = float((v[cuts[k]] + v[cuts[k] + 1]) / 2)
                best = (float(gain[k]), Condition(name, above, float(f"{mid:.6g}")))
    return best


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, max_rules: int = 16,
                max_conditions: int = 4, min_cover: int = 5) -> list[Rule]:
    """Sequential covering: grow on two thirds, prune on one third, stop when a rule isn't precise enough."""
    n = len(bad)
    left, rules = np.ones(n, bool), []
    for turn in range(max_rules):
        held = (np.arange(n) + turn) % 3 == 0
        grow, test = left & ~held, left & held
        rule: Rule = ()
        live = grow.copy()
        while len(rule) < max_conditions and (live & ~bad).any() and (live & bad).any():
            _, c = _best_condition(x, bad, live)
            if c is None:
                break
            rule += (c,)
            live &= c.mask(x)

        def worth(r: Rule) -> float:
            m = _covered(r, x, n) & test
            p, q = int((m & bad).sum()), int((m & ~bad).sum())
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        m = _covered(rule, x, n) & left if rule else np.zeros(n, bool)
        t = m & test
        if m.sum() < min_cover or not t.any() or (bad & t).sum() < precision * t.sum() \
                or (bad & m).sum() < precision * m.sum():
            break
        rules.append(rule)
        left &= ~m
        if not (left & bad).any():
            break
    return rules


def labelled_sample(labels: DataFrame, label: str, max_rows: int, where: Column | None = None) -> DataFrame:
    """At most ``max_rows`` labelled ids by a hash of the id: (doc_id, label), one row for each id."""
    d = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    d = d if where is None else d.where(where)
    d = d.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    return d.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **options) -> list[Rule]:
    """Learn the list from at most ``max_rows`` labelled rows of ``docs`` (columns doc_id, text)."""
    sample = labelled_sample(labels, "quality", max_rows)
    stats = text_stats(F.col("text"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        F.xxhash64("doc_id").alias("h"), "doc_id", "label", stats.alias("s"))
    seen = rows.select("h", "doc_id", "label", *[ratio(F.col("s"), r).alias(r) for r in RATIOS],
                       base_failed(F.col("s")).alias("failed")).where("NOT failed")
    got = seen.orderBy("h", "doc_id", *RATIOS).limit(2 * max_rows).toPandas()
    if got.empty or got["label"].nunique() < 2:
        return []
    return learn_rules({r: got[r].to_numpy(float) for r in RATIOS}, (got["label"] == 0).to_numpy(), **options)


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The first rule that a row meets, as text; null where the row is kept."""
    out = F.when(base_failed(stats), F.lit("base"))
    for rule in rules:
        cond = rule[0].column(stats)
        for c in rule[1:]:
            cond = cond & c.column(stats)
        out = out.when(cond, F.lit(" AND ".join(map(str, rule))))
    return out


def apply_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with ``stats`` (struct) and ``rule`` (null: kept); the names get a prefix if ``docs`` has them."""
    s, r = fresh(docs, "stats", "rule")
    return docs.withColumn(s, text_stats(F.col(text))).withColumn(r, verdict(rules, F.col(s)))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    rules = fit_rules(docs, labels, max_rows)
    judged = apply_rules(docs, rules)
    return judged.where(F.col(judged.columns[-1]).isNull()).select(*docs.columns)
