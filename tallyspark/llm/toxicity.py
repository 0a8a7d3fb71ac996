"""Toxicity (10): class-conditional Kneser-Ney bigram models, toxic against ordinary.

Each class has discounted bigram counts over words (lower-cased A-Z, cut at ASCII white space) and Kneser-Ney
continuation counts as unigrams. The discounts are estimated from the counts, for each class and level, and are
below one, so every word and bigram of the sample keeps a part of its own; what they take away goes to the lower
level, at the end to a distribution that the classes share. The log-likelihoods are normalised by length: over the whole text, and over its windows of a few lengths, of which the most toxic one of each length
counts, since a few words make a long text toxic. Logistic
regression on labelled texts that the models have not seen turns these means into a probability.

The models come from at most ``PER_CLASS`` whole labelled texts of each class (documented bound), a third of
which calibrates; all their bigrams are kept. Repeated texts count once. Scoring is one Arrow pass, no shuffle.

Defined results: null and empty texts have log-likelihood ratio zero and get the calibrated score of that; with
labels of one kind only, or none, every score is the share of toxic labels (0 without any); other columns stay.
"""

from __future__ import annotations

from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.calibration import fit_logistic, labelled_texts, logistic
from tallyspark.llm.storage import release
from tallyspark.llm.text import NOT_SPACE, Words, chunks

#: Labelled texts of each class that the models are fitted on at most.
PER_CLASS = 2500
#: The window lengths.
WINDOWS = (1, 4, 16, 64)


def discount(counts: np.ndarray) -> float:
    """Kneser-Ney discount n1 / (n1 + 2 n2) of a level's counts; half a type more of each keeps it inside (0, 1)."""
    one, two = (counts == 1).sum() + 0.5, (counts == 2).sum() + 0.5
    return one / (one + 2 * two)


def _pairs(words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous word (-1 at a text's start) and word."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[words.first[:-1][words.counts() > 0]] = -1
    return before, ids


def reliability(toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Probability that an entry's rate differs between the classes, given its counts in both.

    Equal rates give binomial counts at the classes' shares, different ones any split alike; the share of
    entries that differ is estimated by EM."""
    pairs, place, n = np.unique(np.stack([toxic, ordinary]), axis=1, return_inverse=True, return_counts=True)
    t, o = pairs
    share = np.clip(toxic.sum() / max(1.0, toxic.sum() + ordinary.sum()), 1e-9, 1 - 1e-9)
    ways = np.array([lgamma(a + b + 1) - lgamma(a + 1) - lgamma(b + 1) for a, b in zip(t, o)])
    odds = np.exp(np.minimum(-np.log(t + o + 1) - ways - t * np.log(share) - o * np.log(1 - share), 700))
    differ = 0.1
    for _ in range(100):
        s = differ * odds / (differ * odds + 1 - differ)
        differ = float(np.clip((s * n).sum() / max(1, n.sum()), 1e-9, 1 - 1e-9))
    return s[place.reshape(-1)]


def fit_models(texts: list[str], toxic: np.ndarray) -> dict:
    """Both models over one vocabulary; the last unigram entry stands for unseen words."""
    words = Words(pa.array(texts, pa.large_string()), NOT_SPACE, lower=True)
    ids, names = words.ids()
    size = len(names)
    before, after = _pairs(words, ids)
    label = toxic[words.doc]
    model = {"words": names.to_pylist(), "classes": []}
    key = (before + 1) * (size + 1) + after
    # bigrams count by distinct words before them, unigrams by distinct bigrams: copies of a text add nothing
    found, pair = np.unique(key, return_inverse=True)
    head = np.where(before >= 0, np.append(-1, pair[:-1]), -1) if len(key) else key
    counts = []
    for y in (1, 0):
        triples = np.unique((head[label == y] + 1) * (size + 1) + after[label == y])
        wide = np.append(-1, found)[triples // (size + 1)]
        # the middle word of a triple is the last one of its first bigram; a text's start has context 0
        middle = np.where(wide >= 0, wide % (size + 1) + 1, 0)
        mine, count = np.unique(middle * (size + 1) + triples % (size + 1), return_counts=True)
        own = np.zeros(len(found))
        own[np.searchsorted(found, mine)] = count
        counts.append((own, np.bincount(mine % (size + 1), minlength=size + 1).astype(float)))
    model["key"] = found
    model["trust"] = reliability(counts[0][0], counts[1][0])
    # a word that no class has says nothing
    model["trust_word"] = np.append(reliability(counts[0][1][:size], counts[1][1][:size]), 0.0)
    # the shared back-off has what the classes give away: the discounts, and one for unseen words
    rare = [discount(continuation) for _, continuation in counts]
    shared = sum(np.minimum(continuation, d) for d, (_, continuation) in zip(rare, counts))
    shared[size] = 1.0
    shared /= shared.sum()
    context = found // (size + 1)
    for d, (own, continuation) in zip(rare, counts):
        p = np.maximum(continuation - d, 0) / max(1.0, continuation.sum())
        p += (1 - p.sum()) * shared
        of_context = np.maximum(np.bincount(context, weights=own, minlength=size + 1), 1)
        direct = np.maximum(own - discount(own), 0) / of_context[context] if len(own) else own
        back = 1 - np.bincount(context, weights=direct, minlength=size + 1)
        model["classes"].append({"p": p, "back": np.append(back, 1.0), "direct": direct})
    return model


def ratios(words: Words, model: dict, vocabulary: pa.Array) -> np.ndarray:
    """log p(word | toxic) - log p(word | ordinary) of every word, each level as far as its counts can be trusted."""
    ids, names = words.ids()
    size = len(vocabulary)
    known = pc.index_in(names, value_set=vocabulary).fill_null(size).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = known[ids]
    before, after = _pairs(words, ids)
    # context 0 is a text's start, an unseen word as context has no counts
    context = np.where(before == size, size + 1, before + 1)
    key = np.where((after < size) & (context <= size), context * (size + 1) + after, -1)
    hit = np.zeros(len(key), bool)
    at = np.zeros(len(key), np.int64)
    if len(model["key"]):
        at = np.minimum(np.searchsorted(model["key"], key), len(model["key"]) - 1)
        hit = model["key"][at] == key
    toxic, ordinary = model["classes"]
    out = model["trust_word"][after] * np.log(toxic["p"] / ordinary["p"])[after]
    at, context, after = at[hit], context[hit], after[hit]
    pair = [np.log(c["direct"][at] + c["back"][context] * c["p"][after]) for c in (toxic, ordinary)]
    trust = model["trust"][at]
    out[hit] = trust * (pair[0] - pair[1]) + (1 - trust) * out[hit]
    return out


def features(arr: pa.Array, model: dict, vocabulary: pa.Array) -> np.ndarray:
    """Mean ratio of each text of a chunk, of its most toxic windows, and the log length."""
    words = Words(arr, NOT_SPACE, lower=True)
    out = np.zeros((words.n_docs, len(WINDOWS) + 2))
    n = words.counts()
    live = np.flatnonzero(n)
    if not len(live):
        return out
    r = ratios(words, model, vocabulary)
    total = np.concatenate([[0.0], np.cumsum(r)])
    first, last = words.first[:-1], words.first[1:]
    out[live, 0] = (total[last[live]] - total[first[live]]) / n[live]
    out[live, 1] = np.log(n[live])
    at = np.arange(len(r))
    for k, window in enumerate(WINDOWS, 2):
        end = np.minimum(at + window, last[words.doc])
        start = np.minimum(at, np.maximum(end - window, first[words.doc]))
        out[live, k] = np.maximum.reduceat((total[end] - total[start]) / (end - start), first[live])
    return out


def fit(docs: DataFrame, labels: DataFrame, where: Column, label: str = "toxic", per_class: int = PER_CLASS) -> dict:
    """The models and the calibration of their features."""
    rows, counts = labelled_texts(docs, labels, label, where, per_class)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    rows = list(dict.fromkeys(rows))
    y = np.array([r[1] for r in rows], int)
    nth = np.empty(len(y), int)
    for k in (0, 1):
        nth[y == k] = np.arange((y == k).sum())
    held = nth % 3 == 2
    if len(np.unique(y[held])) < 2:
        return {"prior": prior, "model": None}
    texts = np.array([r[0] for r in rows], object)
    model = fit_models(list(texts[~held]), y[~held])
    vocabulary = pa.array(model["words"], pa.large_binary())
    x = np.concatenate([features(c, model, vocabulary) for c in chunks(pa.array(list(texts[held]), pa.large_string()))])
    weight = np.where(y[held] == 1, counts[1] / (y[held] == 1).sum(), counts[0] / (y[held] == 0).sum())
    coef, intercept = fit_logistic(x, y[held], weight)
    return {"prior": prior, "model": model, "coef": coef, "intercept": intercept}


def score(text: Column, fitted) -> Column:
    """Probability of label 1 by a broadcast fit."""

    def compare(texts: pa.Array) -> pa.Array:
        f = fitted.value
        if f["model"] is None:
            return pa.array(np.full(len(texts), f["prior"]), pa.float64())
        vocabulary = pa.array(f["model"]["words"], pa.large_binary())
        parts = [logistic(features(c, f["model"], vocabulary) @ f["coef"] + f["intercept"]) for c in chunks(texts)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return arrow_udf(compare, "double")(text)


def score_documents(docs: DataFrame, fitted: dict, name: str = "score", text: str = "text") -> DataFrame:
    return docs.withColumn(name, score(F.col(text), docs.sparkSession.sparkContext.broadcast(fitted)))
