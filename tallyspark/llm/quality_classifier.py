"""Quality classifier (2): compression with zstandard dictionaries of good and of bad labelled texts.

A text is cut into blocks, each compressed alone with either dictionary, so that the dictionaries matter in
long texts as in short ones and all of a text counts. The difference of the compressed sizes over their sum is
the feature; logistic regression on labelled texts that the dictionaries have not seen makes it a probability.

The dictionaries come from at most ``PER_CLASS`` whole labelled texts of each class (documented bound), a
quarter of which calibrates. Two dictionaries of 64 kB are broadcast; scoring is one Arrow pass, no shuffle.

Defined results: null and empty texts have difference zero and get the calibrated score of that; with labels of
one kind only, or none, every score is the share of good labels (0.5 without any); other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyspark.llm.calibration import fit_logistic, labelled_texts, logistic
from tallyspark.llm.storage import release

#: Labelled texts of each class that the classifier is fitted on at most.
PER_CLASS = 2000
BLOCK, DICT_BYTES, LEVEL = 512, 64 << 10, 3


def blocks(text: bytes) -> list[bytes]:
    return [text[k : k + BLOCK] for k in range(0, len(text), BLOCK)]


def train_dictionary(texts: list[str]) -> bytes:
    """A dictionary for the blocks of the texts; few texts are used as they are."""
    parts = [b for t in texts for b in blocks(t.encode())]
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICT_BYTES:]


def compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in dictionaries:
        given = zstandard.ZstdCompressionDict(raw)
        given.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=given, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def difference(text: str | None, good, bad) -> float:
    """(bytes with the bad dictionary - bytes with the good one) / (their sum), over all blocks of a text."""
    parts = blocks((text or "").encode())
    g, b = sum([len(good.compress(p)) for p in parts]), sum([len(bad.compress(p)) for p in parts])
    return (b - g) / (g + b) if parts else 0.0


def fit(docs: DataFrame, labels: DataFrame, where: Column, label: str = "quality", per_class: int = PER_CLASS) -> dict:
    """The two dictionaries, and slope and intercept of the calibration."""
    rows, counts = labelled_texts(docs, labels, label, where, per_class)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 0.5) / (total + 1)
    seen = {0: 0, 1: 0}
    learn: dict[int, list[str]] = {0: [], 1: []}
    held: list[tuple[str, int]] = []
    for text, y in rows:
        seen[y] += 1
        if seen[y] % 4 == 0:
            held.append((text, y))
        else:
            learn[y].append(text)
    texts = {y: b"".join(t.encode() for t in learn[y]) for y in (0, 1)}
    if min(len(texts[0]), len(texts[1])) < 8 or len({y for _, y in held}) < 2:
        return {"dictionaries": None, "slope": 0.0, "intercept": float(np.log(prior / (1 - prior)))}
    dictionaries = (train_dictionary(learn[1]), train_dictionary(learn[0]))
    good, bad = compressors(dictionaries)
    x = np.array([[difference(t, good, bad)] for t, _ in held])
    y = np.array([y for _, y in held])
    # the sample is balanced; weights bring the classes back to their shares
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    coef, intercept = fit_logistic(x, y, weight)
    return {"dictionaries": dictionaries, "slope": float(coef[0]), "intercept": intercept}


def score(text: Column, model) -> Column:
    """Probability of label 1 by a broadcast model."""

    def compress(texts: pa.Array) -> pa.Array:
        m = model.value
        if m["dictionaries"] is None:
            d = np.zeros(len(texts))
        else:
            good, bad = compressors(m["dictionaries"])
            d = np.array([difference(t.as_py(), good, bad) for t in texts])
        release()
        return pa.array(logistic(m["slope"] * d + m["intercept"]), pa.float64())

    return arrow_udf(compress, "double")(text)


def score_documents(docs: DataFrame, model: dict, name: str = "score", text: str = "text") -> DataFrame:
    return docs.withColumn(name, score(F.col(text), docs.sparkSession.sparkContext.broadcast(model)))
