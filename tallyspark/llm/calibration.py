"""Labelled rows bounded for the driver, and logistic calibration of a few score features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, where: Column, per_class: int):
    """Whole texts of at most ``per_class`` rows of each label in order of a hash of the id, and the numbers of
    labelled ids by label: ([(text, label)], {label: ids})."""
    d = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & where)
    d = d.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    counts = dict(d.groupBy("label").count().collect())
    pick = None
    for k in (0, 1):
        one = d.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        pick = one if pick is None else pick.unionByName(one)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.join(F.broadcast(pick), "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "label", text)
    got = rows.orderBy("h", "doc_id", "text").limit(2 * per_class).select("text", "label").collect()
    return [(r[0], r[1]) for r in got], counts


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton's method on standardised features; (coefficients, intercept)."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = weight / weight.sum() * len(weight)
    beta = np.zeros(z.shape[1])
    penalty = np.full(len(beta), ridge * len(x))
    penalty[-1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (w * (y - p)) - penalty * beta
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    coef = beta[:-1] / scale
    return coef, float(beta[-1] - (coef * mean).sum())


def logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))
