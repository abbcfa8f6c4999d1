"""Bounded samples of labelled rows for fitting classifiers, and score calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.llm.tokens import held_out


def usable_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y) of the learning folds: 0/1 labels; ids with conflicting labels are left out."""
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    return (known.groupBy("doc_id").agg(F.min(column).alias("y"), F.max(column).alias("__y"))
            .where("y = __y").select("doc_id", F.col("y").cast("int").alias("y")))


def sample_ids(labels: DataFrame, column: str, most: int, per_class: bool = False) -> DataFrame:
    """At most ``most`` labelled ids (of each class if ``per_class``), smallest hash first."""
    rows = usable_labels(labels, column)
    order = [F.xxhash64("doc_id"), "doc_id"]
    if not per_class:
        return rows.orderBy(*order).limit(most)
    return (rows.where("y = 0").orderBy(*order).limit(most)
            .union(rows.where("y = 1").orderBy(*order).limit(most)))


def sampled_docs(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents of the sample (its size is bounded by ``sample_ids``, so it is broadcast)."""
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b), by Newton steps on the smoothed log loss; a > 0."""
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    w = np.ones(len(y)) if weight is None else weight
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.std(margin)), 1e-9)
    m = margin / scale
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(theta[0] * m + theta[1])
        g = np.array([np.sum(w * (p - target) * m), np.sum(w * (p - target))]) + 1e-3 * np.array([theta[0], 0])
        s = w * p * (1 - p)
        hess = np.array([[np.sum(s * m * m), np.sum(s * m)], [np.sum(s * m), np.sum(s)]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-12))
        theta -= step
        if np.abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 1e-3) / scale, float(theta[1])
