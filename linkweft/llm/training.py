"""Labelled rows for fitting, and the calibration of margins to probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm.frames import unseen


def sample_labels(labels: DataFrame, target: str, limit: int) -> DataFrame:
    """(doc_id, label) of at most `limit` training rows: those with the least hash of their id.

    Held-out rows, rows without id or label, and ids with two different labels are left
    out.  The sample does not depend on the partitions.  It has `limit` rows of 12 bytes
    at most, which bounds what a broadcast of it costs.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~unseen(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def training_texts(docs: DataFrame, labels: DataFrame, target: str, limit: int) -> DataFrame:
    """(doc_id, label, text) of the sampled rows; the texts are not moved."""
    sample = sample_labels(labels, target, limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def platt(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of the logistic curve through held-back margins (Newton steps).

    Targets are smoothed by the class sizes, so that separable margins keep a finite slope.
    """
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margins + b)
        d, v = p - goal, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(d * margins).sum() + 1e-3 * a, d.sum()])
        hess = np.array([[(v * margins * margins).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-6)), float(b)
