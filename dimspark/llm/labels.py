"""Labelled documents for the trained operators, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import store


def fit_curve(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Platt's logistic calibration: smoothed targets, a small ridge,
    Newton steps halved until the loss falls."""
    yes, no = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.append(np.full(x.shape[1] - 1, 1e-2), 0)

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - target * z).sum() + (ridge * w * w).sum() / 2

    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + ridge * w
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(ridge + 1e-9), gradient)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        w, before = w - rate * step, now
        now = loss(w)
        if before - now < 1e-9:
            break
    return w


def sample_labels(labels: DataFrame, id_col: str, label_col: str, max_docs: int) -> DataFrame:
    """(id, label) of about max_docs labelled rows, drawn by a hash of the id."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    n = rows.count()
    if n > max_docs:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * max_docs / n))
    return rows


def labelled_texts(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, label) of the drawn rows; their number is bounded, so the
    label side is broadcast."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return store(docs.sparkSession, texts.join(F.broadcast(rows), "id"), "labelled")
