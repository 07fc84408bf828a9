"""A bounded sample of labelled documents for the operators that fit a classifier."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.language_id import held_out

SAMPLE_DOCS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(text, label): at most `sample_docs` labelled ids that aren't held out, those with the smallest hash, and their documents.

    The sample has two numbers a row, so its size is bounded by the parameter and it can go to every executor; no text
    is shuffled. An id with several labels takes the largest; null labels and ids are left out.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "label")


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression of one feature, by Newton's method with a small ridge."""
    w = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, design.T @ (y - p) - 1e-3 * w), -5, 5)
    return float(w[0]), float(w[1])
