"""Bounded samples of labelled documents, and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Documents with this remainder of crc32(doc_id as text) are never learned from.
FOLDS, HELD_OUT = 5, 0


def held_out(column: str = "doc_id"):
    """Whether a document belongs to the fold that is never learned from."""
    digest = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(digest % FOLDS == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(label, fit, text): texts of at most `rows` labelled documents, written once.

    The documents with the least hashes of their ids are taken, so the choice does not depend
    on the order of the tables; `fit` marks three of four, the others are for calibration.
    Labels of the held-out fold, missing ids and missing labels do not count; of several
    labels for one document the largest does.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                           & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("labelled"))
             .agg(F.max(label).cast("int").alias("label")))
    order = F.xxhash64("labelled")
    chosen = known.orderBy(order, "labelled").limit(rows)
    # At most `rows` ids: small enough to send to every task.
    texts = docs.select(F.col("doc_id").cast("long").alias("labelled"),
                        F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "labelled")
    return stage(joined.select("label", (F.pmod(order, F.lit(4)) != 0).alias("fit"), "text",
                               "labelled")
                 .repartition(8, "labelled").drop("labelled"), "sample")


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic model with a constant (last), by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
