"""What the two convolutional classifiers share: labelled rows, all or a bounded sample, Adam, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded

#: A model is fitted on a sample of labelled rows: of each class at most so many documents, in the order of a hash of the
#: id, and no more of them once their texts come to CLASS_BYTES.  Texts are whole; the bounds keep the driver's memory.
PER_CLASS, CLASS_BYTES = 1500, 16 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> tuple[list[str], np.ndarray, np.ndarray, list[str | None]]:
    """Texts, labels, weights and languages of up to per_class documents of each class.

    A document labelled more than once counts by its greatest label, rows that
    share an id by the greatest text; null ids and labels do not count.  The weights restore the classes' shares among all
    rows that may be learned from.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & may_learn).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    shares = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in sorted(shares):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return [], np.empty(0), np.empty(0), []
    # picked has at most 2 * per_class rows
    some = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang")).join(F.broadcast(picked), "doc_id")
    some = some.groupBy("doc_id", "y").agg(F.max(F.struct("text", "lang")).alias("row")).select("doc_id", "y", "row.*")
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")) - F.octet_length("text")
    rows = some.withColumn("before", before).where(F.col("before") < class_bytes).collect()
    rows = sorted((r.doc_id, r.text, r.y, r.lang) for r in rows)
    y = np.array([r[2] for r in rows], np.float32)
    weight = np.array([shares[r[2]] / max(1, np.count_nonzero(y == r[2])) for r in rows], np.float32)
    return [r[1] for r in rows], y, weight / weight.mean() if len(rows) else weight, [r[3] or None for r in rows]


#: Up to so many labels, they are broadcast.
LABEL_ROWS = 250_000


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column) -> DataFrame:
    """All documents with a label that may be learned from, once each as in labelled_sample: doc_id, y, text, lang ("" of none)."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & may_learn).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    some = docs.where(may_learn).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    some = some.join(bounded(known, LABEL_ROWS), "doc_id")
    return some.groupBy("doc_id", "y").agg(F.max(F.struct("text", "lang")).alias("row")).select("doc_id", "y", "row.*")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            up = self.m[k] / (1 - 0.9**self.t)
            self.params[k] -= (self.rate * scale * up / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


#: Scores are computed with double precision and rounded to so many places: what else stands in a block does not show in them.
PLACES = 9


def doubled(params: dict[str, np.ndarray], *names: str) -> dict[str, np.ndarray]:
    """The parameters, those named in double precision."""
    return {k: v.astype(np.float64) if k in names else v for k, v in params.items()}


def segment_max(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(x, first, axis=0)
