"""What the two trained scorers share: labelled samples, Adam, calibration."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import lean

#: Labelled rows that a model is fitted on: at most so many of each class, with
#: texts of at most so many bytes. Bounds what the task that trains holds. Scores
#: cover every row and the whole of every text.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 1 << 16


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def _sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, text_bytes: int) -> tuple[DataFrame | None, dict[int, int]]:
    """(doc_id, text, label of a sample, one row an id; labelled ids by class)."""
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("label"))
    totals = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [own.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in sorted(totals)]
    if not parts:
        return None, totals
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    return (docs.select("doc_id", "text").filter(F.octet_length("text") <= text_bytes)
            .join(F.broadcast(chosen), "doc_id")  # of at most rows rows a class
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))), totals


def _weighed(found: pa.Table | None, totals: dict[int, int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(texts, labels, weights) of the sample's rows."""
    if found is None or not len(found):
        return pa.array([], pa.string()), np.zeros(0), np.zeros(0)
    found = found.combine_chunks()
    y = found.column("label").to_numpy().astype(np.float64)
    seen = {c: max(1, int((y == c).sum())) for c in totals}
    weight = np.array([totals[c] / seen[c] for c in y])
    return found.column("text").combine_chunks(), y, weight / max(1e-9, weight.mean())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS,
                    text_bytes: int = SAMPLE_BYTES) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(texts, labels, weights) of a sample of labelled documents.

    Of each class the ``rows`` ids with the smallest hash are taken, so the
    sample does not depend on how tables are split. A document with several
    labels has the largest. Weights restore the classes' shares.
    """
    found, totals = _sample(docs, labels, label, rows, text_bytes)
    return _weighed(None if found is None else found.orderBy(F.xxhash64("doc_id"), "doc_id")
                    .select("text", "label").toArrow(), totals)


def trained(docs: DataFrame, labels: DataFrame, label: str, train: Callable, empty: Callable):
    """What ``train`` makes of the labelled sample, in a task: the driver gets
    the model's attributes alone, which fill the one that ``empty`` makes."""
    found, totals = _sample(docs, labels, label, SAMPLE_ROWS, SAMPLE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows := [b for b in batches if len(b)]:
            model = train(*_weighed(pa.Table.from_batches(rows), totals))
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(vars(model))], pa.binary())})

    made = None
    if found is not None:
        # The same order whatever the partitions before: one task has all rows.
        made = (found.select(F.xxhash64("doc_id").alias("place"), "doc_id", "text", "label").repartition(1)
                .sortWithinPartitions("place", "doc_id").select("text", "label").mapInArrow(lean(run), "model binary").first())
    if made is None:
        return train(*_weighed(None, totals))
    model = empty()
    vars(model).update(pickle.loads(made["model"]))
    return model


class Adam:
    """In-place Adam over a dictionary of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.params[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(a, b) of the weighted logistic fit of y on a * logit + b, by Newton."""
    a, b = 1.0, 0.0
    x = np.stack([logit, np.ones_like(logit)])
    for _ in range(steps):
        p = sigmoid(a * logit + b)
        grad = x @ (weight * (p - y)) + 1e-3 * np.array([a - 1, b])
        curve = (x * (weight * p * (1 - p))) @ x.T + np.eye(2) * 1e-3
        move = np.linalg.solve(curve, grad)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -2, 2)
    return float(a), float(b)


def batches_of(n: int, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    order = rng.permutation(n)
    for lo in range(0, n, size):
        yield order[lo:lo + size]


def sum_by(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by index."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(index):
        order = np.argsort(index, kind="stable")
        cuts = np.flatnonzero(np.diff(index[order], prepend=-1))
        out[index[order][cuts]] = np.add.reduceat(values[order], cuts, axis=0)
    return out
