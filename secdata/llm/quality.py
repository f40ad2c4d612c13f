"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes the counts of its hashed three-byte windows (case and punctuation count: layout is what quality shows in), damped
by a logarithm, weighted by rarity, projected on the leading singular vectors of a labelled sample and scaled to length 1.
The vectors and labels of the sample are broadcast (``per_label`` bounds their number). The cosines of every document with all of them are exact matrix products, block
by block; the labels of the ``neighbours`` nearest, weighted by a power of the cosine, give the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from secdata.llm.labelled import sample
from secdata.llm.text import flat, pieces

_KINDS = np.arange(256, dtype=np.uint32)
_KINDS[48:58] = 48
_KINDS[128:] = 128
DIMS = 2048


def features(column: pa.Array) -> np.ndarray:
    """For each text, followed by three line ends, the damped counts of its hashed windows."""
    data, starts = flat(column, "\n\n\n")
    n = len(column)
    if len(data) < 3:
        return np.zeros((n, DIMS), np.float32)
    kind = _KINDS[data]
    code = (kind[:-2] << np.uint32(16)) | (kind[1:-1] << np.uint32(8)) | kind[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - 11)).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(starts))
    own = owner[:-2] == owner[2:]  # a window that reaches into the next text belongs to none
    return np.log1p(np.bincount(owner[:-2][own] * DIMS + bucket[own], minlength=n * DIMS).reshape(n, DIMS)).astype(np.float32)


class Voters:
    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int, neighbours: int, power: float):
        n = len(labels)
        self.neighbours, self.power = max(1, min(neighbours, n)), power
        self.prior = float(labels.mean()) if n else 0.5
        self.weight = np.log((1 + n) / (1 + (counts > 0).sum(0))) + 1
        self.middle = np.zeros(DIMS)
        self.axes = np.zeros((DIMS, 0))
        self.labels = labels.astype(np.float32)
        x = self._scaled(counts)
        self.middle = x.mean(0) if n else self.middle
        x = x - self.middle
        rank = min(rank, n)
        if rank:
            basis = np.random.default_rng(0).normal(size=(DIMS, rank + 8))
            for _ in range(4):  # subspace iteration
                basis, _ = np.linalg.qr(x.T @ (x @ basis))
            _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
            self.axes = (basis @ right.T)[:, :rank]
        self.vectors = self.vector(counts)

    def _scaled(self, counts: np.ndarray) -> np.ndarray:
        x = counts.astype(np.float64) * self.weight
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = (self._scaled(counts) - self.middle) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, column: pa.Array, block: int = 256) -> np.ndarray:
        """The weighted vote for each text, of the prior for texts without bytes or if nothing was labelled."""
        out = np.full(len(column), self.prior)
        empty = np.array([not t for t in column.to_pylist()], bool)
        for at in range(0, len(column), block):
            counts = features(column.slice(at, block))
            if not len(self.labels):
                break
            cosine = np.round(self.vector(counts) @ self.vectors.T, 9)
            # Ties go to the earlier labelled row, so that a score is the same in every batch.
            near = np.argpartition(np.arange(len(self.labels)) * (5e-10 / len(self.labels)) - cosine, self.neighbours - 1, axis=1)[:, : self.neighbours]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6) ** self.power
            out[at : at + block] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        out[empty] = self.prior
        return np.round(np.clip(out, 0, 1), 9)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_label: int = 1000, rank: int = 48, neighbours: int = 15, power: float = 4.0) -> Voters:
    rows = sample(docs, labels, label_col, per_label, id_col, text_col)

    def run(batches):
        for piece in pieces(batches, "text"):
            made = features(piece.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in made.astype(np.float16)], pa.binary()), piece.column("label")], names=["counts", "label"])

    got = rows.select("text", "label").mapInArrow(run, "counts binary, label int").toArrow()
    got = got.sort_by([("counts", "ascending"), ("label", "ascending")])  # the order of tasks must not matter
    counts = np.array([np.frombuffer(c, np.float16) for c in got["counts"].to_pylist()], np.float32).reshape(-1, DIMS)
    return Voters(counts, got["label"].to_numpy().astype(np.float32), rank, neighbours, power)


def score(docs: DataFrame, model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """All rows and columns of ``docs`` plus score (0 to 1) and predicted (1 from ``threshold`` on); columns of these names are replaced.

    Null and empty texts score what the model holds for no evidence. A score depends on the row's own text alone: texts of any length are read whole, repeated rows get
    equal scores, an empty table gives an empty result. ``model`` is anything with ``score(column)``.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in pieces(batches, text_col):
            made = shared.value.score(piece.column(text_col))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(made, pa.float64()), pa.array((made >= threshold).astype(np.int32))], names=[*piece.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
