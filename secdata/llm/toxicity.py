"""Toxicity with a factorization machine over hashed terms.

A term is a word or a word's first four, five or six bytes (inflected forms share them); it counts as present or absent. Terms are hashed to
``1 << BITS`` buckets. The machine is w0 + sum w[i] + sum over pairs <v[i], v[j]>, so two terms that mean little alone, such as an insult's and a group's, can
decide together. Features are the most frequent buckets of a labelled sample whatever their lean, since a term that says nothing alone may decide in a pair, and
those that lean most to a label (by a z score); the others are 0.

Fitting reads a bounded sample (``per_label`` rows for each label). Counts of terms are summed by Spark; the sample's features, a few hundred
numbers a row, are collected and the machine is fitted with Adam on the driver. How many features there are is decided on a part of the sample that the trial isn't fitted on. A
toxic row weighs ``weight`` times a clean one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secdata.llm.labelled import sample
from secdata.llm.quality import score  # noqa: F401  the same scoring pass serves both classifiers
from secdata.llm.text import WORD_BYTES, Words, mix, pieces

BITS = 20
_CUTS = (4, 5, 6)


def terms(column: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, bucket) pairs; with ``only`` (a number for each bucket, -1 for none) the numbers instead."""
    words = Words(column, WORD_BYTES)
    owner = words.owners()
    end = words.end
    found = []
    for i, cut in enumerate((None, *_CUTS)):
        long = np.ones(len(end), bool) if cut is None else end - words.begin >= cut
        words.end = end if cut is None else np.minimum(end, words.begin + cut)
        bucket = (mix(words.hashes() + np.uint64(i)) >> np.uint64(64 - BITS)).astype(np.int64)
        who = owner[long]
        bucket = bucket[long]
        if only is not None:
            bucket = only[bucket]
            who, bucket = who[bucket >= 0], bucket[bucket >= 0]
        found.append((who.astype(np.int64) << BITS) | bucket)
    words.end = end
    both = np.unique(np.concatenate(found))
    return both >> BITS, both & ((1 << BITS) - 1)


class Machine:
    def __init__(self, buckets: np.ndarray, rank: int = 4):
        self.number = np.full(1 << BITS, -1, np.int32)
        self.number[buckets] = np.arange(len(buckets))
        self.bias, self.w = 0.0, np.zeros(len(buckets))
        self.v = np.random.default_rng(0).normal(0, 0.02, (len(buckets), rank))

    def margin(self, owner: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value for n rows, and the summed factors."""
        total = np.stack([np.bincount(owner, self.v[term, f], n) for f in range(self.v.shape[1])], 1)
        square = np.stack([np.bincount(owner, self.v[term, f] ** 2, n) for f in range(self.v.shape[1])], 1)
        return self.bias + np.bincount(owner, self.w[term], n) + 0.5 * (total**2 - square).sum(1), total

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, epochs: int, weight: float = 3.0, batch: int = 256, rate: float = 0.02, decay: float = 3e-4) -> None:
        rng = np.random.default_rng(1)
        state = [np.zeros(1), self.w, self.v]
        first, second = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                pick = order[at : at + batch]
                sizes = np.array([len(rows[i]) for i in pick])
                owner, term = np.repeat(np.arange(len(pick)), sizes), np.concatenate([rows[i] for i in pick]).astype(np.int64)
                z, total = self.margin(owner, term, len(pick))
                slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) * np.where(labels[pick] > 0, weight, 1.0) / len(pick)
                gw = np.bincount(term, slope[owner], len(self.w))
                gv = np.stack([np.bincount(term, slope[owner] * (total[owner, f] - self.v[term, f]), len(self.w)) for f in range(self.v.shape[1])], 1)
                step += 1
                for k, (x, g) in enumerate(zip(state, (np.array([slope.sum()]), gw + decay * self.w, gv + 10 * decay * self.v), strict=True)):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    x -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.bias = float(state[0][0])

    def score(self, column: pa.Array) -> np.ndarray:
        owner, term = terms(column, self.number)
        z, _ = self.margin(owner, term, len(column))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Numbers of features that are tried, passes for a trial, and the part of the sample that judges it.
SIZES, TRIAL_EPOCHS, JUDGES = (128, 512, 2048), 12, 5


def _chosen(rows: list[np.ndarray], labels: np.ndarray, order: list[np.ndarray], weight: float = 3.0) -> int:
    """Which of ``order`` (features by number, nested or not) has the least loss on every ``JUDGES``-th row, fitted on the others. The more features the fewer rows each has to learn from."""
    judge = np.arange(len(rows)) % JUDGES == 0
    if not len(order) > 1 or len(set(labels[judge])) < 2 or len(set(labels[~judge])) < 2:
        return 0
    losses = []
    for features in order:
        machine = Machine(features)
        mine = [machine.number[r][machine.number[r] >= 0] for r in rows]
        machine.fit([mine[i] for i in np.flatnonzero(~judge)], labels[~judge], TRIAL_EPOCHS, weight)
        held = [mine[i] for i in np.flatnonzero(judge)]
        owner, term = np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate(held).astype(np.int64)
        z = np.clip(machine.margin(owner, term, len(held))[0], -30, 30)
        y = labels[judge]
        losses.append(float((np.where(y > 0, weight, 1.0) * np.log1p(np.exp(np.where(y > 0, -z, z)))).sum()))
    return int(np.argmin(losses))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_label: int = 4000, sizes: tuple[int, ...] = SIZES, least_z: float = 4.0, epochs: int = 40) -> Machine:
    """The number of features is one of ``sizes``, chosen by the loss on a part of the sample; half of them at most are chosen by lean (``least_z`` or more), the others by frequency.

    Labels other than 0 and 1 are skipped; repeated rows, and an id with both labels, count as they stand. Without labelled rows of both kinds the machine is constant: 0.5, or near the only label.
    """
    rows = sample(docs, labels, label_col, per_label, id_col, text_col).select("text", "label")

    def count(batches):
        for piece in pieces(batches, "text"):
            owner, bucket = terms(piece.column("text"))
            label = piece.column("label").to_numpy(zero_copy_only=False)[owner]
            both, n = np.unique(bucket * 2 + label, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both >> 1), pa.array(np.where(both & 1, n, 0)), pa.array(np.where(both & 1, 0, n))], names=["bucket", "bad", "good"])

    found = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    p, q = max(1, found.get(1, 0)), max(1, found.get(0, 0))
    sums = rows.mapInArrow(count, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rate = (F.col("bad") + F.col("good")) / F.lit(p + q)
    z = F.abs(F.col("bad") / p - F.col("good") / q) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-9)) * F.lit(1 / p + 1 / q))
    seen = sums.where("bad + good >= 3").select("bucket", z.alias("z"), (F.col("bad") / p + F.col("good") / q).alias("often"))
    leaning = [r[0] for r in seen.where(F.col("z") >= least_z).orderBy(F.desc("z"), "bucket").limit(max(sizes) // 2).collect()]
    frequent = [r[0] for r in seen.orderBy(F.desc("often"), "bucket").limit(max(sizes)).collect()]
    order = []
    for size in sizes:
        first = dict.fromkeys(leaning[: size // 2])
        order.append(np.array(sorted([*first, *[b for b in frequent if b not in first][: size - len(first)]]), np.int64))
    every = np.array(sorted(set().union(*order)), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(Machine(every).number)

    def number(batches):
        for piece in pieces(batches, "text"):
            owner, term = terms(piece.column("text"), shared.value)
            ends = np.cumsum(np.bincount(owner, minlength=piece.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int32).tobytes() for x in np.split(term, ends[:-1])], pa.binary()), piece.column("label")], names=["terms", "label"])

    got = rows.mapInArrow(number, "terms binary, label int").toArrow().sort_by([("terms", "ascending"), ("label", "ascending")])
    if not got.num_rows:
        return Machine(order[0])
    known = [every[np.frombuffer(t, np.int32)] for t in got["terms"].to_pylist()]
    target = got["label"].to_numpy().astype(float)
    machine = Machine(order[_chosen(known, target, order)])
    machine.fit([machine.number[k][machine.number[k] >= 0] for k in known], target, epochs)
    return machine
