"""Licence scan: ordered signature rules behind a keyword prefilter; overlapping detections are resolved by priority and containment.

A text's words are hashed all together and looked up among the keywords of all rules. A rule is tried only on texts that hold all of its keywords, so
most texts meet no regular expression. Detections are intervals of words. They are taken by level, longer ones first, then earlier ones, then by the order of the rules; one
that lies within an interval taken before is suppressed. Phrases of the level ``BASE`` are never suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.llm.license_rules import BASE, BASE_WEIGHT, WEIGHT, Rule, rules
from secdata.llm.text import WORD_BYTES, Words, pieces

Found = tuple[int, int, int]  # first word, end word, number of the rule


class Scanner:
    def __init__(self, table: Sequence[Rule] | None = None):
        self.rules = list(rules() if table is None else table)
        self.patterns = [re.compile(rb"(?<![^ ])(?:" + r.pattern.encode() + rb")(?![^ ])") for r in self.rules]
        groups = [[g.split("/") for g in r.need.split()] for r in self.rules]
        words = sorted({w for gs in groups for g in gs for w in g})
        place = {w: i for i, w in enumerate(words)}
        hashes = Words(pa.array(words, pa.string()), WORD_BYTES).hashes() if words else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.word = hashes[order], order
        # A rule's rarest-looking keyword group leads to it; all of its groups must be there.
        self.groups = [[frozenset(place[w] for w in g) for g in gs] for gs in groups]
        many = np.zeros(len(words), np.int64)
        for gs in self.groups:
            for w in frozenset().union(*gs):
                many[w] += 1
        self.led: dict[int, list[int]] = {}
        for k, gs in enumerate(self.groups):
            for w in min(gs, key=lambda g: sum(many[w] for w in g), default=()):
                self.led.setdefault(w, []).append(k)

    def open_rules(self, words: Words) -> dict[int, list[int]]:
        """For each text with any, the rules whose keywords it holds, in order."""
        if not len(words) or not len(self.hashes):
            return {}
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        row = np.searchsorted(words.first, hit, "right") - 1
        both = np.unique(row * len(self.word) + self.word[at[hit]])
        made = {}
        for r, held in _by_row(both // len(self.word), both % len(self.word)):
            have = frozenset(held.tolist())
            ks = {k for w in have for k in self.led.get(w, ()) if all(g & have for g in self.groups[k])}
            if ks:
                made[r] = sorted(ks)
        return made

    def detect(self, column: pa.Array) -> tuple[Words, dict[int, list[Found]]]:
        """The words, and each text's detections by any open rule, before suppression."""
        words = Words(column, WORD_BYTES)
        opened = self.open_rules(words)
        found: dict[int, list[Found]] = {}
        for row, ks in opened.items():
            lo, hi = words.first[row], words.first[row + 1]
            begin, end = words.begin[lo:hi], words.end[lo:hi]
            # The words with one space after each; the first byte of word i is at starts[i].
            starts = np.cumsum(end - begin + 1) - (end - begin + 1)
            keep = words.inside[begin[0] : end[-1] + 1].copy()
            keep[1:] |= keep[:-1].copy()
            data = words.data[begin[0] : end[-1] + 1][keep]
            text = np.where(data == 0, 32, data).astype(np.uint8).tobytes()
            some = [(m.start(), m.end(), k) for k in ks for m in self.patterns[k].finditer(text)]
            if some:
                a, b, k = (np.array(x) for x in zip(*some, strict=True))
                found[row] = list(zip(np.searchsorted(starts, a).tolist(), np.searchsorted(starts, b).tolist(), k.tolist(), strict=True))
        return words, found

    def settle(self, found: list[Found]) -> list[Found]:
        """The detections that stay, by first word."""
        base = [x for x in found if self.rules[x[2]].level == BASE]
        others = sorted((x for x in found if self.rules[x[2]].level != BASE), key=lambda x: (self.rules[x[2]].level, x[0] - x[1], x[0], x[2]))
        starts = sorted({x[0] for x in others})
        place = {s: i + 1 for i, s in enumerate(starts)}
        furthest = [0] * (len(starts) + 1)  # a tree of largest ends over starts: an interval that holds another begins no later and ends no earlier
        kept = []
        for x in others:
            i, most = place[x[0]], 0
            while i:
                most = max(most, furthest[i])
                i &= i - 1
            if most >= x[1]:
                continue
            kept.append(x)
            i = place[x[0]]
            while i < len(furthest):
                furthest[i] = max(furthest[i], x[1])
                i += i & -i
        return sorted(base + kept)

    def score(self, kept: list[Found]) -> float:
        """How sure it is that the text states a licence: each rule counts once, as independent evidence."""
        doubt = 1.0
        for k in sorted({k for _, _, k in kept}):
            doubt *= 1 - (BASE_WEIGHT if self.rules[k].level == BASE else WEIGHT[self.rules[k].level])
        return round(1 - doubt, 9)


def _by_row(rows: np.ndarray, values: np.ndarray):
    if not len(rows):
        return
    edges = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    for a, b in zip(edges, [*edges[1:], len(rows)], strict=True):
        yield int(rows[a]), values[a:b]


DETECTION = T.StructType([T.StructField("label", T.StringType()), T.StructField("rule", T.IntegerType()), T.StructField("base", T.BooleanType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])


def scan(docs: DataFrame, text_col: str = "text", table: Sequence[Rule] | None = None) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_words``, ``detections`` (label, number of the rule, whether it is a base phrase, first word and end word; by first word)
    and ``license_score`` (0 to 1; 0 without detections); columns of these names are replaced.

    Null and empty texts have no words and no detections. Texts of any length are scanned whole; repeated rows get equal results; ties between rules go to the earlier one; an empty table gives an
    empty result. Words are compared in lower case (A to Z only), whatever stands between them.
    """
    names = ["n_words", "detections", "license_score"]
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(list(rules() if table is None else table))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.ArrayType(DETECTION)), T.StructField(names[2], T.DoubleType())])
    kind = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("base", pa.bool_()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = Scanner(shared.value)
        for piece in pieces(batches, text_col):
            words, found = scanner.detect(piece.column(text_col))
            kept = [scanner.settle(found[r]) if r in found else [] for r in range(piece.num_rows)]
            told = [[{"label": scanner.rules[k].label, "rule": k, "base": scanner.rules[k].level == BASE, "begin": a, "end": b} for a, b, k in some] for some in kept]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(words.counts.astype(np.int64)), pa.array(told, kind), pa.array([scanner.score(k) for k in kept], pa.float64())], names=[*piece.schema.names, *names])

    return docs.mapInArrow(run, schema)


def digest(scanned: DataFrame) -> list[F.Column]:
    """Of ``scan``'s rows: n_words, n_base (places of base phrases), first_word and last_word (smallest and largest start of these), base_labels and labels (distinct, sorted, comma-joined), score."""
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["begin"])
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    return [F.col("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("detections")).alias("labels"), F.col("license_score").alias("score")]
