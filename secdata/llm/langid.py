"""Language identification with bit-sliced Bloom filters over byte n-grams.

Each language has a set of n-grams that are typical of it. One table holds the Bloom filters of all languages, sliced by
bit: slot i is a mask with bit l set if the filter of language l has bit i. The masks at an n-gram's k slots, ANDed, name all languages that
contain it, in k reads however many languages there are. A document's per-language popcounts are corrected for the filters' false-positive
rates (fill ** k), and the largest decides; the score is its share of the sum.

Fitting reads at most about ``fit_docs`` documents of each language (chosen by a hash of the id; all if there are fewer) and keeps at most
``grams`` n-grams of each: both bound the model, not the rows that are classified.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.llm.text import byte_table, flat, mix, pieces

_LETTERS = byte_table(lambda b: 97 <= b <= 122 or b >= 128)
_LETTER = re.compile(r"[^\W\d_]")
SIZES = (3, 4)
HASHES = 2


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, n-gram) for all windows of 3 and 4 bytes of the lower-cased letters, with one blank around words.

    An n-gram is its bytes as a number. Windows inside blanks, or that start with none of a word's bytes, are left out.
    """
    data, starts = flat(pc.utf8_lower(column.cast(pa.large_string())))
    data = _LETTERS[data]
    solid = data != 0
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # one blank after each word
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))[keep]
    text = data[keep].astype(np.uint32)
    if not len(text):
        return np.zeros(0, np.int32), np.zeros(0, np.uint32)
    text = np.concatenate(([0], text)).astype(np.uint32)  # the blank before the first word
    owner = np.concatenate((owner[:1], owner))
    found = []
    for n in SIZES:
        if len(text) < n:
            continue
        code = np.zeros(len(text) - n + 1, np.uint32)
        for j in range(n):
            code = (code << np.uint32(8)) | text[j : j + len(code)]
        inner = text[1 : 1 + len(code)] != 0
        at = owner[n - 1 :]
        inner &= at == owner[1 : 1 + len(code)]
        found.append((at[inner], code[inner] if n == 4 else code[inner] | np.uint32(0xFF000000)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int32), np.zeros(0, np.uint32))


def _slots(code: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(code.astype(np.uint64) + np.uint64(1))
    return [(h >> np.uint64(i * 32 + 32 - bits)) & np.uint64((1 << bits) - 1) for i in range(HASHES)]


class Filters:
    """The sliced table, the languages by bit, and each filter's false-positive rate."""

    def __init__(self, sets: dict[str, np.ndarray], usual: str | None):
        self.langs, self.usual = sorted(sets), usual
        most = max([len(x) for x in sets.values()] + [1])
        self.bits = max(12, int(8 * most).bit_length())
        self.table = np.zeros((-(-max(1, len(sets)) // 64), 1 << self.bits), np.uint64)
        self.wrong = np.zeros(len(sets))
        for i, lang in enumerate(self.langs):
            for slot in _slots(sets[lang], self.bits):
                self.table[i // 64][slot.astype(np.int64)] |= np.uint64(1 << (i % 64))
            self.wrong[i] = ((self.table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() ** HASHES
        if len(sets) <= 8:
            self.table = self.table.astype(np.uint8)

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, corrected count for each text and language)."""
        owner, code = grams(column)
        n = len(column)
        total = np.bincount(owner, minlength=n).astype(float)
        slots = [s.astype(np.int64) for s in _slots(code, self.bits)]
        seen = np.zeros((n, len(self.langs)))
        for at, word in enumerate(self.table):
            mask = word[slots[0]]
            for s in slots[1:]:
                mask = mask & word[s]
            for i in range(64 * at, min(64 * at + 64, len(self.langs))):
                on = (mask >> mask.dtype.type(i - 64 * at)) & mask.dtype.type(1)
                seen[:, i] = np.bincount(owner, on, n)
        return total, np.maximum(0, seen - total[:, None] * self.wrong) / (1 - np.minimum(self.wrong, 0.99))

    def decide(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text: ``und`` and 0 without letters; the usual language where no n-gram is known."""
        _, right = self.counts(column)
        share = right.sum(1)
        best = right.argmax(1) if len(self.langs) else np.zeros(len(column), int)
        top = right[np.arange(len(column)), best] if len(self.langs) else np.zeros(len(column))
        score = np.where(share > 0, top / np.where(share > 0, share, 1), 0.0)
        names = []
        for i, text in enumerate(column.to_pylist()):
            letters = text is not None and _LETTER.search(text)
            if not letters or not self.langs:
                score[i] = 0.0
            names.append("und" if not letters or not self.langs else self.langs[best[i]] if share[i] > 0 else self.usual)
        return names, score


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def out():
        for lang, codes in held.items():
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for piece in pieces(batches, "text"):
        owner, code = grams(piece.column("text"))
        langs = np.array(piece.column("lang").to_pylist(), object)
        for lang in set(langs):
            held.setdefault(lang, []).append(code[(langs == lang)[owner]])
        size += len(code)
        if size > 1 << 22:
            yield from out()
            size = 0
    yield from out()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", fit_docs: int = 4000, n_grams: int = 6000, typical: float = 0.4) -> Filters:
    """Learns the filters from ``docs``. An n-gram is typical of a language if the language's relative frequency of it is at least
    ``typical`` times the sum over languages; the ``n_grams`` most frequent typical ones are kept. Rows without text or language are skipped.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    langs = [(r[0], r[1]) for r in sizes.orderBy(F.desc("rows"), "lang").collect()]
    if not langs:
        return Filters({}, None)
    limit = F.create_map(*[x for lang, n in langs for x in (F.lit(lang), F.lit(min(1.0, fit_docs / n)))])
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.element_at(limit, F.col("lang")) * (1 << 20))
    counts = chosen.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = counts.join(F.broadcast(counts.groupBy("lang").agg(F.sum("n").alias("total"))), "lang").withColumn("f", F.col("n") / F.col("total"))
    typical_of = share.join(share.groupBy("gram").agg(F.sum("f").alias("sum")), "gram").where(F.col("f") >= F.lit(typical) * F.col("sum"))
    ranked = typical_of.groupBy("lang").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("f", "gram")))), 1, n_grams).alias("best"))
    return Filters({r["lang"]: np.array([g["gram"] for g in r["best"]], np.uint32) for r in ranked.collect()}, langs[0][0])


def predict(docs: DataFrame, model: Filters, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus the language and its score in two more columns (columns of these names are replaced).

    A null text, or one without letters, is ``und`` with score 0; so is every text if no row was labelled. Ties go to the first language in alphabetical order. Texts of any
    length are read whole; repeated rows get equal results; an empty table gives an empty result.
    """
    docs = docs.drop(lang_out, score_out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in pieces(batches, text_col):
            names, score = shared.value.decide(piece.column(text_col))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(names, pa.string()), pa.array(score)], names=[*piece.schema.names, lang_out, score_out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]))
