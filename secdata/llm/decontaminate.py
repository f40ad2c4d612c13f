"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The symbols are words. Windows of equal length form one pattern set, so that a short item doesn't shorten the skips of the long
ones. For a set of windows of m words and blocks of B = min(2, m) words:

* the shift table tells, for the block that ends at a text position, how far the search may move on without
  missing a window (m - B + 1 words if no window has the block);
* where the shift is 0, the block's bucket of the suffix table lists the windows that end with it, and the hash of their first
  block thins them out;
* the bytes of the remaining windows are compared with the text, so every reported occurrence is a real one.

All positions of a piece of input are searched together: each run of 64 positions has a cursor, and a step moves all cursors.

The benchmark reaches the tasks as broadcast tables of at most ``block_bytes`` of text; a larger benchmark is split by item
into as many blocks, each searched in a pass of its own over rows that carry what was found so far; between passes these are written to the shared folder, so a task holds one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secdata.llm.shared import release, settle
from secdata.llm.text import WORD_BYTES, Words, mix, pieces, ranges

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RUN = 64
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class WindowSet:
    """The tables for distinct windows of ``m`` words, each given as its words joined by spaces."""

    def __init__(self, m: int, windows: list[bytes], items: list[list[int]]):
        self.m, self.block = m, min(2, m)
        words = Words(pa.array([w.decode() for w in windows], pa.string()), WORD_BYTES)
        hashes = words.hashes()
        first = words.first[:-1]
        bits = max(16, int(4 * m * len(windows)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, m - self.block + 1, np.uint8 if m < 255 else np.int64)
        for j in range(self.block - 1, m):
            np.minimum.at(self.shift, (self.blocks(hashes, first + j) & self.mask).astype(np.int64), m - 1 - j)
        suffix = self.blocks(hashes, first + m - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.prefix = suffix[order], self.blocks(hashes, first + self.block - 1)[order]
        texts = [windows[i] + b" " for i in order]
        self.length = np.array([len(t) for t in texts], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.items = [items[i] for i in order]

    def blocks(self, hashes: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of the block whose last word is at ``end``."""
        h = hashes[end]
        return mix(h if self.block == 1 else h * _A + hashes[end - 1] * _B)

    def search(self, words: Words, hashes: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of all occurrences. text: the words with one space after each; at: where each word begins there."""
        first, last = words.first[:-1] + self.m - 1, words.first[1:]
        runs = np.maximum(0, -(-(last - first) // _RUN))
        start = np.repeat(first, runs) + ranges(np.zeros(len(runs), np.int64), runs) * _RUN
        stop = np.minimum(start + _RUN, np.repeat(last, runs))
        ends, blocks = [], []
        while len(start):
            h = self.blocks(hashes, start)
            step = self.shift[(h & self.mask).astype(np.int64)]
            hit = step == 0
            ends.append(start[hit])
            blocks.append(h[hit])
            start = start + np.maximum(step, 1)
            going = start < stop
            start, stop = start[going], stop[going]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end, block = np.concatenate(ends), np.concatenate(blocks)
        low, high = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        begin, window = np.repeat(end - self.m + 1, high - low), ranges(low, high - low)
        thin = self.blocks(hashes, begin + self.block - 1) == self.prefix[window]
        begin, window = begin[thin], window[thin]
        size = self.length[window]
        same = at[begin + self.m] - at[begin] == size
        begin, window, size = begin[same], window[same], size[same]
        if not len(begin):
            return begin, window
        equal = text[ranges(at[begin], size)] == self.bytes[ranges(self.at[window], size)]
        real = np.logical_and.reduceat(equal, np.concatenate(([0], np.cumsum(size)[:-1])))
        return begin[real], window[real]


def window_sets(items: list[tuple[int, str | None]], n: int) -> list[WindowSet]:
    """The windows of the items by length: n consecutive words, or all words of an item that has fewer."""
    found: dict[int, dict[bytes, set[int]]] = {}
    for item, text in items:
        words = _WORD.findall((text or "").encode().lower())
        m = min(n, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            found.setdefault(m, {}).setdefault(b" ".join(words[i : i + m]), set()).add(item)
    return [WindowSet(m, list(w), [sorted(x) for x in w.values()]) for m, w in sorted(found.items())]


def search_piece(column: pa.Array, sets: list[WindowSet]) -> tuple[np.ndarray, list[tuple[np.ndarray, list[list[int]]]], Words]:
    """Which words are hit; for each window set its hits as first word and items; the words."""
    words = Words(column, WORD_BYTES)
    hashes = words.hashes()
    keep = words.inside.copy()
    keep[1:] |= words.inside[:-1]
    text = words.data[keep]
    text[text == 0] = 32
    at = np.concatenate(([0], np.cumsum(words.end - words.begin + 1)))
    edges, hits = np.zeros(len(words) + 1, np.int64), []
    for s in sets:
        begin, window = s.search(words, hashes, text, at)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + s.m, -1)
        hits.append((begin, [s.items[w] for w in window]))
    return np.cumsum(edges)[:-1] > 0, hits, words


def _per_row(words: Words, hits: list) -> list[set[int]]:
    items: list[set[int]] = [set() for _ in range(len(words.first) - 1)]
    for begin, found in hits:
        for row, ids in zip(np.searchsorted(words.first, begin, "right") - 1, found, strict=True):
            items[row].update(ids)
    return items


def _spans(hit: np.ndarray, words: Words) -> list[list[dict]]:
    first = words.first
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    cut = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(hit))]
    cut = cut[hit[cut - 1] & hit[cut]] if len(cut) else cut  # a hit run over the border of two values is two spans
    edge = np.sort(np.concatenate((edge, np.unique(cut), np.unique(cut))))
    spans: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    for a, b in zip(edge[0::2], edge[1::2], strict=True):
        row = int(np.searchsorted(first, a, "right")) - 1
        spans[row].append({"begin": int(a - first[row]), "end": int(b - first[row])})
    return spans


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    bench = bench.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("i IS NOT NULL")
    n = max(1, -(-(bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes))
    for k in range(n):
        yield [tuple(r) for r in bench.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()]


def _next(table: DataFrame, before: DataFrame | None) -> DataFrame:
    """``table`` settled for another pass; what it was made from is deleted."""
    made = settle(table)
    if before is not None:
        release(before)
    return made


def find_windows(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_hit (words inside any occurrence), items (sorted ids of the items with an
    occurring window) and spans (hit runs as word offsets, end exclusive).

    Null and empty texts have no words; items without words or id are ignored; repeated items and rows are treated one by one. Other columns
    of the inputs aren't read, whatever their names. Texts of any length are searched whole. No documents give an empty result, no items leave every text clean. Item ids must be numbers.
    """
    sc = docs.sparkSession.sparkContext
    state = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast("array<long>").alias("items"), F.lit(None).cast("array<struct<begin:long,end:long>>").alias("spans"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"))
    schema = state.schema
    out = pa.schema([("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
    held = None
    for k, items in enumerate(_blocks(bench, item_col, item_text, block_bytes)):
        if k:
            state = held = _next(state, held)
        sets = sc.broadcast(window_sets(items, n))

        def run(batches, sets=sets):
            for piece in pieces(batches, "text"):
                hit, hits, words = search_piece(piece.column("text"), sets.value)
                for row, old in enumerate(piece.column("spans").to_pylist()):
                    for x in old or ():
                        hit[words.first[row] + x["begin"] : words.first[row] + x["end"]] = True
                items = [sorted(new | set(old or ())) for new, old in zip(_per_row(words, hits), piece.column("items").to_pylist(), strict=True)]
                total = np.concatenate(([0], np.cumsum(hit)))
                made = [piece.column("id"), piece.column("text"), pa.array(items, out.field("items").type), pa.array(_spans(hit, words), out.field("spans").type), pa.array(words.counts), pa.array(total[words.first[1:]] - total[words.first[:-1]])]
                yield pa.RecordBatch.from_arrays(made, names=["id", "text", "items", "spans", "n_words", "n_hit"])

        state = state.mapInArrow(run, schema)
    return state.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def remove_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose text no window of any item occurs. Null texts stay. Other cases as in ``find_windows``."""
    sc = docs.sparkSession.sparkContext
    held = None
    for k, items in enumerate(_blocks(bench, item_col, item_text, block_bytes)):
        if k:
            docs = held = _next(docs, held)
        sets = sc.broadcast(window_sets(items, n))

        def run(batches, sets=sets):
            for piece in pieces(batches, text_col):
                hit, _, words = search_piece(piece.column(text_col), sets.value)
                total = np.concatenate(([0], np.cumsum(hit)))
                yield piece.filter(pa.array(total[words.first[1:]] == total[words.first[:-1]]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
