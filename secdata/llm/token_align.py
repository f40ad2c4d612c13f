"""Alignment of two tokenizers' tokens over the same texts.

A text's tokens end at byte offsets. Where tokens of both sides end, the text falls into groups; tokens of one group are linked. The
ends of both sides are merged along the merge path: the merged sequence of all texts of a piece of input is cut by diagonals into equal parts, a binary search on
each diagonal finds how much of either side comes before it, and so the parts, which may begin and end anywhere in a text, are
merged independently of each other, all together one step at a time. A part emits the overlaps of the tokens it passes and counts the group ends in it;
the counts of the parts before tell which group its first tokens go on with, which stitches the groups at the borders.

Tokens come from chunks: a text is cut before single spaces between two characters that aren't white space. No token of either side
reaches over such a cut (``Pair`` checks what that takes), so each distinct chunk is encoded once and kept in a bounded memo.

Corpus-wide counts of linked pairs of ids: each text's distinct pairs are written once (shared folder), counted by Spark, and the counts go back
to the texts. The most frequent pairs (at most ``hot_pairs``) and the best count of each A id (at most one per entry of the
vocabulary) are broadcast; what is left, rare pairs without hot keys, is joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.llm.shared import release, settle
from secdata.llm.text import pieces, ranges

FOLDER, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Merged ends in one part of the merge path.
WORK = 256
#: Chunks and bytes of chunks in a worker's memo before it starts afresh, and pairs of ids that are expanded together.
MEMO_CHUNKS, MEMO_BYTES, EXPAND = 1 << 19, 1 << 24, 1 << 20
#: Pairs that are broadcast at most: 12 MB.
HOT_PAIRS = 1 << 20
_CUT = re.compile(r" (?=\S)(?<=\S )")


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, as the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def read_files(folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[str, bytes]:
    return Path(folder, a_file).read_text(encoding="utf-8"), Path(folder, b_file).read_bytes()


def vocabulary(files: tuple[str, bytes]) -> int:
    """One more than the largest id on either side."""
    import sentencepiece

    made = json.loads(files[0])
    ids = [*made["model"]["vocab"].values(), *(t["id"] for t in made.get("added_tokens", []))]
    return max(1 + max(ids), sentencepiece.SentencePieceProcessor(model_proto=files[1]).get_piece_size())


#: How byte-level vocabularies cut a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Pair:
    """Both tokenizers in a Python worker, with each id's bytes. a: a byte-level vocabulary whose ids follow its merges (JSON text), b: a piece model (its bytes)."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece
        import tiktoken

        made, byte_of = json.loads(a), _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in made["model"]["vocab"].items() if all(c in byte_of for c in token)}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in made["model"]["merges"]]
        if [made["model"]["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("ids don't follow the merges")
        ranks = {x: i for x, i in ranks.items() if i < 256 + len(merged)}
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.size = vocabulary((a, b))
        self.a_bytes = [b""] * self.size
        for token, i in ranks.items():
            self.a_bytes[i] = token
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        # A piece with a space behind another character could reach over a cut, and so could one of A.
        if any(b" " in x.lstrip(b" ") for i, x in enumerate(self.b_bytes) if not self.b.is_control(i)) or any(re.search(r"\S ", x.decode(errors="replace")) for x in self.a_bytes):
            raise ValueError("a token goes on behind a space: texts can't be cut into chunks")
        self.names = [str(i) for i in range(self.size)]
        self.written = [n + end for end in (",", "|", ";", "") for n in self.names]
        self.a_len, self.b_len = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        self.good = bytearray()
        self.ids, self.many = ((array("i"), array("i")) for _ in range(2))

    def learn(self, chunks: list[str]) -> None:
        """Encodes chunks that the memo doesn't hold. A chunk stands for itself with a space before it."""
        whole = [f" {c}".encode() for c in chunks]
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        good = np.ones(len(chunks), bool)
        for side, ids in enumerate(([self.a(f" {c}") for c in chunks], self.b.encode(chunks, num_threads=1))):
            flat, many = list(chain.from_iterable(ids)), list(map(len, ids))
            table = (self.a_bytes, self.b_bytes)[side]
            end = np.concatenate(([0], np.cumsum((self.a_len, self.b_len)[side][np.array(flat, np.int64)])))[np.cumsum(many)]
            if not np.array_equal(end, np.cumsum(sizes)) or b"".join([table[i] for i in flat]) != b"".join(whole):
                good &= np.fromiter((b"".join([table[i] for i in x]) == w for x, w in zip(ids, whole, strict=True)), bool, len(ids))
            self.ids[side].extend(flat)
            self.many[side].extend(many)
        self.place.update(zip(chunks, range(len(self.good), len(self.good) + len(chunks)), strict=True))
        self.good.extend(good.tobytes())
        self.held += int(sizes.sum())

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For A and B: the ids of all texts in a row, and how many each text has. Texts without tokens by definition have none."""
        if len(self.place) > MEMO_CHUNKS or self.held > MEMO_BYTES:
            self.forget()
        chunks: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            if text:
                cut = _CUT.split(text)
                chunks += cut
                count[row] = len(cut)
        new = [c for c in dict.fromkeys(chunks) if c not in self.place]
        if new:
            self.learn(new)
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        first = np.concatenate(([0], np.cumsum(count)))
        bad = np.concatenate(([0], np.cumsum(~np.array(self.good, bool)[at])))
        whole = bad[first[1:]] == bad[first[:-1]]
        at = at[np.repeat(whole, count)]
        count = np.where(whole, count, 0)
        row = np.repeat(np.arange(len(texts)), count)
        ids, sizes = [], []
        for side in range(2):
            many = np.array(self.many[side], np.int64)
            start = np.concatenate(([0], np.cumsum(many)))[:-1]
            ids.append(np.array(self.ids[side], np.int64)[ranges(start[at], many[at])])
            sizes.append(np.bincount(row, many[at], len(texts)).astype(np.int64))
        return ids, sizes


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of two rising sequences of ends with the same last end: for each A token and each B token its group, and the overlapping (A token, B token) pairs in order."""
    n = len(a) + len(b)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    diagonal = np.arange(0, n, work)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():  # how many A ends come before each diagonal; equal ends: A first
        middle = (low + high) // 2
        before = (low < high) & (a[np.minimum(middle, len(a) - 1)] <= b[np.maximum(diagonal - 1 - middle, 0)])
        low, high = np.where(before, middle + 1, low), np.where(before | (low >= high), high, middle)
    i, j = low, diagonal - low
    beyond = np.iinfo(np.int64).max
    a_end, b_end = np.append(a, beyond), np.append(b, beyond)
    steps, parts = min(work, n), len(diagonal)
    from_a, at_a, at_b, ends = (np.zeros((steps, parts), t) for t in (bool, np.int64, np.int64, bool))
    for s in range(steps):  # all parts make one step; the last one idles behind its end
        x, y = a_end[i], b_end[j]
        take = x <= y
        from_a[s], at_a[s], at_b[s] = take, i, j
        ends[s] = ~take & (i > 0) & (a_end[i - 1] == y)
        i, j = np.minimum(i + take, len(a)), np.minimum(j + ~take, len(b))
    last = n - (parts - 1) * work
    ends[last:, -1] = False
    passed = np.cumsum(ends, axis=0) - ends  # group ends in the part before the step
    before = np.cumsum(passed[-1] + ends[-1]) - (passed[-1] + ends[-1])  # and in the parts before
    group = (passed + before).T.reshape(-1)[:n]
    from_a, ends, at_a, at_b = (x.T.reshape(-1)[:n] for x in (from_a, ends, at_a, at_b))
    return group[from_a], group[~from_a], at_a[~ends], at_b[~ends]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights, first)


class Aligned:
    """The groups of a piece of texts. ids, sizes: of A and B as in ``Pair.encode``; group: of A's and B's tokens; row: each group's text."""

    def __init__(self, pair: Pair, texts: list[str | None], work: int = WORK):
        self.pair, self.rows = pair, len(texts)
        self.ids, self.sizes = pair.encode(texts)
        a, b = (np.cumsum(length[ids]) for length, ids in zip((pair.a_len, pair.b_len), self.ids, strict=True))
        *self.group, self.over_a, self.over_b = merge_path(a, b, work)
        owner = [np.repeat(np.arange(self.rows), s) for s in self.sizes]
        self.groups = int(self.group[0][-1]) + 1 if len(self.group[0]) else 0
        self.many = [np.bincount(g, minlength=self.groups) for g in self.group]
        self.first = [np.cumsum(m) - m for m in self.many]
        self.row = owner[0][self.first[0]] if self.groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.row, minlength=self.rows)
        self.n_links = np.bincount(self.row, self.many[0] * self.many[1], self.rows).astype(np.int64)
        self.n_overlaps = np.bincount(owner[0][self.over_a], minlength=self.rows)

    def written(self) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        size = self.many[0] + self.many[1]
        at = np.cumsum(size) - size
        keys = np.zeros(int(size.sum()), np.int64)
        for side in range(2):
            g = self.group[side]
            inside = np.arange(len(g)) - self.first[side][g]
            final = inside == self.many[side][g] - 1
            end = np.where(final, 1, 0)
            if side and len(g):
                of_row = np.append(self.row[1:] != self.row[:-1], True)[g]
                end = np.where(final, np.where(of_row, 3, 2), 0)
            keys[at[g] + inside + (self.many[0][g] if side else 0)] = self.ids[side] + end * self.pair.size
        first = np.concatenate(([0], np.cumsum(self.sizes[0] + self.sizes[1])))
        text = self.pair.written
        return ["".join(map(text.__getitem__, keys[x:y].tolist())) for x, y in zip(first[:-1], first[1:], strict=True)]

    def pairs(self, expand: int = EXPAND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of the distinct linked pairs of ids, in order; a pair is a * size + b. A group's repeated ids are added up first; expanded pairs are added up by ``expand``."""
        size = self.pair.size
        held = []
        for side in range(2):
            large = (self.many[0] * self.many[1] > 64)[self.group[side]]
            key = self.group[side] * size + self.ids[side]
            some, weight = _summed(key[large], np.ones(int(large.sum()), np.int64))
            key, weight = np.concatenate((key[~large], some)), np.concatenate((np.ones(int((~large).sum()), np.int64), weight))
            order = np.argsort(key // size, kind="stable")
            held.append((key[order] // size, key[order] % size, weight[order]))
        (g, a, w), (h, b, v) = held
        first, last = np.searchsorted(h, g, "left"), np.searchsorted(h, g, "right")
        upto, done = np.cumsum(last - first), 0
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while done < len(g):
            to = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + expand, "right")))
            many = (last - first)[done:to]
            other = ranges(first[done:to], many)
            row = np.repeat(self.row[g[done:to]], many)
            new = _summed((row * size + np.repeat(a[done:to], many)) * size + b[other], np.repeat(w[done:to], many) * v[other])
            keys, sums = _summed(np.concatenate((keys, new[0])), np.concatenate((sums, new[1]))) if len(keys) else new
            done = to
        return keys // (size * size), keys % (size * size), sums


def _pair_of(shared) -> Pair:
    """The worker's tokenizers: made once for each worker process."""
    global _made
    if _made is None or _made[0] != shared.value["key"]:
        _made = (shared.value["key"], Pair(*shared.value["files"]))
    return _made[1]


_made: tuple[str, Pair] | None = None


def _ship(spark: SparkSession, files: tuple[str, bytes]):
    digest = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    return spark.sparkContext.broadcast({"key": digest, "files": files})


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """One row per row of ``docs``: its id, ids of both tokenizers (``a_ids``, ``b_ids``) and each token's group, from 0 (``a_group``, ``b_group``).

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens. Repeated rows get equal results; an empty table gives none; texts of any
    length are aligned whole; other columns aren't read, whatever their names.
    """
    shared = _ship(docs.sparkSession, read_files(folder, a_file, b_file))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["a_ids", "b_ids", "a_group", "b_group"]

    def run(batches):
        pair = _pair_of(shared)
        for piece in pieces(batches, "text"):
            made = Aligned(pair, piece.column("text").to_pylist())
            start = np.cumsum(made.n_groups) - made.n_groups
            columns = [piece.column("id")]
            for values in (made.ids, [g - start[made.row[g]] for g in made.group]):
                for side in range(2):
                    offsets = np.concatenate(([0], np.cumsum(made.sizes[side]))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[side].astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=["id", *names])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The rows' slices of ``values`` as bytes."""
    data = np.ascontiguousarray(values).tobytes()
    at = (first * values.itemsize).tolist()
    return pa.array([data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All rows' values of ``_packed`` as 64-bit integers, and the offsets of the rows."""
    cells = column.to_pylist()
    values = np.frombuffer(b"".join(cells), kind).astype(np.int64)
    return values, np.concatenate(([0], np.cumsum([len(c) // np.dtype(kind).itemsize for c in cells]))).astype(np.int64)


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]


def _aligned(docs: DataFrame, id_col: str, text_col: str, files: tuple[str, bytes], kind) -> DataFrame:
    """Settled: (row, id, counts, groups_sha256, pairs, links); each text's distinct pairs of ids, and the links of each, are bytes."""
    shared = _ship(docs.sparkSession, files)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        pair = _pair_of(shared)
        for piece in pieces(batches, "text"):
            made = Aligned(pair, piece.column("text").to_pylist())
            digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in made.written()]
            row, key, links = made.pairs()
            first = np.searchsorted(row, np.arange(len(digests) + 1))
            counts = [pa.array(x.astype(np.int64)) for x in (*made.sizes, made.n_groups, made.n_links, made.n_overlaps)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), piece.column("id"), *counts, pa.array(digests, pa.string()), _packed(key.astype(kind), first), _packed(links, first)], names=["row", "id", *COUNTS, "groups_sha256", "pairs", "links"])

    fields = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("links", T.BinaryType())]
    return settle(rows.mapInArrow(run, T.StructType([T.StructField("row", T.LongType()), T.StructField("id", rows.schema["id"].dataType), *fields])))


def _text_counts(aligned: DataFrame, kind) -> DataFrame:
    """Settled (pair, n): how many texts hold a pair linked. A task adds up each of its batches before Spark does."""

    def run(batches):
        for piece in pieces(batches, "pairs", 8 * EXPAND):
            key, n = np.unique(_unpacked(piece.column("pairs"), kind)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    return settle(aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The pairs of the largest counts, at most ``most``, with their counts, and the least count among them: pairs of smaller counts aren't there, all others are."""
    step = F.floor(F.log2("n") * 16)  # counts of one step come in together
    sizes = sorted(((int(r[0]), r[1], r[2]) for r in counts.groupBy(step.alias("s")).agg(F.count("*"), F.min("n")).collect()), reverse=True)
    least, total = np.iinfo(np.int64).max, 0
    for _, many, low in sizes:
        if total + many > most:
            break
        total, least = total + many, low
    got = counts.where(F.col("n") >= least).toArrow()
    key, n = got["pair"].to_numpy(), got["n"].to_numpy()
    order = np.argsort(key)
    return key[order], n[order], int(least)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row of ``docs``: its id; n_a, n_b: tokens; n_groups; n_links: pairs of an A token and a B token of one group; n_overlaps: those that share bytes; n_best: links whose pair of
    ids is held linked by as many texts as any pair of its A id; count_sum: that number of texts, summed over the links; groups_sha256: of ``a1,a2|b1;a3|b2,b3``, empty without tokens.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens: zeros. Repeated rows count one by one, and null ids are ids like others. Ties for the
    best count are all best. An empty table gives none; texts of any length are aligned whole; other columns aren't read, whatever their names.
    """
    files, spark = read_files(folder, a_file, b_file), docs.sparkSession
    size = vocabulary(files)
    kind = np.uint32 if size * size < 1 << 32 else np.int64
    aligned = _aligned(docs, id_col, text_col, files, kind)
    counts = _text_counts(aligned, kind)
    a_id = F.floor(F.col("pair") / size).cast("int")
    best = np.zeros(size, np.int64)
    for r in counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = r["n"]
    hot, n_hot, least = _most_frequent(counts, hot_pairs)
    shared = spark.sparkContext.broadcast((hot, n_hot, best))
    numbers = ["n_best", "count_sum"]

    def add(batches):
        hot, n_hot, best = shared.value
        for piece in pieces(batches, "pairs", 8 * EXPAND):
            key, first = _unpacked(piece.column("pairs"), kind)
            links, _ = _unpacked(piece.column("links"), np.int64)
            at = np.minimum(np.searchsorted(hot, key), max(len(hot) - 1, 0))
            known = hot[at] == key if len(hot) else np.zeros(len(key), bool)
            n = np.where(known, n_hot[at] if len(hot) else 0, 0)
            made = []
            for x in (links * (known & (n == best[key // size])), links * n):
                total = np.concatenate(([0], np.cumsum(x)))
                made.append(pa.array(total[first[1:]] - total[first[:-1]]))
            rest = np.concatenate(([0], np.cumsum(~known)))[first]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("row", "id", *COUNTS, "groups_sha256")), *made, _packed(key[~known].astype(kind), rest), _packed(links[~known], rest)], names=["row", "id", *COUNTS, "groups_sha256", *numbers, "pairs", "links"])

    fields = [*aligned.schema.fields[:-2], *(T.StructField(c, T.LongType()) for c in numbers), *aligned.schema.fields[-2:]]
    added = settle(aligned.mapInArrow(add, T.StructType(fields)))

    def rare(batches):
        for piece in pieces(batches, "pairs", 8 * EXPAND):
            key, first = _unpacked(piece.column("pairs"), kind)
            row = piece.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row, np.diff(first))), pa.array(key), pa.array(_unpacked(piece.column("links"), np.int64)[0])], names=["row", "pair", "links"])

    # Rare pairs have at most ``least`` texts each, so no key of this join is hot. Best counts, one for an A id, come from the vocabulary's bounded table.
    cold = added.where(F.length("pairs") > 0).select("row", "pairs", "links").mapInArrow(rare, "row long, pair long, links long").join(counts.where(F.col("n") < least), "pair")
    bests = spark.createDataFrame(list(enumerate(best.tolist())), "a int, best long")
    cold = cold.withColumn("a", a_id).join(F.broadcast(bests), "a").groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    out = settle(added.drop("pairs", "links").join(cold, "row", "left").select(F.col("id").alias(id_col), *COUNTS, *((F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c) for c, more in zip(numbers, ("more_best", "more_sum"), strict=True)), "groups_sha256"))
    release(aligned, counts, added)
    return out
