"""Exact top-k search: BM25 by block-max WAND over an inverted index per shard, merged exactly with global statistics.

The index is built once, without regard to queries: documents are dealt by a hash of the id to shards of about ``SHARD_WORDS`` words, however many shards that
takes, and each shard becomes one row of packed arrays in a table in the shared folder: terms, postings lists (document and count) in the order of the
shard's documents, document lengths. Documents stand in the order of their most frequent term and their length, so that neighbours resemble each other.

Queries are broadcast in blocks of a bounded number of terms, with the terms' document frequencies; these, the number of documents and their mean length are
global, so the merged best of all shards are those of one index. Shards are searched in rounds (8, then 56, 448 ...). After a round every query's k-th best
score is known and is the threshold of the next, so later shards return only what can still be among the best.

In a shard, a list's documents are cut into blocks of ``BLOCK`` neighbours with the largest score in each. A document is scored only if the sum of its upper bounds exceeds
the query's threshold (WAND's pivot test): a term of a short list contributes its score in that document, a term of a long list the maximum of the
document's block, whether the document has it or not. All tests of a batch of queries are one sparse sum and one matrix product. If a query has no threshold yet, the k documents with the
highest bounds are scored first. Blocks with a document that passes are then added up exactly, for all queries of the batch that need them at once. Scores are summed in one order of terms, so equal texts tie exactly; ties go to the smaller id.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secdata.llm.shared import release, settle
from secdata.llm.text import WORD_BYTES, Words, pieces, ranges

K1, B, BLOCK = 1.2, 0.75, 64
SHARD_WORDS, LEAST_SHARDS, FIRST_ROUND = 2_000_000, 8, 8
BLOCK_TERMS, BLOCK_QUERIES, BATCH_CELLS, LONG_CELLS = 4_000_000, 20_000, 500_000, 2_000_000
_BYTES_PER_WORD = 6
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_INDEX = "shard int, round int, docs int, ids binary, dl binary, term binary, first binary, owner binary, tf binary"
_FOUND = "query_id long, doc_id long, score double"


def query_terms(text: str | None, n: int | None = None) -> list[bytes]:
    """A text's distinct words, longest first (ties: alphabetical order), at most ``n``."""
    return sorted(set(_WORD.findall((text or "").encode().lower())), key=lambda w: (-len(w), w))[:n]


def _narrow(x: np.ndarray, small: type) -> bytes:
    """The numbers as ``small`` if they fit, or as 32 bits."""
    return x.astype(small if not len(x) or x.max() <= np.iinfo(small).max else np.uint32).tobytes()


def _wide(raw: bytes, n: int, small: type) -> np.ndarray:
    return np.frombuffer(raw, small if len(raw) == n * np.dtype(small).itemsize else np.uint32)


def _pack(batches):
    """(doc, text) to one row a document: its length, its terms (hashes, ascending), and their counts."""
    for piece in pieces(batches, "text"):
        words = Words(piece.column("text"), WORD_BYTES)
        hashes, owner = words.hashes(), words.owners()
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))) if len(order) else np.zeros(0, np.int64)
        tf = np.diff(np.append(new, len(order)))
        cuts = np.searchsorted(owner[new], np.arange(piece.num_rows + 1))
        terms, hashes = [], hashes[new]
        counts = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            terms.append(hashes[a:b].tobytes())
            counts.append(_narrow(tf[a:b], np.uint8))
        yield pa.RecordBatch.from_arrays([piece.column("doc"), pa.array(words.counts.astype(np.int64)), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=["doc", "dl", "terms", "tfs"])


def _round_of(shard: int) -> int:
    r, end = 0, FIRST_ROUND
    while shard >= end:
        r, end = r + 1, end * 8
    return r


def _index(shard: int, doc: np.ndarray, dl: np.ndarray, terms: list[bytes], tfs: list[bytes]) -> list:
    """One row of the index from the shard's packed documents; rows with equal ids are one document."""
    ids, at = np.unique(doc, return_inverse=True)
    n = len(ids)
    dl = np.bincount(at, dl, n)
    count = np.fromiter((len(t) // 8 for t in terms), np.int64, len(terms))
    owner, term = np.repeat(at, count), np.frombuffer(b"".join(terms), np.uint64)
    tf = np.concatenate([np.zeros(0, np.int64), *(_wide(x, c, np.uint8) for x, c in zip(tfs, count, strict=True))]).astype(np.int64)
    # The most frequent term of each document: the count and the upper bits of the term in one number.
    head = np.zeros(n, np.uint64)
    np.maximum.at(head, owner, (np.minimum(tf, (1 << 20) - 1).astype(np.uint64) << np.uint64(44)) | (term >> np.uint64(20)))
    order = np.lexsort((dl, head & np.uint64((1 << 44) - 1)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    owner = place[owner]
    order_ = np.lexsort((owner, term))
    owner, term, tf = owner[order_], term[order_], tf[order_]
    new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])))) if len(term) else np.zeros(0, np.int64)
    if len(new) < len(term):
        tf = np.add.reduceat(tf, new)
        owner, term = owner[new], term[new]
    first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
    return [shard, _round_of(shard), n, ids[order].tobytes(), dl[order].astype(np.float32).tobytes(), term[first].tobytes(), np.append(first, len(term)).astype(np.uint32).tobytes(), _narrow(owner, np.uint16), _narrow(tf, np.uint8)]


def _build(batches):
    """All packed documents of a partition to one index row for each shard in it."""
    tables = [b for b in batches if b.num_rows]
    if tables:
        table = pa.Table.from_batches(tables)
        shards = table.column("shard").to_numpy()
        for s in np.unique(shards):
            part = table.filter(pa.array(shards == s))
            row = _index(int(s), part.column("doc").to_numpy(), part.column("dl").to_numpy(), part.column("terms").to_pylist(), part.column("tfs").to_pylist())
            types = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=[x.split()[0] for x in _INDEX.split(", ")])


def _rows(batches, names: list[str]):
    for batch in batches:
        for i in range(batch.num_rows):
            yield [batch.column(c)[i].as_py() for c in names]


class Shard:
    """The part of a shard's index that a block of queries needs, with scores and block maxima. Terms are places in the block's sorted ``wanted``."""

    def __init__(self, row: list, wanted: np.ndarray, df: np.ndarray, total: int, mean: float):
        n, ids, dl, term, first, owner, tf = row
        self.n, self.ids = n, np.frombuffer(ids, np.int64)
        term, first = np.frombuffer(term, np.uint64), np.frombuffer(first, np.uint32).astype(np.int64)
        dl = np.frombuffer(dl, np.float32).astype(float)
        code = np.minimum(np.searchsorted(wanted, term), max(0, len(wanted) - 1))
        known = np.flatnonzero(wanted[code] == term) if len(wanted) else np.zeros(0, np.int64)
        code, count = code[known], (first[1:] - first[:-1])[known]
        at = ranges(first[:-1][known], count)
        self.doc = _wide(owner, first[-1], np.uint16)[at]
        tf = _wide(tf, first[-1], np.uint8)[at].astype(float)
        self.count, self.begin = count, np.concatenate(([0], np.cumsum(count)))
        self.slot = np.full(len(wanted), -1, np.int32)  # from a term's place to its list here
        self.slot[code] = np.arange(len(code))
        list_of = np.repeat(np.arange(len(code), dtype=np.int32), count)
        idf = np.log(1 + (total - df[code] + 0.5) / (df[code] + 0.5))
        self.score = np.repeat(idf, count) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / (mean or 1.0))[self.doc])
        order = np.argsort(self.doc, kind="stable")  # document by document, terms ascending
        self.own_list, self.own_score = list_of[order], self.score[order]
        self.own = np.searchsorted(self.doc[order], np.arange(n + 1))
        # Long lists: by block of documents, the scores and their maxima.
        self.blocks = -(-n // BLOCK)
        most = min(int((count >= max(8, n / 50)).sum()), LONG_CELLS // max(1, self.blocks * BLOCK))
        long = np.sort(np.argsort(-count, kind="stable")[:most])
        self.column = np.full(len(code) + 1, -1)
        self.column[long] = np.arange(most)
        at = ranges(self.begin[long], count[long])
        self.long = np.zeros((self.blocks, most, BLOCK))
        self.long[self.doc[at] // BLOCK, np.repeat(np.arange(most), count[long]), self.doc[at] % BLOCK] = self.score[at]
        self.maxima = self.long.max(2).T if self.blocks else np.zeros((most, 0))
        self.asked = np.zeros(len(code), bool)
        self.added = 0  # blocks added up, by query

    def _scored(self, docs: np.ndarray) -> np.ndarray:
        """The documents' sums over the asked lists, in one order of terms."""
        count = self.own[docs + 1] - self.own[docs]
        at = ranges(self.own[docs], count)
        return np.bincount(np.repeat(np.arange(len(docs)), count), self.own_score[at] * self.asked[self.own_list[at]], len(docs))

    def top(self, queries: list[np.ndarray], least: np.ndarray, k: int):
        """For each query (the places of its terms), the documents and scores of at most k best that reach ``least``, best first; ties by the smaller id."""
        step = max(1, BATCH_CELLS // max(1, self.n))
        for i in range(0, len(queries), step):
            some = [s[s >= 0] for s in (self.slot[q] for q in queries[i : i + step])]
            owner = np.repeat(np.arange(len(some)), [len(s) for s in some])
            lists = np.concatenate([np.zeros(0, np.int32), *some])
            column = self.column[lists]
            chosen = np.zeros((len(some), len(self.maxima)))
            chosen[owner[column >= 0], column[column >= 0]] = 1
            short, whose = lists[column < 0], owner[column < 0]
            at = ranges(self.begin[short], self.count[short])
            cell = np.repeat(whose * self.n, self.count[short]) + self.doc[at]
            sums = np.zeros((len(some), self.blocks * BLOCK))
            sums[:, : self.n] = np.bincount(cell, self.score[at], len(some) * self.n).reshape(len(some), self.n)
            bound = (sums.reshape(len(some), self.blocks, BLOCK) + (chosen @ self.maxima)[:, :, None]).reshape(sums.shape)
            floor = least[i : i + step].copy()
            for r in np.flatnonzero(floor <= 0) if self.n > k else ():  # no threshold yet: the most promising documents give one
                self.asked[some[r]] = True
                floor[r] = self._scored(np.argpartition(bound[r, : self.n], self.n - k)[self.n - k :]).min()
                self.asked[some[r]] = False
            near = (bound >= floor[:, None] * (1 - 1e-9)) & (bound > 0)
            wanted = near.reshape(len(some), self.blocks, BLOCK).any(2)
            for b in np.flatnonzero(wanted.any(0)):
                rows = np.flatnonzero(wanted[:, b])
                self.added += len(rows)
                sums[rows, b * BLOCK : (b + 1) * BLOCK] += chosen[rows] @ self.long[b]
            near &= sums >= floor[:, None] * (1 - 1e-9)
            for r, mine in enumerate(some):
                self.asked[mine] = True
                yield self._best(np.flatnonzero(near[r]), sums[r], floor[r], k)
                self.asked[mine] = False

    def _best(self, found: np.ndarray, sums: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the documents found, the best: those near the k-th sum are summed again in one order of terms."""
        if len(found) > k:
            held = sums[found]
            found = found[held >= np.partition(held, len(held) - k)[len(held) - k] * (1 - 1e-9)]
        held = self._scored(found)
        good = (held > 0) & (held >= least)
        found, held = self.ids[found[good]], held[good]
        order = np.lexsort((found, -held))[:k]
        return found[order], held[order]


def _frequencies(wanted):
    """(term, first) of shards to the number of documents with each wanted term, summed over the task's shards."""

    def run(batches):
        n = np.zeros(len(wanted.value), np.int64)
        for term, first in _rows(batches, ["term", "first"]):
            term, first = np.frombuffer(term, np.uint64), np.frombuffer(first, np.uint32).astype(np.int64)
            place = np.minimum(np.searchsorted(wanted.value, term), max(0, len(n) - 1))
            known = wanted.value[place] == term if len(n) else np.zeros(len(term), bool)
            n[place[known]] += (first[1:] - first[:-1])[known]
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(n[has])], names=["term", "df"])

    return run


def _answerer(plan, total: int, mean: float, k: int):
    """Shards to the best documents of each query in the broadcast ``plan``: terms, document frequencies, query ids, their terms' places, thresholds."""

    def answer(batches):
        wanted, df, names, queries, least = plan.value
        for row in _rows(batches, ["docs", "ids", "dl", "term", "first", "owner", "tf"]):
            found = list(Shard(row, wanted, df, total, mean).top(queries, least, k))
            sizes = np.array([len(d) for d, _ in found], np.int64)
            docs, scores = (np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.int64, [d for d, _ in found]), (float, [s for _, s in found])))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, sizes)), pa.array(docs), pa.array(scores)], names=["query_id", "doc_id", "score"])

    return answer


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The settled index of all documents with an id, a row for each shard; folders by search round."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL")
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(LEAST_SHARDS, -(-size // (SHARD_WORDS * _BYTES_PER_WORD)))
    packed = source.mapInArrow(_pack, "doc long, dl long, terms binary, tfs binary").withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int"))
    return settle(packed.repartitionById(shards, F.col("shard")).mapInArrow(_build, _INDEX), "round")


def _terms_of(n_terms: int | None):
    def run(batches):
        for piece in pieces(batches, "text"):
            column = piece.column("text")
            if n_terms is not None:
                column = pa.array([b" ".join(query_terms(t, n_terms)).decode() for t in column.to_pylist()], pa.string())
            words = Words(column, WORD_BYTES)
            hashes = words.hashes()
            made = [np.unique(hashes[a:b]) for a, b in zip(words.first, words.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([piece.column("q"), pa.array([len(m) for m in made], pa.int64()), pa.array([m.tobytes() for m in made], pa.binary())], names=["q", "n", "terms"])

    return run


def search(docs: DataFrame, queries: DataFrame, k: int = 10, n_terms: int | None = None, id_col: str = "doc_id", text_col: str = "text", block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query; queries has the same two columns. A query is all distinct words of its text, or the ``n_terms`` longest.

    Null ids are left out; null, empty and wordless texts match nothing; a document with no query term isn't returned, so a query may have fewer than k rows. Texts may have any
    length: a document is one row of its distinct terms. Ids of documents should be unique: rows with equal ids count as one document made of the rows' postings. Query rows with equal ids are one
    query with the terms of all. No documents or no queries give an empty result. Other columns aren't read, whatever their names. Ids must be numbers.
    """
    spark = docs.sparkSession
    asked = queries.select(F.col(id_col).cast("long").alias("q"), F.col(text_col).cast("string").alias("text")).where("q IS NOT NULL")
    index = build_index(docs, id_col, text_col)
    sums = index.select("docs", "dl").mapInArrow(_lengths, "docs long, words double").agg(F.sum("docs"), F.sum("words")).first()
    total, mean = sums[0] or 0, (sums[1] or 0.0) / max(1, sums[0] or 0)
    rounds = [r[0] for r in index.select("round").distinct().orderBy("round").collect()]
    asked = settle(asked.mapInArrow(_terms_of(n_terms), "q long, n long, terms binary"))
    n_queries, n_asked = asked.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_blocks = max(-(-n_queries // block_queries), -(-n_asked // BLOCK_TERMS))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")  # some k rows a round
    parts = []
    for block in range(n_blocks):
        held: dict[int, list[np.ndarray]] = {}
        for r in asked.where(F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == block).select("q", "terms").collect():
            held.setdefault(r.q, []).append(np.frombuffer(r.terms, np.uint64))
        names = np.array(sorted(held), np.int64)
        terms = [np.unique(np.concatenate(held[q])) for q in names.tolist()]
        distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms]))
        wanted = spark.sparkContext.broadcast(distinct)
        counted = index.select("term", "first").mapInArrow(_frequencies(wanted), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(len(distinct))
        df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
        places = [np.searchsorted(distinct, t) for t in terms]
        least = np.zeros(len(names))
        mine: list[DataFrame] = []
        for r in rounds:
            plan = spark.sparkContext.broadcast((distinct, df, names, places, least))
            mine.append(settle(index.where(F.col("round") == r).mapInArrow(_answerer(plan, total, mean, k), _FOUND)))
            if r != rounds[-1]:
                known = _union(mine).withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", "score").toArrow()
                least[np.searchsorted(names, known.column("query_id").to_numpy())] = known.column("score").to_numpy()
        parts += mine
    release(index, asked)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    return _union(parts).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _union(parts: list[DataFrame]) -> DataFrame:
    made = parts[0]
    for p in parts[1:]:
        made = made.unionByName(p)
    return made


def _lengths(batches):
    for n, dl in _rows(batches, ["docs", "dl"]):
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([float(np.frombuffer(dl, np.float32).astype(float).sum())])], names=["docs", "words"])


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, docs.where("doc_id % 100 = 0"), k=10)
