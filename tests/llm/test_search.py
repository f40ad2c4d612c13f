"""The search against a plain BM25 over all documents."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from secdata.llm import search as S


def words_of(text):
    return S._WORD.findall((text or "").lower().encode())


def brute(rows, asked, k, n_terms=None):
    """For each query the (rank, doc, score) of its k best by plain BM25; rows with equal ids are one document."""
    words = {}
    for i, t in rows:
        words.setdefault(i, []).extend(words_of(t))
    n, mean = len(words), sum(map(len, words.values())) / len(words)
    tf = {d: Counter(ws) for d, ws in words.items()}
    freq = Counter(w for c in tf.values() for w in c)
    out = {}
    for q, t in asked:
        terms = S.query_terms(t, n_terms)
        scored = []
        for d, ws in words.items():
            s = sum(math.log(1 + (n - freq[w] + 0.5) / (freq[w] + 0.5)) * tf[d][w] * (S.K1 + 1) / (tf[d][w] + S.K1 * (1 - S.B + S.B * len(ws) / mean)) for w in terms if tf[d][w])
            if s:
                scored.append((-round(s, 9), d))
        out[q] = [(r, d, round(-s, 6)) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return {q: x for q, x in out.items() if x}


def found(df):
    got = {}
    for x in df.collect():
        got.setdefault(x.query_id, []).append((x.rank, x.doc_id, round(x.score, 6)))
    return {q: sorted(x) for q, x in got.items()}


@pytest.mark.parametrize(("n_terms", "block"), [(None, 20_000), (None, 7), (5, 20_000)])
def test_search(spark, monkeypatch, n_terms, block):
    """Whole queries and short ones, in one block of queries and in several, over many shards and search rounds."""
    for name, value in (("SHARD_WORDS", 60), ("LEAST_SHARDS", 3), ("BLOCK_TERMS", 5000), ("BATCH_CELLS", 200), ("LONG_CELLS", 60)):
        monkeypatch.setattr(S, name, value)
    r = random.Random(11)
    vocab = [f"w{'x' * (i % 9)}{i}" for i in range(400)]
    rows = [(i, " ".join(r.choices(vocab, weights=range(1, 401), k=r.choice([1, 5, 30, 90])))) for i in range(150)]
    rows += [(500 + i, rows[3][1]) for i in range(15)] + [(40, "Twice W1 w1"), (700, " ".join(vocab * 3)), (900, None), (901, "..."), (902, ""), (None, "w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named = [(i, t) for i, t in rows if i is not None]
    asked = [(i, t) for i, t in named if i != 40 and (i % 10 == 0 or i > 499)]
    clashing = spark.createDataFrame([(i, t, "x", 1.0) for i, t in asked], "doc_id long, text string, doc string, score double")
    assert found(S.search(df, clashing, k=7, n_terms=n_terms, block_queries=block)) == brute(named, asked, 7, n_terms)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    assert S.search(df.limit(0), df).collect() == [] and S.search(df, df.limit(0)).collect() == []
    assert [(r.query_id, r.doc_id) for r in S.search(df, df).collect()] == [(1, 1)]


def test_pruning_loses_nothing_and_skips(monkeypatch):
    """One shard against sums over all documents: with and without a threshold, and blocks are skipped."""
    monkeypatch.setattr(S, "LONG_CELLS", 4000)
    skipped = 0
    for seed in range(60):
        r = np.random.default_rng(seed)
        monkeypatch.setattr(S, "BLOCK", int(r.integers(1, 9)))
        n, terms = 200, np.sort(r.choice(1 << 40, 40, replace=False)).astype(np.uint64)
        per_doc = [np.sort(r.choice(40, int(r.integers(1, 12)), replace=False, p=np.arange(1, 41) / 820)) for _ in range(n)]
        tf = [r.integers(1, 9, len(t)) for t in per_doc]
        dl = np.array([int(t.sum()) for t in tf])
        ids = r.permutation(1000)[:n]
        row = S._index(3, ids, dl, [terms[t].tobytes() for t in per_doc], [t.astype(np.uint8).tobytes() for t in tf])
        df = np.bincount(np.concatenate(per_doc), minlength=40)
        shard = S.Shard(row[2:], terms, df.astype(float), n, dl.mean())
        query = np.array([0, 20, 33, 38, 39])
        sums = Counter()
        for d, (t, c) in enumerate(zip(per_doc, tf, strict=True)):
            for x, f in zip(t, c, strict=True):
                if x in query:
                    sums[int(ids[d])] += math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * f * (S.K1 + 1) / (f + S.K1 * (1 - S.B + S.B * dl[d] / dl.mean()))
        expected = sorted((-round(s, 9), d) for d, s in sums.items())[:7]
        for least in (0.0, -expected[-1][0] * (1 - 1e-9), -expected[3][0] * (1 - 1e-9)):
            shard.added = 0
            (docs, scores), = shard.top([query], np.array([least]), 7)
            got = list(zip((-scores).round(9).tolist(), docs.tolist(), strict=True))
            assert got == [x for x in expected if -x[0] >= least]
            skipped += shard.added < shard.blocks
    assert skipped > 60, skipped


def test_registered_query_is_whole(spark, tmp_path):
    long = " ".join(f"{c * 9}" for c in "abcdefgh")
    spark.createDataFrame([(0, f"{long} cat"), (1, "a cat")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r.query_id, r.rank, r.doc_id) for r in S.op10_topk_search(spark, str(tmp_path)).orderBy("rank").collect()] == [(0, 1, 0), (0, 2, 1)]
