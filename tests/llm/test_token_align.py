import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from secdata.llm import token_align
from secdata.llm.token_align import Aligned, Pair, digest, groups, merge_path, read_files

TEXTS = [
    None, "", " ", "a", "hello world", "Hello  world, it's 3.14!\n\n\tdef f(x):\n    return x", "  leading and trailing  ", "<|endoftext|> and <s> x </s> <unk> <0x41>", "▁tile", "a ▁b", "nul\x00byte \x1c \x85x",
    "é́ ﬁ 🙂🙂 日本語のテキスト　全角 空白", "a b c  d", "Größe über Übermut, naïve café", "ааа ббб", "\n", "\r\n x\r\n", "x" * 3000, "ab " * 2000, " " * 700, "0123456789abcdef" * 200, "don't 's 'll  're", "﻿bom", "é ́x", "𝔘𝔫𝔦 ​ zero",
]


@pytest.fixture(scope="module")
def pair():
    return Pair(*read_files())


def plain(text, pair, whole):
    """By the definition: whole texts encoded at once, groups by common ends, all links."""
    if not text:
        return [], []
    a, b = whole[0].encode(f" {text}", add_special_tokens=False).ids, whole[1].encode(text)
    if not b"".join(pair.a_bytes[i] for i in a) == f" {text}".encode() == b"".join(pair.b_bytes[i] for i in b):
        return [], []
    ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((pair.a_bytes, a), (pair.b_bytes, b))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    split = lambda ids, end: [[i for i, e in zip(ids, end, strict=True) if lo < e <= hi] for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True)]
    return list(zip(split(a, ends[0]), split(b, ends[1]), strict=True)), ends


@pytest.fixture(scope="module")
def whole():
    files = read_files()
    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=files[1])


def written(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


@pytest.mark.parametrize("work", [1, 3, 64, 100000])
def test_pieces_of_any_size_give_the_groups_of_whole_texts(pair, whole, work):
    made = Aligned(pair, TEXTS, work)
    found = [plain(t, pair, whole)[0] for t in TEXTS]
    assert made.written() == [written(f) for f in found]
    assert made.n_groups.tolist() == [len(f) for f in found]
    assert made.n_links.tolist() == [sum(len(a) * len(b) for a, b in f) for f in found]
    row, key, links = made.pairs(expand=7)
    want = {}
    for r, f in enumerate(found):
        for a, b in f:
            for x in a:
                for y in b:
                    want[(r, x * pair.size + y)] = want.get((r, x * pair.size + y), 0) + 1
    assert dict(zip(zip(row.tolist(), key.tolist(), strict=True), links.tolist(), strict=True)) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'▁xé1. ")), max_size=40), max_size=4))
def test_chunks_equal_whole_texts(pair, whole, texts):
    assert Aligned(pair, texts, 5).written() == [written(plain(t, pair, whole)[0]) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 40))
def test_merge_path(a, b, work):
    a, b = (np.array(sorted(x | {61}), np.int64) for x in (a, b))
    group_a, group_b, over_a, over_b = merge_path(a, b, work)
    both = np.intersect1d(a, b)
    assert group_a.tolist() == np.searchsorted(both, a).tolist() and group_b.tolist() == np.searchsorted(both, b).tolist()
    begin_a, begin_b = (np.concatenate(([0], x[:-1])) for x in (a, b))
    assert list(zip(over_a.tolist(), over_b.tolist(), strict=True)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if max(begin_a[i], begin_b[j]) < min(a[i], b[j])]


@pytest.mark.parametrize("hot", [0, 40, 1 << 20])
def test_digest_equals_the_definition(spark, pair, whole, hot):
    texts = [*TEXTS, "hello world", "hello there world", "world hello 日本", "ab ab ab cab"]
    rows = [(k if k != 5 else None, t, "x", 1) for k, t in enumerate(texts)] + [(4, "hello world", "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, pairs int").repartition(3)
    found = [plain(t, pair, whole)[0] for _, t, *_ in rows]
    held, per = {}, []
    for f in found:
        links = {}
        for a, b in f:
            for x in a:
                for y in b:
                    links[x, y] = links.get((x, y), 0) + 1
        per.append(links)
        for p in links:
            held[p] = held.get(p, 0) + 1
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    want = []
    for (i, *_), f, links in zip(rows, found, per, strict=True):
        w = written(f)
        want.append((str(i), sum(len(a) for a, _ in f), sum(len(b) for _, b in f), len(f), sum(links.values()), sum(m for p, m in links.items() if held[p] == best[p[0]]), sum(m * held[p] for p, m in links.items()), hashlib.sha256(w.encode()).hexdigest() if w else ""))
    got = [(str(r["doc_id"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in digest(df, hot_pairs=hot).collect()]
    assert sorted(got) == sorted(want)


def test_groups_and_empty_tables(spark, pair, whole):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    for r in groups(df, "id").collect():
        f = plain(TEXTS[r["id"]], pair, whole)[0]
        assert r["a_ids"] == [x for a, _ in f for x in a] and r["b_group"] == [g for g, (_, b) in enumerate(f) for _ in b] and len(r["a_group"]) == len(r["a_ids"])
    assert digest(df.where("false"), "id").count() == 0


def test_memo_starts_afresh(pair, whole, monkeypatch):
    monkeypatch.setattr(token_align, "MEMO_CHUNKS", 3)
    for t in ("one two three four five", "four five six", "one", "one two"):
        assert Aligned(pair, [t]).written() == [written(plain(t, pair, whole)[0])]
