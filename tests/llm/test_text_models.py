"""Classifiers and the HTML extraction against plain formulas: scores that depend on the text alone, pairs of terms, hostile pages."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from secdata.llm import html_extract, langid, quality, sharding, toxicity


def sample_texts(n, seed=1):
    r = random.Random(seed)
    return ["", None, "ok", "Zq", *("".join(r.choices("abc .,!\nÄx9", k=r.choice([1, 2, 3, 5, 30, 400]))) for _ in range(n))]


def test_quality_scores_depend_on_the_own_text_alone():
    texts = sample_texts(60)
    labels = np.array([i % 2 for i in range(len(texts))])
    model = quality.Voters(quality.features(pa.array(texts)), labels, rank=16, neighbours=5, power=4.0)
    together = model.score(pa.array(texts))
    assert together.tolist() == [float(model.score(pa.array([t], pa.string()))[0]) for t in texts]
    assert together[::-1].tolist() == model.score(pa.array(texts[::-1])).tolist()


def test_quality_is_the_vote_of_the_nearest():
    texts = sample_texts(80, seed=2)
    labels = np.array([(i * 7) % 3 == 0 for i in range(len(texts))], float)
    counts = quality.features(pa.array(texts))
    for text, row in zip(texts, counts, strict=True):  # windows counted one by one
        data, plain = [48 if 48 <= b <= 57 else min(b, 128) for b in (text or "").encode() + b"\n\n\n"], Counter()
        for a, b, c in zip(data, data[1:], data[2:], strict=False):
            plain[(((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 21] += 1
        assert np.allclose(row, [np.log1p(plain[i]) for i in range(quality.DIMS)], atol=1e-6)
    model = quality.Voters(counts, labels, rank=20, neighbours=7, power=4.0)
    got = model.score(pa.array(texts))
    for i, text in enumerate(texts):
        if text:
            v = model.vector(counts[i : i + 1])[0]
            cosine = [round(sum(a * b for a, b in zip(v, w, strict=True)), 9) for w in model.vectors]
            near = sorted(range(len(labels)), key=lambda j: (-cosine[j], j))[:7]
            weight = [max(cosine[j], 1e-6) ** 4 for j in near]
            assert abs(got[i] - sum(w * labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight)) < 1e-6


def test_machine_is_its_formula():
    r = np.random.default_rng(3)
    machine = toxicity.Machine(np.arange(50), rank=3)
    machine.bias, machine.w, machine.v = 0.3, r.normal(size=50), r.normal(size=(50, 3))
    rows = [r.choice(50, int(r.integers(0, 9)), replace=False) for _ in range(20)]
    owner = np.repeat(np.arange(20), [len(x) for x in rows])
    z, _ = machine.margin(owner, np.concatenate(rows), 20)
    for row, got in zip(rows, z, strict=True):
        plain = machine.bias + machine.w[row].sum() + sum(machine.v[i] @ machine.v[j] for k, i in enumerate(row) for j in row[k + 1 :])
        assert abs(got - plain) < 1e-9


def test_toxicity_learns_pairs_that_a_linear_model_cannot(spark):
    """Toxic: both of two terms or neither; each term alone is as frequent in toxic as in clean texts."""
    r = random.Random(4)
    words = ["".join(r.choices("bcdfghjklm", k=3)) for _ in range(60)]
    rows, labels = [], []
    for i in range(1600):
        a, b = i & 1, (i >> 1) & 1
        rows.append((i, " ".join([*r.choices(words, k=8), *(["zap"] if a else []), *(["qux"] if b else [])])))
        labels.append((i, int(a == b)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id < 1200"), lab)
    test = [(t, y) for (i, t), (_, y) in zip(rows, labels, strict=True) if i >= 1200]
    score = model.score(pa.array([t for t, _ in test]))
    y = np.array([y for _, y in test])
    assert ((score > 0.5) == y).mean() > 0.95
    model.v[:] = 0  # what is left is linear
    assert ((model.score(pa.array([t for t, _ in test])) > 0.5) == y).mean() < 0.65


def test_language_counts(monkeypatch):
    """The bit-sliced filters against plain sets: what a filter contains beyond its set is a false positive, and corrected for."""
    texts = ["The house, the Thing", "der Straße und", "le garçon", "", None, "123", "x" * 9]
    owner, code = langid.grams(pa.array(texts))
    plain = defaultdict(Counter)
    for i, t in enumerate(texts):
        joined = b"".join(w + b"\0" for w in re.findall(rb"[a-z\x80-\xff]+", (t or "").lower().encode()))
        padded = b"\0" + joined
        for n in (3, 4):
            for k in range(len(padded) - n + 1):
                if padded[k + 1]:
                    plain[i][int.from_bytes(padded[k : k + n]) | (0xFF000000 if n == 3 else 0)] += 1
    inner = {i: Counter(code[owner == i].tolist()) for i in range(len(texts))}
    assert {i: sum(c.values()) for i, c in inner.items() if i} == {i: sum(plain[i].values()) for i in inner if i}
    sets = {"a": np.unique(code[owner == 0]), "b": np.unique(code[owner == 1]), "c": np.unique(code[owner == 2])}
    model = langid.Filters(sets, "a")
    total, right = model.counts(pa.array(texts))
    for i in range(len(texts)):
        for k, lang in enumerate(model.langs):
            seen = sum(n for g, n in inner[i].items() if g in set(sets[lang].tolist()))
            wrong = model.wrong[k]
            assert right[i, k] >= max(0.0, seen - total[i] * wrong) / (1 - wrong) - 1e-9
            assert abs(right[i, k] - seen) <= 3
    assert model.decide(pa.array(texts))[0] == ["a", "b", "c", "und", "und", "und", "a"]


def test_sharding_is_the_greedy_dot_product():
    """``place`` against a plain loop over the shards; and the law: sizes near equal."""
    r = random.Random(6)
    units = [(f"u{i:03}", r.randint(1, 900), r.randint(1, 200), r.randint(1, 9)) for i in range(300)]
    got = sharding.place(units, 5)
    sums = [sum(u[d] for u in units) for d in (1, 2, 3)]
    left = [[1.0] * 3 for _ in range(5)]
    for name, *v in sorted(units, key=lambda u: (-max(x / s * 5 for x, s in zip(u[1:], sums, strict=True)), u[0])):
        share = [x / s * 5 for x, s in zip(v, sums, strict=True)]
        fits = [s for s in range(5) if left[s][0] - share[0] >= 1 - 1.0005]
        s = max(fits, key=lambda s: (sum(a * b for a, b in zip(left[s], share, strict=True)), -s)) if fits else max(range(5), key=lambda s: (left[s][0], -s))
        assert got[name] == s
        left[s] = [a - b for a, b in zip(left[s], share, strict=True)]
    load = Counter()
    for name, size, *_ in units:
        load[got[name]] += size
    assert max(load.values()) - min(load.values()) <= 900


def test_sharding_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 7), (1, "a b", "y", 7), (2, None, "x", 7), (3, "", "x", 7), (4, "w " * 100_000, "x", 7)], "doc_id long, text string, shard string, size int")
    rows = sharding.assign(docs, shards=2).collect()
    assert len(rows) == 5 and sorted(r["size"] for r in rows) == [1, 1, 4, 4, 200_001] and all(r.shard in (0, 1) for r in rows)
    assert sharding.assign(docs.limit(0), shards=2).collect() == []


STORY = "A long paragraph, with several marks; and many words, so that nobody takes it for a card. " * 3


def test_pages_without_article_need_the_threshold(monkeypatch):
    links = "".join(f"<li><a>Link {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{links}</ul></div><div class=c1><p>{STORY}</p><p>{STORY}</p></div><div><span>Share this</span></div></body>"
    assert html_extract.main_text(page).splitlines() == [STORY.strip()] * 2
    monkeypatch.setattr(html_extract, "LEAST", 0.0)
    assert len(html_extract.main_text(page).splitlines()) > 2


def test_article_text_is_not_dropped_for_its_class_names():
    page = f'<article><h1>Head</h1><div class="share-price"><p>The share price rose, {STORY}</p></div><p class="search-results notice-board">{STORY}</p></article>'
    assert html_extract.main_text(page).splitlines() == ["Head", f"The share price rose, {STORY}".strip(), STORY.strip()]


def test_hostile_pages_take_linear_time():
    pages = {
        "quotes": "<a " + '"x' * 60, "many quotes": "<a " + '"x' * 60_001 + ">", "unclosed tags": "<a " * 60_000, "tags in quotes": '<a "' * 60_001 + '">', "deep": "".join(f"<div>text {i}, and more." for i in range(4000)),
        "ends": "<div>" * 5000 + "</x>" * 50_000, "comments": "<!--" * 50_000, "scripts": "<script>" * 50_000, "attributes": "<p " + 'a=" ' * 50_001 + ">x</p>", "signs": "<" * 200_000,
    }
    for name, page in pages.items():
        began = time.time()
        html_extract.main_text(f"<p>{STORY}</p>{page}")
        assert time.time() - began < 3, name


def test_long_page_and_empty_table(spark):
    page = "<article>" + "".join(f"<p>{i} {STORY}</p>" for i in range(5000)) + "</article>"
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert html_extract.extract(df).select(F.size(F.split("text", "\n"))).first()[0] == 5000
    assert html_extract.extract(df.limit(0)).collect() == []
