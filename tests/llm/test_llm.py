"""The operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from secdata.llm import decontaminate, html_extract, jaccard_join, langid, mixing, quality, sharding, toxicity

WORDS = [f"w{i}" for i in range(300)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(seed=0):
    r = random.Random(seed)
    base = [" ".join(r.choice(WORDS) for _ in range(r.choice([0, 1, 3, 4, 5, 9, 20, 60, 200]))) for _ in range(60)]
    out = list(base)
    for t in base:
        w = t.split()
        for _ in range(3):
            v = list(w)
            for _ in range(r.choice([0, 1, 2, 6])):
                if v:
                    v[r.randrange(len(v))] = r.choice(WORDS)
            out.append(" ".join(v))
    hot = [r.choice(WORDS) for _ in range(80)]
    for _ in range(60):  # near copies of one text, and exact ones
        v = list(hot)
        v[r.randrange(80)] = r.choice(WORDS)
        out.append(" ".join(v).upper())
    return out + [None, "", " \t\n", "ü" * 50, " ".join(WORDS * 40)] + [base[7]] * 5


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}", i, 1.0, "x") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, class long, score double, n_words string")


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate(LOWER)) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            u = len(sets[a] | sets[b])
            if u and 100 * len(sets[a] & sets[b]) >= 75 * u and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_join(docs):
    got = {r.doc: (r.n, r.component) for r in jaccard_join.components(docs).collect()}
    expected = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert got == expected
    kept = {r.doc_id for r in jaccard_join.keep_one(docs).collect()}
    assert kept == {i for i, (_, c) in expected.items() if i == c}


def test_decontamination(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    long = [r.text for r in rows if r.text and len(r.text.split()) > 25]
    items = [(1, " ".join(long[0].split()[3:18])), (2, long[1].upper()), (3, "w1 w2"), (4, None), (5, ""), (6, "never seen words at all in any text here ok yes"), (2, "w7")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    for block in (8 << 20, 40):  # one block, and several
        got = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in decontaminate.find_windows(docs, bench, block_bytes=block).collect()}
        for r in rows:
            w = word.findall((r.text or "").translate(LOWER))
            hit, found = set(), set()
            for win, ids in windows.items():
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit.update(range(k, k + len(win)))
                        found |= ids
            assert got[r.doc_id] == (len(w), len(hit), sorted(found))
    clean = decontaminate.remove_contaminated(docs, bench)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == {i for i, x in got.items() if x[1] == 0}


def test_sharding(docs):
    rows = sharding.assign(docs, shards=4).collect()
    assert len(rows) == docs.count()
    load, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 1
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        if r.text:
            where[r.text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(r["size"] for r in rows)
    assert max(load.values()) - min(load.values()) <= longest
    assert all(len(s) == 1 for t, s in where.items())


def test_sharding_splits_only_what_exceeds_a_shard(spark):
    df = spark.createDataFrame([(i, "same text " * 20 if i < 60 else f"text {i} " * 20) for i in range(100)], "doc_id long, text string")
    load = Counter()
    for r in sharding.assign(df, shards=4).collect():
        load[r.shard] += r["size"]
    assert max(load.values()) <= 1.35 * min(load.values())


def test_mixing(spark):
    rows = [(i, "hot" if i < 600 else f"s{i % 4}", "a b c " * (1 + i % 5)) for i in range(1000)] + [(2000 + i, None, "x y z " * 5) for i in range(60)] + [(3001, "hot", None), (3002, "hot", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, entropy=0.98, repeats=2.0).collect()
    total = sum(len(t.strip("\n").split(" ")) for _, _, t in rows if t)
    assert total * 0.95 <= sum(r.tokens for r in got) <= total
    share = Counter()
    for r in got:
        share[r.source] += r.tokens
    assert share["hot"] < 0.5 * total
    counts = Counter((r.doc_id, r.epoch) for r in got)
    assert max(counts.values()) == 1 and max(r.epoch for r in got) <= 1
    assert mixing.mix(df.limit(0)).count() == 0
    once = mixing.mix(df, entropy=0.98, repeats=1.0, budget_part=None).collect()
    assert max(Counter(r.doc_id for r in once).values()) == 1


def test_small_sources_do_not_set_the_budget(spark):
    rows = [(i, "big" if i < 500 else f"s{i % 20}", "a b c d") for i in range(1000)]
    kept = {}
    for name, more in (("without", []), ("null", [(5000, None, "x")]), ("tiny", [(5000, "tiny", "x"), (5001, None, "y")])):
        got = mixing.mix(spark.createDataFrame(rows + more, "doc_id long, source string, text string"), entropy=0.9, repeats=1.0, budget_part=None).collect()
        assert max(Counter(r.doc_id for r in got).values()) == 1
        assert {r.doc_id for r in got} >= {i for i, _, _ in more}
        kept[name] = sum(r.tokens for r in got) / 4000
        share = Counter(r.source for r in got)
        assert share["big"] / len(got) < 0.45 and min(share[f"s{i}"] for i in range(20)) >= 24
    assert min(kept.values()) >= 0.69, kept
    many = rows + [(5000 + i, f"t{i}", "x") for i in range(300)]
    got = mixing.mix(spark.createDataFrame(many, "doc_id long, source string, text string"), entropy=0.9, repeats=1.0, budget_part=None).collect()
    assert sum(r.tokens for r in got) >= mixing.LEAST_PART * 4300 - 25 * 4


def test_language_id(spark):
    r = random.Random(3)
    langs = {"en": ["the", "and", "with", "house", "thing"], "de": ["der", "und", "mit", "straße", "ding"], "fr": ["le", "et", "avec", "maison", "garçon"]}
    rows = [(i, " ".join(r.choice(langs[k]) for _ in range(20)), k) for i, k in enumerate(list(langs) * 40)] + [(900, None, "en"), (901, "123 ...", "en"), (902, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.predict(df.withColumn("score", F.lit("clash")), langid.fit(df)).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:120])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert all(0 <= x.score <= 1 for x in got.values())
    assert langid.predict(df.limit(0), langid.fit(df.limit(0))).count() == 0


def test_classifiers(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(200):
        bad = i % 4 == 0
        rows.append((i, " ".join([r.choice(WORDS) for _ in range(30)] + (["idiot!!!", "STUPID***"] if bad else [])) + ("!!!***" * 20 if bad else ".")))
        labels.append((i, int(not bad), int(bad)))
    rows += [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        got = {x.doc_id: x for x in quality.score(df, module.fit(df, lab, column)).collect()}
        truth = {i: (q if column == "quality" else t) for i, q, t in labels}
        assert sum(got[i].predicted == truth[i] for i in truth) >= 190
        assert all(0 <= x.score <= 1 for x in got.values()) and len(got) == 202
        assert quality.score(df.limit(0), module.fit(df, lab.limit(0), column)).count() == 0


def test_html(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a>Menu</a></nav><div class="cookie-notice">We use cookies.</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>First   line,
 with text.<br><p>Second &eacute;.</p><ul><li>one<li>two</ul><form><p>sign up</p></form><script>var a = "</p>";</script><div class="comments"><p>Nice post!</p></div></article>
    <aside>More</aside><div id="ad-1">Buy now.</div><footer>&copy; 2024</footer></body></html>"""
    plain = "<body><div class=menu><a>a</a></div><div><p>A long paragraph, with several marks; and words.</p><h2>Short</h2><p>Another long paragraph, with marks.</p></div><div><a>x</a></div></body>"
    df = spark.createDataFrame([(1, page, "a"), (2, None, "b"), (3, "", "c"), (4, plain, "d"), (5, "<p>unclosed <b>text", "e")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[1] == "Head & line\nFirst line, with text.\nSecond é.\none\ntwo"
    assert got[2] == got[3] == ""
    assert got[4] == "A long paragraph, with several marks; and words.\nShort\nAnother long paragraph, with marks."
    assert got[5] == "unclosed text"


def test_html_ratios_decide():
    story = "A long paragraph, with several marks; and many words, so that nobody takes it for a card. " * 3
    menu = "<nav><a>Home</a></nav><footer>Copyright, all rights reserved.</footer>"
    cards = "".join(f"<article><p>Card {i}</p></article>" for i in range(4))
    got = html_extract.main_text(f"<body>{menu}<div><p>{story}</p><p>{story}</p></div><div>{cards}</div></body>")
    assert got.splitlines() == [story.strip()] * 2
    for attribute in ('style="overflow:hidden"', 'data-id="search"', 'class="content widget-free"', 'title="hidden id=search"'):
        assert html_extract.main_text(f"<body>{menu}<article><div {attribute}><p>{story}</p></div></article></body>") == story.strip(), attribute
    for tag in ("form", 'div class="search widget"'):  # declared to be something else, but clearly content
        assert html_extract.main_text(f"<body><div>Home</div><{tag}><p>{story}</p><p>{story}</p></{tag.split()[0]}></body>").splitlines() == [story.strip()] * 2
    assert html_extract.main_text(f'<body><p>{story}<span class="ad">Buy now!</span> End.</p><p hidden>{story * 9}</p></body>') == f"{story}End."


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = [r.doc_id for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        kept = [r.doc_id for r in after.collect()]
        assert set(kept) <= set(before) and len(kept) == len(set(kept))
        if name != "sharding":
            assert sorted(after.columns) == sorted(docs.columns)
        if name == "near_duplicates":
            assert set(kept) == {i for i, (_, c) in brute_components(before.items()).items() if i == c}
        docs = after
    assert 0 < docs.count() < len(ids)
    assert corpus_pipeline.run(spark, sf).count() == docs.count()
