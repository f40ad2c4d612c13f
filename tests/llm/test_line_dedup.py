"""Fuzzy line deduplication against all pairs of lines by their edit similarity alone."""

import random
from collections import defaultdict

import numpy as np
import pytest

from secdata.llm import line_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def edits(a, b, most):
    """The edit distance, or ``most`` + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            row[j] = min(row[j - 1] + 1, last[j] + 1, last[j - 1] + (x != b[j - 1]))
        if min(row) > most:
            return most + 1
    return row[-1]


def similar_pairs(kinds, least=0.9):
    """All pairs of the distinct lines with the edit similarity ``least``. An edit changes at most two counts of letters, which passes over most pairs."""
    kinds = sorted(kinds, key=len)
    size = np.array([len(k) for k in kinds])
    letters = np.array([np.bincount(np.frombuffer(k.encode("latin-1"), np.uint8), minlength=256) for k in kinds], np.int32)
    for i, a in enumerate(kinds):
        others = np.arange(i + 1, np.searchsorted(size, size[i] / least + 1e-9, "right"))
        apart = np.abs(letters[others] - letters[i]).sum(1)
        for j in others[apart <= 2 * (1 - least) * size[others] + 1e-9]:
            most = int((1 - least) * size[j] + 1e-9)
            if edits(a, kinds[j], most) <= most:
                yield a, kinds[j]


def lines_of(rows):
    return [(i, k, line_dedup.normalised(t)) for i, x in rows if x is not None for k, t in enumerate(x.split("\n")) if line_dedup.normalised(t)]


def test_dropped_lines(spark):
    r = random.Random(5)
    vocab = ["".join(r.choices(LETTERS, k=r.randint(3, 9))) for _ in range(400)]
    base = [" ".join(r.choice(vocab) for _ in range(n)) for n in (40, 40, 30, 30, 70, 100, 60, 150)]
    rows = []
    for i in range(40):
        ls = []
        for _ in range(4):
            v = r.choice(base).split()
            if r.random() < 0.6:
                v[r.randrange(len(v))] = r.choice(vocab)
            ls.append(" ".join(v).upper() + "!")
        rows.append((i, "\n".join([*ls, "", "---", "the end"])))
    rows += [(100, None), (101, ""), (102, rows[1][1]), (103, "\n" * 50), (104, "\n".join(["all the same 17"] * 30)), (105, "word " * 60_000)]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows] + [(None, rows[2][1], "x", 1, 2)], "doc_id long, text string, class string, line int, sigs int")
    lines = lines_of(rows)
    parent = {t: t for _, _, t in lines}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in similar_pairs(parent):
        parent[find(a)] = find(b)
    first, expected = {}, defaultdict(list)
    for i, k, t in sorted(lines):
        if first.setdefault(find(t), (i, k)) != (i, k):
            expected[i].append(k)
    assert {x.doc: x.dropped for x in line_dedup.dropped_lines(df).collect()} == dict(expected)
    out = {x.doc_id: x for x in line_dedup.dedup_lines(df).collect()}
    assert out[100].text is None and out[101].text == "" and out[102].text == "\n---" and out[103].text == "\n" * 50 and out[104].text == "all the same 17"
    assert len(out) == len(rows) + 1 and out[3].sigs == 2
    assert line_dedup.dedup_lines(df.limit(0)).collect() == [] and line_dedup.dropped_lines(df.limit(0)).collect() == []


def test_recall(spark):
    """At least nine tenths of all similar pairs of lines end up in one group, and so do lines with one changed letter or word."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds = sorted({t for _, _, t in lines_of([(r.doc_id, r.text) for r in docs.collect()]) if 20 <= len(t) <= 300})
    pairs = list(similar_pairs(kinds))
    r = random.Random(2)
    changed = []
    for t in r.sample(kinds, 800):
        b = list(t)
        b[r.choice([k for k, c in enumerate(t) if "a" <= c <= "z"] or [0])] = r.choice(LETTERS)
        w = t.split()
        w[r.randrange(len(w))] = r.choice(r.choice(kinds).split())
        changed += [("letter", t, "".join(b)), ("word", t, " ".join(w))]
    changed = [(name, a, b) for name, a, b in changed if a != b and edits(a, b, int(0.1 * max(len(a), len(b)))) <= 0.1 * max(len(a), len(b))]
    texts = [t.encode("latin-1").decode("utf-8", "replace") for t in {*kinds, *(b for _, _, b in changed)}]
    whole = [t for t in texts if line_dedup.normalised(t).encode("latin-1") == t.encode()]  # edits inside a letter of several bytes aside
    df = spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string")
    root = {line_dedup.normalised(whole[x.doc]): x.root for x in line_dedup.line_classes(df).collect()}

    def recall(found):
        found = [(a, b) for a, b in found if a in root and b in root]
        return len(found), sum(root[a] == root[b] for a, b in found) / len(found)

    measured = {"all pairs": recall(pairs), "letter": recall([(a, b) for n, a, b in changed if n == "letter"]), "word": recall([(a, b) for n, a, b in changed if n == "word"])}
    print(measured)
    assert all(n >= 60 and share >= 0.9 for n, share in measured.values()), measured


@pytest.mark.parametrize("least", [0.9, 0.8])
def test_short_lines_lose_no_link(spark, least):
    """Lines for which ``least`` allows one edit: every similar pair of them is in one group, whatever the edit and its place; dissimilar lines are only there by chains."""
    r = random.Random(5)
    shortest, two, _ = line_dedup.edit_lengths(least)
    kinds = set()
    for n in range(max(2, shortest - 2), two + 2):
        for _ in range(16):
            a = r.choice("abcdefgh") + "".join(r.choices("abcdefgh ", k=n - 2)) + r.choice("abcdefgh")
            k = r.randrange(n)
            for b in (a, a[:k] + r.choice("abcé") + a[k + 1 :], a[:k] + a[k + 1 :], a[:k] + r.choice("xyz ") + a[k:], a[1:], a + "q"):
                kinds.add(line_dedup.normalised(b))
    kinds = sorted(t for t in kinds if t)
    whole = [t.encode("latin-1").decode("utf-8") for t in kinds]
    df = spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string")
    root = {kinds[x.doc]: x.root for x in line_dedup.line_classes(df, least=least).collect()}
    parent = {t: t for t in kinds}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    n = 0
    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            most = int(np.floor((1 - least) * max(len(a), len(b)) + 1e-9))
            if max(len(a), len(b)) < two and abs(len(a) - len(b)) <= most and edits(a, b, most) <= most:
                n += 1
                assert root[a] == root[b], (a, b)
                parent[find(a)] = find(b)
    assert n > 250
    short = [t for t in kinds if len(t) < two - 2]  # these have no links that the loop left out
    groups = defaultdict(set)
    for t in short:
        groups[root[t]].add(find(t))
    linked_up = {root[t] for t in kinds if len(t) >= two - 2}
    assert all(len(g) == 1 for k, g in groups.items() if k not in linked_up)


def test_recall_by_length(spark):
    """One changed letter, by the length of the line: none is lost below 20 bytes, nine tenths are found above."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds = sorted({t for _, _, t in lines_of([(r.doc_id, r.text) for r in docs.collect()]) if t.isascii()})
    r, cut = random.Random(3), random.Random(4)
    bands, pairs = ((10, 14), (15, 19), (20, 40), (41, 300), (301, 5000)), defaultdict(list)
    for low, high in bands:
        some = [t for t in kinds if low <= len(t) <= high]
        # Beginnings of longer lines where the tables have few lines so short.
        some += [x for t in cut.sample([t for t in kinds if len(t) > high], 300) if (x := t[: cut.randint(low, high)].strip()) and low <= len(x)] if len(some) < 300 else []
        for t in r.sample(some, 300):
            b = list(t)
            b[r.choice([k for k, c in enumerate(t) if c != " "])] = r.choice("abcdefghijklmnopqrstuvwxyz")
            if "".join(b) != t:
                pairs[low].append((t, "".join(b)))
    whole = sorted({x for p in pairs.values() for ab in p for x in ab})
    df = spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string")
    root = {whole[x.doc]: x.root for x in line_dedup.line_classes(df).collect()}
    measured = {low: (len(p), sum(root[a] == root[b] for a, b in p) / len(p)) for low, p in pairs.items()}
    print(measured)
    assert all(n >= 100 and share >= (1 if low < 20 else 0.9) for low, (n, share) in measured.items()), measured


def test_bounded_edits():
    r = random.Random(1)
    for n in [*(r.randint(0, 40) for _ in range(1500)), *([300] * 20)]:
        a = bytes(r.choices(b"abc", k=n))
        b = bytearray(a)
        for _ in range(r.randint(0, 12 + n // 10)):
            k = r.randint(0, len(b))
            b[k : k + r.randint(0, 1)] = bytes(r.choices(b"abcd", k=r.randint(0, 1)))
        most = r.randint(0, 14 + n // 8)
        expected = min(edits(a, bytes(b), most), most + 1)
        assert line_dedup.bounded_edits(a, bytes(b), most) == expected
        assert line_dedup.few_edits(a, bytes(b), most) == (expected if expected <= most else None)
    a = bytes(r.choices(b"abcdefgh ", k=120_000))
    assert line_dedup.bounded_edits(a, a[:70_000] + b"zz" + a[70_001:] + b"y", 12_000) == 3


def test_letter_counts_bound_the_edit_distance(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from secdata.llm.text import Words

    r = random.Random(8)
    lines = ["".join(r.choices("abcxyz é", k=r.randint(0, 600))) for _ in range(60)] + ["a" * 400, "a" * 127, ""]
    packed = line_dedup.letter_counts(Words(pa.array(lines), line_dedup._SIGNS))
    rows = [(i, j, *map(int, packed[i]), *map(int, packed[j])) for i in range(len(lines)) for j in range(0, len(lines), 7)]
    names = line_dedup._LETTERS
    df = spark.createDataFrame(rows, ", ".join(["i int", "j int", *[f"x{c} long" for c in names], *[f"y{c} long" for c in names]]))
    df = df.select("i", "j", F.struct(*[F.col(f"x{c}").alias(c) for c in names]).alias("x"), F.struct(*[F.col(f"y{c}").alias(c) for c in names]).alias("y"))
    for row in df.select("i", "j", line_dedup._letters_apart("x", "y").alias("apart")).collect():
        counts = [np.bincount((np.frombuffer(line_dedup.normalised(lines[k]).replace(" ", "").encode("latin-1"), np.uint8) & 31) % 28, minlength=28) for k in (row.i, row.j)]
        assert row.apart == np.abs(np.minimum(counts[0], 127) - np.minimum(counts[1], 127)).sum()


def _compiled_sizes(spark, condition):
    from pyspark.sql import functions as F

    t = spark.range(100).select(F.col("id").alias("sig"), *[F.when(F.col("id") > 1, F.col("id")).alias(c) for c in line_dedup._LETTERS])
    joined = t.alias("x").hint("merge").join(t.alias("y"), (F.col("x.sig") == F.col("y.sig")) & condition)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = joined._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))


def test_the_counts_of_a_pack_are_compared_at_once(spark):
    """The largest and smallest counts in every place, and no more code than a few steps a pack."""
    from pyspark.sql import functions as F

    r = random.Random(4)
    rows = []
    for _ in range(400):
        a, b = ([r.choice([0, 1, 63, 64, 126, 127, r.randint(0, 127)]) for _ in range(28)] for _ in range(2))
        packs = [[sum(v << (8 * k) for k, v in enumerate(z[7 * i : 7 * i + 7])) for i in range(4)] for z in (a, b)]
        rows.append((*packs[0], *packs[1], sum(abs(p - q) for p, q in zip(a, b, strict=True))))
    rows += [(*[sum(127 << (8 * k) for k in range(7))] * 4, *[0] * 4, 28 * 127), (*[0] * 4, *[sum(127 << (8 * k) for k in range(7))] * 4, 28 * 127)]
    names = line_dedup._LETTERS
    df = spark.createDataFrame(rows, ", ".join([*[f"x{c} long" for c in names], *[f"y{c} long" for c in names], "want long"]))
    df = df.select("want", *[F.struct(*[F.col(f"{z}{c}").alias(c) for c in names]).alias(z) for z in "xy"])
    assert df.where(line_dedup._letters_apart("x", "y") != F.col("want")).count() == 0
    size = _compiled_sizes(spark, line_dedup._letters_apart("x", "y") <= 5)
    assert size < 7000, size


def test_many_pairs_are_decided_as_one_by_one():
    import pyarrow as pa

    from secdata.llm.text import flat_bytes

    r = random.Random(3)
    xs, ys, most = [], [], []
    for _ in range(3000):
        n = r.choice([0, 1, 5, 20, 63, 64, 65, 100, 127, 128, 129, 200, 300, 450, 700])
        a = bytes(r.choices(b"abcd ", k=n))
        b = bytearray(a)
        for _ in range(r.randint(0, 3 + n // 5)):
            k = r.randint(0, len(b))
            b[k : k + r.randint(0, 1)] = bytes(r.choices(b"abcde", k=r.randint(0, 1)))
        xs.append(a)
        ys.append(bytes(b))
        most.append(max(0, line_dedup.bounded_edits(a, bytes(b), 10**6) + r.choice([-30, -2, -1, 0, 1, 5, 50])))
    xs.append(b"word " * 2000)
    ys.append(b"word " * 1999 + b"wort ")
    most.append(1)
    sides = [(data, starts[:-1], np.diff(starts)) for data, starts in (flat_bytes(pa.array(v, pa.binary())) for v in (xs, ys))]
    expected = [line_dedup.bounded_edits(a, b, m) <= m for a, b, m in zip(xs, ys, most, strict=True)]
    assert line_dedup.within(*sides, np.array(most)).tolist() == expected
    assert [line_dedup.within(*((d, s[i : i + 1], n[i : i + 1]) for d, s, n in sides), np.array(most[i : i + 1]))[0] for i in range(0, 3000, 100)] == expected[:3000:100]


def test_normalised_bytes():
    import pyarrow as pa

    lines = ["", " ", "A b--C 17", "é Ü!", "end.", "...", "x"]
    assert line_dedup.normalised_bytes(pa.array(lines)).to_pylist() == [line_dedup.normalised(t).encode("latin-1") for t in lines]
    assert line_dedup.normalised_bytes(pa.array([], pa.string())).to_pylist() == []


def test_the_bound_on_letters_is_compiled(spark):
    """The JVM interprets methods of 8000 bytes and more."""
    from pyspark.sql import functions as F

    t = spark.range(100).select(F.col("id").alias("sig"), *[F.when(F.col("id") > 1, F.col("id")).alias(c) for c in line_dedup._LETTERS])
    joined = t.alias("x").hint("merge").join(t.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (line_dedup._letters_apart("x", "y") <= 5))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = joined._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    assert sizes and max(sizes) < 8000, sizes
