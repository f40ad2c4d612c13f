import hashlib
import math

import numpy as np
import pytest

from secdata.llm import queries
from secdata.llm.vector_codes import Cells, encode, fit

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def plain(rows, parts=4, rounds=4):
    """The same by the definition: every part against every entry, in Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:256]
    d = len(first[0][1]) // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            found = {}
            for _, v, _ in kept:
                found.setdefault(near(v, p)[1], []).append(cut(v, p))
            for k, vs in found.items():
                new[p][k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
        books = new
    out = []
    for i, v, lab in kept:
        got = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in got), sum(e for e, _ in got), lab))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def made(seed, n, d=8, spread=0.2):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, spread, d)], int(i) % 3 if i % 5 else None, "own") for i in rng.permutation(n)]
    rows += [(n + k, rows[0][1], 1, "own") for k in range(40)]  # copies
    rows += [(900 + n, None, 1, "x"), (901 + n, [None] * d, 1, "x"), (902 + n, [float("nan")] * d, 1, "x"), (903 + n, [float("inf")] + [0.0] * (d - 1), 2, "x"), (None, rows[1][1], None, "x"), (3, rows[2][1], 2, "x")]
    return rows


@pytest.mark.parametrize(("n", "cell"), [(400, None), (400, 16), (60, None)])
def test_equals_plain_integer_k_means(spark, n, cell):
    rows = made(n, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    books = fit(df, cell=cell)
    got = sorted((str(r["vec_id"]), r["code"], r["error"], str(r["label"])) for r in encode(df, books).collect())
    want, digest = plain(rows)
    assert got == sorted((str(i), c, e, str(lab)) for i, c, e, lab in want)
    assert books.sha256() == digest


def test_query_adds_errors_per_label(spark, tmp_path):
    rows = made(5, 300)
    spark.createDataFrame(rows, SCHEMA).drop("code").write.parquet(f"{tmp_path}/embeddings.parquet")
    want, digest = plain(rows)
    total = {}
    for _, _, e, lab in want:
        total[lab] = total.get(lab, 0) + e
    got = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got) == sorted((str(i), c, e, total[lab]) for i, c, e, lab in want)
    assert {r["codebooks_sha256"] for r in got} == {digest}


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_cells_are_exact_for_any_width_and_bound_their_memo(width):
    rng = np.random.default_rng(1)
    book, points = rng.integers(-300, 300, (50, 3)), rng.integers(-400, 400, (3000, 3))
    book[7] = book[3]  # a tie goes to the lower index
    points[:1000] = points[0]
    memo = Cells(book, width, most=64)
    code, error = memo.assign(points)
    apart = ((points[:, None] - book) ** 2).sum(2)
    assert (code == apart.argmin(1)).all() and (error == apart.min(1)).all()
    assert len(memo.place) <= 64
    if width == 64:
        assert memo.compared < 0.5 * apart.size and memo.cells < 3000


def test_empty_and_short_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert encode(none, fit(none)).count() == 0
    unusable = spark.createDataFrame([(1, None, 1, "x"), (2, [float("nan")], 1, "x"), (3, [], 1, "x")], SCHEMA)
    assert encode(unusable, fit(unusable)).count() == 0
    one = spark.createDataFrame([(1, [0.5, -0.25, 0.0, 1.0], None, "x"), (2, [0.5], 1, "x")], SCHEMA)
    assert [(r["vec_id"], r["code"], r["error"]) for r in encode(one, fit(one)).collect()] == [(1, "00000000", 0)]
    uneven = spark.createDataFrame([(1, [0.5, 0.1, 0.2], 1, "x"), (2, [0.5, 0.1, 0.9], 1, "x")], SCHEMA)
    assert {r["code"] for r in encode(uneven, fit(uneven)).collect()} == {"00000000", "00000001"}
    with pytest.raises(Exception, match="beyond"):
        fit(spark.createDataFrame([(1, [1e9] * 4, 1, "x")], SCHEMA))
