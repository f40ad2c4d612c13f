"""Line jobs against plain versions, on small hand-made pairs."""

import difflib
import time

from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from secdata.operators import lines, reports
from secdata.plans import curation

PAIRS = "key string, before string, after string, lang string"


def _plain(before, after):
    """(n_removed, n_added, the pairs of equal lines) by the standard diff."""
    a, b = before.splitlines(), after.splitlines()
    ops = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    kept = [(i + 1, j + 1) for t, i1, i2, j1, _ in ops if t == "equal" for i, j in zip(range(i1, i2), range(j1, j1 + i2 - i1), strict=True)]
    return len(a) - len(kept), len(b) - len(kept), kept


def test_alignment_with_repeated_lines_is_the_plain_diff(spark, monkeypatch):
    cases = {"blank": ("a\n\nb\n\nc\n\nd", "a\n\nc\n\nx\n\nd"), "same": ("x\nx\nx\ny\nx\nx", "x\nx\nz\ny\nx\nx\nx"), "none": ("", "a\na"), "long": ("q\nr\n" * 300, "q\n" + "q\nr\n" * 299 + "s")}
    monkeypatch.setattr(lines, "PIECE_CHARS", 5)  # every pair is a table of its own
    long = lines.align(spark.createDataFrame([(k, b, a, "lua") for k, (b, a) in cases.items()], PAIRS))
    rows = lines.renumber(long).orderBy("key", "union_line").collect()
    for k, (before, after) in cases.items():
        mine = [r for r in rows if r.key == k]
        removed, added, kept = _plain(before, after)
        assert (sum(r.is_removed for r in mine), sum(r.is_added for r in mine)) == (removed, added)
        assert [(r.before_line, r.after_line) for r in mine if r.in_before and r.in_after] == kept
        assert [r.before_text for r in mine if r.in_before] == before.splitlines()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("klmno"), max_size=6), st.lists(st.sampled_from("pqrst"), max_size=6))
def test_cutting_common_ends_changes_nothing(a, b, head, tail):
    a, b = head + a + tail, head + b + tail
    want = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()

    def kept(codes):
        return [(i, j) for t, i1, i2, j1, _ in codes if t == "equal" for i, j in zip(range(i1, i2), range(j1, j1 + i2 - i1), strict=True)]

    got = list(lines.opcodes(a, b))
    assert kept(got) == kept(want)
    assert sum(i2 - i1 for _, i1, i2, _, _ in got) == len(a) and sum(j2 - j1 for _, _, _, j1, j2 in got) == len(b)


def test_each_content_is_aligned_once_and_equals_the_plain_diff(spark, monkeypatch):
    """All documents, repeated lines and all, with copies, against the plain diff."""
    raw = curation._pairs(spark, SF, raw=True).select("key", "before", "after", "lang")
    copies = raw.where("cast(key AS long) % 3 = 0").selectExpr("'copy ' || key AS key", "before", "after", "lang")
    asked = []
    real = lines.align
    monkeypatch.setattr(lines, "align", lambda p, *a: asked.append(p.count()) or real(p, *a))
    pairs = raw.unionByName(copies)
    got = {}
    for r in lines.renumber(lines.align_distinct(pairs)).orderBy("key", "union_line").collect():
        got.setdefault(r.key, []).append(r)
    assert asked == [pairs.select("before", "after", "lang").distinct().count()]
    for p in pairs.collect():
        removed, added, kept = _plain(p.before, p.after)
        mine = got.get(p.key, [])
        assert (sum(r.is_removed for r in mine), sum(r.is_added for r in mine)) == (removed, added)
        assert [(r.before_line, r.after_line) for r in mine if r.in_before and r.in_after] == kept


def test_a_pair_of_100000_lines():
    a = [f"line {i}" for i in range(100_000)]
    b = [*a[:50_000], "new", *a[50_001:]]
    began = time.process_time()
    assert [c for c in lines.opcodes(a, b) if c[0] != "equal"] == [("replace", 50_000, 50_001, 50_000, 50_001)]
    assert time.process_time() - began < 2


def test_tabs_are_blanks(spark):
    long = lines.align(spark.createDataFrame([("k", "f()\n\tfoo();\n\t\nx", "f()\nx", "lua")], PAIRS))
    flaws = spark.createDataFrame([("k", "foo();"), ("k", "  \t")], "key string, text string")
    assert [r.union_line for r in lines.external_lines(long, flaws).collect()] == [2]
    none = spark.createDataFrame([], "key string, a int, b int, kind string"), spark.createDataFrame([], "key string, n_graph_lines int, n_cdg long, n_ddg long")
    _, found = lines.line_labels(spark.createDataFrame([("k", "f()\n\tfoo();\n\t\nx", "f()\nx", "lua")], PAIRS), long, *none)
    assert [r.union_line for r in found.collect()] == [2]  # the line of a tab alone is no label
    blank = spark.createDataFrame([("k", "\t\n", "x", "lua")], PAIRS)
    assert lines.gates(blank, lines.align(blank)).first().gate == "missing_code"
    rows = spark.createDataFrame([(["\ta"], ["a"])], "ours array<string>, theirs array<string>")
    assert lines.agreement(rows).first().relation == "exact"


def test_only_a_limit_leaves_pairs_out(spark):
    pairs = spark.createDataFrame([("k", "a\n" * 50, "a\n" * 50 + "b", "lua")], PAIRS)
    assert lines.align(pairs).count() == 51
    assert lines.align(pairs, max_lines=60).count() == 0


def test_comments_are_blanked_and_strings_stay():
    assert lines.strip_comments('x = "//a"; // b\n/* c\nd */ y', "c") == 'x = "//a"; \n\n y'
    assert lines.strip_comments("x = '#a' # b", "python") == "x = '#a' "
    assert lines.strip_comments("-- c", "lua") == "-- c"


def test_given_lines_and_dependences_less_the_signature(spark):
    before, after = "f(a)\nx\ny\nz", "f(a)\nx\nw\nz"
    rows = spark.createDataFrame([("k", before, after, "lua", [3]), ("s", before, after, "lua", [1, 3]), ("n", None, None, None, None)], PAIRS + ", deleted array<int>")
    # In the union view of 5 lines the added line is the fourth; it depends on the signature and on the last line.
    edges = spark.createDataFrame([(k, 4, b, "cdg") for k in "ks" for b in (1, 5)], "key string, a int, b int, kind string")
    sizes = spark.createDataFrame([(k, 5, 2, 0) for k in "ks"], "key string, n_graph_lines int, n_cdg long, n_ddg long")
    got = {r.key: r for r in lines.line_change_labels(rows, edges, sizes).collect()}
    assert got["k"].vul_lines_linevd == [1, 3, 4] and got["k"].vul_lines_final == [3, 4]
    assert got["s"].vul_lines_final == [1, 3, 4]
    assert (got["k"].removed_lines_fb, got["k"].depadd_lines_fb, got["k"].added_lines_fa) == ([3], [1, 4], [3])
    assert (got["k"].status, got["k"].label_completeness) == ("joern_ok", "full")
    assert (got["n"].status, got["n"].has_line_label, got["n"].label_completeness) == ("unsupported_language", False, "")


def test_one_row_a_sample_finds_what_the_long_table_does(spark):
    """All documents, repeated and blank lines and all, with random graphs, against joins by line; and pairs without code, or too long."""
    from pyspark.sql import functions as F

    pairs = curation._pairs(spark, SF, raw=True).select("key", F.regexp_replace("before", r"(?m)^(.{7}).*$", "$1").alias("before"), F.regexp_replace("after", r"(?m)^(.{7}).*$", "$1").alias("after"), "lang")
    pairs = pairs.withColumn("after", F.when(F.col("key").cast("long") % 5 == 0, F.regexp_replace("after", "[aeiou]", "y")).otherwise(F.col("after")))
    odd = [("-1", None, "x", "lua"), ("-2", "x\n" * 20_000, "x\n" * 20_000, "lua"), ("-3", " \t\n", "x", "lua"), ("-4", "x\n\t\ny", None, "lua"), ("-5", "x\n\t\nz\nq", "x\nz", "lua"), ("-6", "", "", None)]
    pairs = pairs.unionByName(spark.createDataFrame(odd, PAIRS)).localCheckpoint()
    seq = F.sequence(F.lit(0), F.lit(40))

    def edges(salt):
        return F.to_json(F.transform(seq, lambda i: F.array(F.pmod(F.hash("key", i, F.lit(salt)), F.lit(30)), F.pmod(F.hash("key", i, F.lit(salt + 1)), F.lit(30)))))

    graphs = pairs.where("cast(key AS long) % 4 <> 0").select("key", "lang", F.lit(2).alias("offset"), F.to_json(F.sequence(F.lit(0), F.lit(14))).alias("lines"), edges(1).alias("cdg"), F.when(F.col("key").cast("long") % 3 > 0, edges(7)).alias("rd"))
    graphs = graphs.localCheckpoint()
    long = lines.align(pairs, max_lines=4 * lines.MAX_LINES).localCheckpoint()
    status, found = lines.line_labels(pairs, long, *lines.graph_edges(graphs), 0.6, 1)
    numbers = {r.key: tuple(sorted(x or []) for x in r[1:]) for r in lines.renumbered(long, found).collect()}
    want = {r.key: (*r[1:], *numbers.get(r.key, ([],) * 4)) for r in status.collect()}
    names = (*status.columns[1:], "vul_lines_fb", "removed_lines_fb", "depadd_lines_fb", "added_lines_fa")
    rows = lines.align(pairs, max_lines=4 * lines.MAX_LINES, compact=True)
    got = {r.key: tuple(r[c] for c in names) for r in lines.sample_labels(rows, lines.graph_rows(graphs), 0.6, 1).collect()}
    assert got == want
    assert {"missing_code", "too_large", "diff_too_large", "no_change", "joern_ok", "ok_delete_only", "unsupported_language"} <= {v[0] for v in want.values()}
    assert sum(len(v[-2]) for v in want.values()) > 30
    sizes = {r.key: r for r in lines.graph_edges(graphs)[1].collect()}
    assert {r.key: r for r in lines.graph_rows(graphs).drop("edges").collect()} == sizes


def test_a_change_set_is_read_and_parsed_once(spark, monkeypatch):
    """Each document is asked for once: not again by each filter, column and join that needs a part of it."""
    from secdata.plans import fixtures

    asked = spark.sparkContext.accumulator(0)
    real = fixtures.frame

    def frame(*args):
        def count(batches):
            for b in batches:
                asked.add(b.num_rows)
                yield b

        made = real(*args)
        return made.mapInArrow(count, made.schema)

    pairs = curation._pairs(spark, SF).count()
    monkeypatch.setattr(fixtures, "frame", frame)
    assert curation.v10_line_changes(spark, SF).count() == pairs
    assert asked.value == pairs


def test_merge_keeps_all_samples(spark):
    rows = spark.createDataFrame([("a", "c", True), ("b", "c", None), ("d", "go", False)], "key string, lang string, has_bigvul_lines boolean")
    assert {r.key for r in lines.to_label(rows).collect()} == {"b", "d"}
    assert {r.key for r in lines.to_label(rows, ["c"], every=True).collect()} == {"a", "b"}
    results = spark.createDataFrame([("b", "joern_ok", 2), ("d", "no_change", 0)], "key string, status string, n_vul long")
    got = {r.key: (r.status, r.derived_ok) for r in lines.merge_results(rows, results).collect()}
    assert got == {"a": ("skipped_has_bigvul", False), "b": ("joern_ok", True), "d": ("no_change", False)}


def test_one_row_per_hash_and_key(spark):
    ref = spark.createDataFrame([("h", None, 1, "a", 1), ("h", "x", 0, "b", 2), ("h", "y", 1, "c", 3), ("h", "z", 1, "c", 4), (None, "w", 1, "a", 0)], "h string, lines_before string, vul int, file string, pos int")
    assert [r.lines_before for r in lines.dedupe_reference(ref).collect()] == ["y"]
    a = spark.createDataFrame([("k", 1), ("k", None), ("j", 5)], "sample_key string, load int")
    b = spark.createDataFrame([("k", 2)], "sample_key string, load int")
    assert sorted(tuple(r) for r in lines.keep_last(a, b).collect()) == [("j", 5), ("k", 2)]


def test_agreement_trims(spark):
    rows = spark.createDataFrame([([" a", "b "], ["a", "b"]), (["a", "b"], ["b"]), (["a"], ["a", "b"]), (["a"], ["c"])], "ours array<string>, theirs array<string>")
    assert {r.relation: r.n for r in lines.agreement(rows).collect()} == {"exact": 1, "subset": 1, "overlap": 1, "disjoint": 1}
    assert reports.origin_share(spark.createDataFrame([(True, True), (False, True)], "from_removed boolean, from_depadd boolean")).first() == (1, 1)
    assert set(curation.QUERIES) >= {"v10_line_changes", "j15_u6_merge", "v8_renumbered"}
