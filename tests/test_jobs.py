import difflib

from conftest import SF
from pyspark.sql import functions as F

from secdata.operators import evidence, lines, propagate, taxonomy
from secdata.plans import curation, recovery


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_blank_commits_never_share_labels(spark):
    rows = spark.createDataFrame([(1, None, "", "CVE-2020-1111", None), (2, None, "", None, None), (3, "sha:a", "", "CVE-2020-2222", None), (4, "sha:a", "", None, None)], "sample_id long, k string, commit_link string, cve_id string, cwe_id string")
    rows = rows.withColumns({"commit_key": F.coalesce("k", F.lit("")), "cve_source": F.lit(None).cast("string"), "cwe_source": F.lit(None).cast("string")})
    got = {r.sample_id: r.cve_id for r in propagate.propagate_same_commit(rows).collect()}
    assert got == {1: "CVE-2020-1111", 2: None, 3: "CVE-2020-2222", 4: "CVE-2020-2222"}


def test_propagation_is_idempotent_and_loses_nothing(spark):
    rows = recovery.samples(spark, SF)
    once = propagate.propagate_same_commit(rows)
    assert propagate.stage_diff(rows, once).first()["lost"] == 0
    diff = propagate.stage_diff(once, propagate.propagate_same_commit(once)).first()
    assert (diff["new_cve"], diff["new_cwe"]) == (0, 0)


def test_match_targets(spark):
    full = "ab" * 20
    other = "abababa" + "c" * 33
    targets = spark.createDataFrame([(full, (1, 0)), (full[:7], (2, 0)), (other[:9], (3, 0))], "target string, rank struct<sample_id:long,pos:int>")
    shas = spark.createDataFrame([(full,), (other,), ("d" * 40,)], "sha string")
    # A whole target wins alone; among short ones the first inserted.
    assert {r.sha: r.target for r in evidence.match_targets(shas, targets).collect()} == {full: full, other: full[:7]}


def test_alignment_round_trip(spark):
    before, after = "int f(int a,\n      int b)\n{\n  x();\n\n  return 1; // one\n}", "int f(int a,\n      int b)\n{\n  y();\n  z();\n\n  return 1;\n}"
    pairs = spark.createDataFrame([("k", before, after, "c"), ("e", "", None, "c")], "key string, before string, after string, lang string")
    rows = sorted(lines.align(pairs).where("key = 'k'").collect(), key=lambda r: r.union_line)
    assert [r.before_text for r in rows if r.in_before] == lines.strip_comments(before, "c").splitlines()
    assert [r.after_text for r in rows if r.in_after] == lines.strip_comments(after, "c").splitlines()
    assert not any(r.is_added and r.is_removed for r in rows)
    assert {r.union_line for r in rows if r.is_sig} == {1, 2, 3}
    matcher = difflib.SequenceMatcher(None, lines.strip_comments(before, "c").splitlines(), lines.strip_comments(after, "c").splitlines(), autojunk=False)
    assert sum(r.is_removed for r in rows) == sum(i2 - i1 for t, i1, i2, _, _ in matcher.get_opcodes() if t in ("replace", "delete"))


def test_classes(spark):
    tree = curation.tree(spark)
    cwes = spark.createDataFrame([("CWE-125",), ("CWE-770",), ("CWE-384",), ("CWE-17",), ("CWE-990",), ("CWE-991",), ("CWE-abc",), ("CWE-639",), ("CWE-754",)], "cwe string")
    got = {r.cwe: (r.classes, r.rule) for r in taxonomy.classify(cwes, tree, taxonomy.CLASSES).collect()}
    assert got["CWE-125"] == (["BND"], "2_category_699")
    assert got["CWE-770"] == (["BND"], taxonomy.NEAR)
    assert got["CWE-384"] == (["PRT"], taxonomy.OVERRIDDEN)
    assert got["CWE-17"] == ([], taxonomy.NOTHING)
    assert got["CWE-990"] == (["BND"], taxonomy.DOWN)
    assert got["CWE-991"] == (["BND"], taxonomy.REDIRECTED)
    assert got["CWE-abc"] == ([], taxonomy.INVALID)
    assert got["CWE-639"] == (["PRT"], taxonomy.DIRECT)
    assert got["CWE-754"][1] == taxonomy.DOWN


def test_prune(spark):
    rows = spark.createDataFrame([(1, "CWE-119;CWE-787"), (2, "CWE-416;CWE-502"), (3, None)], "i int, cwes string")
    got = {r.i: r.cwe_pruned for r in taxonomy.prune_ancestors(rows, "cwes", curation.tree(spark)["parent"]).collect()}
    assert got == {1: "CWE-787", 2: "CWE-416;CWE-502", 3: ""}


def test_items_keep_their_digits(spark):
    rows = spark.createDataFrame([("CWE-770, CWE-131;CWE-20 x",), ("CWE-20",), (None,)], "v string")
    assert [r[0] for r in rows.select(taxonomy.cwe_items(F.col("v"))).collect()] == [["CWE-770", "CWE-131", "CWE-20"], ["CWE-20"], None]
