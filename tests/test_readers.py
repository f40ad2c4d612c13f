"""Readers and writers over real files."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from secdata.operators import taxonomy
from secdata.sources import readers, sinks


def _write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_samples_are_numbered_over_the_declared_order(spark, tmp_path):
    spark.range(1000).select((999 - F.col("id")).alias("x")).write.parquet(str(tmp_path / "s"))
    got = readers.read_samples(spark, str(tmp_path / "s"), ["x"]).collect()
    assert sorted((r.sample_id, r.x) for r in got) == [(i, i) for i in range(1000)]
    with pytest.raises(ValueError):
        readers.read_samples(spark, str(tmp_path / "s"))
    spark.range(3).select(F.col("id").alias("sample_id")).write.parquet(str(tmp_path / "t"))
    assert readers.read_samples(spark, str(tmp_path / "t")).columns == ["sample_id"]


def test_numbering_of_many_ties_is_row_number(spark, monkeypatch):
    rows = spark.range(100_000).select((F.col("id") % 7).alias("x"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("y"), F.lit("same").alias("z"), (F.col("id") % 50).alias("w"))
    made = []
    real = sinks.stage_table
    monkeypatch.setattr(sinks, "stage_table", lambda df, *a, **k: made.append(real(df, *a, **k)) or made[-1])
    numbered = readers.number_rows(rows, ["z", "y"], range_rows=5000)
    got = numbered.collect()
    assert len(made) == 1 and made[0].select("__r").distinct().count() > 10  # one evaluation of the bounds
    assert made[0].groupBy("__r").count().agg(F.max("count")).first()[0] < 20_000  # 33 334 rows tie
    want = rows.withColumn("h", F.xxhash64("x", "y", "z", "w")).withColumn("sample_id", F.row_number().over(Window.orderBy("z", "y", "h")) - 1).collect()
    assert sorted((r.sample_id, r.y) for r in got) == sorted((r.sample_id, r.y) for r in want)
    assert sorted(r.sample_id for r in got) == list(range(100_000))
    # Rows that differ get the same numbers again; only rows that are alike in all columns may swap theirs.
    assert sorted((r.sample_id, r.x, r.w) for r in got) == sorted((r.sample_id, r.x, r.w) for r in want)


def test_advisory_files(spark, tmp_path):
    osv = {"id": "GHSA-1", "aliases": ["CVE-2020-1234"], "references": [{"type": "FIX", "url": "u"}], "affected": [{"ranges": [{"type": "GIT", "repo": "r", "events": [{"introduced": "0"}, {"fixed": "ab"}]}], "database_specific": {"CWE": {"id": "CWE-079"}}}]}
    _write(tmp_path, "osv/a.json", json.dumps(osv))
    _write(tmp_path, "osv/deep/b.json", json.dumps(osv | {"withdrawn": "2020"}))
    _write(tmp_path, "osv/c.json", "{broken")
    _write(tmp_path, "osv/d.json", "[]")
    r = readers.read_osv(spark, str(tmp_path / "osv"))
    assert [(x.cves, x.cwes) for x in r.collect()] == [(["CVE-2020-1234"], ["CWE-79"])]
    assert {(x.event, x.sha) for x in readers.osv_events(r).collect()} == {("introduced", "0"), ("fixed", "ab")}
    assert readers.osv_references(r).first().kind == "FIX"

    nvd = {"vulnerabilities": [{"cve": {"id": "cve-2020-1234", "weaknesses": [{"type": "Primary", "description": [{"lang": "en", "value": "CWE-20"}]}], "references": [{"url": "u", "tags": ["Patch"]}], "evaluatorImpact": "CWE-7"}}, {"cve": {"id": "other"}}]}
    _write(tmp_path, "nvd/2020.json", json.dumps(nvd, indent=1))
    n = readers.read_nvd(spark, str(tmp_path / "nvd"))
    assert [(x.cve, x.primary_cwes, x.evaluator_cwes) for x in n.collect()] == [("CVE-2020-1234", ["CWE-20"], ["CWE-7"])]

    rec = {"cveMetadata": {"cveId": "CVE-2020-1234", "state": "PUBLISHED"}, "containers": {"cna": {"problemTypes": [{"descriptions": [{"cweId": "CWE-9", "description": "CWE-8"}]}], "references": [{"url": "u", "tags": ["patch"]}]}}}
    _write(tmp_path, "list/cves/2020/x.json", json.dumps(rec))
    _write(tmp_path, "list/delta.json", json.dumps(rec))
    c = readers.read_cvelist(spark, str(tmp_path / "list"))
    assert [(x.container, x.cwes, x.primary_cwes) for x in c.collect()] == [("cna", ["CWE-8", "CWE-9"], ["CWE-9"])]
    assert readers.cvelist_references(c).first().kind == "patch"


def test_catalog_feeds_the_taxonomy(spark, tmp_path):
    xml = """<Catalog><Weaknesses>
<Weakness ID="125" Name="Read" Abstraction="Base"><Description>d</Description><Related_Weaknesses><Related_Weakness Nature="ChildOf" CWE_ID="119" View_ID="1000"/><Related_Weakness Nature="ChildOf" CWE_ID="1" View_ID="699"/></Related_Weaknesses></Weakness>
<Weakness ID="119" Name="Memory" Abstraction="Class"><Description>e</Description></Weakness></Weaknesses>
<Categories><Category ID="1218" Name="Buffers"><Summary>s</Summary><Relationships><Has_Member CWE_ID="125" View_ID="699"/></Relationships></Category></Categories></Catalog>"""
    _write(tmp_path, "cwe.xml", xml)
    tree = readers.read_cwe_catalog(spark, str(tmp_path / "cwe.xml"))
    assert {(r.id, r.kind) for r in tree["node"].collect()} == {("125", "weakness"), ("119", "weakness"), ("1218", "category")}
    assert [tuple(r) for r in tree["parent"].collect()] == [("125", "119")]
    assert [tuple(r) for r in tree["cat699"].collect()] == [("125", "1218")]
    got = taxonomy.classify(spark.createDataFrame([("CWE-125",)], "cwe string"), tree, taxonomy.CLASSES).first()
    assert (got.classes, got.rule) == (["BND"], "2_category_699")


def test_categories_reach_their_pillar(spark, tmp_path):
    xml = """<Catalog><Weaknesses>
<Weakness ID="664" Name="Pillar" Abstraction="Pillar"><Description>d</Description></Weakness>
<Weakness ID="118" Name="Class" Abstraction="Class"><Description>d</Description><Related_Weaknesses><Related_Weakness Nature="ChildOf" CWE_ID="664"/><Related_Weakness Nature="PeerOf" CWE_ID="1"/></Related_Weaknesses></Weakness></Weaknesses>
<Categories><Category ID="19" Name="Data"><Summary>s</Summary><Relationships><Member_Of CWE_ID="118"/><Member_Of CWE_ID="699"/></Relationships></Category>
<Category ID="20" Name="More"><Summary>s</Summary><Relationships><Has_Member CWE_ID="118" View_ID="699"/><Relationship Nature="MemberOf" CWE_ID="19"/></Relationships></Category></Categories></Catalog>"""
    _write(tmp_path, "cwe.xml", xml)
    tree = readers.read_cwe_hierarchy(spark, str(tmp_path / "cwe.xml"))
    assert {(r.id, r.abstraction) for r in tree["node"].collect()} == {("664", "Pillar"), ("118", "Class"), ("19", None), ("20", None)}
    asked = spark.createDataFrame([("CWE-20",), ("CWE-19",), ("118",), ("CWE-699",), ("CWE-664",)], "cwe string")
    got = {r.cwe: (r.tops, r.depth, r.multi_parent, r.kinds) for r in taxonomy.top_ancestors(asked, tree).collect()}
    assert got == {"CWE-20": ("664", 3, False, "ChildOf;MemberOf"), "CWE-19": ("664", 2, False, "ChildOf;MemberOf"), "118": ("664", 1, False, "ChildOf"), "CWE-699": ("", -1, False, ""), "CWE-664": ("664", 0, False, "")}


def test_a_walk_passes_each_node_once(spark):
    """A ladder of 24 rungs with two ways each has 2 ** 24 paths; a circle closes it."""
    edges = [(f"{i}{s}", f"{i + 1}{t}") for i in range(24) for s in "ab" for t in "ab"] + [("24a", "0a")]
    roots = spark.createDataFrame([("0a",), ("alone",)], "root string")
    got = {(r.root, r.node): r.depth for r in taxonomy.closure(roots, spark.createDataFrame(edges, "child string, parent string"), "child", "parent", 30).collect()}
    assert len(got) == 48 and got["0a", "24b"] == 24 and ("0a", "0a") not in got
    step = spark.createDataFrame([("r", "s", True), ("s", "t", False), ("u", "v", False)], "node string, next string, open boolean")
    assert {(r.root, r.node) for r in taxonomy.reached(spark.createDataFrame([("r",), ("u",)], "root string"), step, 5).collect()} == {("r", "s"), ("u", "v")}


def test_line_sets(spark, tmp_path):
    row = {"func_name": "f", "func_src_before": "a", "func_src_after": "b", "file_name": "x.py", "vul_type": "cwe-089", "line_changes": {"deleted": [{"line_no": 3, "line": "z"}, {"line_no": 1, "line": "a"}], "added": []}}
    _write(tmp_path, "set/val/cwe-089.jsonl", json.dumps(row) + "\n")
    got = readers.read_line_changes(spark, str(tmp_path / "set")).first()
    assert (got.split, got.language, got.cwe_id, got.deleted, got.added) == ("val", "Python", "CWE-89", [1, 3], [])
    spark.createDataFrame([("a  b", "x", 1)], "func_before string, lines_before string, vul int").write.parquet(str(tmp_path / "flaws"))
    flaw = readers.read_flaw_lines(spark, str(tmp_path / "flaws")).first()
    assert flaw.vul == 1 and flaw.file and flaw.h


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None)], "i int, l array<string>, cve_id string")
    sinks.write_full(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out.parquet")).first().l == ["a", "b"]
    assert spark.read.option("header", True).csv(str(tmp_path / "out.csv")).first().l == "a;b"
    assert sinks.audit(df, ["cve_id", "gone", "i"]).columns == ["cve_id", "i"]
    first = sinks.stage_table(df, str(tmp_path), "stage")
    assert sinks.stage_table(first.limit(0), str(tmp_path), "stage", fresh=False).count() == 1


def test_slices_are_written_by_one_job(spark, tmp_path):
    """K1 to K5: all rows, the audit list and every slice."""
    rows = [(i, None if i % 2 else "CVE-1", None if i % 3 else "CWE-2", "multiple_cves_ambiguous" if i % 5 == 0 else None, "CWE-3;CWE-4" if i % 7 == 0 else ("CWE-2" if i % 7 == 1 else ""), None if i % 4 else "CWE-2", ["a", "b"]) for i in range(200)]
    df = spark.createDataFrame(rows, "sample_id long, cve_id string, cwe_id string, osv_status string, cwe_candidates string, cwe_label_final string, more array<string>")
    path, group = str(tmp_path / "out"), "one write"
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        counts = sinks.write_slices(df, sinks.review_slices(["osv_status"]), path)
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1
    plain = {"all": df, "missing_both": sinks.missing_both(df), "ambiguous": sinks.ambiguous(df, ["osv_status"]), "cwe_conflict": sinks.cwe_conflict(df), "trainable": sinks.trainable(df), "gap": sinks.gap(df)}
    for name, want in plain.items():
        got = sinks.read_slice(spark, path, name)
        assert sorted(r.sample_id for r in got.collect()) == sorted(r.sample_id for r in want.collect()), name
        assert counts[name] == want.count() > 0
    sinks.write_slices(df, {}, path, csv=["cwe_id", "gone", "more"])
    back = spark.read.option("header", True).csv(f"{path}.csv")
    assert back.columns == ["cwe_id", "more"] and back.count() == 200 and back.first().more == "a;b"
    made, counted = sinks.counted_table(df, str(tmp_path), "stage", sinks.label_counts())
    assert (counted["rows"], counted["cve"], counted["cwe"]) == (200, 100, 67)
    assert counted["any_label"] == 100 + 67 - counted["both"] and counted["missing_both"] == 200 - counted["any_label"] and made.count() == 200
