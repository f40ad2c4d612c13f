"""The store of results and incremental line labels."""

import pytest
from pyspark.sql import functions as F

from secdata.operators import incremental, lines
from secdata.sources.store import ResultStore

SCHEMA = "sample_key string, n long"


def _keys(spark, values):
    return spark.createDataFrame([(i,) for i in values], "n long").select(F.sha1(F.col("n").cast("string")).alias("sample_key"), "n")


def test_put_rewrites_only_touched_partitions_and_the_last_put_stays(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "store"), SCHEMA, digits=1)
    assert store.rows().count() == 0 and store.last_load() == 0
    rows = _keys(spark, range(200))
    assert store.pending(rows.unionByName(rows).unionByName(spark.createDataFrame([(None, 1)], SCHEMA))).count() == 200
    assert store.put(rows) == 1
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    one = rows.where("n = 7").withColumn("n", F.lit(-7).cast("long"))
    assert store.put(one) == 2
    key = one.first().sample_key
    kept = {p for p in (tmp_path / "store").rglob("*.parquet") if p in files and p.stat().st_mtime_ns == files[p]}
    assert {p.parent.name for p in files if p not in kept} == {f"bucket={key[0]}"}
    got = {r.sample_key: (r.n, r.load) for r in store.rows().collect()}
    assert len(got) == 200 and got[key] == (-7, 2) and sum(load == 1 for _, load in got.values()) == 199
    assert store.pending(_keys(spark, range(150, 260))).count() == 60
    assert store.put(rows.limit(0)) == 3 and store.rows().count() == 200
    assert ResultStore(spark, str(tmp_path / "store"), SCHEMA, digits=1).attach(_keys(spark, [7, 999]).select("sample_key")).orderBy("load").collect()[0].n is None


def test_a_store_keeps_its_own_names(spark, tmp_path):
    with pytest.raises(ValueError, match="own"):
        ResultStore(spark, str(tmp_path), "sample_key string, load int")
    store = ResultStore(spark, str(tmp_path / "s"), SCHEMA)
    with pytest.raises(ValueError, match="clash"):
        store.attach(_keys(spark, [1]))


def _graph(key, edges):
    return (key, "lua", 0, "[1,2,3,4,5]", str([list(e) for e in edges]), "[]")


def test_only_changed_samples_are_aligned_again(spark, tmp_path, monkeypatch):
    pairs = [("a", "f()\nx\ny", "f()\nx\nz\ny", "lua"), ("b", "f()\n\tp\nq", "f()\nq", "lua"), ("copy of b", "f()\n\tp\nq", "f()\nq", "lua"), ("none", None, "x", "lua")]
    samples = spark.createDataFrame(pairs, "name string, before string, after string, lang string")
    key = {r.name: r.graph_key for r in incremental.keyed(samples, spark.createDataFrame([], "key string, n_graph_lines int, n_cdg long, n_ddg long")).collect()}
    asked = []
    real = lines.align
    monkeypatch.setattr(incremental.label_pending, "__defaults__", (lines.MAX_RATIO, lines.MIN_CHANGED, lambda p, **k: asked.append(p.count()) or real(p, **k)))
    graphs = "key string, lang string, offset int, lines string, cdg string, rd string"
    store = incremental.label_store(spark, str(tmp_path / "labels"))

    def run(*rows, logic="1"):
        got = incremental.label_increment(samples, spark.createDataFrame(list(rows), graphs), store, logic=logic).collect()
        return {r.name: (r.status, r.vul_lines_fb, r.load) for r in got}

    assert run() == {"a": ("no_pdg_signal", [], 1), "b": ("ok_delete_only", [2], 1), "copy of b": ("ok_delete_only", [2], 1), "none": ("missing_code", [], 1)}
    assert asked == [3]
    # A graph for one sample: only its key changes. The added line 3 of the union view depends on line 2.
    assert run(_graph(key["a"], [(2, 3)])) == {"a": ("joern_add_only", [2], 2), "b": ("ok_delete_only", [2], 1), "copy of b": ("ok_delete_only", [2], 1), "none": ("missing_code", [], 1)}
    assert asked == [3, 1]
    assert run(_graph(key["a"], [(2, 3)]))["a"] == ("joern_add_only", [2], 2) and asked == [3, 1]
    # The graph goes away again: the first result is still there.
    assert run()["a"] == ("no_pdg_signal", [], 1) and asked == [3, 1]
    assert run(logic="2")["b"] == ("ok_delete_only", [2], 3) and asked == [3, 1, 3]


def test_no_text_is_written(spark, monkeypatch):
    """Texts, larger than all results, are in no stage table: neither the samples' nor those of their lines."""
    from conftest import SF

    from secdata.plans import curation
    from secdata.sources import sinks

    written = []
    real = sinks.stage_table
    monkeypatch.setattr(sinks, "stage_table", lambda df, folder, name, *a: written.append(df.columns) or real(df, folder, name, *a))
    rows = curation.u3_w2_n25_rounds(spark, SF).collect()
    assert {r.load for r in rows} == {1, 2} and len({r.key for r in rows}) == len(rows)
    assert written and not {c for columns in written for c in columns} & {"before", "after", "before_text", "after_text", "text"}
