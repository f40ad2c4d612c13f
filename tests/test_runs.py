"""Label recovery as a run of stages: it breaks, goes on, and leaves nothing behind."""

import pytest
from conftest import SF

from secdata.plans import recovery
from secdata.sources import runs, sinks


def _tables(folder):
    return {p.name for p in folder.iterdir() if p.is_dir() and p.name != "marks"} if folder.exists() else set()


def test_a_broken_recovery_goes_on_and_reads_no_earlier_input(spark, tmp_path):
    folder, stages = tmp_path / "run", recovery.stages_of(spark, SF)
    names = [s.name for s in stages]

    def broken(*_):
        raise RuntimeError("lost")

    def but(changed):
        return [runs.Stage(s.name, s.needs, changed.get(s.name, s.make)) for s in stages]

    first = runs.Run(spark, str(folder), "v1")
    with pytest.raises(RuntimeError, match="lost"):
        first.result(but({"nvd": broken}))
    done = set(first.made)
    assert done == {"samples", "commit", "evidence_osv", "osv", "evidence_nvd"}
    # What is no longer needed is gone: the samples and the evidence that the last whole stage took.
    assert _tables(folder) == done - {"samples", "commit", "evidence_osv"}

    second = runs.Run(spark, str(folder), "v1")
    out = second.result(but(dict.fromkeys(done, broken)))  # what is marked isn't made again
    assert not done & set(second.made) and done | set(second.made) == set(names)
    assert _tables(folder) == {"recovered"}
    want = recovery.p1_recover_labels(spark, SF)
    got = out.select(*want.columns)
    assert got.count() == 1500 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert {r[0] for r in got.select("osv_status").distinct().collect()} >= {"single_cve_filled", "weak_event_only"}
    assert got.where("cve_source LIKE 'osv_fixed_commit_exact%'").count() > 0

    # The same inputs: the result is there. Others: all is made anew.
    third = runs.Run(spark, str(folder), "v1")
    assert third.result(but(dict.fromkeys(names, broken))).count() == 1500 and third.made == []
    with pytest.raises(RuntimeError, match="lost"):
        runs.Run(spark, str(folder), "v2").result(but({"samples": broken}))
    third.close()
    assert not folder.exists()


def test_strict_repositories_drop_other_evidence(spark):
    made = {}
    for strict in (False, True):
        base = recovery.stages_of(spark, SF)
        stages = recovery.recovery_stages(base[0].make, {s: (lambda s=s: recovery._flat_refs(spark, SF, s)) for s in recovery.SOURCES}, lambda: recovery._events(spark, SF), recovery._Records(spark, SF), strict)
        kept = [s for s in stages if s.name in ("samples", "commit", "evidence_osv", "osv")]
        made[strict] = {r.sample_id: r.cve_source for r in runs.Run(spark, sinks.work_folder(spark), "x").result(kept).collect()}
    osv = {k: {i for i, s in v.items() if s and s.startswith("osv")} for k, v in made.items()}
    assert osv[True] < osv[False]


def test_fingerprints_follow_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.json").write_text("1")
    first = runs.fingerprint(spark, str(tmp_path / "a"))
    assert first == runs.fingerprint(spark, str(tmp_path / "a"))
    (tmp_path / "a/y.json").write_text("1")
    assert first != runs.fingerprint(spark, str(tmp_path / "a"))
