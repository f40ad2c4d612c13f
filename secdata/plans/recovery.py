"""Queries on label recovery: normalisation, commit propagation, evidence, ladders."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.functions import normalize as N
from secdata.functions import rules
from secdata.operators import cwe_ladder, evidence, propagate
from secdata.plans import fixtures as X
from secdata.sources import runs, sinks


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.frame(spark, sf_dir, X.SAMPLES)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with normalised labels, their sources and commit ids: where every recovery job begins."""
    return propagate.add_commit_ids(N.initialize_sources(N.normalize_labels(raw_samples(spark, sf_dir))))


LABEL_COLUMNS = ["sample_id", "cve_id", "cwe_id", "cve_source", "cwe_source"]


def n1_n5_labels(spark, sf_dir):
    return samples(spark, sf_dir).select(*LABEL_COLUMNS, "cve_id_all", "cwe_id_all")


def n4_label_repairs(spark, sf_dir):
    return N.label_repairs(raw_samples(spark, sf_dir))


def n6_n20_commit_ids(spark, sf_dir):
    return samples(spark, sf_dir).select("sample_id", "commit_sha", F.array_join("alt_shas", ";").alias("alt_shas"), "commit_key")


def n8_n9_urls(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS)
    sha = F.lower(N.first(N.extract_sha40s(F.col("url"))))
    return refs.select("ref_id", sha.alias("sha"), N.looks_like_commit_url(F.col("url"), sha).alias("is_commit"))


def n10_messages(spark, sf_dir):
    m = F.col("commit_message")
    return raw_samples(spark, sf_dir).select("sample_id", F.array_join(N.message_cves(m), ";").alias("cves"), F.array_join(N.message_cwes(m), ";").alias("cwes"))


def n11_row_shas(spark, sf_dir):
    s = samples(spark, sf_dir).select("sample_id", F.posexplode(N.row_shas(F.col("commit_sha"), F.col("alt_shas"))).alias("pos", "s"))
    return s.select("sample_id", "pos", "s.sha", "s.is_backport")


def n18_confidence(spark, sf_dir):
    out = propagate.same_commit(samples(spark, sf_dir))
    return out.select("sample_id", N.confidence_of(F.col("cve_source")).alias("cve_confidence"), N.confidence_of(F.col("cwe_source")).alias("cwe_confidence"))


def n21_n22_description_rules(spark, sf_dir):
    rule = rules.predict_from_description(F.col("cve_description"), coarse=True)
    return raw_samples(spark, sf_dir).select("sample_id", rule.alias("r")).select("sample_id", "r.cwe", "r.rule", "r.accuracy")


def n23_norm_hash(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", N.norm_hash(F.col("text")).alias("h"))


def n24_joern_key(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", N.joern_key(F.col("text"), F.col("source"), F.col("lang")).alias("key"))


def a1_commit_majority(spark, sf_dir):
    return propagate.majority(samples(spark, sf_dir).withColumn("link", N.strip(F.col("commit_link"))), "link", F.col("cwe_id"))


def a1_commit_unambiguous(spark, sf_dir):
    return propagate.majority(samples(spark, sf_dir).withColumn("link", N.strip(F.col("commit_link"))), "link", F.col("cve_id"), "unambiguous")


def j8_same_commit(spark, sf_dir):
    return propagate.same_commit(samples(spark, sf_dir)).select(*LABEL_COLUMNS)


def p2_message_fill(spark, sf_dir):
    return propagate.commit_message(samples(spark, sf_dir)).select(*LABEL_COLUMNS)


def a2_propagate(spark, sf_dir):
    return propagate.propagate_same_commit(samples(spark, sf_dir)).select(*LABEL_COLUMNS, "commit_key")


def _recovered(spark, sf_dir):
    return propagate.commit_message(propagate.same_commit(samples(spark, sf_dir)))


def a5_label_stats(spark, sf_dir):
    return propagate.label_stats(samples(spark, sf_dir), "before").unionByName(propagate.label_stats(_recovered(spark, sf_dir), "after"))


def a6_stage_diff(spark, sf_dir):
    return propagate.stage_diff(samples(spark, sf_dir), _recovered(spark, sf_dir))


def a7_source_distribution(spark, sf_dir):
    return propagate.distribution(_recovered(spark, sf_dir), "cve_source")


def a10_p3_method_overlap(spark, sf_dir):
    s = samples(spark, sf_dir)
    return propagate.method_overlap(s, propagate.same_commit(s), propagate.commit_message(s))


def j19_own_map(spark, sf_dir):
    return propagate.own_cve_to_cwe(samples(spark, sf_dir)).select(*LABEL_COLUMNS)


def p5_quick_recovery(spark, sf_dir):
    return propagate.quick_recovery(samples(spark, sf_dir)).select(*LABEL_COLUMNS)


def _targets(spark, sf_dir):
    return evidence.build_targets(samples(spark, sf_dir))


def _flat_refs(spark, sf_dir, source):
    refs = X.frame(spark, sf_dir, X.REFS)
    kind = F.when(F.col("kind") == "FIX", "patch").otherwise("other") if source != "osv" else F.col("kind")
    return refs.select("cve", F.array("cwe").alias("cwes"), F.array("cwe").alias("primary_cwes"), "url", kind.alias("kind"))


def j2_targets(spark, sf_dir):
    return _targets(spark, sf_dir).select("target", F.col("rank.sample_id").alias("first_row"), F.col("rank.pos").alias("first_pos"))


def j1_match_targets(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS).select(F.explode(N.extract_sha40s(F.col("url"))).alias("sha"))
    return evidence.match_targets(refs, _targets(spark, sf_dir)).select("sha", "target")


def j3_osv_evidence(spark, sf_dir):
    found = evidence.reference_evidence(_flat_refs(spark, sf_dir, "osv"), "osv")
    return found.groupBy("sha", "tier").agg(F.array_join(F.array_sort(F.collect_set("cve")), ";").alias("cves"))


def j4_nvd_evidence(spark, sf_dir):
    found = evidence.reference_evidence(_flat_refs(spark, sf_dir, "nvd"), "nvd")
    return found.groupBy("sha", "tier", "fills").agg(F.array_join(F.array_sort(F.collect_set("cve")), ";").alias("cves"))


def _applied(spark, sf_dir, source, **more):
    rows = samples(spark, sf_dir)
    out = evidence.apply_evidence(rows, evidence.reference_evidence(_flat_refs(spark, sf_dir, source), source), source, **more)
    return out.select(*LABEL_COLUMNS, F.col(f"{source}_status").alias("status"), F.col(f"{source}_candidates").alias("candidates"))


def j6_apply_osv(spark, sf_dir):
    return _applied(spark, sf_dir, "osv")


def j6_j7_apply_nvd(spark, sf_dir):
    return _applied(spark, sf_dir, "nvd", with_cwe=True)


def j6_j7_apply_cveorg(spark, sf_dir):
    return _applied(spark, sf_dir, "cveorg", with_cwe=True)


def p4_patch_only(spark, sf_dir):
    return _applied(spark, sf_dir, "nvd", patch_only=True)


def _tables(spark, sf_dir, t=None):
    t = (X.frame(spark, sf_dir, X.CVE_CWES) if t is None else t).withColumn("cwes", F.array("cwe"))
    of = {s: t.where(F.col("source") == s) for s in ("nvd", "cna", "osv", "evaluator")}
    return {
        "nvd_primary": cwe_ladder.last_record(of["nvd"]),
        "cna_primary": cwe_ladder.last_record(of["cna"]),
        "nvd_evaluator": cwe_ladder.merge_sets(of["evaluator"]),
        "osv": cwe_ladder.merge_sets(of["osv"]),
        "nvd_all": cwe_ladder.merge_sets(of["nvd"]),
        "cna_all": cwe_ladder.merge_sets(of["cna"]),
    }


def a3_cve_tables(spark, sf_dir):
    wide = cwe_ladder.pivot_tables(_tables(spark, sf_dir))
    return wide.select("cve", *[F.array_join(c, ";").alias(c) for c in wide.columns if c != "cve"])


def j9_u1_cve_to_cwe(spark, sf_dir):
    return cwe_ladder.cve_to_cwe(samples(spark, sf_dir), _tables(spark, sf_dir)).select(*LABEL_COLUMNS, "cwe_candidates")


def _ladder(spark, sf_dir):
    t = {k: cwe_ladder.clean_table(v) for k, v in _tables(spark, sf_dir).items()}
    return {k: t[k] for k in ("nvd_evaluator", "osv", "nvd_all", "cna_all")}, t["nvd_primary"], t["cna_primary"]


def j10_final_cwe(spark, sf_dir):
    out = cwe_ladder.resolve_final_cwe(samples(spark, sf_dir), *_ladder(spark, sf_dir))
    return out.select("sample_id", *[c for c in out.columns if c.startswith("cwe_label_final")], "has_cwe_label_final")


def j21_first_hit(spark, sf_dir):
    return cwe_ladder.first_hit_ladder(samples(spark, sf_dir), _ladder(spark, sf_dir)[0]).select("sample_id", "cwe_first", "cwe_first_source")


def p6_gap_rescue(spark, sf_dir):
    _, observed, vendor = _ladder(spark, sf_dir)
    return cwe_ladder.rescue_gap(samples(spark, sf_dir), observed, vendor).select("sample_id", "rescued_cwe", "rescue_source", "rescue_conf")


def _events(spark, sf_dir):
    return X.frame(spark, sf_dir, X.EVENTS).withColumn("cwes", F.array("cwe"))


def j3_j20_fixed_events(spark, sf_dir):
    """The best OSV tier alone: fixed-commit events, of repositories that are the row's own."""
    out = evidence.apply_evidence(samples(spark, sf_dir), evidence.event_evidence(_events(spark, sf_dir)), "osv", strict_repo=True)
    return out.select(*LABEL_COLUMNS, F.col("osv_status").alias("status"), F.col("osv_candidates").alias("candidates"))


SOURCES = ("osv", "nvd", "cveorg")


def recovery_stages(start, references: dict, events, tables, strict_repo: bool = False) -> list[runs.Stage]:
    """The stages of label recovery: normalise, same commit and message, three sources in turn, twice (CVE -> CWE, propagation), confidence.

    start() gives samples with labels and commit ids, references[source]() a source's flat references, events() the OSV git events, tables(df) the CVE -> CWE tables of
    a settled table of records that ``tables.records()`` gives. strict_repo: OSV evidence counts only for rows of its own repository.
    """
    def evident(source):
        made = evidence.reference_evidence(references[source](), source)
        return made.unionByName(evidence.event_evidence(events())) if source == "osv" else made

    stages = [runs.Stage("samples", (), start), runs.Stage("commit", ("samples",), lambda s: propagate.commit_message(propagate.same_commit(s))), runs.Stage("cve_cwes", (), tables.records)]
    before = "commit"
    for source in SOURCES:
        stages.append(runs.Stage(f"evidence_{source}", (), lambda source=source: evident(source)))
        stages.append(runs.Stage(source, (before, f"evidence_{source}"), lambda rows, found, source=source: evidence.apply_evidence(rows, found, source, with_cwe=source != "osv", strict_repo=strict_repo and source == "osv")))
        before = source
    for i in range(2):
        stages.append(runs.Stage(f"cwes_{i}", (before, "cve_cwes"), lambda rows, records: cwe_ladder.cve_to_cwe(rows, tables(records))))
        stages.append(runs.Stage(f"propagated_{i}", (f"cwes_{i}",), propagate.propagate_same_commit))
        before = f"propagated_{i}"
    conf = {f"{k}_confidence": N.confidence_of(F.col(f"{k}_source")) for k in ("cve", "cwe")}
    stages.append(runs.Stage("recovered", (before,), lambda rows: rows.withColumns(conf)))
    # Label statistics of every method come with its table.
    of_rows = {s.name for s in stages if not s.name.startswith("evidence_")} - {"cve_cwes"}
    return [replace(s, counts=sinks.label_counts()) if s.name in of_rows else s for s in stages]


def a5_stage_counters(spark, sf_dir):
    """Label statistics before and after every method of P1, counted while its table was written; what each method added is the difference to the row before."""
    run, stages = runs.Run(spark, sinks.work_folder(spark), sf_dir), stages_of(spark, sf_dir)
    run.result(stages)
    told = [(i, s.name, *[run.counters(s.name)[k] for k in ("rows", "cve", "cwe", "any_label", "both", "missing_both")]) for i, s in enumerate(s for s in stages if s.counts)]
    run.close()
    return spark.createDataFrame(told, "step int, stage string, n_rows long, cve long, cwe long, any_label long, both long, missing_both long")


class _Records:
    """The CVE -> CWE records of the fixtures, and the tables made of them."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def records(self):
        return X.frame(self.spark, self.sf_dir, X.CVE_CWES)

    def __call__(self, settled):
        return _tables(self.spark, self.sf_dir, settled)


def stages_of(spark, sf_dir):
    references = {s: (lambda s=s: _flat_refs(spark, sf_dir, s)) for s in SOURCES}
    return recovery_stages(lambda: samples(spark, sf_dir), references, lambda: _events(spark, sf_dir), _Records(spark, sf_dir))


def p1_recover_labels(spark, sf_dir):
    """All stages of label recovery over the supplied tables. A run that breaks can go on in the same folder; here each query is a run of its own."""
    run = runs.Run(spark, sinks.work_folder(spark), sf_dir)
    out = run.result(stages_of(spark, sf_dir))
    return out.select(*LABEL_COLUMNS, "osv_status", "nvd_status", "cveorg_status", "cve_confidence", "cwe_confidence")


def u2_any_label(spark, sf_dir):
    return propagate.with_any_label(samples(spark, sf_dir)).select(*LABEL_COLUMNS)


QUERIES = {k: v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and k[0] in "najpu" and k[1].isdigit()}

# ---------------------------------------------------------------- SQL twins

_W = f"WITH {X.LABELLED}"
_MAJ = "SELECT {k}, {v} AS v, count(*) AS n, min(sample_id) AS mn FROM {t} WHERE coalesce({k}, '') <> '' AND {v} IS NOT NULL GROUP BY 1, 2"


def _majority(t: str, k: str, v: str) -> str:
    return f"SELECT {k}, arg_min(v, (-n, mn)) AS winner, count(*) AS n_values FROM ({_MAJ.format(t=t, k=k, v=v)}) GROUP BY 1"


def _fill(name: str, t: str, k: str, source: str, kinds=("cve", "cwe")) -> str:
    """CTE: t with both labels filled by majority over key k."""
    joins = " ".join(f"LEFT JOIN ({_majority(t, k, x + '_id')}) m_{x} ON m_{x}.{k} = b.{k}" for x in kinds)
    cols = ", ".join(f"coalesce(b.{x}_id, m_{x}.winner) AS {x}_id, CASE WHEN b.{x}_id IS NULL AND m_{x}.winner IS NOT NULL THEN '{source}' ELSE b.{x}_source END AS {x}_source" for x in kinds)
    drop = ", ".join(f"{x}_id, {x}_source" for x in kinds)
    return f"{name} AS (SELECT b.* EXCLUDE ({drop}), {cols} FROM {t} b {joins})"


_MSG = (
    f"msg AS (SELECT *, list_sort(list_distinct({X.cve_tokens('commit_message', chr(92) + 'b')})) AS mv, "
    "list_sort(list_distinct(list_transform(regexp_extract_all(commit_message, '(?i)\\bCWE[-_ ]?([0-9]{1,5})\\b', 1), lambda x: 'CWE-' || CAST(CAST(x AS INT) AS VARCHAR)))) AS mw FROM {t})"
)


def _message(name: str, t: str) -> str:
    one = ", ".join(f"CASE WHEN {x}_id IS NULL AND len({m}) = 1 THEN {m}[1] ELSE {x}_id END AS {x}_id, CASE WHEN {x}_id IS NULL AND len({m}) = 1 THEN 'commit_message_explicit' ELSE {x}_source END AS {x}_source" for x, m in (("cve", "mv"), ("cwe", "mw")))
    return f"{_MSG.replace('{t}', t).replace('msg AS', name + '_m AS')}, {name} AS (SELECT * EXCLUDE (cve_id, cwe_id, cve_source, cwe_source, mv, mw), {one} FROM {name}_m)"


_L = ", ".join(LABEL_COLUMNS)
_SAME = _fill("same", "keyed", "link", "same_commit")
_AFTER = f"{_SAME}, {_message('rec', 'same')}"
_STAT = "count(*) AS n_rows, count(cve_id) AS cve, count(cwe_id) AS cwe, count(*) FILTER (cve_id IS NOT NULL OR cwe_id IS NOT NULL) AS any_label, count(*) FILTER (cve_id IS NOT NULL AND cwe_id IS NOT NULL) AS both_, count(*) FILTER (cve_id IS NULL AND cwe_id IS NULL) AS missing_both"
_PCT = "n_rows, cve, cwe, any_label, both_ AS both, missing_both, " + ", ".join(f"round(100.0 * {c} / n_rows, 4) AS {c.rstrip('_')}_pct" for c in ("cve", "cwe", "any_label", "both_", "missing_both"))
_CONF = "CASE WHEN {c} IS NULL THEN NULL WHEN {c} = 'original' THEN 'gold' WHEN {c} IN ('same_commit', 'commit_message_explicit') THEN 'high' ELSE 'medium' END"
_REFS = f"refs AS ({X.text(X.REFS)})"
_SHAS = "shas AS (SELECT sample_id, 0 AS pos, commit_sha AS sha, FALSE AS is_backport FROM keyed WHERE commit_sha IS NOT NULL UNION ALL SELECT sample_id, CASE WHEN commit_sha IS NULL THEN 0 ELSE 1 END, alt_sha, TRUE FROM keyed WHERE alt_sha IS NOT NULL AND alt_sha IS DISTINCT FROM commit_sha)"
_TARGETS = f"{_SHAS}, tgt AS (SELECT sha AS target, arg_min(s.sample_id, (s.sample_id, pos)) AS first_row, arg_min(pos, (s.sample_id, pos)) AS first_pos FROM shas s JOIN keyed k ON s.sample_id = k.sample_id WHERE k.cve_id IS NULL GROUP BY sha)"
_MATCH = f"""{_TARGETS}, {_REFS}, rs AS (SELECT *, right(url, 40) AS sha FROM refs),
mt AS (SELECT sha, coalesce(max(target) FILTER (length(target) = 40), arg_min(target, (first_row, first_pos))) AS target FROM (SELECT DISTINCT sha FROM rs) r JOIN tgt ON starts_with(sha, target) GROUP BY sha)"""


def _evidence(source: str) -> str:
    commit = "contains(url, '/commit/')"
    tier = {
        "osv": f"CASE WHEN {commit} AND kind = 'FIX' THEN 'osv_fix_reference_exact' WHEN {commit} THEN 'osv_reference_exact' END",
        "nvd": f"CASE WHEN kind = 'FIX' THEN 'nvd_patch_commit_exact' WHEN {commit} THEN 'nvd_commit_reference_exact' ELSE 'other' END",
        "cveorg": f"CASE WHEN {commit} AND kind = 'FIX' THEN 'cveorg_patch_commit_exact' WHEN {commit} THEN 'cveorg_commit_reference_exact' END",
    }[source]
    return f"ev AS (SELECT DISTINCT sha, cve, cwe, tier, tier <> 'other' AS fills FROM (SELECT *, {tier} AS tier FROM rs) WHERE tier IS NOT NULL)"


#: Events as evidence: ev_e (sha, cve, cwe, tier, fills, repo).
_EVENTS = f"""ev_e AS (SELECT DISTINCT sha, cve, cwe, CASE WHEN event = 'fixed' THEN 'osv_fixed_commit_exact' ELSE 'weak' END AS tier, event = 'fixed' AS fills, repo FROM ({X.text(X.EVENTS)}) WHERE length(sha) = 40)"""
#: Does a sample's link (of keyed k) name the event's repository (e.repo)?
_SAME_REPO = "(k.project % 8 IN (1, 5) AND lower(replace(replace(replace(e.repo, 'git@github.com:', 'github.com/'), 'https://', ''), '.git', '')) = 'github.com/org' || CAST(k.project % 40 AS VARCHAR) || '/proj' || CAST(k.project % 40 AS VARCHAR))"


def _strict_events() -> str:
    return f"""{_W}, {_TARGETS}, {_EVENTS},
mt AS (SELECT sha, coalesce(max(target) FILTER (length(target) = 40), arg_min(target, (first_row, first_pos))) AS target FROM (SELECT DISTINCT sha FROM ev_e) r JOIN tgt ON starts_with(sha, target) GROUP BY sha),
hit AS (SELECT s.sample_id, s.pos, s.is_backport, e.*, CASE tier WHEN 'weak' THEN 3 ELSE 0 END AS rnk FROM shas s JOIN keyed k ON s.sample_id = k.sample_id AND k.cve_id IS NULL JOIN mt ON mt.target = s.sha JOIN ev_e e ON e.sha = mt.sha WHERE {_SAME_REPO}),
cell AS (SELECT sample_id, rnk, pos, list_sort(list_distinct(list(cve))) AS cves, min(tier) || CASE WHEN bool_or(is_backport) THEN '_via_backport' ELSE '' END AS src, bool_and(fills) AS fills FROM hit GROUP BY 1, 2, 3),
row_ AS (SELECT sample_id, arg_min({{'cve': cves[1], 'src': src}}, (rnk, pos)) FILTER (fills AND len(cves) = 1) AS pick, list_sort(list_distinct(flatten(list(cves) FILTER (fills)))) AS cands, list_sort(list_distinct(flatten(list(cves) FILTER (NOT fills)))) AS audit FROM cell GROUP BY 1)
SELECT k.sample_id, coalesce(k.cve_id, pick.cve) AS cve_id, k.cwe_id, CASE WHEN k.cve_id IS NULL AND pick IS NOT NULL THEN pick.src ELSE k.cve_source END AS cve_source, k.cwe_source,
 CASE WHEN k.cve_id IS NOT NULL OR (k.commit_sha IS NULL AND k.alt_sha IS NULL) THEN NULL WHEN pick IS NOT NULL THEN 'single_cve_filled' WHEN len(cands) > 0 THEN 'multiple_cves_ambiguous' WHEN len(audit) > 0 THEN 'weak_event_only' ELSE 'no_match' END AS status,
 CASE WHEN k.cve_id IS NOT NULL OR (k.commit_sha IS NULL AND k.alt_sha IS NULL) THEN '' WHEN len(cands) > 0 THEN array_to_string(cands, ';') ELSE coalesce(array_to_string(audit, ';'), '') END AS candidates
FROM keyed k LEFT JOIN row_ r ON r.sample_id = k.sample_id"""


def _apply(source: str, with_cwe: bool = False, patch_only: bool = False) -> str:
    order = {t: i for i, (t, _) in enumerate(evidence.TIERS[source])}
    rank = "CASE tier " + " ".join(f"WHEN '{t}' THEN {i}" for t, i in order.items()) + " END"
    usable = "fills AND len(cves) = 1" + (" AND rnk = 0" if patch_only else "")
    audit = {"nvd": "sha_in_non_commit_url", "osv": "weak_event_only", "cveorg": "no_exact_commit_reference"}[source]
    ambiguous = "exact_sha_nonpatch_only" if patch_only else "multiple_cves_ambiguous"
    cwe_id = "CASE WHEN k.cwe_id IS NULL AND pick IS NOT NULL AND len(pick.cwes) = 1 THEN pick.cwes[1] ELSE k.cwe_id END" if with_cwe else "k.cwe_id"
    cwe_src = "CASE WHEN k.cwe_id IS NULL AND pick IS NOT NULL AND len(pick.cwes) = 1 THEN pick.src ELSE k.cwe_source END" if with_cwe else "k.cwe_source"
    return f"""{_W}, {_MATCH}, {_evidence(source)},
hit AS (SELECT s.sample_id, s.pos, s.is_backport, ev.*, {rank} AS rnk FROM shas s JOIN keyed k ON s.sample_id = k.sample_id AND k.cve_id IS NULL JOIN mt ON mt.target = s.sha JOIN ev ON ev.sha = mt.sha),
cell AS (SELECT sample_id, rnk, pos, list_sort(list_distinct(list(cve))) AS cves, list_sort(list_distinct(list(cwe))) AS cwes, min(tier) || CASE WHEN bool_or(is_backport) THEN '_via_backport' ELSE '' END AS src, bool_and(fills) AS fills FROM hit GROUP BY 1, 2, 3),
row_ AS (SELECT sample_id, arg_min({{'cve': cves[1], 'src': src, 'cwes': cwes}}, (rnk, pos)) FILTER ({usable}) AS pick, list_sort(list_distinct(flatten(list(cves) FILTER (fills)))) AS cands, list_sort(list_distinct(flatten(list(cves) FILTER (NOT fills)))) AS audit FROM cell GROUP BY 1)
SELECT k.sample_id, coalesce(k.cve_id, pick.cve) AS cve_id, {cwe_id} AS cwe_id, CASE WHEN k.cve_id IS NULL AND pick IS NOT NULL THEN pick.src ELSE k.cve_source END AS cve_source, {cwe_src} AS cwe_source,
 CASE WHEN k.cve_id IS NOT NULL OR (k.commit_sha IS NULL AND k.alt_sha IS NULL) THEN NULL WHEN pick IS NOT NULL THEN 'single_cve_filled' WHEN len(cands) > 0 THEN '{ambiguous}' WHEN len(audit) > 0 THEN '{audit}' ELSE '{evidence.NO_MATCH[source]}' END AS status,
 CASE WHEN k.cve_id IS NOT NULL OR (k.commit_sha IS NULL AND k.alt_sha IS NULL) THEN '' WHEN len(cands) > 0 THEN array_to_string(cands, ';') ELSE coalesce(array_to_string(audit, ';'), '') END AS candidates
FROM keyed k LEFT JOIN row_ r ON r.sample_id = k.sample_id"""


_TBL = f"""ct AS ({X.text(X.CVE_CWES)}),
un AS (SELECT source, cve, list_sort(list_distinct(list(cwe))) AS cwes FROM ct GROUP BY 1, 2),
tb AS (SELECT c.cve, np.w AS nvd_primary, cp.w AS cna_primary, e.cwes AS nvd_evaluator, o.cwes AS osv, na.cwes AS nvd_all, ca.cwes AS cna_all FROM (SELECT DISTINCT cve FROM ct) c
 LEFT JOIN (SELECT cve, [arg_max(cwe, ordinal)] AS w FROM ct WHERE source = 'nvd' GROUP BY 1) np ON np.cve = c.cve
 LEFT JOIN (SELECT cve, [arg_max(cwe, ordinal)] AS w FROM ct WHERE source = 'cna' GROUP BY 1) cp ON cp.cve = c.cve
 LEFT JOIN un e ON e.cve = c.cve AND e.source = 'evaluator' LEFT JOIN un o ON o.cve = c.cve AND o.source = 'osv'
 LEFT JOIN un na ON na.cve = c.cve AND na.source = 'nvd' LEFT JOIN un ca ON ca.cve = c.cve AND ca.source = 'cna')"""
_EVERY = "list_sort(list_distinct(coalesce(nvd_all, []) || coalesce(cna_all, []) || coalesce(osv, []) || coalesce(nvd_evaluator, [])))"


def _apply_on(t: str, source: str, with_cwe: bool) -> str:
    """CTEs, ending with one named after the source: ``t`` after ``apply_evidence``."""
    p = source
    rank = "CASE tier " + " ".join(f"WHEN '{x}' THEN {i}" for i, (x, _) in enumerate(evidence.TIERS[source])) + " END"
    searched = "k.cve_id IS NULL AND (k.commit_sha IS NOT NULL OR k.alt_sha IS NOT NULL)"
    new_cwe = "k.cwe_id IS NULL AND pick IS NOT NULL AND len(pick.cwes) = 1" if with_cwe else "FALSE"
    return f"""{p}_tgt AS (SELECT sha AS target, arg_min(s.sample_id, (s.sample_id, pos)) AS first_row, arg_min(pos, (s.sample_id, pos)) AS first_pos FROM shas s JOIN {t} k ON s.sample_id = k.sample_id WHERE k.cve_id IS NULL GROUP BY sha),
{p}_mt AS (SELECT sha, coalesce(max(target) FILTER (length(target) = 40), arg_min(target, (first_row, first_pos))) AS target FROM (SELECT DISTINCT sha FROM rs UNION SELECT sha FROM ev_e) r JOIN {p}_tgt ON starts_with(sha, target) GROUP BY sha),
{_evidence(source).replace("ev AS", f"{p}_ev0 AS", 1)}, {p}_ev AS (SELECT * FROM {p}_ev0{" UNION SELECT sha, cve, cwe, tier, fills FROM ev_e" if source == "osv" else ""}),
{p}_hit AS (SELECT s.sample_id, s.pos, s.is_backport, e.*, {rank} AS rnk FROM shas s JOIN {t} k ON s.sample_id = k.sample_id AND k.cve_id IS NULL JOIN {p}_mt m ON m.target = s.sha JOIN {p}_ev e ON e.sha = m.sha),
{p}_cell AS (SELECT sample_id, rnk, pos, list_sort(list_distinct(list(cve))) AS cves, list_sort(list_distinct(list(cwe))) AS cwes, min(tier) || CASE WHEN bool_or(is_backport) THEN '_via_backport' ELSE '' END AS src, bool_and(fills) AS fills FROM {p}_hit GROUP BY 1, 2, 3),
{p}_row AS (SELECT sample_id, arg_min({{'cve': cves[1], 'src': src, 'cwes': cwes}}, (rnk, pos)) FILTER (fills AND len(cves) = 1) AS pick, bool_or(fills) AS any_fills, count(*) AS n FROM {p}_cell GROUP BY 1),
{p} AS (SELECT k.* EXCLUDE ({_L.replace("sample_id, ", "")}), coalesce(k.cve_id, pick.cve) AS cve_id, CASE WHEN {new_cwe} THEN pick.cwes[1] ELSE k.cwe_id END AS cwe_id, CASE WHEN k.cve_id IS NULL AND pick IS NOT NULL THEN pick.src ELSE k.cve_source END AS cve_source, CASE WHEN {new_cwe} THEN pick.src ELSE k.cwe_source END AS cwe_source,
 CASE WHEN NOT ({searched}) THEN NULL WHEN pick IS NOT NULL THEN 'single_cve_filled' WHEN any_fills THEN 'multiple_cves_ambiguous' WHEN n > 0 THEN '{evidence.AUDIT_ONLY[source]}' ELSE '{evidence.NO_MATCH[source]}' END AS {source}_status FROM {t} k LEFT JOIN {p}_row r ON r.sample_id = k.sample_id)"""


def _cwes_on(name: str, t: str) -> str:
    """CTEs, ending with ``name``: ``t`` after ``cve_to_cwe``."""
    picks = " ".join(f"WHEN len({c}) = 1 THEN ['{tag}', {c}[1]]" for c, tag in (("nvd_primary", "nvd_cve_primary"), ("cna_primary", "cveorg_cve_primary"), ("nvd_evaluator", "nvd_evaluator_note"), ("osv", "osv_cve_cwe_ids"), ("every", "cve_cwe_single")))
    return f"""{name}_j AS (SELECT k.*, tb.* EXCLUDE (cve), {_EVERY} AS every FROM {t} k LEFT JOIN tb ON tb.cve = k.cve_id),
{name}_p AS (SELECT *, CASE WHEN cwe_id IS NOT NULL OR cve_id IS NULL THEN NULL {picks} WHEN len(every) > 1 THEN ['cve_cwe_ambiguous', every[1]] END AS pick FROM {name}_j),
{name} AS (SELECT * EXCLUDE (cwe_id, cwe_source, pick, every, nvd_primary, cna_primary, nvd_evaluator, osv, nvd_all, cna_all), coalesce(cwe_id, pick[2]) AS cwe_id, coalesce(pick[1], cwe_source) AS cwe_source FROM {name}_p)"""


def _counters_sql() -> str:
    """The label statistics of each of P1's tables."""
    ctes, t = _p1_ctes()
    names = {"samples": "keyed", "commit": "rec", **{x: x for x in SOURCES}, **{f"{k}_{i}": f"{c}{i}" for i in range(2) for k, c in (("cwes", "cw"), ("propagated", "pr"))}, "recovered": t}
    each = " UNION ALL ".join(f"SELECT {i} AS step, '{k}' AS stage, n_rows, cve, cwe, any_label, both_ AS both, missing_both FROM (SELECT {_STAT} FROM {v})" for i, (k, v) in enumerate(names.items()))
    return f"WITH {', '.join(ctes)} {each}"


def _p1_ctes() -> tuple[list[str], str]:
    ctes = [X.LABELLED, _AFTER, _SHAS, _REFS, _EVENTS, "rs AS (SELECT *, right(url, 40) AS sha FROM refs)", _TBL]
    t = "rec"
    for source in ("osv", "nvd", "cveorg"):
        ctes.append(_apply_on(t, source, source != "osv"))
        t = source
    for i in range(2):
        ctes += [_cwes_on(f"cw{i}", t), _fill(f"pr{i}", f"cw{i}", "commit_key", "same_commit_propagated")]
        t = f"pr{i}"
    return ctes, t


def _p1_sql() -> str:
    ctes, t = _p1_ctes()
    known = " ".join(f"WHEN {{c}} = '{k}' THEN '{v}'" for k, v in N.CONFIDENCE.items())
    conf = ", ".join(f"CASE WHEN {c}_source IS NULL THEN NULL {known.replace('{c}', c + '_source')} ELSE 'medium' END AS {c}_confidence" for c in ("cve", "cwe"))
    return f"WITH {', '.join(ctes)} SELECT {_L}, osv_status, nvd_status, cveorg_status, {conf} FROM {t}"


def _quick_sql() -> str:
    def mode(label: str) -> str:
        return f"m_{label} AS (SELECT link, arg_min({label}, (-n, {label})) AS w FROM (SELECT link, {label}, count(*) AS n FROM keyed WHERE coalesce(link, '') <> '' AND {label} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"

    def filled(label: str, value: str, source: str) -> str:
        kind = label[:3]
        return f"coalesce(k.{label}, {value}) AS {label}, CASE WHEN k.{label} IS NULL AND {value} IS NOT NULL THEN '{source}' ELSE k.{kind}_source END AS {kind}_source"

    return f"""{_W}, {_MSG.replace('{t}', 'raw')}, {mode('cve_id')}, {mode('cwe_id')},
q1 AS (SELECT k.sample_id, {filled('cve_id', 'a.w', 'commit')}, {filled('cwe_id', 'b.w', 'commit')} FROM keyed k LEFT JOIN m_cve_id a ON a.link = k.link LEFT JOIN m_cwe_id b ON b.link = k.link),
q2 AS (SELECT k.sample_id, {filled('cve_id', 'mv[1]', 'message')}, k.cwe_id, k.cwe_source FROM q1 k JOIN msg ON msg.sample_id = k.sample_id),
om AS (SELECT cve_id AS c, arg_min(cwe_id, (-n, cwe_id)) AS w FROM (SELECT cve_id, cwe_id, count(*) AS n FROM q2 WHERE cve_id IS NOT NULL AND cwe_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT sample_id, k.cve_id, k.cve_source, {filled('cwe_id', 'w', 'cve_map')} FROM q2 k LEFT JOIN om ON om.c = k.cve_id"""


_RULE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(cve_description, '(?i){p}') THEN '{n}'" for n, p, _, _ in [*rules.DESCRIPTION_RULES, rules.COARSE_RULE]) + " END"
_RULE_NO_COARSE = "CASE " + " ".join(f"WHEN regexp_matches(cve_description, '(?i){p}') THEN '{n}'" for n, p, _, _ in rules.DESCRIPTION_RULES) + " END"
_RULE_CWE = "CASE {r} " + " ".join(f"WHEN '{n}' THEN '{w}'" for n, _, w, _ in [*rules.DESCRIPTION_RULES, rules.COARSE_RULE]) + " END"
_RULE_ACC = "CASE {r} " + " ".join(f"WHEN '{n}' THEN {a}::DOUBLE" for n, _, _, a in [*rules.DESCRIPTION_RULES, rules.COARSE_RULE]) + " END"
_FIRST4 = ["nvd_evaluator", "osv", "nvd_all", "cna_all"]

SQL = {
    "n1_n5_labels": f"{_W} SELECT {_L}, cve_id_all, cwe_id_all FROM lab",
    "n4_label_repairs": f"{_W} SELECT count(*) FILTER (NOT {X.missing('cve_id')} AND len(cves) > 0 AND cves[1] <> cve_id) AS cve_id_fixed, count(*) FILTER (len(cves) > 1) AS cve_id_multi, count(*) FILTER (NOT {X.missing('cve_id')} AND len(cves) = 0) AS cve_id_dropped, count(*) FILTER (NOT {X.missing('cwe_id')} AND len(cwes) > 0 AND cwes[1] <> cwe_id) AS cwe_id_fixed, count(*) FILTER (len(cwes) > 1) AS cwe_id_multi, count(*) FILTER (NOT {X.missing('cwe_id')} AND len(cwes) = 0) AS cwe_id_dropped FROM tok",
    "n6_n20_commit_ids": f"{_W} SELECT sample_id, commit_sha, coalesce(alt_sha, '') AS alt_shas, commit_key FROM keyed",
    "n8_n9_urls": f"WITH {_REFS} SELECT ref_id, regexp_extract(url, '(?:^|[^0-9a-fA-F])([0-9a-fA-F]{{40}})(?:[^0-9a-fA-F]|$)', 1) AS sha, contains(url, '/commit/') AS is_commit FROM refs",
    "n10_messages": f"{_W}, {_MSG.replace('{t}', 'raw')} SELECT sample_id, coalesce(array_to_string(mv, ';'), '') AS cves, coalesce(array_to_string(mw, ';'), '') AS cwes FROM msg",
    "n11_row_shas": f"{_W}, {_SHAS} SELECT * FROM shas",
    "n18_confidence": f"{_W}, {_SAME} SELECT sample_id, {_CONF.format(c='cve_source')} AS cve_confidence, {_CONF.format(c='cwe_source')} AS cwe_confidence FROM same",
    "n21_n22_description_rules": f"WITH raw AS ({X.text(X.SAMPLES)}), r AS (SELECT sample_id, {_RULE_SQL} AS rule FROM raw) SELECT sample_id, rule, {_RULE_CWE.format(r='rule')} AS cwe, {_RULE_ACC.format(r='rule')} AS accuracy FROM r",
    "n23_norm_hash": "SELECT doc_id, md5(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS h FROM documents",
    "n24_joern_key": "SELECT doc_id, sha1(coalesce(text, 'None') || chr(0) || coalesce(source, 'None') || chr(0) || coalesce(lang, 'None') || chr(0)) AS key FROM documents",
    "a1_commit_majority": f"{_W} {_majority('keyed', 'link', 'cwe_id')}",
    "a1_commit_unambiguous": f"{_W} SELECT * FROM ({_majority('keyed', 'link', 'cve_id')}) WHERE n_values = 1",
    "j8_same_commit": f"{_W}, {_SAME} SELECT {_L} FROM same",
    "p2_message_fill": f"{_W}, {_message('rec', 'keyed')} SELECT {_L} FROM rec",
    "p1_recover_labels": _p1_sql(),
    "a5_stage_counters": _counters_sql(),
    "j3_j20_fixed_events": _strict_events(),
    "p5_quick_recovery": _quick_sql(),
    "u2_any_label": f"{_W} SELECT {_L} FROM keyed WHERE cve_id IS NOT NULL OR cwe_id IS NOT NULL",
    "a2_propagate": f"{_W}, {_fill('prop', 'keyed', 'commit_key', 'same_commit_propagated')} SELECT {_L}, commit_key FROM prop",
    "a5_label_stats": f"{_W}, {_AFTER} SELECT 'before' AS stage, {_PCT} FROM (SELECT {_STAT} FROM keyed) UNION ALL SELECT 'after', {_PCT} FROM (SELECT {_STAT} FROM rec)",
    "a6_stage_diff": f"{_W}, {_AFTER} SELECT count(*) FILTER (r.cve_id IS NOT NULL AND k.cve_id IS NULL) AS new_cve, count(*) FILTER (r.cwe_id IS NOT NULL AND k.cwe_id IS NULL) AS new_cwe, count(*) FILTER (coalesce(r.cve_id, r.cwe_id) IS NOT NULL AND coalesce(k.cve_id, k.cwe_id) IS NULL) AS rescued, count(*) FILTER (r.cve_id IS NOT NULL AND r.cwe_id IS NOT NULL AND (k.cve_id IS NULL OR k.cwe_id IS NULL)) AS new_complete, count(*) FILTER ((k.cve_id IS NOT NULL AND r.cve_id IS NULL) OR (k.cwe_id IS NOT NULL AND r.cwe_id IS NULL)) AS lost FROM keyed k JOIN rec r ON k.sample_id = r.sample_id",
    "a7_source_distribution": f"{_W}, {_AFTER} SELECT cve_source AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM rec), 4) AS pct FROM rec GROUP BY 1",
    "a10_p3_method_overlap": f"{_W}, {_SAME}, {_message('rec', 'keyed')}, j AS (SELECT coalesce(k.cve_id, k.cwe_id) IS NOT NULL AS had, coalesce(a.cve_id, a.cwe_id) IS NOT NULL AS a, coalesce(b.cve_id, b.cwe_id) IS NOT NULL AS b, (a.cve_id IS DISTINCT FROM k.cve_id OR a.cwe_id IS DISTINCT FROM k.cwe_id) AS ta, (b.cve_id IS DISTINCT FROM k.cve_id OR b.cwe_id IS DISTINCT FROM k.cwe_id) AS tb FROM keyed k JOIN same a ON a.sample_id = k.sample_id JOIN rec b ON b.sample_id = k.sample_id) SELECT count(*) FILTER (a AND NOT had AND NOT b) AS rescued_only_a, count(*) FILTER (b AND NOT had AND NOT a) AS rescued_only_b, count(*) FILTER (a AND b AND NOT had) AS rescued_both, count(*) FILTER ((a OR b) AND NOT had) AS rescued_union, count(*) FILTER (ta) AS touched_a, count(*) FILTER (tb) AS touched_b FROM j",
    "j19_own_map": f"{_W}, om AS (SELECT cve_id, arg_min(cwe_id, (-n, cwe_id)) AS w FROM (SELECT cve_id, cwe_id, count(*) AS n FROM keyed WHERE cve_id IS NOT NULL AND cwe_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1) SELECT k.sample_id, k.cve_id, coalesce(k.cwe_id, w) AS cwe_id, cve_source, CASE WHEN k.cwe_id IS NULL AND w IS NOT NULL THEN 'cve_map' ELSE cwe_source END AS cwe_source FROM keyed k LEFT JOIN om ON om.cve_id = k.cve_id",
    "j2_targets": f"{_W}, {_TARGETS} SELECT * FROM tgt",
    "j1_match_targets": f"{_W}, {_MATCH} SELECT sha, target FROM mt",
    "j3_osv_evidence": f"{_W}, {_MATCH}, {_evidence('osv')} SELECT sha, tier, array_to_string(list_sort(list_distinct(list(cve))), ';') AS cves FROM ev GROUP BY 1, 2",
    "j4_nvd_evidence": f"{_W}, {_MATCH}, {_evidence('nvd')} SELECT sha, tier, fills, array_to_string(list_sort(list_distinct(list(cve))), ';') AS cves FROM ev GROUP BY 1, 2, 3",
    "j6_apply_osv": _apply("osv"),
    "j6_j7_apply_nvd": _apply("nvd", with_cwe=True),
    "j6_j7_apply_cveorg": _apply("cveorg", with_cwe=True),
    "p4_patch_only": _apply("nvd", patch_only=True),
    "a3_cve_tables": f"WITH {_TBL} SELECT cve, " + ", ".join(f"array_to_string({c}, ';') AS {c}" for c in ("nvd_primary", "cna_primary", *_FIRST4)) + " FROM tb",
    "j9_u1_cve_to_cwe": f"""{_W}, {_TBL}, j AS (SELECT k.*, tb.* EXCLUDE (cve), {_EVERY} AS every FROM keyed k LEFT JOIN tb ON tb.cve = k.cve_id),
p AS (SELECT *, CASE WHEN cwe_id IS NOT NULL OR cve_id IS NULL THEN NULL WHEN len(nvd_primary) = 1 THEN ['nvd_cve_primary', nvd_primary[1]] WHEN len(cna_primary) = 1 THEN ['cveorg_cve_primary', cna_primary[1]] WHEN len(nvd_evaluator) = 1 THEN ['nvd_evaluator_note', nvd_evaluator[1]] WHEN len(osv) = 1 THEN ['osv_cve_cwe_ids', osv[1]] WHEN len(every) = 1 THEN ['cve_cwe_single', every[1]] WHEN len(every) > 1 THEN ['cve_cwe_ambiguous', every[1]] END AS pick FROM j)
SELECT sample_id, cve_id, coalesce(cwe_id, pick[2]) AS cwe_id, cve_source, coalesce(pick[1], cwe_source) AS cwe_source, CASE WHEN cve_id IS NULL THEN '' ELSE coalesce(array_to_string(every, ';'), '') END AS cwe_candidates FROM p""",
    "j21_first_hit": f"{_W}, {_TBL} SELECT sample_id, coalesce({', '.join(f'{t}[1]' for t in _FIRST4)}) AS cwe_first, CASE {' '.join(f'WHEN len({t}) > 0 THEN {t!r}' for t in _FIRST4)} END AS cwe_first_source FROM keyed k LEFT JOIN tb ON tb.cve = k.cve_id",
    "j10_final_cwe": f"""{_W}, {_TBL}, j AS (SELECT k.sample_id, k.cwe_id, {_RULE_NO_COARSE} AS rule, {', '.join(f'coalesce({t}, []) AS {t}' for t in _FIRST4)}, coalesce(nvd_primary, []) AS ven, coalesce(cna_primary, []) AS thi FROM keyed k LEFT JOIN tb ON tb.cve = k.cve_id),
l AS (SELECT *, nvd_evaluator || osv || nvd_all || cna_all AS l0 FROM j), l1 AS (SELECT *, list_filter(l0, lambda x, i: list_position(l0, x) = i) AS loc FROM l),
t AS (SELECT *, CASE {' '.join(f'WHEN len({t}) = 1 THEN [{t!r}, {t}[1]]' for t in _FIRST4)} WHEN len(loc) = 1 THEN ['all_sources_single', loc[1]] END AS bt FROM l1),
e AS (SELECT *, CASE WHEN bt IS NOT NULL THEN bt WHEN len(ven) > 0 THEN ['vendor_api', ven[1]] WHEN len(thi) > 0 THEN ['third_party', thi[1]] END AS early FROM t),
r AS (SELECT *, early IS NULL AND rule IS NOT NULL AS ruled, {_RULE_CWE.format(r='rule')} AS rcwe, {_RULE_ACC.format(r='rule')} AS racc FROM e),
c AS (SELECT *, CASE WHEN cwe_id IS NOT NULL THEN loc || [cwe_id] ELSE loc || CASE WHEN bt IS NULL THEN ven ELSE [] END || thi || CASE WHEN ruled THEN [rcwe] ELSE [] END END AS c0 FROM r),
d AS (SELECT *, list_filter(c0, lambda x, i: list_position(c0, x) = i) AS cands FROM c),
f AS (SELECT *, CASE WHEN cwe_id IS NOT NULL THEN ['pipeline_cwe_id', cwe_id] WHEN early IS NOT NULL THEN early WHEN ruled THEN ['description_rule', rcwe] WHEN len(cands) > 1 THEN ['multi_source_ambiguous', cands[1]] END AS fin FROM d)
SELECT sample_id, fin[2] AS cwe_label_final, fin[1] AS cwe_label_final_source, array_to_string(cands, ';') AS cwe_label_final_all, CASE WHEN fin[1] = 'description_rule' THEN rule ELSE '' END AS cwe_label_final_rule, CASE WHEN fin[1] = 'description_rule' THEN racc END AS cwe_label_final_acc,
 CASE WHEN fin IS NULL THEN NULL WHEN fin[1] = 'third_party' THEN 'third_party' WHEN fin[1] IN ('description_rule', 'multi_source_ambiguous') THEN 'medium' ELSE 'high' END AS cwe_label_final_conf, fin IS NOT NULL AS has_cwe_label_final FROM f""",
    "p6_gap_rescue": f"""{_W}, {_TBL}, j AS (SELECT k.sample_id, {_RULE_SQL} AS rule, nvd_primary[1] AS ob, cna_primary[1] AS ve FROM keyed k LEFT JOIN tb ON tb.cve = k.cve_id WHERE k.cve_id IS NOT NULL AND k.cwe_id IS NULL)
SELECT sample_id, coalesce(ob, ve, {_RULE_CWE.format(r='rule')}) AS rescued_cwe, CASE WHEN ob IS NOT NULL THEN 'observed_examples' WHEN ve IS NOT NULL THEN 'vendor_api' WHEN rule = 'buffer_overflow_coarse' THEN 'coarse_rule' WHEN rule IS NOT NULL THEN 'description_rule' END AS rescue_source, CASE WHEN ob IS NOT NULL OR ve IS NOT NULL THEN 'high' WHEN rule = 'buffer_overflow_coarse' THEN 'low' WHEN rule IS NOT NULL THEN 'medium' END AS rescue_conf FROM j""",
}
