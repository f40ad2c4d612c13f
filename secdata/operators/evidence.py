"""Evidence from advisory sources: which commits they name, and what that says about rows.

Evidence is a flat table (sha, tier, fills, cve, cwes, primary_cwes, url): a 40-digit commit that a record of one source names, the tier of the
reference (its name as a label source), and whether the tier may fill labels or is only kept for audit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secdata.functions import normalize as N
from secdata.operators.joins import join_hot

# Tiers of each source, best first; the last element tells whether the tier fills.
TIERS = {
    "osv": [("osv_fixed_commit_exact", True), ("osv_fix_reference_exact", True), ("osv_reference_exact", True), ("weak", False)],
    "nvd": [("nvd_patch_commit_exact", True), ("nvd_commit_reference_exact", True), ("other", False)],
    "cveorg": [("cveorg_patch_commit_exact", True), ("cveorg_commit_reference_exact", True)],
}
NO_MATCH = {"osv": "no_match", "nvd": "no_match", "cveorg": "no_exact_commit_reference"}
AUDIT_ONLY = {"osv": "weak_event_only", "nvd": "sha_in_non_commit_url", "cveorg": "no_exact_commit_reference"}


def build_targets(rows: DataFrame) -> DataFrame:
    """(target, rank): distinct commits, own or repeated, of rows without a CVE; rank orders them by first row, own before repeated."""
    shas = rows.where("cve_id IS NULL").select("sample_id", F.posexplode(N.row_shas(F.col("commit_sha"), F.col("alt_shas"))).alias("pos", "s"))
    usable = shas.select(F.lower(F.trim("s.sha")).alias("target"), F.struct("sample_id", "pos").alias("rank")).where(F.col("target").rlike("^[0-9a-f]{7,40}$"))
    return usable.groupBy("target").agg(F.min("rank").alias("rank"))


def match_targets(shas: DataFrame, targets: DataFrame) -> DataFrame:
    """(sha, target): the target of each distinct 40-digit sha. A whole target wins; else the first-ranked short one that is a prefix.

    The prefix match is an equality on seven digits with a residual test.
    """
    shas = shas.select(F.lower("sha").alias("sha")).distinct()
    whole = shas.join(targets.where(F.length("target") == 40).select(F.col("target").alias("sha")), "sha", "left_semi").withColumn("target", F.col("sha"))
    short = targets.where(F.length("target") < 40).withColumn("head", F.substring("target", 1, 7))
    rest = shas.withColumn("head", F.substring("sha", 1, 7)).join(short, "head").where(F.expr("startswith(sha, target)"))
    rest = rest.groupBy("sha").agg(F.min_by("target", "rank").alias("target")).join(whole.select("sha"), "sha", "left_anti")
    return whole.unionByName(rest)


def reference_evidence(refs: DataFrame, source: str) -> DataFrame:
    """Evidence of a flat reference table (cve, cwes, primary_cwes, url, kind) by the rules of one source.

    kind: OSV has FIX and other reference types, NVD and the CVE list have ``patch`` for tagged references. OSV references and the CVE list's must look like a commit;
    NVD's count without that if tagged, and untagged ones that don't look like one are kept for audit.
    """
    each = refs.select("*", F.explode(N.extract_sha40s(F.col("url"))).alias("raw")).withColumn("sha", F.lower("raw"))
    commit = N.looks_like_commit_url(F.col("url"), F.col("sha"))
    if source == "osv":
        tier = F.when(commit & (F.upper("kind") == "FIX"), F.lit("osv_fix_reference_exact")).when(commit, F.lit("osv_reference_exact"))
    elif source == "nvd":
        tier = F.when(F.col("kind") == "patch", F.lit("nvd_patch_commit_exact")).when(commit, F.lit("nvd_commit_reference_exact")).otherwise(F.lit("other"))
    else:
        tier = F.when(commit & (F.col("kind") == "patch"), F.lit("cveorg_patch_commit_exact")).when(commit, F.lit("cveorg_commit_reference_exact"))
    fills = F.col("tier").isin([t for t, f in TIERS[source] if f])
    return each.withColumn("tier", tier).where("tier IS NOT NULL AND cve IS NOT NULL").withColumn("fills", fills).select("sha", "tier", "fills", "cve", "cwes", "primary_cwes", "url").distinct()


def event_evidence(events: DataFrame) -> DataFrame:
    """Evidence of git events (cve, cwes, event, sha): ``fixed`` fills, every other event is for audit; only exact 40-digit values count."""
    good = events.where(F.col("sha").rlike("^[0-9a-fA-F]{40}$") & F.col("cve").isNotNull())
    tier = F.when(F.col("event") == "fixed", F.lit("osv_fixed_commit_exact")).otherwise(F.lit("weak"))
    return good.select(F.lower("sha").alias("sha"), tier.alias("tier"), (F.col("event") == "fixed").alias("fills"), "cve", "cwes", F.col("cwes").alias("primary_cwes"), F.coalesce("repo", F.lit("")).alias("url")).distinct()


def apply_evidence(rows: DataFrame, evidence: DataFrame, source: str, with_cwe: bool = False, patch_only: bool = False, strict_repo: bool = False) -> DataFrame:
    """Fills cve_id (with_cwe: and a missing cwe_id) of rows without a CVE; adds {source}_status and {source}_candidates.

    Tiers are tried in order, within a tier the row's own commit before those it repeats. The first (tier, commit) with exactly one CVE fills; an
    ambiguous one doesn't stop the search, and evidence after the filling one still counts as candidate. Audit tiers are looked at only without candidates.
    patch_only fills from the first tier alone. strict_repo drops evidence whose repository isn't the row's.
    """
    names = [t for t, _ in TIERS[source]]
    order = F.create_map(*[F.lit(x) for i, t in enumerate(names) for x in (t, i)])
    todo = rows.where(F.col("cve_id").isNull()).select("sample_id", "commit_link", F.posexplode(N.row_shas(F.col("commit_sha"), F.col("alt_shas"))).alias("pos", "s")).select("sample_id", "commit_link", "pos", F.col("s.sha").alias("target"), "s.is_backport")
    matched = match_targets(evidence, build_targets(rows))
    named = evidence.join(matched, "sha").withColumn("rank", F.element_at(order, F.col("tier")))
    hits = join_hot(todo, named, "target", "inner")
    if strict_repo:
        hits = hits.where(N.repo_matches(F.col("commit_link"), F.col("url")))
    cells = hits.groupBy("sample_id", "rank", "pos").agg(
        F.array_sort(F.collect_set("cve")).alias("cves"),
        F.first("is_backport").alias("is_backport"),
        F.first("tier").alias("tier"),
        F.first("fills").alias("fills"),
        F.array_distinct(F.flatten(F.array_sort(F.collect_set("cwes")))).alias("all_cwes"),
        F.array_distinct(F.flatten(F.array_sort(F.collect_set("primary_cwes")))).alias("best_cwes"),
    )
    usable = F.col("fills") & (F.size("cves") == 1)
    if patch_only:
        usable = usable & (F.col("rank") == 0)
    place = F.struct("rank", "pos")
    chosen = F.min_by(F.when(usable, F.struct(F.col("cves")[0].alias("cve"), "tier", "is_backport", "all_cwes", "best_cwes")), F.when(usable, place))
    per_row = cells.groupBy("sample_id").agg(
        chosen.alias("pick"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("fills"), F.col("cves")))))).alias("cands"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("fills"), F.col("cves")))))).alias("audit"),
    )
    j = rows.join(per_row, "sample_id", "left")
    searched = F.col("cve_id").isNull() & ((F.col("commit_sha").isNotNull()) | (F.size("alt_shas") > 0))
    some = F.coalesce(F.size("cands"), F.lit(0)) > 0
    status = (
        F.when(~searched, F.lit(None))
        .when(F.col("pick").isNotNull(), F.lit("single_cve_filled"))
        .when(some, F.lit("exact_sha_nonpatch_only" if patch_only else "multiple_cves_ambiguous"))
        .when(F.coalesce(F.size("audit"), F.lit(0)) > 0, F.lit(AUDIT_ONLY[source]))
        .otherwise(F.lit(NO_MATCH[source]))
    )
    cands = F.when(searched, F.array_join(F.when(some, F.col("cands")).otherwise(F.coalesce("audit", F.array().cast("array<string>"))), ";")).otherwise(F.lit(""))
    tagged = N.tag_source(F.col("pick.tier"), F.col("pick.is_backport"))
    take = F.col("cve_id").isNull() & F.col("pick").isNotNull()
    sole = F.when(F.size("pick.best_cwes") == 1, F.col("pick.best_cwes")[0]).when(F.size("pick.all_cwes") == 1, F.col("pick.all_cwes")[0])
    cwe = F.when(take & F.col("cwe_id").isNull() & F.lit(with_cwe), sole)
    out = j.withColumns({f"{source}_status": status, f"{source}_candidates": cands, "__cwe": cwe})
    out = out.withColumns({"cwe_source": F.when(F.col("__cwe").isNotNull(), tagged).otherwise(F.col("cwe_source")), "cwe_id": F.coalesce("cwe_id", "__cwe"), "cve_source": F.when(take, tagged).otherwise(F.col("cve_source")), "cve_id": F.when(take, F.col("pick.cve")).otherwise(F.col("cve_id"))})
    return out.drop("pick", "cands", "audit", "__cwe")
