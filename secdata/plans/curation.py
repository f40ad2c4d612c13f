"""Queries on taxonomies, languages, line labels, sources and reports."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.functions import language_rules as L
from secdata.functions import normalize as N
from secdata.functions import rules
from secdata.functions.binding import let
from secdata.operators import cwe_ladder, incremental, language, lines, propagate, reports, taxonomy
from secdata.plans import fixtures as X
from secdata.plans import recovery as R
from secdata.sources import feeds, readers, sinks

# ------------------------------------------------------------------ fixtures

#: Rows with lists of CWEs, messages and code, from parts.
LISTS = """
SELECT p_partkey AS sample_id, 'proj' || CAST(p_size AS STRING) AS project_key, p_size AS size,
 CASE p_partkey % 13 WHEN 0 THEN 'CWE-476;CWE-703' WHEN 1 THEN 'CWE-119;CWE-787' WHEN 2 THEN 'CWE-416;CWE-502' WHEN 3 THEN 'CWE-79' WHEN 4 THEN 'CWE-20' WHEN 5 THEN 'CWE-770'
  WHEN 6 THEN 'CWE-17' WHEN 7 THEN 'CWE-384' WHEN 8 THEN 'CWE-639' WHEN 9 THEN 'CWE-908' WHEN 10 THEN 'CWE-990' WHEN 11 THEN 'CWE-991' ELSE NULL END AS cwes,
 CASE p_partkey % 7 WHEN 0 THEN 'fix a memory leak on exit' WHEN 1 THEN 'prevent SQL injection' WHEN 2 THEN 'weak cipher is gone' WHEN 3 THEN NULL ELSE 'cleanup' END AS commit_message,
 CASE p_partkey % 5 WHEN 0 THEN 'integer overflow in size' ELSE NULL END AS cve_description,
 CASE p_partkey % 4 WHEN 0 THEN 'memcpy(dst, src, n);' WHEN 1 THEN 'x = a[i];' WHEN 2 THEN 'kfree(p);' ELSE 'y = 2;' END AS func_before,
 CASE p_partkey % 3 WHEN 0 THEN 'lock(m);' ELSE '' END AS vul_lines_text
FROM {part}
"""

_EDGES = [("125", "119"), ("787", "119"), ("119", "118"), ("118", "664"), ("416", "825"), ("825", "672"), ("672", "666"), ("666", "664"), ("476", "754"), ("754", "703"), ("79", "74"), ("74", "707"), ("89", "943"), ("943", "74"), ("770", "400"), ("400", "664"), ("384", "610"), ("610", "664"), ("502", "913"), ("913", "664"), ("190", "682"), ("639", "863"), ("863", "285"), ("285", "284"), ("362", "691"), ("20", "707"), ("908", "665"), ("665", "664"), ("476", "710"), ("881", "990"), ("882", "990"), ("883", "990")]
_MEMBERS = [("125", "1218"), ("787", "1218"), ("190", "189"), ("416", "399"), ("476", "465"), ("79", "137"), ("89", "137"), ("639", "1212"), ("639", "840"), ("908", "399"), ("502", "399"), ("881", "1218"), ("882", "1218"), ("883", "137")]
_NODES = sorted({x for e in _EDGES for x in e} | {m for m, _ in _MEMBERS} | {"17", "991"}, key=int)


def _values(rows, *names) -> str:
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(repr(x) for x in r) + ')' for r in rows)}) AS t({', '.join(names)}))"


def tree(spark: SparkSession) -> dict[str, DataFrame]:
    """A small weakness tree: chains, two parents, a redirect (991 to 125), a node with classified children only (990)."""
    parent = spark.createDataFrame(_EDGES, "child string, parent string")
    node = spark.createDataFrame([(n, "DEPRECATED: gone" if n == "991" else f"Weakness {n}", "This is a duplicate of CWE-125." if n == "991" else "") for n in _NODES], "id string, name string, text string")
    return {"node": node, "parent": parent, "child": parent.select("parent", "child"), "cat699": spark.createDataFrame(_MEMBERS, "member string, category string")}


def lists(spark, sf_dir):
    return X.frame(spark, sf_dir, LISTS)


def _dim(spark, sf_dir, scheme):
    each = lists(spark, sf_dir).select(F.explode(taxonomy.cwe_items(F.col("cwes"))).alias("cwe"))
    return taxonomy.classify(each, tree(spark), scheme)


# ------------------------------------------------------------------ taxonomy


def g1_ancestors(spark, sf_dir):
    roots = lists(spark, sf_dir).select(F.explode(rules.split_cwes(F.col("cwes"))).alias("c")).select(F.replace("c", F.lit("CWE-"), F.lit("")).alias("root")).distinct()
    return taxonomy.ancestors(roots, tree(spark)["parent"]).select("root", "node", "depth")


def g2_pruned(spark, sf_dir):
    return taxonomy.prune_ancestors(lists(spark, sf_dir), "cwes", tree(spark)["parent"]).select("sample_id", "cwe_pruned")


def g3_classes(spark, sf_dir):
    return _dim(spark, sf_dir, taxonomy.CLASSES).select("cwe", F.array_join("classes", ";").alias("classes"), "rule")


def g5_types(spark, sf_dir):
    d = _dim(spark, sf_dir, taxonomy.TYPES)
    groups = F.create_map(*[F.lit(x) for kv in taxonomy.TYPE_TO_GROUP.items() for x in kv])
    return d.select("cwe", F.array_join("classes", ";").alias("types"), F.array_join(F.array_sort(F.array_distinct(F.transform("classes", lambda t: F.try_element_at(groups, t)))), ";").alias("groups"), "rule")


def g4_j16_classify_many(spark, sf_dir):
    pruned = taxonomy.prune_ancestors(lists(spark, sf_dir), "cwes", tree(spark)["parent"])
    return taxonomy.classify_many(pruned, "cwe_pruned", _dim(spark, sf_dir, taxonomy.CLASSES), "vuln_class").select("sample_id", "vuln_class", "vuln_class_all", "vuln_class_rule", "n_vuln_class")


def g6_top_ancestors(spark, sf_dir):
    each = lists(spark, sf_dir).select(F.explode(rules.split_cwes(F.col("cwes"))).alias("cwe"))
    return taxonomy.top_ancestors(each, tree(spark))


#: A hierarchy from the tables: parts are weaknesses under two others each, suppliers are categories under categories, the first of these under weaknesses, and all under a view without a name.
_TREE = {
    "node": "SELECT CAST(p_partkey AS STRING) AS id, 'w' AS name FROM {part} UNION ALL SELECT CAST(1000000 + s_suppkey AS STRING), 'c' FROM {supplier}",
    "parent": "SELECT CAST(p_partkey AS STRING) AS child, CAST(CAST(floor(p_partkey / d) AS BIGINT) AS STRING) AS parent FROM {part}, (SELECT 4 AS d UNION ALL SELECT 7) x WHERE p_partkey >= d",
    "member_of": "SELECT CAST(1000000 + s_suppkey AS STRING) AS child, CAST(CASE WHEN s_suppkey >= 10 THEN 1000000 + CAST(floor(s_suppkey / 10) AS BIGINT) ELSE 20 + s_suppkey END AS STRING) AS parent FROM {supplier} UNION ALL SELECT CAST(1000000 + s_suppkey AS STRING), '9999999' FROM {supplier}",
}
_ASKED = "SELECT 'CWE-' || id AS cwe FROM ({node}) n UNION ALL SELECT ' cwe-' || CAST(5000000 + s_suppkey AS STRING) FROM {supplier}"


def g6_hierarchy(spark, sf_dir):
    """The parentless nodes above every weakness and category of a hierarchy as large as the tables; unknown ids have none."""
    tables = {k: X.frame(spark, sf_dir, v) for k, v in _TREE.items()}
    return taxonomy.top_ancestors(X.frame(spark, sf_dir, _ASKED.replace("{node}", _TREE["node"])), tables)


def _grouped(spark, sf_dir):
    return taxonomy.add_groups(taxonomy.prune_ancestors(lists(spark, sf_dir), "cwes", tree(spark)["parent"]))


def g7_g8_groups(spark, sf_dir):
    return _grouped(spark, sf_dir).select("sample_id", "cwe_group", "cwe_group_src", "cwe_group_all", "n_cwe_groups", "cwe_multi_label")


def n40_n41_groups(spark, sf_dir):
    c = F.explode(rules.split_cwes(F.col("cwes"))).alias("cwe")
    return lists(spark, sf_dir).select("sample_id", c).select("sample_id", "cwe", rules.group_of(F.col("cwe")).alias("grp"), rules.is_precise(F.col("cwe")).alias("precise"), rules.informative(F.col("cwe")).alias("informative"))


def a18_class_report(spark, sf_dir):
    rows = taxonomy.classify_many(lists(spark, sf_dir), "cwes", _dim(spark, sf_dir, taxonomy.CLASSES), "vuln_class")
    return reports.class_report(rows, "vuln_class")


def a18_class_balance(spark, sf_dir):
    rows = taxonomy.classify_many(lists(spark, sf_dir), "cwes", _dim(spark, sf_dir, taxonomy.CLASSES), "vuln_class")
    return reports.class_balance(rows, "vuln_class")


def a21_pillars(spark, sf_dir):
    rows = lists(spark, sf_dir).withColumn("cwe_id", N.first(rules.split_cwes(F.col("cwes"))))
    return reports.pillar_report(rows, taxonomy.top_ancestors(rows.where("cwe_id IS NOT NULL").select(F.col("cwe_id").alias("cwe")), tree(spark)))


def k7_cwe_audit(spark, sf_dir):
    rows = lists(spark, sf_dir).withColumn("cwe_label_final", N.first(rules.split_cwes(F.col("cwes"))))
    return reports.per_cwe_audit(rows, _dim(spark, sf_dir, taxonomy.CLASSES))


def w5_top_per_group(spark, sf_dir):
    return reports.top_per_group(R.samples(spark, sf_dir).withColumn("host", L.project_key(F.col("commit_link"))), "host", "cwe_id")


def a20_sizes(spark, sf_dir):
    return reports.size_report(R.samples(spark, sf_dir), "cve_id")


def a20_gap(spark, sf_dir):
    return reports.gap_by(R.samples(spark, sf_dir).withColumn("source", F.coalesce("cve_source", F.lit("none"))), "source")


def k3_slices(spark, sf_dir):
    rows = R.j9_u1_cve_to_cwe(spark, sf_dir)
    unclear = sinks.ambiguous(R.j6_j7_apply_nvd(spark, sf_dir), ["status"])
    slices = {"conflict": sinks.cwe_conflict(rows), "missing_both": sinks.missing_both(rows), "ambiguous": unclear}
    return functools.reduce(DataFrame.unionByName, [d.select("sample_id", F.lit(k).alias("slice")) for k, d in slices.items()])


def k4_slices(spark, sf_dir):
    rows = R.j10_final_cwe(spark, sf_dir).join(R.samples(spark, sf_dir).select("sample_id", "cve_id"), "sample_id")
    return sinks.trainable(rows).select("sample_id", F.lit("trainable").alias("slice")).unionByName(sinks.gap(rows).select("sample_id", F.lit("gap").alias("slice")))


# ------------------------------------------------------------------ links and languages


def n28_n30_repo_keys(spark, sf_dir):
    c = F.col("commit_link")
    return R.raw_samples(spark, sf_dir).select("sample_id", L.repo_key(c).alias("repo_key"), L.project_key(c).alias("project_key"), L.project_key_ownerrepo(c).alias("owner_repo"))


def v11_split(spark, sf_dir):
    rows = R.raw_samples(spark, sf_dir).withColumn("project_key", L.project_key(F.col("commit_link")))
    return lines.split_by_project(rows).select("sample_id", "project_key", "split")


FILES = """
SELECT p_partkey AS sample_id, CASE p_partkey % 6 WHEN 0 THEN '.C' WHEN 1 THEN 'hpp' WHEN 2 THEN 'unknown' WHEN 3 THEN NULL WHEN 4 THEN 'tar.py' ELSE '' END AS extension,
 CASE p_partkey % 4 WHEN 0 THEN 'src/a.b/main.rs' WHEN 1 THEN 'Makefile' WHEN 2 THEN NULL ELSE 'x.TS' END AS file_name,
 CASE p_partkey % 3 WHEN 0 THEN 'https://git.x.org/commit/drivers/net/slip/slhc.c?id=1' WHEN 1 THEN 'https://git.x.org/commit/lib%2Fa.go' ELSE NULL END AS commit_link,
 CASE p_partkey % 5 WHEN 0 THEN 'touch a.c and b.cpp' WHEN 1 THEN 'edit foo.py, bar.js' WHEN 2 THEN 'no file' WHEN 3 THEN NULL ELSE 'see net/x.java' END AS commit_message
FROM {part}
"""


def l1_n26_n27_cascade(spark, sf_dir):
    return language.cascade(X.frame(spark, sf_dir, FILES)).select("sample_id", "language", "language_source", "language_confidence")


def n31_message_family(spark, sf_dir):
    return X.frame(spark, sf_dir, FILES).select("sample_id", L.family_from_commit_message(F.col("commit_message")).alias("family"))


#: Predictions of a classifier for both versions, from documents.
WITNESSES = """
SELECT doc_id AS sample_id, source AS repo_key, source AS project_key, text AS func_before,
 CASE doc_id % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'C++' WHEN 2 THEN 'Java' WHEN 3 THEN 'Unknown' ELSE NULL END AS before_language, (doc_id % 10) / 10.0D AS before_score, (doc_id % 4) / 10.0D AS before_margin,
 CASE doc_id % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'Java' ELSE NULL END AS after_language, (doc_id % 8) / 8.0D AS after_score, (doc_id % 5) / 10.0D AS after_margin,
 CASE WHEN doc_id % 2 = 0 THEN 'extension' ELSE 'github_linguist' END AS language_source,
 CASE lang WHEN 'en' THEN 'C' WHEN 'de' THEN 'Java' WHEN 'fr' THEN 'C++' ELSE 'Python' END AS true_language,
 CASE doc_id % 7 WHEN 0 THEN 'see a.c' WHEN 1 THEN 'see b.java' ELSE NULL END AS commit_message
FROM {documents}
"""


def _predicted(spark, sf_dir):
    w = X.frame(spark, sf_dir, WITNESSES)

    def p(side):
        return F.when(F.col(f"{side}_language").isNotNull(), F.struct(F.col(f"{side}_language").alias("language"), F.col(f"{side}_score").cast("double").alias("score"), F.col(f"{side}_margin").cast("double").alias("margin")))

    return w.withColumn("p", L.combine_predictions(p("before"), p("after")))


def n36_n37_predictions(spark, sf_dir):
    d = _predicted(spark, sf_dir).select("sample_id", "p.*")
    return d.select("sample_id", "language", "language_family", F.round("score", 9).alias("score"), F.round("margin", 9).alias("margin"), "confidence", "agree", "exact_agree", "decision", "review")


def a8_language_prior(spark, sf_dir):
    rows = X.frame(spark, sf_dir, WITNESSES).where("language_source = 'extension'")
    return language.language_prior(rows, "repo_key", "true_language", min_purity=0.5).select("repo_key", "prior", F.round("purity", 9).alias("purity"), "support")


def _reconciled(spark, sf_dir):
    rows = _predicted(spark, sf_dir)
    rows = rows.select("sample_id", "repo_key", "project_key", "func_before", "commit_message", "language_source", F.when(F.col("language_source") == "extension", F.col("true_language")).otherwise(F.col("p.language")).alias("language"), F.col("p.language_family").alias("language_family"), F.col("p.confidence").alias("language_confidence"), F.col("p.decision").alias("language_decision"), F.col("p.review").alias("needs_language_review"))
    trusted = rows.where("language_source = 'extension'")
    prior = language.language_prior(trusted, "repo_key", min_purity=0.6)
    return language.reconcile(language.attach_prior(rows, prior, prior.withColumnRenamed("repo_key", "project_key")))


def l2_j12_reconcile(spark, sf_dir):
    return _reconciled(spark, sf_dir).select("sample_id", "language", "language_source", "language_confidence", "language_decision", "needs_language_review", "reconcile_case")


def l3_finalise(spark, sf_dir):
    return language.finalise(_reconciled(spark, sf_dir)).select("sample_id", "language", "language_confidence", "needs_language_review")


def a23_case_counts(spark, sf_dir):
    return reports.case_counts(_reconciled(spark, sf_dir), "reconcile_case")


def l4_n33_rule_pass(spark, sf_dir):
    """Code-like text: each document behind a line of code of one of five languages."""
    rows = _reconciled(spark, sf_dir)
    code = F.element_at(F.array(F.lit("#include <stdio.h>\nint main(void) { char *p = NULL; }\n"), F.lit("import java.util.List;\npublic static void main(String[] a) { System.out.println(1); }\n"), F.lit("def f(self):\n    return self.x is None\n"), F.lit("func main() {\n if err != nil { defer x() }\n y := 1\n}\n"), F.lit("fn main() { let mut s = String::new(); s.unwrap() }\n")), (F.col("sample_id") % 5 + 1).cast("int"))
    rows = rows.withColumns({"func_before": F.concat(code, "func_before"), "func_after": F.concat(code, F.lit("x"))})
    return language.rule_pass(rows).select("sample_id", "language", "language_source", "language_confidence", "rule_case", "rule_language", "rule_margin")


def a9_j13_token_prior(spark, sf_dir):
    rows = X.frame(spark, sf_dir, WITNESSES)
    prior = language.token_prior(rows.where("language_source = 'extension'"), "func_before", "true_language")
    scores = language.token_scores(rows, "sample_id", "func_before", prior)
    return scores.select("sample_id", "token_group", F.round("token_score", 6).alias("token_score"), F.round("token_margin", 6).alias("token_margin"), "token_confident")


def l5_group_vote(spark, sf_dir):
    w = X.frame(spark, sf_dir, WITNESSES)
    rows = w.select("sample_id", "language_source", F.col("true_language").alias("language"), F.lit("high").alias("language_confidence"), L.family_of(F.col("before_language")).alias("classifier"), L.family_of(F.col("after_language")).alias("prior"), F.when(F.col("sample_id") % 11 < 6, L.family_of(F.col("true_language"))).alias("rule_group"), (F.col("sample_id") % 6).cast("int").alias("rule_margin"), F.when(F.col("sample_id") % 13 < 5, F.lit("Java")).alias("token_group"))
    return language.group_vote(rows).select("sample_id", "language_group", "group_source", "group_confidence", "group_n_sources", "needs_group_review")


def j17_manual(spark, sf_dir):
    votes = l5_group_vote(spark, sf_dir)
    manual = votes.where("sample_id % 17 = 3").select("sample_id", F.lit("Go").alias("language_group"))
    return language.apply_manual(votes, manual).select("sample_id", "language_group", "group_source", "group_confidence", "needs_group_review")


# ------------------------------------------------------------------ line labels

#: Documents with two lines or more: the fixed version lacks line 1 + doc_id % n, or has it replaced.
PAIRS = """
SELECT doc_id, n, 1 + doc_id % n AS k, doc_id % 3 AS kind, text FROM
 (SELECT doc_id, text, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INT) AS n FROM {documents}) d WHERE n >= 2
"""


def _pairs(spark, sf_dir, raw=False):
    """All documents of PAIRS. A line that occurred before gets its number appended, so that the alignment is what the edit says and SQL can know it; ``raw`` leaves the lines as they are."""
    p = X.frame(spark, sf_dir, PAIRS)
    k = F.col("k").cast("int")

    def numbered(lines):
        again = F.transform(lines, lambda t, i: F.when(F.array_position(lines, t) == i + 1, t).otherwise(F.concat(t, F.lit(" again "), i + 1)))
        return F.when(F.size(F.array_distinct(lines)) == F.size(lines), lines).otherwise(again)

    def versions(lines):
        edited = F.transform(lines, lambda t, i: F.when(i + 1 == k, F.concat(F.lit("edited "), t)).otherwise(t))
        after = F.when(F.col("kind") == 0, F.filter(lines, lambda t, i: i + 1 != k)).when(F.col("kind") == 1, edited).otherwise(lines)
        return F.struct(F.array_join(lines, "\n").alias("before"), F.array_join(after, "\n").alias("after"))

    whole = F.split("text", "\n")
    both = let(whole, versions) if raw else let(whole, lambda x: let(numbered(x), versions))
    # A generator's columns are computed once a row; an expression would be repeated in each use of theirs, and by each filter.
    made = p.select("doc_id", "n", "k", "kind", F.inline(F.array(both)))
    return made.select(F.col("doc_id").cast("string").alias("key"), "n", "k", "kind", "before", "after", F.when(F.col("doc_id") % 19 == 0, F.lit(None)).otherwise(F.lit("lua")).alias("lang"))


def v1_w3_alignment(spark, sf_dir):
    return lines.renumber(lines.align(_pairs(spark, sf_dir))).select("key", "union_line", "in_before", "in_after", "is_added", "is_removed", "before_line", "after_line")


def v1_raw_alignment(spark, sf_dir):
    """The alignment on the texts as they are, repeated lines included: what the diff pairs there is its own choice, which SQL can't express (tests compare with a plain diff)."""
    return lines.renumber(lines.align_distinct(_pairs(spark, sf_dir, raw=True))).select("key", "union_line", "in_before", "in_after", "is_added", "is_removed", "before_line", "after_line")


def v2_gates(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return lines.gates(pairs, lines.align(pairs), 0.4, 2)


def _graphs(spark, sf_dir, long):
    """A line graph with edges (i, i + 1) as control and (i, i + 3) as data dependence over the union lines, encoded as in files, offset 1."""
    return _line_graphs(long.groupBy("key").agg(F.max("union_line").alias("m")))


def _line_graphs(sizes):
    """The graphs of ``_graphs`` for samples (key, m union lines)."""
    n = sizes.where("cast(key AS long) % 4 <> 0")
    seq = F.sequence(F.lit(1), F.col("m"))

    def edges(step):
        return F.to_json(F.transform(seq, lambda i: F.array(i + 1, i + 1 + step)))

    return n.select("key", F.lit("lua").alias("lang"), F.lit(1).alias("offset"), F.to_json(F.transform(seq, lambda i: i + 1)).alias("lines"), edges(1).alias("cdg"), edges(3).alias("rd"))


def s10_graph_sizes(spark, sf_dir):
    long = lines.align(_pairs(spark, sf_dir))
    return lines.graph_edges(_graphs(spark, sf_dir, long))[1].select("key", F.col("n_graph_lines").cast("int").alias("n_graph_lines"), "n_cdg", "n_ddg")


def _labels(spark, sf_dir, pairs=None):
    pairs = _pairs(spark, sf_dir) if pairs is None else pairs
    long = sinks.stage_table(lines.align(pairs, max_lines=4 * lines.MAX_LINES), sinks.work_folder(spark), "long")
    edges, sizes = lines.graph_edges(_graphs(spark, sf_dir, long))
    return pairs, long, *lines.line_labels(pairs, long, edges, sizes, 0.9, 0)


def v3_v5_status(spark, sf_dir):
    return _labels(spark, sf_dir)[2]


def j14_u4_vul_lines(spark, sf_dir):
    _, _, _, found = _labels(spark, sf_dir)
    return found.select("key", "union_line", "from_removed", "from_depadd")


def v6_v8_final(spark, sf_dir):
    pairs, long, status, found = _labels(spark, sf_dir)
    flaws = pairs.where("cast(key AS long) % 5 = 0").select("key", F.element_at(F.split("before", "\n"), 1).alias("text"))
    s, final = lines.fuse(status, found, lines.external_lines(long, flaws))
    nosig = lines.collapse(lines.without_signature(final, long), "vul_lines_nosig")
    numbered = final.join(lines.renumber(long).select("key", "union_line", "before_line"), ["key", "union_line"])
    out = s.join(lines.collapse(final, "vul_lines_final"), "key", "left").join(nosig, "key", "left").join(lines.collapse(numbered, "vul_lines_fb", "before_line"), "key", "left").join(lines.label_text(final, long), "key", "left")
    return out.select("key", "status", "label_source", "coord_space", "completeness", "has_line_label", "vul_lines_final", "vul_lines_nosig", "vul_lines_fb", F.md5("vul_text").alias("text_md5"))


def v8_renumbered(spark, sf_dir):
    _, long, _, found = _labels(spark, sf_dir)
    r = lines.renumbered(long, found)
    return r.select("key", *[F.array_join(c, ";").alias(c) for c in r.columns if c != "key"], *[F.size(c).alias(f"n_{c}") for c in ("vul_lines_fb", "removed_lines_fb", "depadd_lines_fb")])


def j15_u6_merge(spark, sf_dir):
    """Every fifth sample has external lines already, and only one language is asked for: the others are labelled and merged onto all samples."""
    rows = _pairs(spark, sf_dir).withColumn("has_bigvul_lines", F.col("key").cast("long") % 5 == 0)
    _, _, status, _ = _labels(spark, sf_dir, lines.to_label(rows, ["lua"]))
    return lines.merge_results(rows.select("key", "has_bigvul_lines"), status).select("key", "has_bigvul_lines", "status", "confidence", "n_lines", "n_vul", "derived_ok")


def _line_changes(spark, sf_dir):
    """The pairs as a line-change set: JSON lines with the deleted line's number, parsed by the reader's rules."""
    p = _pairs(spark, sf_dir)
    gone = F.when(F.col("kind") < 2, F.array(F.struct(F.col("k").cast("int").alias("line_no"), F.element_at(F.split("before", "\n"), F.col("k").cast("int")).alias("line")))).otherwise(F.array().cast("array<struct<line_no:int,line:string>>"))
    doc = F.to_json(F.struct(F.concat(F.lit("f"), F.col("key")).alias("func_name"), F.col("before").alias("func_src_before"), F.col("after").alias("func_src_after"), F.when(F.col("lang").isNull(), "a").otherwise("src/a.lua").alias("file_name"), F.lit("cwe-079").alias("vul_type"), F.struct(gone.alias("deleted")).alias("line_changes")))
    raw = p.select("key", F.concat(F.lit("set/"), F.when(F.col("kind") == 0, "val").otherwise("train"), F.lit("/cwe.jsonl")).alias("path"), doc.alias("json"))
    rows = readers.line_changes(readers.parse(raw, readers.LINE_CHANGE_SCHEMA))
    return rows.withColumns({"before": F.col("func_src_before"), "after": F.col("func_src_after"), "lang": lines.resolve(F.col("language"))})


def v10_line_changes(spark, sf_dir):
    rows = _line_changes(spark, sf_dir)
    aligned = lines.align(rows.select("key", "split", "cwe_id", "before", "after", "lang", "deleted"), max_lines=4 * lines.MAX_LINES, compact=True)
    aligned = sinks.stage_table(aligned, sinks.work_folder(spark), "aligned")
    graphs = lines.graph_rows(_line_graphs(aligned.where("n_lines > 0").select("key", F.col("n_lines").alias("m"))))
    out = lines.change_labels(aligned, graphs)
    kept = ("deleted", "depadd_lines_fb", "vul_lines_linevd", "vul_lines_final")
    return out.select("key", "split", "cwe_id", "status", "derived_ok", "label_completeness", "has_line_label", *[F.array_join(c, ";").alias(c) for c in kept])


def a15_agreement(spark, sf_dir):
    """The lines found against every sample's first line and edited line as external ones."""
    pairs, _, _, found = _labels(spark, sf_dir)
    ours = found.where("from_removed").groupBy("key").agg(F.collect_list(F.col("union_line").cast("string")).alias("ours"))
    theirs = F.when(F.col("kind") == 0, F.array(F.lit(" 1 "), F.col("k").cast("string"))).otherwise(F.array(F.col("k").cast("string")))
    return lines.agreement(pairs.select("key", theirs.alias("theirs")).join(ours, "key"))


def a12_coverage(spark, sf_dir):
    _, _, status, _ = _labels(spark, sf_dir)
    s = status.withColumn("label_source", F.when(F.col("n_vul") > 0, "derived").otherwise("none"))
    return reports.coverage(s)


def a13_by_language(spark, sf_dir):
    pairs, _, status, _ = _labels(spark, sf_dir)
    return reports.by_language(status.join(pairs.select("key", "lang"), "key"))


def a17_per_cwe_lines(spark, sf_dir):
    pairs, _, status, _ = _labels(spark, sf_dir)
    return reports.per_cwe_lines(status.join(pairs.select("key", F.concat(F.lit("CWE-"), F.col("kind")).alias("cwe")), "key"))


def a12_origin_share(spark, sf_dir):
    return reports.origin_share(_labels(spark, sf_dir)[3])


def k5_failures(spark, sf_dir):
    _, _, status, _ = _labels(spark, sf_dir)
    return sinks.failures(status.withColumn("has_line_label", F.col("n_vul") > 0)).select("key", "status", "confidence")


def a12_a13_status_report(spark, sf_dir):
    return reports.status_counts(_labels(spark, sf_dir)[2])


def a14_failure_reasons(spark, sf_dir):
    pairs, _, status, _ = _labels(spark, sf_dir)
    return reports.failure_reasons(status.join(pairs.select("key", "lang"), "key"), ["unsupported_language", "no_change", "diff_too_large"])


def a16_precision_recall(spark, sf_dir):
    pairs, _, _, found = _labels(spark, sf_dir)
    ours = found.where("from_removed").groupBy("key").agg(F.array_sort(F.collect_list("union_line")).alias("ours"))
    given = pairs.where("kind < 2 AND lang IS NOT NULL").select("key", F.array(F.col("k").cast("int")).alias("given"))
    return lines.precision_recall(given.join(ours, "key", "left").withColumn("ours", F.coalesce("ours", F.array().cast("array<int>"))))


def w1_j11_flaw_lines(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    h = N.norm_hash(F.col("text"))
    ref = d.where("doc_id % 2 = 0").select(h.alias("h"), F.when(F.col("doc_id") % 4 == 0, F.col("text")).alias("lines_before"), (F.col("doc_id") % 3).cast("int").alias("vul"), F.lit("f").alias("file"), F.col("doc_id").alias("pos"), F.concat(F.lit("CVE-"), F.col("doc_id") % 2).alias("cve"), F.col("lang").alias("commit"))
    rows = d.select("doc_id", h.alias("h"), F.lit("CVE-0").alias("cve_id"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("commit_sha"), "lang")
    return lines.attach_flaw_lines(rows, ref).select("doc_id", "line_count", "matched", "match_level")


def _with_flaw_lines(spark, sf_dir):
    return w1_j11_flaw_lines(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("lang").alias("language")), "doc_id")


def a11_flaw_line_coverage(spark, sf_dir):
    return reports.flaw_line_coverage(_with_flaw_lines(spark, sf_dir))


def a11_line_count_histogram(spark, sf_dir):
    return reports.line_count_histogram(w1_j11_flaw_lines(spark, sf_dir))


def a11_line_count_stats(spark, sf_dir):
    return reports.line_count_stats(w1_j11_flaw_lines(spark, sf_dir))


def u3_w2_incremental(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.md5("text").alias("sample_key"), F.col("doc_id").alias("load"))
    cache = d.where("load % 3 = 0")
    todo = lines.pending(d, cache).select("sample_key", F.lit(-1).cast("long").alias("load"))
    return lines.keep_last(cache, todo)


def k1_k5_one_write(spark, sf_dir):
    """Every slice of the recovered labels, written by one job and read back."""
    j = R.j9_u1_cve_to_cwe(spark, sf_dir).select("sample_id", "cve_id", "cwe_id", "cwe_candidates")
    v = R.j6_j7_apply_nvd(spark, sf_dir).select("sample_id", F.col("status").alias("nvd_status"))
    f = R.j10_final_cwe(spark, sf_dir).select("sample_id", "cwe_label_final")
    path = f"{sinks.work_folder(spark)}/slices"
    sinks.write_slices(j.join(v, "sample_id").join(f, "sample_id"), sinks.review_slices(["nvd_status"]), path)
    return spark.read.parquet(path).select("sample_id", "slice", "cve_id", "cwe_id", "cwe_label_final")


def _sized_contents(pairs):
    """Contents that have a graph, and how many union lines they have."""
    key = N.joern_key(F.col("before"), F.col("after"), F.col("lang"))
    return pairs.select(key.alias("key"), (F.col("n") + (F.col("kind") == 1).cast("int")).cast("int").alias("m")).where("substring(key, 1, 1) >= '4'").distinct()


def _content_graphs(one, second):
    """Line graphs by content: three of four have one, as in ``_graphs``; in the ``second`` round every fourth of these lost its data dependences."""
    seq = F.sequence(F.lit(1), F.col("m"))

    def edges(step):
        return F.to_json(F.transform(seq, lambda i: F.array(i + 1, i + 1 + step)))

    rd = F.when(F.substring("key", 2, 1) < "4", F.lit("[]")).otherwise(edges(3)) if second else edges(3)
    return one.select("key", F.lit("lua").alias("lang"), F.lit(1).alias("offset"), F.to_json(F.transform(seq, lambda i: i + 1)).alias("lines"), edges(1).alias("cdg"), rd.alias("rd"))


def u3_w2_n25_rounds(spark, sf_dir):
    """Two rounds over one store of results: some graphs change before the second, which labels only their samples again."""
    folder = sinks.work_folder(spark)
    pairs = _pairs(spark, sf_dir)
    sized = sinks.stage_table(_sized_contents(pairs), folder, "contents")
    first, second = (_content_graphs(sized, late) for late in (False, True))
    store = incremental.label_store(spark, f"{folder}/results", digits=1, files=1)
    incremental.label_increment(pairs, first, store, 0.9, 0)
    out = incremental.label_increment(pairs, second, store, 0.9, 0)
    return out.select("key", "load", "status", "confidence", "n_lines", "n_removed", "n_added", "n_cdg", "n_ddg", "n_vul", *[F.array_join(c, ";").alias(c) for c in ("vul_lines", "vul_lines_fb")])


# ------------------------------------------------------------------ nested sources, from the flat references


def _osv_docs(spark, sf_dir):
    """References as advisory documents, one a row, parsed with the reader's schema: some withdrawn, some broken."""
    refs = X.frame(spark, sf_dir, X.REFS)
    doc = F.to_json(F.struct(F.concat(F.lit("OSV-"), F.col("ref_id")).alias("id"), F.array("cve").alias("aliases"), F.when(F.col("ref_id") % 10 == 0, F.lit("2024-01-01")).alias("withdrawn"), F.array(F.struct(F.col("kind").alias("type"), "url")).alias("references"), F.struct(F.array("cwe").alias("cwe_ids")).alias("database_specific")))
    raw = refs.select("ref_id", F.when(F.col("ref_id") % 17 == 0, F.lit("{broken")).otherwise(doc).alias("json"))
    return readers.osv_live(readers.parse(raw, readers.OSV_SCHEMA))


def s2_n12_n13_osv(spark, sf_dir):
    return readers.osv_references(_osv_docs(spark, sf_dir)).select("cve", F.array_join("cwes", ";").alias("cwes"), "url", "kind")


def s3_n14_nvd(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS)
    item = F.struct(F.struct(F.lower("cve").alias("id"), F.array(F.struct(F.when(F.col("ref_id") % 2 == 0, "Primary").otherwise("Secondary").alias("type"), F.array(F.struct(F.lit("en").alias("lang"), F.col("cwe").alias("value"))).alias("description"))).alias("weaknesses"), F.array(F.struct("url", F.array(F.when(F.col("kind") == "FIX", "Patch").otherwise("Other")).alias("tags"))).alias("references"), F.concat(F.lit("see CWE-0"), F.col("ref_id") % 50).alias("evaluatorComment")).alias("cve"))
    feeds = readers.parse(refs.select("ref_id", F.to_json(F.struct(F.array(item).alias("vulnerabilities"))).alias("json")), readers.NVD_SCHEMA)
    r = readers.nvd_records(feeds)
    return readers.nvd_references(r).join(r.select("cve", "evaluator_cwes").groupBy("cve").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("evaluator_cwes")))), ";").alias("evaluator")), "cve").select("cve", F.array_join("cwes", ";").alias("cwes"), F.array_join("primary_cwes", ";").alias("primary_cwes"), "url", "kind", "evaluator")


def s3_a3_feeds(spark, sf_dir):
    """Records of three feeds as the feed source hands them over; of each CVE the last record of the last feed wins."""
    refs = X.frame(spark, sf_dir, X.REFS)
    item = F.struct(F.struct(F.lower("cve").alias("id"), F.array(F.struct(F.lit("Primary").alias("type"), F.array(F.struct(F.lit("en").alias("lang"), F.col("cwe").alias("value"))).alias("description"))).alias("weaknesses")).alias("cve"))
    records = refs.select((F.col("ref_id") % 3).cast("int").alias("file_rank"), F.col("ref_id").cast("long").alias("position"), F.to_json(item).alias("json"))
    rows = readers.nvd_items(readers.parse(records, readers.NVD_ITEM).select(feeds.ordinal().alias("ordinal"), "cve"))
    last = cwe_ladder.last_record(rows).join(rows.groupBy("cve").agg(F.max("ordinal").alias("o")), "cve")
    return last.select("cve", F.array_join("cwes", ";").alias("cwes"), "o.file_rank", "o.position")


def s4_s5_n16_cvelist(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS)
    cna = F.struct(F.array(F.struct(F.array(F.struct(F.col("cwe").alias("cweId"), F.lit("also CWE-5").alias("description"))).alias("descriptions"))).alias("problemTypes"), F.array(F.struct("url", F.array(F.when(F.col("kind") == "FIX", "x_refsource_PATCH").otherwise("vdb")).alias("tags"))).alias("references"))
    doc = F.struct(F.struct(F.col("cve").alias("cveId"), F.when(F.col("ref_id") % 7 == 0, "REJECTED").otherwise("PUBLISHED").alias("state")).alias("cveMetadata"), F.struct(cna.alias("cna"), F.array(cna).alias("adp")).alias("containers"))
    raw = refs.select("ref_id", F.when(F.col("ref_id") % 13 == 0, F.lit("[]")).otherwise(F.to_json(doc)).alias("json"))
    r = readers.cvelist_records(readers.parse(raw, readers.CVELIST_SCHEMA))
    return r.select("cve", "container", F.array_join("cwes", ";").alias("cwes"), F.array_join("primary_cwes", ";").alias("primary_cwes"), F.size("references").alias("n_refs"))


def a22_scan_counters(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS)
    live = _osv_docs(spark, sf_dir)
    return readers.scan_counters(refs, live, readers.osv_references(live))


def s11_s12_enrichment(spark, sf_dir):
    refs = X.frame(spark, sf_dir, X.REFS)
    docs = refs.select("ref_id", F.to_json(F.create_map(F.concat(F.lit(" "), F.lower("cve")), F.array(F.struct(F.concat(F.lit("cwe-0"), F.substring("cwe", 5, 9)).alias("cweID"))))).alias("json"))
    return readers.enrichment_map(docs, "third").select("cve", F.array_join("cwes", ";").alias("cwes"))


QUERIES = {k: v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and k[0] in "najpulgvskw" and k[1:2].isdigit()}
SQL: dict[str, str] = {}

# ---------------------------------------------------------------- SQL twins

_LISTS = f"lists AS ({X.text(LISTS)})"
_E = _values(_EDGES, "child", "parent")
_ITEMS = "items AS (SELECT sample_id, cwes, unnest(string_split(cwes, ';')) AS cwe FROM lists)"
_UP = f"up AS (SELECT DISTINCT replace(cwe, 'CWE-', '') AS root, replace(cwe, 'CWE-', '') AS node, 0 AS depth FROM items UNION SELECT up.root, e.parent, up.depth + 1 FROM up JOIN {_E} e ON e.child = up.node WHERE up.depth < 12), upm AS (SELECT root, node, min(depth) AS depth FROM up WHERE root <> node GROUP BY 1, 2)"
_PAIR = f"p AS (SELECT * EXCLUDE (l0), CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 19 = 0 THEN NULL ELSE 'lua' END AS lang, list_transform(l0, lambda t, i: CASE WHEN list_position(l0, t) = i THEN t ELSE t || ' again ' || CAST(i AS VARCHAR) END) AS l FROM (SELECT *, string_split(text, chr(10)) AS l0 FROM ({X.text(PAIRS)})))"
_UNION = f"""{_PAIR}, u0 AS (SELECT key, doc_id, n, k, kind, lang, l, CAST(unnest(range(1, n + 1 + CASE WHEN kind = 1 THEN 1 ELSE 0 END)) AS INT) AS i FROM p),
u AS (SELECT *, kind = 1 AND i = k + 1 AS is_added, kind < 2 AND i = k AS is_removed, i - CASE WHEN kind = 1 AND i > k THEN 1 ELSE 0 END AS bl, i - CASE WHEN kind < 2 AND i > k THEN 1 ELSE 0 END AS al FROM u0)"""
_MARK = f"""{_UNION}, m AS (SELECT *, is_removed AS r, kind = 1 AND doc_id % 4 <> 0 AND i - k IN (0, 2, 4, -2) AS d FROM u WHERE lang IS NOT NULL AND kind < 2 AND NOT is_added),
lab AS (SELECT key, i AS union_line, r AS from_removed, d AS from_depadd FROM m WHERE (r OR d) AND trim(l[bl]) <> ''),
st AS (SELECT p.key, p.lang, p.kind, n + CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_lines, CASE WHEN kind < 2 THEN 1 ELSE 0 END AS n_removed, CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_added, doc_id % 4 <> 0 AS g, coalesce(c, 0) AS n_vul FROM p LEFT JOIN (SELECT key, count(*) AS c FROM lab GROUP BY 1) x ON x.key = p.key),
status AS (SELECT key, lang, CASE WHEN lang IS NULL THEN 'unsupported_language' WHEN kind = 2 THEN 'no_change' WHEN g AND n_vul > 0 THEN CASE WHEN kind = 0 THEN 'joern_delete_only' ELSE 'joern_ok' END WHEN kind = 0 THEN 'ok_delete_only' ELSE 'no_pdg_signal' END AS status, CASE WHEN lang IS NULL OR kind = 2 THEN 'none' WHEN (g AND n_vul > 0) OR kind = 0 THEN 'high' ELSE 'low' END AS confidence, n_lines, n_removed, n_added, CASE WHEN g THEN n_lines ELSE 0 END AS n_cdg, CASE WHEN g THEN n_lines ELSE 0 END AS n_ddg, n_vul FROM st)"""
_OK = "({s} IN (" + ", ".join(repr(x) for x in lines.USABLE) + "))"
_FLAW = """d AS (SELECT *, md5(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS h FROM documents),
ref AS (SELECT h, arg_min({'l': CASE WHEN doc_id % 4 = 0 THEN text END, 'c': lang}, (CASE WHEN doc_id % 4 = 0 AND trim(text) <> '' THEN 0 ELSE 1 END, CASE WHEN doc_id % 3 = 1 THEN 0 ELSE 1 END, doc_id)) AS b FROM d WHERE doc_id % 2 = 0 AND h IS NOT NULL GROUP BY 1),
fl0 AS (SELECT doc_id, lang, coalesce(trim(b.l), '') <> '' AS matched, b.l AS l, coalesce(doc_id % 3 = 0 AND lang = b.c, FALSE) AS same FROM d LEFT JOIN ref ON ref.h = d.h),
fl AS (SELECT doc_id, lang, matched, CASE WHEN matched THEN CAST(len(list_filter(string_split(l, chr(10)), lambda t: trim(t) <> '')) AS INT) ELSE 0 END AS line_count, CASE WHEN NOT matched THEN NULL WHEN same THEN 'func_commit_cve' ELSE 'func_and_cve' END AS match_level FROM fl0)"""
_R = f"refs AS ({X.text(X.REFS)})"
_RAW = f"raw AS ({X.text(X.SAMPLES)}), pk AS (SELECT *, CAST(project % 40 AS VARCHAR) AS pj, sha1(CAST(project AS VARCHAR)) AS sha FROM raw)"
_PROJECT = "CASE project % 8 WHEN 0 THEN NULL WHEN 3 THEN substr(sha, 1, 12) WHEN 6 THEN sha ELSE 'proj' || pj END"


def _fam(c: str) -> str:
    return f"CASE WHEN {c} IN ('C', 'C++') THEN 'C/C++' ELSE {c} END"


def _conf(s: str, m: str, agreed: bool) -> str:
    a, b, c, d = (0.55, 0.15, 0.30, 0.08) if agreed else (0.70, 0.20, 0.50, 0.12)
    return f"CASE WHEN {s} >= {a}::DOUBLE AND {m} >= {b}::DOUBLE THEN 'high' WHEN {s} >= {c}::DOUBLE AND {m} >= {d}::DOUBLE THEN 'medium' ELSE 'low' END"


_WIT = f"w AS (SELECT *, CAST(before_score AS DOUBLE) AS bs, CAST(before_margin AS DOUBLE) AS bm, CAST(after_score AS DOUBLE) AS s2, CAST(after_margin AS DOUBLE) AS m2 FROM ({X.text(WITNESSES).replace('10.0D', '10.0::DOUBLE').replace('8.0D', '8.0::DOUBLE')}))"
_CASES = f"""{_WIT}, c AS (SELECT *, CASE WHEN before_language IS NULL AND after_language IS NULL THEN 'no_prediction' WHEN after_language IS NULL THEN 'before_only' WHEN before_language IS NULL THEN 'after_only' WHEN before_language = after_language THEN 'before_after_exact_agree'
 WHEN {_fam('before_language')} = {_fam('after_language')} THEN 'before_after_family_agree_choose_' || CASE WHEN bs + bm >= s2 + m2 THEN 'before' ELSE 'after' END ELSE 'disagree_choose_' || CASE WHEN bs + bm >= s2 + m2 THEN 'before' ELSE 'after' END END AS decision FROM w),
c2 AS (SELECT *, decision LIKE '%agree%' AND decision NOT LIKE 'disagree%' AS agree, CASE WHEN decision = 'no_prediction' THEN 'Unknown' WHEN decision LIKE '%after' AND decision LIKE '%choose%' OR decision = 'after_only' THEN after_language ELSE before_language END AS language FROM c),
c3 AS (SELECT *, CASE WHEN decision = 'no_prediction' THEN 0.0 WHEN agree THEN (bs + s2) / 2 WHEN decision IN ('after_only', 'disagree_choose_after') THEN s2 ELSE bs END AS sc, CASE WHEN decision = 'no_prediction' THEN 0.0 WHEN agree THEN (bm + m2) / 2 WHEN decision IN ('after_only', 'disagree_choose_after') THEN m2 ELSE bm END AS ma FROM c2),
c4 AS (SELECT *, CASE WHEN agree THEN {_conf('sc', 'ma', True)} WHEN decision LIKE 'disagree%' AND {_conf('sc', 'ma', False)} = 'high' THEN 'medium' ELSE {_conf('sc', 'ma', False)} END AS confidence FROM c3)"""

def _rounds_sql() -> str:
    """_MARK with graphs by content, the second round's; ``c``: the graph changed between the rounds."""
    after = "CASE kind WHEN 0 THEN array_to_string(list_filter(l, lambda t, i: i <> k), chr(10)) WHEN 1 THEN array_to_string(list_transform(l, lambda t, i: CASE WHEN i = k THEN 'edited ' || t ELSE t END), chr(10)) ELSE array_to_string(l, chr(10)) END"
    key = f"sha1(array_to_string(l, chr(10)) || chr(0) || {after} || chr(0) || coalesce(lang, 'None') || chr(0))"
    mark = _MARK.replace("p AS (", "p0 AS (", 1).replace(", u0 AS (", f", p1 AS (SELECT *, {key} AS jk FROM p0), p AS (SELECT *, substr(jk, 1, 1) >= '4' AS g, substr(jk, 1, 1) >= '4' AND substr(jk, 2, 1) < '4' AS c FROM p1), u0 AS (", 1)
    mark = mark.replace("SELECT key, doc_id, n, k, kind, lang, l, CAST", "SELECT key, doc_id, n, k, kind, lang, l, g, c, CAST", 1)
    mark = mark.replace("doc_id % 4 <> 0 AND i - k IN (0, 2, 4, -2)", "g AND (i - k IN (0, 2) OR (NOT c AND i - k IN (4, -2)))", 1).replace("doc_id % 4 <> 0 AS g, coalesce(c, 0) AS n_vul", "p.g, p.c, coalesce(x.c, 0) AS n_vul", 1)
    mark = mark.replace("CASE WHEN g THEN n_lines ELSE 0 END AS n_ddg", "CASE WHEN g AND NOT c THEN n_lines ELSE 0 END AS n_ddg, CASE WHEN c THEN 2 ELSE 1 END AS load", 1)
    lists = "v AS (SELECT lab.key, array_to_string(list_sort(list(union_line)), ';') AS vul_lines, array_to_string(list_sort(list(bl)), ';') AS vul_lines_fb FROM lab JOIN u ON u.key = lab.key AND u.i = lab.union_line GROUP BY 1)"
    return f"WITH {mark}, {lists} SELECT s.key, load, status, confidence, n_lines, n_removed, n_added, n_cdg, n_ddg, n_vul, coalesce(vul_lines, '') AS vul_lines, coalesce(vul_lines_fb, '') AS vul_lines_fb FROM status s LEFT JOIN v ON v.key = s.key"


def _tops_sql(asked: str, node: str, parent: str, member_of: str = "") -> str:
    """``top_ancestors`` over the given tables."""
    edges = f"SELECT child, parent, 'ChildOf' AS kind FROM ({parent})" + (f" UNION ALL SELECT child, parent, 'MemberOf' FROM ({member_of})" if member_of else "")
    return f"""WITH RECURSIVE nd AS (SELECT DISTINCT id FROM ({node})), ed AS (SELECT DISTINCT * FROM ({edges}) WHERE parent IN (SELECT id FROM nd)),
ask AS (SELECT DISTINCT cwe, replace(upper(trim(cwe)), 'CWE-', '') AS root FROM ({asked})),
up AS (SELECT DISTINCT root, root AS node, 0 AS depth FROM ask UNION SELECT up.root, ed.parent, up.depth + 1 FROM up JOIN ed ON ed.child = up.node WHERE up.depth < 12),
um AS (SELECT root, node, min(depth) AS depth FROM up GROUP BY 1, 2), pc AS (SELECT child, count(DISTINCT parent) AS k FROM ed GROUP BY 1),
tp AS (SELECT root, string_agg(node, ';' ORDER BY um.depth, node) AS tops, min(um.depth) AS depth FROM um JOIN nd ON nd.id = um.node WHERE node NOT IN (SELECT child FROM ed) GROUP BY 1),
mu AS (SELECT root, max(k) > 1 AS m FROM um JOIN pc ON pc.child = um.node GROUP BY 1), ki AS (SELECT root, string_agg(DISTINCT kind, ';' ORDER BY kind) AS kinds FROM um JOIN ed ON ed.child = um.node GROUP BY 1)
SELECT cwe, coalesce(tops, '') AS tops, CAST(coalesce(depth, -1) AS INT) AS depth, coalesce(m, FALSE) AS multi_parent, coalesce(kinds, '') AS kinds FROM ask LEFT JOIN tp USING (root) LEFT JOIN mu USING (root) LEFT JOIN ki USING (root)"""


SQL |= {
    "g6_top_ancestors": _tops_sql(f"WITH {_LISTS}, {_ITEMS} SELECT cwe FROM items", f"SELECT id FROM {_values([(n,) for n in _NODES], 'id')}", f"SELECT * FROM {_E}"),
    "g6_hierarchy": _tops_sql(*[X.text(x.replace("STRING", "VARCHAR")) for x in (_ASKED.replace("{node}", _TREE["node"]), _TREE["node"], _TREE["parent"], _TREE["member_of"])]),
    "s3_a3_feeds": f"WITH {_R} SELECT cve, arg_max(cwe, (ref_id % 3, ref_id)) AS cwes, max(ref_id % 3) AS file_rank, arg_max(ref_id, (ref_id % 3, ref_id)) AS position FROM refs GROUP BY 1",
    "u3_w2_n25_rounds": _rounds_sql(),
    "g1_ancestors": f"WITH RECURSIVE {_LISTS}, {_ITEMS}, {_UP} SELECT * FROM upm",
    "g2_pruned": f"WITH RECURSIVE {_LISTS}, {_ITEMS}, {_UP}, keep AS (SELECT i.sample_id, string_agg(i.cwe, ';' ORDER BY list_position(string_split(i.cwes, ';'), i.cwe)) AS k FROM items i WHERE NOT EXISTS (SELECT 1 FROM items o JOIN upm ON upm.root = replace(o.cwe, 'CWE-', '') WHERE o.sample_id = i.sample_id AND upm.node = replace(i.cwe, 'CWE-', '')) GROUP BY 1) SELECT l.sample_id, coalesce(k, '') AS cwe_pruned FROM lists l LEFT JOIN keep ON keep.sample_id = l.sample_id",
    "n28_n30_repo_keys": f"WITH {_RAW} SELECT sample_id, CASE project % 8 WHEN 0 THEN NULL WHEN 2 THEN 'git.example.org/cgit/proj' || pj WHEN 3 THEN 'android.googlesource.com/platform/proj' || pj || '/+/' || substr(sha, 1, 12) WHEN 4 THEN 'git.example.net/proj' || pj || '.git' WHEN 6 THEN 'example.com/archive/' || sha WHEN 7 THEN 'gitlab.com/org' || pj || '/proj' || pj ELSE 'github.com/org' || pj || '/proj' || pj END AS repo_key, {_PROJECT} AS project_key, CASE project % 8 WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 2 THEN 'cgit/proj' || pj || '.git' WHEN 3 THEN 'platform/proj' || pj WHEN 6 THEN 'archive/' || sha ELSE 'org' || pj || '/proj' || pj END AS owner_repo FROM pk",
    "v11_split": f"WITH {_RAW} SELECT sample_id, {_PROJECT} AS project_key, CASE WHEN CAST('0x' || substr(md5({_PROJECT}), 1, 8) AS BIGINT) % 10000 < 2000 THEN 'test' ELSE 'train' END AS split FROM pk",
    "l1_n26_n27_cascade": "WITH f AS (SELECT p_partkey AS sample_id, CASE p_partkey % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'C++' WHEN 4 THEN 'Python' END AS e, CASE p_partkey % 4 WHEN 0 THEN 'Rust' WHEN 3 THEN 'TypeScript' END AS f, CASE p_partkey % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'Go' END AS c FROM part) SELECT sample_id, coalesce(e, f, c) AS language, CASE WHEN e IS NOT NULL THEN 'extension' WHEN f IS NOT NULL THEN 'file_name' WHEN c IS NOT NULL THEN 'commit_link_path' END AS language_source, CASE WHEN coalesce(e, f, c) IS NOT NULL THEN 'high' END AS language_confidence FROM f",
    "n31_message_family": "SELECT p_partkey AS sample_id, CASE p_partkey % 5 WHEN 0 THEN 'C/C++' WHEN 4 THEN 'Java' END AS family FROM part",
    "n36_n37_predictions": f"WITH {_CASES} SELECT sample_id, language, {_fam('language')} AS language_family, round(sc, 9) AS score, round(ma, 9) AS margin, confidence, agree, decision = 'before_after_exact_agree' AS exact_agree, decision, decision LIKE 'disagree%' OR confidence = 'low' OR language = 'Unknown' AS review FROM c4",
    "a8_language_prior": f"WITH {_WIT}, n AS (SELECT repo_key, true_language AS l, count(*) AS c FROM w WHERE language_source = 'extension' GROUP BY 1, 2) SELECT repo_key, arg_min(l, (-c, l)) AS prior, round(max(c) / sum(c), 9) AS purity, max(c) AS support FROM n GROUP BY 1 HAVING max(c) / sum(c) >= 0.5",
    "v1_w3_alignment": f"WITH {_UNION} SELECT key, i AS union_line, NOT is_added AS in_before, NOT is_removed AS in_after, is_added, is_removed, CASE WHEN NOT is_added THEN bl END AS before_line, CASE WHEN NOT is_removed THEN al END AS after_line FROM u",
    "v2_gates": f"WITH {_PAIR}, g AS (SELECT key, lang, kind, n + CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_lines, CASE WHEN kind < 2 THEN 1 ELSE 0 END AS n_removed, CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_added FROM p) SELECT key, CASE WHEN lang IS NULL THEN 'unsupported_language' WHEN kind = 2 THEN 'no_change' WHEN (n_removed + n_added) / n_lines > 0.4 AND n_removed + n_added >= 2 THEN 'diff_too_large' END AS gate, n_lines, n_removed, n_added FROM g",
    "s10_graph_sizes": f"WITH {_PAIR} SELECT key, n + CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_graph_lines, n + CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_cdg, n + CASE WHEN kind = 1 THEN 1 ELSE 0 END AS n_ddg FROM p WHERE doc_id % 4 <> 0",
    "j14_u4_vul_lines": f"WITH {_MARK} SELECT * FROM lab",
    "v3_v5_status": f"WITH {_MARK} SELECT * EXCLUDE (lang) FROM status",
    "a12_a13_status_report": f"WITH {_MARK} SELECT status, count(*) AS n, count(*) FILTER (n_vul > 0) AS usable FROM status GROUP BY 1",
    "v8_renumbered": f"""WITH {_MARK}, g AS (SELECT lab.*, bl FROM lab JOIN u ON u.key = lab.key AND u.i = lab.union_line),
h AS (SELECT key, list_sort(list(bl)) AS v, list_sort(coalesce(list(bl) FILTER (from_removed), [])) AS r, list_sort(coalesce(list(bl) FILTER (from_depadd), [])) AS d FROM g GROUP BY 1)
SELECT p.key, coalesce(array_to_string(v, ';'), '') AS vul_lines_fb, coalesce(array_to_string(r, ';'), '') AS removed_lines_fb, coalesce(array_to_string(d, ';'), '') AS depadd_lines_fb, CASE WHEN kind = 1 THEN CAST(k AS VARCHAR) ELSE '' END AS added_lines_fa,
 CAST(coalesce(len(v), 0) AS INT) AS n_vul_lines_fb, CAST(coalesce(len(r), 0) AS INT) AS n_removed_lines_fb, CAST(coalesce(len(d), 0) AS INT) AS n_depadd_lines_fb FROM p LEFT JOIN h ON h.key = p.key""",
    "j15_u6_merge": f"WITH {_MARK}, t AS (SELECT p.key, doc_id % 5 = 0 AS e, CASE WHEN p.lang = 'lua' AND doc_id % 5 <> 0 THEN s END AS s FROM p JOIN (SELECT key, status AS s FROM status) x ON x.key = p.key) SELECT t.key, e AS has_bigvul_lines, coalesce(s, 'skipped_has_bigvul') AS status, CASE WHEN s IS NOT NULL THEN confidence END AS confidence, CASE WHEN s IS NOT NULL THEN n_lines END AS n_lines, CASE WHEN s IS NOT NULL THEN n_vul END AS n_vul, coalesce({_OK.format(s='s')} AND n_vul > 0, FALSE) AS derived_ok FROM t JOIN status ON status.key = t.key",
    "v10_line_changes": f"""WITH {_MARK}, ln AS (SELECT key, n, unnest(l) AS t, unnest(range(1, n + 1)) AS i FROM p),
f AS (SELECT key, min(i) AS f FROM ln WHERE trim(t) <> '' GROUP BY 1),
cum AS (SELECT ln.key, n, i, f, sum(2 * length(t) - length(replace(t, '(', '')) - length(replace(t, ')', '')) - 2 * (length(t) - length(replace(t, ')', '')))) OVER (PARTITION BY ln.key ORDER BY i) AS c FROM ln JOIN f ON f.key = ln.key WHERE i BETWEEN f AND f + 7),
la AS (SELECT key, any_value(f) AS f, coalesce(min(i) FILTER (c <= 0), max(i)) AS last FROM cum GROUP BY 1),
br AS (SELECT key, min(i) AS i, arg_min(t, i) AS t FROM ln JOIN la USING (key) WHERE i > last AND trim(t) <> '' GROUP BY 1),
dep AS (SELECT lab.key, list(CAST(bl AS INT)) AS d FROM lab JOIN u ON u.key = lab.key AND u.i = lab.union_line WHERE from_depadd GROUP BY 1),
x AS (SELECT p.key, kind, s.status, {_OK.format(s='s.status')} AND n_vul > 0 AS ok, CASE WHEN kind < 2 THEN [CAST(k AS INT)] ELSE [] END AS del, list_sort(coalesce(d, [])) AS d, f, last, CASE WHEN trim(br.t) = '{{' THEN br.i END AS brace FROM p JOIN status s ON s.key = p.key LEFT JOIN dep ON dep.key = p.key LEFT JOIN la ON la.key = p.key LEFT JOIN br ON br.key = p.key),
y AS (SELECT *, list_sort(list_distinct(del || d)) AS v FROM x), z AS (SELECT *, list_filter(v, lambda a: NOT (coalesce(a BETWEEN f AND last, FALSE) OR coalesce(a = brace, FALSE)) OR list_contains(del, a)) AS fin FROM y)
SELECT key, CASE WHEN kind = 0 THEN 'val' ELSE 'train' END AS split, 'CWE-79' AS cwe_id, status, ok AS derived_ok, CASE WHEN NOT ok THEN '' WHEN status = 'no_pdg_signal' THEN 'removed_only' ELSE 'full' END AS label_completeness, len(fin) > 0 AS has_line_label, array_to_string(del, ';') AS deleted, array_to_string(d, ';') AS depadd_lines_fb, array_to_string(v, ';') AS vul_lines_linevd, array_to_string(fin, ';') AS vul_lines_final FROM z""",
    "a15_agreement": f"WITH {_MARK} SELECT CASE WHEN kind = 0 AND k <> 1 THEN 'overlap' ELSE 'exact' END AS relation, count(*) AS n FROM lab JOIN p ON p.key = lab.key WHERE from_removed GROUP BY 1",
    "a16_precision_recall": f"WITH {_MARK}, g AS (SELECT CASE WHEN o.key IS NULL THEN 0 ELSE 1 END AS hit FROM p LEFT JOIN (SELECT key FROM lab WHERE from_removed) o ON o.key = p.key WHERE kind < 2 AND lang IS NOT NULL) SELECT count(*) AS n, CAST(sum(hit) AS BIGINT) AS exact, 1.0::DOUBLE AS precision_, round(sum(hit) / count(*), 6) AS recall_, round(2 * sum(hit) / (count(*) + sum(hit)), 6) AS f1 FROM g",
    "a12_coverage": f"WITH {_MARK} SELECT CASE WHEN n_vul > 0 THEN 'derived' ELSE 'none' END AS label_source, count(*) AS n, round(sum(n_vul) / sum(n_lines), 6) AS density, round(avg(n_vul), 6) AS mean_lines FROM status GROUP BY 1",
    "a12_origin_share": f"WITH {_MARK} SELECT count(*) FILTER (from_removed) AS from_removed, count(*) FILTER (from_depadd AND NOT from_removed) AS from_depadd FROM lab",
    "a13_by_language": f"WITH {_MARK} SELECT lang, count(*) AS n, round(100.0 * avg(CASE WHEN n_vul > 0 THEN 1 ELSE 0 END), 4) AS usable_pct, round(avg(n_lines), 6) AS mean_lines, round(avg(n_cdg), 6) AS mean_cdg, round(avg(n_ddg), 6) AS mean_ddg FROM status GROUP BY 1",
    "a17_per_cwe_lines": f"WITH {_MARK} SELECT 'CWE-' || kind AS cwe, count(*) AS rows, CAST(sum(n_vul) AS BIGINT) AS lines, CAST(median(n_vul) AS DOUBLE) AS median FROM st GROUP BY 1",
    "k5_failures": f"WITH {_MARK} SELECT key, status, confidence FROM status WHERE n_vul = 0",
    "w1_j11_flaw_lines": f"WITH {_FLAW} SELECT doc_id, line_count, matched, match_level FROM fl",
    "a11_flaw_line_coverage": f"WITH {_FLAW} SELECT lang AS language, count(*) AS n, count(*) FILTER (matched) AS matched, round(100.0 * count(*) FILTER (matched) / count(*), 4) AS pct FROM fl GROUP BY 1",
    "a11_line_count_histogram": f"WITH {_FLAW} SELECT least(line_count, 11) AS bin, count(*) AS n FROM fl WHERE matched GROUP BY 1",
    "a11_line_count_stats": f"WITH {_FLAW} SELECT round(avg(line_count), 6) AS mean, CAST(median(line_count) AS DOUBLE) AS median, max(line_count) AS max FROM fl WHERE matched",
    "w5_top_per_group": f"WITH {X.LABELLED}, pk AS (SELECT *, CAST(project % 40 AS VARCHAR) AS pj, sha1(CAST(project AS VARCHAR)) AS sha FROM keyed), h AS (SELECT {_PROJECT} AS host, cwe_id, count(*) AS rows FROM pk WHERE cwe_id IS NOT NULL GROUP BY 1, 2) SELECT host, cwe_id, rows, CAST(row_number() OVER (PARTITION BY host ORDER BY rows DESC, cwe_id) AS INT) AS rank FROM h WHERE host IS NOT NULL QUALIFY rank <= 3",
    "k3_slices": f"WITH j AS ({R.SQL['j9_u1_cve_to_cwe']}), v AS ({R.SQL['j6_j7_apply_nvd']}) SELECT sample_id, 'conflict' AS slice FROM j WHERE cwe_id IS NOT NULL AND cwe_candidates <> '' AND NOT list_contains(string_split(cwe_candidates, ';'), cwe_id) UNION ALL SELECT sample_id, 'missing_both' FROM j WHERE cve_id IS NULL AND cwe_id IS NULL UNION ALL SELECT sample_id, 'ambiguous' FROM v WHERE cve_id IS NULL AND status LIKE '%ambiguous%'",
    "k1_k5_one_write": f"WITH j AS ({R.SQL['j9_u1_cve_to_cwe']}), v AS ({R.SQL['j6_j7_apply_nvd']}), f AS ({R.SQL['j10_final_cwe']}), r AS (SELECT j.*, v.status, f.cwe_label_final FROM j JOIN v ON v.sample_id = j.sample_id JOIN f ON f.sample_id = j.sample_id), "
    "s AS (SELECT *, unnest(list_filter(['all', CASE WHEN cve_id IS NULL AND cwe_id IS NULL THEN 'missing_both' END, CASE WHEN cve_id IS NULL AND status LIKE '%ambiguous%' THEN 'ambiguous' END, CASE WHEN cwe_id IS NOT NULL AND cwe_candidates <> '' AND NOT list_contains(string_split(cwe_candidates, ';'), cwe_id) THEN 'cwe_conflict' END, "
    "CASE WHEN cwe_label_final IS NOT NULL THEN 'trainable' END, CASE WHEN cve_id IS NOT NULL AND cwe_label_final IS NULL THEN 'gap' END], lambda x: x IS NOT NULL)) AS slice FROM r) SELECT sample_id, slice, cve_id, cwe_id, cwe_label_final FROM s",
    "k4_slices": f"WITH j AS ({R.SQL['j10_final_cwe']}), k AS ({R.SQL['n1_n5_labels']}) SELECT j.sample_id, 'trainable' AS slice FROM j WHERE cwe_label_final IS NOT NULL UNION ALL SELECT j.sample_id, 'gap' FROM j JOIN k ON k.sample_id = j.sample_id WHERE cve_id IS NOT NULL AND cwe_label_final IS NULL",
    "s3_n14_nvd": f"WITH {_R}, e AS (SELECT cve, array_to_string(list_sort(list_distinct(list('CWE-' || CAST(ref_id % 50 AS VARCHAR)))), ';') AS evaluator FROM refs GROUP BY 1) SELECT r.cve, cwe AS cwes, CASE WHEN ref_id % 2 = 0 THEN cwe ELSE '' END AS primary_cwes, url, CASE WHEN kind = 'FIX' THEN 'patch' ELSE 'other' END AS kind, evaluator FROM refs r JOIN e ON e.cve = r.cve",
    "a14_failure_reasons": f"WITH {_MARK} SELECT lang, count(*) FILTER (status = 'unsupported_language') AS unsupported_language, count(*) FILTER (status = 'no_change') AS no_change, count(*) FILTER (status = 'diff_too_large') AS diff_too_large FROM status GROUP BY 1",
    "u3_w2_incremental": "SELECT md5(text) AS sample_key, coalesce(max(doc_id) FILTER (doc_id % 3 = 0), -1) AS load FROM documents GROUP BY 1",
    "s2_n12_n13_osv": f"WITH {_R} SELECT cve, cwe AS cwes, url, kind FROM refs WHERE ref_id % 17 <> 0 AND ref_id % 10 <> 0",
    "s4_s5_n16_cvelist": f"WITH {_R} SELECT cve, c AS container, array_to_string(list_sort([cwe, 'CWE-5']), ';') AS cwes, cwe AS primary_cwes, 1 AS n_refs FROM refs, (VALUES ('cna'), ('adp0')) t(c) WHERE ref_id % 7 <> 0 AND ref_id % 13 <> 0",
    "a22_scan_counters": f"WITH {_R}, k AS (SELECT * FROM refs WHERE ref_id % 17 <> 0 AND ref_id % 10 <> 0) SELECT (SELECT count(*) FROM refs) AS scanned, count(*) AS kept, count(*) AS refs, count(*) FILTER (kind = 'FIX') AS patch_refs FROM k",
    "s11_s12_enrichment": f"WITH {_R} SELECT cve, cwe AS cwes FROM refs",
    "a20_sizes": f"WITH {X.LABELLED}, n AS (SELECT cve_id, count(*) AS n FROM keyed WHERE cve_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_classes, count(*) FILTER (n < 10) AS n_small, max(n) AS largest FROM n",
    "a20_gap": f"WITH {X.LABELLED} SELECT coalesce(cve_source, 'none') AS source, count(*) AS n, count(*) FILTER (length(trim(cve_description)) > 0) AS with_description FROM keyed WHERE cve_id IS NOT NULL AND cwe_id IS NULL GROUP BY 1",
}
