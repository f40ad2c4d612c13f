"""SQL twins of the language jobs: reconciliation, rule pass, token prior, group vote, manual overrides."""

from __future__ import annotations

from secdata.functions import language_rules as L
from secdata.operators import language
from secdata.plans import curation as C


def _str(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _family(c: str) -> str:
    return f"CASE WHEN {c} IN ({', '.join(map(_str, L.FAMILY))}) THEN 'C/C++' ELSE {c} END"


def _enough(group: str, margin: str, thresholds: dict[str, int]) -> str:
    return f"coalesce({margin} >= CASE {group} {' '.join(f'WHEN {_str(k)} THEN {v}' for k, v in thresholds.items())} END, FALSE)"


#: ``rec``: the witnesses' predictions reconciled with the priors of their sources. The message's family is that of its only file.
_MESSAGE = "CASE commit_message WHEN 'see a.c' THEN 'C/C++' WHEN 'see b.java' THEN 'Java' END"
_RECONCILED = f"""{C._CASES}, r0 AS (SELECT sample_id, repo_key, func_before, language_source, decision, confidence, {_MESSAGE} AS msg, decision LIKE 'disagree%' OR confidence = 'low' OR language = 'Unknown' AS review,
 {C._fam('language')} AS family, CASE WHEN language_source = 'extension' THEN true_language ELSE language END AS lang FROM c4),
pn AS (SELECT repo_key, lang, count(*) AS n FROM r0 WHERE language_source = 'extension' AND repo_key IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2),
pr AS (SELECT repo_key, arg_min(lang, (-n, lang)) AS prior FROM pn GROUP BY 1 HAVING max(n) / sum(n) >= 0.6),
r1 AS (SELECT r0.*, prior, CASE WHEN language_source <> 'github_linguist' THEN NULL WHEN prior IS NULL THEN CASE WHEN lang <> 'Unknown' AND msg = {C._fam('lang')} THEN 'message_confirms' ELSE 'no_prior' END
 WHEN lang = 'Unknown' THEN 'prior_fills_unknown' WHEN prior = lang THEN 'prior_confirms' WHEN {C._fam('prior')} = {C._fam('lang')} THEN 'prior_refines_family' ELSE 'prior_overrides' END AS k FROM r0 LEFT JOIN pr ON pr.repo_key = r0.repo_key),
rec AS (SELECT sample_id, func_before, k AS reconcile_case, coalesce(k IN ('prior_fills_unknown', 'prior_refines_family', 'prior_overrides'), FALSE) AS takes,
 CASE WHEN takes THEN prior ELSE lang END AS language, CASE WHEN takes THEN {C._fam('prior')} ELSE family END AS language_family,
 CASE WHEN k = 'message_confirms' THEN 'linguist+commit_message' WHEN k IN ('prior_confirms', 'prior_refines_family') THEN 'linguist+repo_prior' WHEN takes THEN 'repo_prior' ELSE language_source END AS language_source,
 CASE WHEN k = 'prior_confirms' THEN 'high' WHEN takes OR (k = 'message_confirms' AND confidence = 'low') THEN 'medium' ELSE confidence END AS language_confidence,
 CASE k WHEN 'prior_fills_unknown' THEN 'repo_prior_fills_unknown' WHEN 'prior_overrides' THEN 'repo_prior_overrides_linguist' WHEN 'prior_confirms' THEN decision || '+repo_confirms' WHEN 'prior_refines_family' THEN decision || '+repo_refines' ELSE decision END AS language_decision,
 CASE WHEN k = 'prior_overrides' THEN TRUE WHEN takes OR k = 'prior_confirms' THEN FALSE ELSE review END AS needs_language_review FROM r1)"""

_TRUSTED = f"({', '.join(map(_str, language.TRUSTED))})"
_VOTED = f"""{C._WIT}, v0 AS (SELECT sample_id, language_source, {_family('true_language')} AS own, {_family('before_language')} AS classifier, {_family('after_language')} AS prior,
 CASE WHEN sample_id % 11 < 6 THEN {_family('true_language')} END AS rule_group, CAST(sample_id % 6 AS INT) AS margin, CASE WHEN sample_id % 13 < 5 THEN 'Java' END AS token_group FROM w),
vs AS (SELECT sample_id, unnest([classifier, prior, rule_group, token_group]) AS g FROM v0), vc AS (SELECT sample_id, g, count(*) AS n FROM vs WHERE g IS NOT NULL GROUP BY 1, 2),
vm AS (SELECT sample_id, count(*) AS kinds, CAST(sum(n) AS INT) AS votes, max(n) AS most, arg_max(g, n) AS winner FROM vc GROUP BY 1),
vw AS (SELECT vc.sample_id, count(*) AS winners FROM vc JOIN vm USING (sample_id) WHERE n = most GROUP BY 1),
v1 AS (SELECT v0.*, coalesce(kinds, 0) AS kinds, coalesce(votes, 0) AS votes, most, winner, winners, coalesce(prior, rule_group, token_group, classifier) AS tie, {_enough('rule_group', 'margin', L.GROUP)} AS sure FROM v0 LEFT JOIN vm USING (sample_id) LEFT JOIN vw USING (sample_id)),
v2 AS (SELECT v1.*, coalesce(a.n, 0) AS rule_n, coalesce(b.n, 0) AS tie_n, CASE WHEN language_source IN {_TRUSTED} THEN 'trusted' WHEN kinds = 1 THEN 'one' WHEN sure THEN 'rule' WHEN votes > 0 AND winners = 1 THEN 'most' WHEN votes > 0 THEN 'tie' ELSE 'none' END AS way
 FROM v1 LEFT JOIN vc a ON a.sample_id = v1.sample_id AND a.g = rule_group LEFT JOIN vc b ON b.sample_id = v1.sample_id AND b.g = tie),
vote AS (SELECT sample_id, CASE way WHEN 'one' THEN winner WHEN 'rule' THEN rule_group WHEN 'most' THEN winner WHEN 'tie' THEN tie ELSE own END AS language_group,
 CASE way WHEN 'one' THEN CASE WHEN votes >= 2 THEN 'all_sources_agree' ELSE 'single_source' END WHEN 'rule' THEN CASE WHEN rule_n >= 2 THEN 'rule+other' ELSE 'rule_based' END WHEN 'most' THEN 'majority_vote'
  WHEN 'tie' THEN CASE WHEN prior IS NOT NULL THEN 'tie_break_repo_prior' WHEN rule_group IS NOT NULL THEN 'tie_break_rule' WHEN token_group IS NOT NULL THEN 'tie_break_token' ELSE 'tie_break_linguist' END ELSE language_source END AS group_source,
 CASE way WHEN 'trusted' THEN 'high' WHEN 'one' THEN CASE WHEN votes >= 2 THEN 'high' ELSE 'low' END WHEN 'rule' THEN CASE WHEN rule_n >= 2 THEN 'high' ELSE 'medium' END WHEN 'most' THEN 'medium' WHEN 'tie' THEN CASE WHEN prior IS NOT NULL THEN 'medium' ELSE 'low' END ELSE 'low' END AS group_confidence,
 CAST(CASE way WHEN 'trusted' THEN 4 WHEN 'one' THEN votes WHEN 'rule' THEN rule_n WHEN 'most' THEN most WHEN 'tie' THEN tie_n ELSE 0 END AS INT) AS group_n_sources, way = 'none' AS needs_group_review FROM v2)"""

_STOP = "[" + ", ".join(map(_str, L.STOP_WORDS)) + "]"
_TOKENS = f"""{C._WIT}, tk AS (SELECT sample_id, language_source, true_language AS l, unnest(list_distinct(regexp_extract_all(substr(func_before, 1, {L.MAX_TOKENS}), '[A-Za-z_][A-Za-z0-9_]{{2,}}'))) AS token FROM w),
t1 AS (SELECT * FROM tk WHERE NOT list_contains({_STOP}, token) AND NOT list_contains({_STOP}, lower(token))),
tn AS (SELECT token, l, count(*) AS n FROM t1 WHERE language_source = 'extension' AND l IS NOT NULL GROUP BY 1, 2),
tp AS (SELECT token, arg_min(l, (-n, l)) AS label, max(n) / sum(n) AS purity, sum(n) AS support FROM tn GROUP BY 1 HAVING sum(n) >= 8 AND max(n) / sum(n) >= 0.97),
ts AS (SELECT sample_id, label, sum(ln(1 + support) * purity) AS s FROM t1 JOIN tp USING (token) GROUP BY 1, 2),
tr AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY s DESC, label) AS rk FROM ts),
tw AS (SELECT sample_id, max(CASE WHEN rk = 1 THEN label END) AS g, max(CASE WHEN rk = 1 THEN s END) AS s1, coalesce(max(CASE WHEN rk = 2 THEN s END), 0) AS s2 FROM tr GROUP BY 1)"""


def _weighed(text: str, signs: list[tuple[int, str]]) -> str:
    """The weights of the patterns that a text meets. Without look-behind: "not after a colon" is "at the start or after another sign"."""
    return " + ".join(f"CASE WHEN regexp_matches({text}, {_str('(?m)' + p.replace('(?<!:)', r'(?:\A|[^:])'))}) THEN {w} ELSE 0 END" for w, p in signs)


def _rule_pass() -> str:
    code = "CASE sample_id % 5 WHEN 0 THEN '#include <stdio.h>' || chr(10) || 'int main(void) { char *p = NULL; }' WHEN 1 THEN 'import java.util.List;' || chr(10) || 'public static void main(String[] a) { System.out.println(1); }' WHEN 2 THEN 'def f(self):' || chr(10) || '    return self.x is None' WHEN 3 THEN 'func main() {' || chr(10) || ' if err != nil { defer x() }' || chr(10) || ' y := 1' || chr(10) || '}' ELSE 'fn main() { let mut s = String::new(); s.unwrap() }' END || chr(10)"
    blank = r"'^[\s\v]+|[\s\v]+$'"
    scores = ", ".join(f"({_weighed('t', signs)}, {-i}, {_str(f)})" for i, (f, signs) in enumerate(L.FAMILIES.items()))
    return f"""WITH {_RECONCILED}, x AS (SELECT *, needs_language_review AND language_source NOT IN {_TRUSTED} AS target, {code} AS code FROM rec),
side AS (SELECT sample_id, 'b' AS side, regexp_replace(code || func_before, {blank}, '', 'g') AS whole FROM x WHERE target UNION ALL SELECT sample_id, 'a', regexp_replace(code || 'x', {blank}, '', 'g') FROM x WHERE target),
cut AS (SELECT sample_id, side, substr(whole, 1, {L.MAX_CODE}) AS t FROM side WHERE length(whole) >= {L.MIN_CODE}),
sc AS (SELECT sample_id, side, list_reverse_sort([{scores}]) AS s, {_weighed('t', L.OBJC)} AS objc, {_weighed('t', L.CPP)} AS cpp FROM cut),
det AS (SELECT sample_id, side, s[1][3] AS family, s[1][1] - s[2][1] AS margin, CASE WHEN s[1][3] <> 'C/C++' THEN s[1][3] WHEN objc >= 8 AND objc > cpp THEN 'Objective-C' WHEN cpp >= 8 THEN 'C++' ELSE 'C' END AS language FROM sc WHERE s[1][1] > 0),
two AS (SELECT x.*, CASE WHEN b.family IS NULL THEN a.family WHEN a.family IS NULL OR a.family = b.family THEN b.family END AS fam, CASE WHEN b.family IS NULL THEN a.margin WHEN a.family IS NULL THEN b.margin ELSE least(a.margin, b.margin) END AS mar,
 CASE WHEN b.family IS NULL THEN a.language WHEN a.family IS NULL OR b.margin >= a.margin THEN b.language ELSE a.language END AS lng, a.family = b.family AS agreed FROM x LEFT JOIN det b ON b.sample_id = x.sample_id AND b.side = 'b' LEFT JOIN det a ON a.sample_id = x.sample_id AND a.side = 'a'),
y AS (SELECT *, CASE WHEN NOT target THEN NULL WHEN fam IS NULL THEN 'no_rule_output' WHEN fam = {_family('language')} THEN CASE WHEN {_enough('fam', 'mar', L.CONFIRM)} THEN 'confirmed' ELSE 'rule_unsure' END WHEN {_enough('fam', 'mar', L.OVERRIDE)} AND coalesce(agreed, FALSE) THEN 'overridden' ELSE 'rule_unsure' END AS k FROM two)
SELECT sample_id, CASE WHEN k = 'overridden' THEN lng ELSE language END AS language, CASE WHEN k = 'overridden' THEN 'rule_based' WHEN k = 'confirmed' THEN language_source || '+rule' ELSE language_source END AS language_source,
 CASE WHEN k = 'overridden' OR (k = 'confirmed' AND language_confidence = 'low') THEN 'medium' ELSE language_confidence END AS language_confidence, k AS rule_case, CASE WHEN fam IS NOT NULL THEN lng END AS rule_language, CAST(CASE WHEN fam IS NOT NULL THEN mar END AS INT) AS rule_margin FROM y"""


_NONE = "language IS NULL OR language = 'Unknown'"
SQL = {
    "l2_j12_reconcile": f"WITH {_RECONCILED} SELECT sample_id, language, language_source, language_confidence, language_decision, needs_language_review, reconcile_case FROM rec",
    "l3_finalise": f"WITH {_RECONCILED} SELECT sample_id, coalesce(language, 'Unknown') AS language, CASE WHEN {_NONE} THEN 'low' ELSE language_confidence END AS language_confidence, {_NONE} OR coalesce(needs_language_review, FALSE) AS needs_language_review FROM rec",
    "a23_case_counts": f'WITH {_RECONCILED} SELECT reconcile_case AS "case", count(*) AS n FROM rec WHERE reconcile_case IS NOT NULL GROUP BY 1',
    "l4_n33_rule_pass": _rule_pass(),
    "a9_j13_token_prior": f"WITH {_TOKENS} SELECT sample_id, g AS token_group, round(s1, 6) AS token_score, round(s1 - s2, 6) AS token_margin, {_enough('g', '(s1 - s2)', language.TOKEN_MARGIN)} AS token_confident FROM tw",
    "l5_group_vote": f"WITH {_VOTED} SELECT * FROM vote",
    "j17_manual": f"WITH {_VOTED} SELECT sample_id, CASE WHEN m THEN 'Go' ELSE language_group END AS language_group, CASE WHEN m THEN 'manual' ELSE group_source END AS group_source, CASE WHEN m THEN 'high' ELSE group_confidence END AS group_confidence, NOT m AND needs_group_review AS needs_group_review FROM (SELECT *, sample_id % 17 = 3 AS m FROM vote)",
}
