"""SQL twins of the taxonomy jobs over the queries' small weakness tree."""

from __future__ import annotations

from secdata.functions import rules
from secdata.operators import taxonomy as T
from secdata.plans import curation as C


def _str(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _pairs(mapping: dict[str, str], key: str, value: str) -> str:
    return C._values(list(mapping.items()), key, value) if mapping else f"(SELECT '' AS {key}, '' AS {value} WHERE FALSE)"


def _in(c: str, values) -> str:
    return f"{c} IN ({', '.join(repr(v) for v in values)})" if values else "FALSE"


def _dim(s: T.Scheme) -> str:
    """``dim``: (cwe, classes, rule) of the distinct weaknesses of ``items``."""
    level2 = f"WHEN l.classes IS NOT NULL THEN {{'c': l.classes, 'r': {_str(T.LEVEL2)}}} WHEN p.classes IS NOT NULL THEN {{'c': p.classes, 'r': {_str(T.PILLAR)}}}" if s.level2 else ""
    return f"""{C._LISTS}, {C._ITEMS}, ask AS (SELECT DISTINCT cwe, replace(cwe, 'CWE-', '') AS id FROM items WHERE cwe IS NOT NULL), pl AS (SELECT cwe, id, CASE id WHEN '991' THEN '125' ELSE id END AS root, id = '991' AS moved FROM ask),
cat AS (SELECT * FROM {_pairs(s.category, 'category', 'class')}), l2 AS (SELECT node, [class] AS classes FROM {_pairs(s.level2, 'node', 'class')}), pil AS (SELECT node, [class] AS classes FROM {_pairs(s.pillar, 'node', 'class')}), ovr AS (SELECT * FROM {_pairs(s.override, 'node', 'class')}),
ed AS (SELECT * FROM {C._E}), mem AS (SELECT * FROM {C._values(C._MEMBERS, 'member', 'category')}), own AS (SELECT category AS node, [class] AS classes FROM cat),
dir AS (SELECT * FROM own UNION ALL SELECT member, list_sort(list(DISTINCT class)) FROM mem JOIN cat USING (category) WHERE member NOT IN (SELECT node FROM own) GROUP BY 1 HAVING NOT bool_and({_in('category', s.catch_all)})),
w0 AS (SELECT DISTINCT root, root AS node, 0 AS depth FROM pl UNION SELECT w0.root, parent, depth + 1 FROM w0 JOIN ed ON child = node WHERE depth < 12), w AS (SELECT root, node, min(depth) AS depth FROM w0 WHERE node <> root GROUP BY 1, 2),
near AS (SELECT child AS root, list_sort(list(DISTINCT classes[1])) AS classes FROM ed JOIN l2 ON node = parent GROUP BY 1),
stops AS (SELECT node, classes, {_str(T.UP)} AS r FROM dir UNION ALL SELECT node, classes, {_str(T.UP_LEVEL2)} FROM l2 WHERE node NOT IN (SELECT node FROM dir)),
climb AS (SELECT root, arg_min({{'c': classes, 'r': r}}, (depth, CAST(node AS INT))) AS x FROM w JOIN stops USING (node) WHERE depth <= 6 GROUP BY 1),
far AS (SELECT node, classes, {_str(T.FAR_LEVEL2)} AS r FROM l2 UNION ALL SELECT node, classes, {_str(T.FAR_PILLAR)} FROM pil WHERE node NOT IN (SELECT node FROM l2)), topped AS (SELECT root, arg_min({{'c': classes, 'r': r}}, (depth, CAST(node AS INT))) AS x FROM w JOIN far USING (node) GROUP BY 1),
dn AS (SELECT DISTINCT root, root AS node, 0 AS depth FROM pl UNION SELECT dn.root, child, depth + 1 FROM dn JOIN ed ON parent = node WHERE depth < 6 AND (depth = 0 OR node NOT IN (SELECT node FROM dir))),
tally AS (SELECT root, class, count(*) AS n FROM (SELECT root, unnest(classes) AS class FROM (SELECT DISTINCT root, node FROM dn WHERE node <> root) q JOIN dir USING (node)) z GROUP BY 1, 2),
voted AS (SELECT root, list_sort(list(class)) AS classes FROM tally WHERE n = (SELECT max(n) FROM tally o WHERE o.root = tally.root) GROUP BY 1),
caught AS (SELECT member AS root, [class] AS classes FROM (SELECT member, min(category) AS category FROM mem WHERE {_in('category', s.catch_all)} GROUP BY 1) m JOIN cat USING (category)),
picked AS (SELECT pl.*, CASE WHEN NOT regexp_full_match(id, '[0-9]+') THEN {{'c': [], 'r': {_str(T.INVALID if s.level2 else T.NONE)}}} WHEN {_in('pl.root', T.NO_INFO)} THEN {{'c': [], 'r': {_str(T.NOTHING)}}} WHEN o.class IS NOT NULL THEN {{'c': [o.class], 'r': {_str(T.OVERRIDDEN)}}}
 WHEN ne.classes IS NOT NULL THEN {{'c': ne.classes, 'r': {_str(T.NEAR)}}} WHEN d.classes IS NOT NULL THEN {{'c': d.classes, 'r': {_str(T.DIRECT)}}} {level2} WHEN cl.x IS NOT NULL THEN cl.x WHEN vo.classes IS NOT NULL THEN {{'c': vo.classes, 'r': {_str(T.DOWN)}}}
 WHEN tp.x IS NOT NULL THEN tp.x WHEN p.classes IS NOT NULL THEN {{'c': p.classes, 'r': {_str(T.FAR_PILLAR)}}} WHEN ca.classes IS NOT NULL THEN {{'c': ca.classes, 'r': {_str(T.CATCH)}}} ELSE {{'c': [], 'r': {_str(T.NONE)}}} END AS x FROM pl LEFT JOIN ovr o ON o.node = pl.root LEFT JOIN near ne ON ne.root = pl.root
 LEFT JOIN dir d ON d.node = pl.root LEFT JOIN l2 l ON l.node = pl.root LEFT JOIN pil p ON p.node = pl.root LEFT JOIN climb cl ON cl.root = pl.root LEFT JOIN voted vo ON vo.root = pl.root LEFT JOIN topped tp ON tp.root = pl.root LEFT JOIN caught ca ON ca.root = pl.root),
dim AS (SELECT cwe, x.c AS classes, CASE WHEN moved THEN {_str(T.REDIRECTED)} ELSE x.r END AS rule FROM picked)"""


#: ``pruned``: the lists without the ancestors of their own members.
_PRUNED = f"{C._UP}, keep AS (SELECT i.sample_id, string_agg(i.cwe, ';' ORDER BY list_position(string_split(i.cwes, ';'), i.cwe)) AS k FROM items i WHERE NOT EXISTS (SELECT 1 FROM items o JOIN upm ON upm.root = replace(o.cwe, 'CWE-', '') WHERE o.sample_id = i.sample_id AND upm.node = replace(i.cwe, 'CWE-', '')) GROUP BY 1), pruned AS (SELECT lists.*, coalesce(k, '') AS cwe_pruned FROM lists LEFT JOIN keep USING (sample_id))"


def _many(rows: str, column: str) -> str:
    """``many``: the rows' first class, all classes, rule and number of classes."""
    return f"""ev AS (SELECT sample_id, unnest(string_split({column}, ';')) AS cwe, unnest(range(1, len(string_split({column}, ';')) + 1)) AS pos FROM {rows}),
hit AS (SELECT sample_id, pos, classes, rule FROM ev JOIN dim USING (cwe) WHERE len(classes) > 0),
agg AS (SELECT sample_id, arg_min(classes[1], pos) AS first, arg_min(rule, pos) AS rule, list_sort(list_distinct(flatten(list(classes)))) AS every FROM hit GROUP BY 1),
many AS (SELECT r.sample_id, first AS vuln_class, coalesce(array_to_string(every, ';'), '') AS vuln_class_all, coalesce(rule, {_str(T.NONE)}) AS vuln_class_rule, CAST(coalesce(len(every), 0) AS INT) AS n_vuln_class FROM {rows} r LEFT JOIN agg USING (sample_id))"""


def _number(c: str) -> str:
    return f"CAST(replace({c}, 'CWE-', '') AS INT)"


def _group(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {_in(_number(c), v)} THEN {_str(g)}" for g, v in rules.GROUP_CWES.items()) + " ELSE 'other' END"


def _informative(c: str) -> str:
    return f"({_in(_number(c), rules.NO_MECHANISM)} = FALSE AND {_group(c)} <> 'other')"


def _first(patterns, text: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {_str('(?i)' + p)}) THEN {_str(g)}" for p, g in patterns) + " END"


def _split_memory(c: str) -> str:
    return f"CASE WHEN {c} <> 'mem_spatial' THEN {c} WHEN {c} IS NOT NULL THEN CASE WHEN coalesce(regexp_matches(code, {_str('(?i)' + rules.COPY_API)}), FALSE) THEN 'mem_copy' ELSE 'mem_index' END END"


def _grouped() -> str:
    precise = f"list_filter(told, lambda x: NOT {_in(_number('x'), rules.IMPRECISE)})"
    return f"""WITH RECURSIVE {C._LISTS}, {C._ITEMS}, {_PRUNED}, g0 AS (SELECT sample_id, project_key, substr(func_before, 1, 6000) AS code, vul_lines_text AS vl, coalesce(commit_message, '') || chr(10) || coalesce(cve_description, '') AS txt, list_filter(list_filter(string_split(cwe_pruned, ';'), lambda x: x <> ''), lambda x: {_informative('x')}) AS told FROM pruned),
g1 AS (SELECT *, {precise} AS pre FROM g0),
g2 AS (SELECT *, CASE WHEN len(pre) > 0 THEN {_group('pre[1]')} END AS t0, {_first(rules.TEXT_STRONG, 'txt')} AS t1, CASE WHEN len(told) > 0 THEN {_group('told[1]')} END AS t2, {_first(rules.TEXT_WEAK, 'txt')} AS t3, {_first(rules.CODE_PATTERNS, 'vl')} AS t4, {_first(rules.CODE_PATTERNS, 'code')} AS t5 FROM g1),
g3 AS (SELECT *, coalesce(t0, t1, t2, t3, t4, t5) AS g, CASE {' '.join(f'WHEN t{i} IS NOT NULL THEN {_str(T.TIERS[i])}' for i in range(6))} END AS src FROM g2),
mj AS (SELECT project_key, arg_min(g, (-n, g)) AS major FROM (SELECT project_key, g, count(*) AS n FROM g3 WHERE g IS NOT NULL AND project_key IS NOT NULL GROUP BY 1, 2) c GROUP BY 1),
g4 AS (SELECT g3.*, coalesce(src, CASE WHEN major IS NOT NULL THEN {_str(T.TIERS[7])} ELSE {_str(T.TIERS[8])} END) AS source, coalesce(g, major, 'mem_spatial') AS m, list_concat(list_filter(list_transform(told, lambda x: {_group('x')}), lambda y: y <> 'other'), CASE WHEN g IS NULL THEN [] ELSE [g] END) AS gs FROM g3 LEFT JOIN mj USING (project_key)),
g5 AS (SELECT sample_id, source, {_split_memory('m')} AS cwe_group, list_transform(gs, lambda y: {_split_memory('y')}) AS more FROM g4), g6 AS (SELECT *, list_sort(list_distinct(list_append(more, cwe_group))) AS every FROM g5)
SELECT sample_id, cwe_group, source AS cwe_group_src, array_to_string(every, ';') AS cwe_group_all, CAST(len(every) AS INT) AS n_cwe_groups, len(every) > 1 AS cwe_multi_label FROM g6"""


_CLASSES, _TYPES = f"WITH RECURSIVE {_dim(T.CLASSES)}", f"WITH RECURSIVE {_dim(T.TYPES)}"
_OF_TYPE = "CASE t " + " ".join(f"WHEN {_str(k)} THEN {_str(v)}" for k, v in T.TYPE_TO_GROUP.items()) + " END"
_FIRST_CWE = f"WITH {C._LISTS} SELECT string_split(cwes, ';')[1] AS cwe FROM lists WHERE cwes IS NOT NULL"
_TOPS = C._tops_sql(_FIRST_CWE, f"SELECT id FROM {C._values([(n,) for n in C._NODES], 'id')}", f"SELECT * FROM {C._E}")
SQL = {
    "g3_classes": f"{_CLASSES} SELECT cwe, array_to_string(classes, ';') AS classes, rule FROM dim",
    "g5_types": f"{_TYPES} SELECT cwe, array_to_string(classes, ';') AS types, array_to_string(list_sort(list_distinct(list_transform(classes, lambda t: {_OF_TYPE}))), ';') AS groups, rule FROM dim",
    "g4_j16_classify_many": f"{_CLASSES}, {_PRUNED}, {_many('pruned', 'cwe_pruned')} SELECT * FROM many",
    "a18_class_report": f"{_CLASSES}, {_many('lists', 'cwes')}, pr AS (SELECT vuln_class AS c, count(*) AS p FROM many WHERE vuln_class IS NOT NULL GROUP BY 1), an AS (SELECT c, count(*) AS a FROM (SELECT unnest(string_split(vuln_class_all, ';')) AS c FROM many) q WHERE c <> '' GROUP BY 1) SELECT c AS class, coalesce(p, 0) AS primary_rows, coalesce(a, 0) AS any_rows FROM an FULL JOIN pr USING (c)",
    "a18_class_balance": f"{_CLASSES}, {_many('lists', 'cwes')}, z AS (SELECT max(n) AS most, min(n) AS least FROM (SELECT count(*) AS n FROM many WHERE vuln_class IS NOT NULL GROUP BY vuln_class) q) SELECT count(*) AS n_rows, count(vuln_class) AS classified, count(*) FILTER (n_vuln_class > 1) AS several, round(100.0::DOUBLE * count(vuln_class) / count(*), 4) AS coverage_pct, round(CAST(any_value(most) AS DOUBLE) / any_value(least), 4) AS imbalance FROM many, z",
    "k7_cwe_audit": f"{_CLASSES} SELECT f.cwe, n, array_to_string(classes, ';') AS classes, rule FROM (SELECT string_split(cwes, ';')[1] AS cwe, count(*) AS n FROM lists WHERE cwes IS NOT NULL GROUP BY 1) f LEFT JOIN dim ON dim.cwe = f.cwe",
    "a21_pillars": f"SELECT string_split(tops, ';')[1] AS pillar, count(*) AS n_rows, count(DISTINCT f.cwe) AS n_cwes FROM ({_FIRST_CWE}) f JOIN ({_TOPS}) t ON t.cwe = f.cwe GROUP BY 1",
    "n40_n41_groups": f"WITH {C._LISTS}, {C._ITEMS} SELECT sample_id, cwe, {_group('cwe')} AS grp, NOT {_in(_number('cwe'), rules.IMPRECISE)} AS precise, {_informative('cwe')} AS informative FROM items WHERE cwe IS NOT NULL",
    "g7_g8_groups": _grouped(),
}
