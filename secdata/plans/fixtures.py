"""Inputs of the library's jobs, derived from the supplied tables by SQL that Spark and DuckDB both run.

The text of a fixture names its tables in braces: ``frame`` puts DataFrames there, ``text`` puts table names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SAMPLES = """
SELECT o_orderkey AS sample_id, o_custkey AS project,
  CASE o_custkey % 8
    WHEN 0 THEN NULL
    WHEN 1 THEN 'https://github.com/org' || pj || '/proj' || pj || '/commit/' || sha
    WHEN 2 THEN 'https://git.example.org/cgit/proj' || pj || '.git/commit/?id=' || sha
    WHEN 3 THEN 'https://android.googlesource.com/platform/proj' || pj || '/+/' || substr(sha, 1, 12)
    WHEN 4 THEN 'https://git.example.net/?p=proj' || pj || '.git;a=commit;h=' || sha
    WHEN 5 THEN ' https://github.com/org' || pj || '/proj' || pj || '/commit/' || substr(sha, 1, 9) || ' '
    WHEN 6 THEN 'https://example.com/archive/' || sha
    ELSE 'https://gitlab.com/org' || pj || '/proj' || pj || '/-/commit/' || sha END AS commit_link,
  CASE o_orderkey % 9
    WHEN 0 THEN 'Fix CVE-2020-' || lpad(CAST(o_custkey AS STRING), 5, '0') || ' overflow'
    WHEN 1 THEN 'cve_2019_' || lpad(CAST(o_custkey AS STRING), 6, '0') || ' and CVE-2018-12345'
    WHEN 2 THEN '(cherry picked from commit ' || sha1(CAST(o_custkey + 1 AS STRING)) || ')'
    WHEN 3 THEN 'see CWE-0' || CAST(79 + o_orderkey % 20 AS STRING)
    WHEN 4 THEN NULL ELSE o_orderpriority END AS commit_message,
  CASE o_orderkey % 6 WHEN 0 THEN 'CVE-2017-' || lpad(CAST(o_custkey % 25 AS STRING), 4, '0') || ', '
    WHEN 1 THEN 'unknown' WHEN 2 THEN 'cve-2016-' || lpad(CAST(o_orderkey % 30 AS STRING), 4, '0') ELSE NULL END AS cve_id,
  CASE o_orderkey % 7 WHEN 0 THEN 'cwe-089' WHEN 1 THEN 'CWE-125,CWE-787' WHEN 2 THEN 'NVD-CWE-noinfo'
    WHEN 3 THEN 'CWE-416, CWE-284, CWE-264' WHEN 4 THEN 'None' ELSE NULL END AS cwe_id,
  CASE o_orderkey % 11 WHEN 0 THEN 'A NULL pointer dereference in the parser' WHEN 1 THEN 'Use-after-free when closing' WHEN 2 THEN 'double free of a list'
    WHEN 3 THEN 'An out-of-bounds write' WHEN 4 THEN 'SQL injection in login' WHEN 5 THEN 'reflected XSS on search' WHEN 6 THEN 'heap-based buffer problem'
    WHEN 7 THEN 'An integer overflow leads to an out of bounds read' WHEN 8 THEN '' WHEN 9 THEN NULL ELSE 'A race condition in ' || o_orderpriority END AS cve_description
FROM (SELECT o_orderkey, o_custkey, o_orderpriority, sha1(CAST(o_custkey AS STRING)) AS sha, CAST(o_custkey % 40 AS STRING) AS pj FROM {orders}) o
"""

REFS = """
SELECT p_partkey AS ref_id, 'CVE-2021-' || lpad(CAST(p_partkey % 90 AS STRING), 5, '0') AS cve,
 'CWE-' || CAST(20 + p_size AS STRING) AS cwe,
 CASE p_size % 3 WHEN 0 THEN 'FIX' WHEN 1 THEN 'WEB' ELSE 'fixed' END AS kind,
 CASE p_size % 4 WHEN 0 THEN 'https://example.com/report/' ELSE 'https://github.com/a/b/commit/' END
   || sha1(CAST(p_partkey % 150 AS STRING)) AS url
FROM {part}
"""

#: Git events of advisories: some fix, some introduce; the repository is a sample's own (in two spellings) or another one.
EVENTS = """
SELECT 'CVE-2022-' || lpad(CAST(p_partkey % 60 AS STRING), 5, '0') AS cve, 'CWE-' || CAST(20 + p_size AS STRING) AS cwe,
 CASE p_size % 4 WHEN 0 THEN 'introduced' WHEN 1 THEN 'limit' ELSE 'fixed' END AS event,
 CASE p_size % 3 WHEN 0 THEN 'https://github.com/org' || c || '/proj' || c || '.git' WHEN 1 THEN 'git@github.com:Org' || c || '/proj' || c ELSE 'https://github.com/other/fork' END AS repo,
 CASE p_size % 10 WHEN 9 THEN '0' ELSE sha1(CAST(p_partkey % 200 AS STRING)) END AS sha
FROM (SELECT p_partkey, p_size, CAST(p_partkey % 200 % 40 AS STRING) AS c FROM {part}) e
"""

#: CVE -> CWE rows of several sources: (source, cve, ordinal, cwe).
CVE_CWES = """
SELECT CASE p_partkey % 4 WHEN 0 THEN 'nvd' WHEN 1 THEN 'cna' WHEN 2 THEN 'osv' ELSE 'evaluator' END AS source,
 CASE WHEN p_partkey % 3 = 0 THEN 'CVE-2017-' || lpad(CAST(p_partkey % 25 AS STRING), 4, '0') ELSE 'CVE-2016-' || lpad(CAST(p_partkey % 30 AS STRING), 4, '0') END AS cve,
 p_partkey AS ordinal, 'CWE-' || CAST(20 + p_size % 7 AS STRING) AS cwe
FROM {part}
"""

_TABLE = re.compile(r"\{(\w+)\}")


def text(sql: str) -> str:
    """For DuckDB: the tables by their names."""
    return _TABLE.sub(r"\1", sql)


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """For Spark: the tables as DataFrames."""
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_TABLE.findall(sql))})


# What the oracles share: normalised labels and commit ids of the samples.
def missing(c: str) -> str:
    return f"({c} IS NULL OR lower(trim({c})) IN ('', 'nan', 'none', 'null', 'unknown'))"


def cve_tokens(c: str, edge: str = "") -> str:
    return f"list_transform(regexp_extract_all({c}, '(?i){edge}(CVE[-_ ]?[0-9]{{4}}[-_ ]?[0-9]{{4,}}){edge}', 1), lambda x: 'CVE-' || regexp_extract(x, '([0-9]{{4}})[-_ ]?([0-9]{{4,}})$', 1) || '-' || regexp_extract(x, '([0-9]{{4}})[-_ ]?([0-9]{{4,}})$', 2))"


def cwe_tokens(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '(?i)CWE[-_ ]?0*([0-9]{{1,5}})', 1), lambda x: 'CWE-' || CAST(CAST(x AS INT) AS VARCHAR))"


LABELLED = f"""
raw AS ({text(SAMPLES)}),
tok AS (SELECT *, CASE WHEN {missing("cve_id")} THEN [] ELSE list_sort(list_distinct({cve_tokens("cve_id")})) END AS cves, CASE WHEN {missing("cwe_id")} THEN [] ELSE {cwe_tokens("cwe_id")} END AS cwes FROM raw),
lab AS (SELECT * EXCLUDE (cve_id, cwe_id), cves[1] AS cve_id, cwes[1] AS cwe_id, array_to_string(cves, ';') AS cve_id_all,
  array_to_string(list_filter(cwes, lambda x, i: list_position(cwes, x) = i), ';') AS cwe_id_all,
  CASE WHEN cves[1] IS NOT NULL THEN 'original' END AS cve_source, CASE WHEN cwes[1] IS NOT NULL THEN 'original' END AS cwe_source,
  trim(commit_link) AS link,
  CASE WHEN regexp_matches(trim(commit_link), '(?i)(?:/commit/|/commits/|/\\+/)([0-9a-f]{{7,40}})(?:[/?#]|$)') THEN lower(regexp_extract(trim(commit_link), '(?i)(?:/commit/|/commits/|/\\+/)([0-9a-f]{{7,40}})(?:[/?#]|$)', 1))
       WHEN commit_link LIKE '%commit%' AND regexp_matches(commit_link, '[?;&](?:id|h)=[0-9a-f]{{7,40}}') THEN regexp_extract(commit_link, '[?;&](?:id|h)=([0-9a-f]{{7,40}})', 1) END AS commit_sha,
  nullif(regexp_extract(coalesce(commit_message, ''), 'cherry picked from commit ([0-9a-f]{{40}})', 1), '') AS alt_sha
  FROM tok),
keyed AS (SELECT *, CASE WHEN commit_sha IS NOT NULL THEN 'sha:' || commit_sha WHEN coalesce(link, '') <> '' THEN 'url:' || link ELSE '' END AS commit_key FROM lab)
"""
