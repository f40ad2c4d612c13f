"""Column expressions that normalise labels, commit links, URLs, messages and evidence records.

All are built-in expressions; null inputs give null or an empty array, as each docstring says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of a missing label, white space, commit markers in paths and keys in queries, confidence by source.
MISSING = ["", "nan", "none", "null", "unknown"]
BLANK = " \t\n\r\x0b\x0c"
COMMIT_MARKERS = ["/commit/", "/commits/", "/-/commit/", "/commitdiff/", "/commitdiff_plain/", "/changeset/", "/+/"]
COMMIT_QUERY_KEYS = ["id", "h", "hash", "commit", "rev", "revision"]
CONFIDENCE = {
    "original": "gold",
    "commit_message_explicit": "high",
    "same_commit": "high",
    "same_commit_propagated": "high",
    "osv_fixed_commit_exact": "high",
    "osv_fix_reference_exact": "high",
    "osv_reference_exact": "medium",
    "nvd_patch_commit_exact": "high",
    "nvd_commit_reference_exact": "medium",
    "cveorg_patch_commit_exact": "high",
    "cveorg_commit_reference_exact": "medium",
    "nvd_cve_primary": "high",
    "nvd_evaluator_note": "high",
    "cveorg_cve_primary": "high",
    "osv_cve_cwe_ids": "high",
    "cve_cwe_single": "high",
    "cve_cwe_ambiguous": "medium",
    "backport_source_commit": "medium",
}

CWE_TOKEN = r"(?i)CWE[-_ ]?0*(\d{1,5})"
CVE_TOKEN = r"(?i)CVE[-_ ]?\d{4}[-_ ]?\d{4,}"
_YEAR_AND_NUMBER = r"^\D*(\d{4})[-_ ]?(\d{4,})$"
_SHA = r"^[0-9a-f]{7,40}$"


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def no_strings(c: Column) -> Column:
    """An array of strings, empty instead of null."""
    return F.coalesce(c, F.array().cast("array<string>"))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK))


def is_missing(c: Column) -> Column:
    """Null, NaN spelled out, or a spelling of "nothing"."""
    return c.isNull() | F.lower(strip(c)).isin(MISSING)


def present(c: Column) -> Column:
    """The value, null where it is missing."""
    return F.when(~is_missing(c), c)


def _cwe_name(number: Column) -> Column:
    return F.concat(F.lit("CWE-"), number.cast("int").cast("string"))


def normalize_cwe(c: Column) -> Column:
    """CWE names in order of appearance without repeats; [] if there are none."""
    return no_strings(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(CWE_TOKEN), F.lit(1)), _cwe_name)))


def _cve_name(token: Column) -> Column:
    return F.concat(F.lit("CVE-"), F.regexp_extract(token, _YEAR_AND_NUMBER, 1), F.lit("-"), F.regexp_extract(token, _YEAR_AND_NUMBER, 2))


def normalize_cve(c: Column) -> Column:
    """CVE names sorted as strings without repeats; [] if there are none."""
    return no_strings(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(CVE_TOKEN), F.lit(0)), _cve_name))))


def first(c: Column) -> Column:
    return F.get(c, F.lit(0))


def normalize_labels(df: DataFrame) -> DataFrame:
    """Sets cve_id, cwe_id (first normalised value or null), cve_id_all and cwe_id_all (joined by ';', empty if none).

    A CVE text without a CVE in it is kept out of both columns like a missing one.
    """
    cves, cwes = normalize_cve(present(F.col("cve_id"))), normalize_cwe(present(F.col("cwe_id")))
    return df.withColumns({"cve_id": first(cves), "cve_id_all": F.array_join(cves, ";"), "cwe_id": first(cwes), "cwe_id_all": F.array_join(cwes, ";")})


def label_repairs(raw: DataFrame) -> DataFrame:
    """One row of counts on raw labels: fixed (spelled differently), multi (several values), dropped (a text without a label)."""

    def counts(name: str, values: Column) -> list[Column]:
        c = present(F.col(name))
        some = c.isNotNull() & (F.size(values) > 0)
        return [
            F.count_if(some & (first(values) != c)).alias(f"{name}_fixed"),
            F.count_if(some & (F.size(values) > 1)).alias(f"{name}_multi"),
            F.count_if(c.isNotNull() & (F.size(values) == 0)).alias(f"{name}_dropped"),
        ]

    return raw.agg(*counts("cve_id", normalize_cve(present(F.col("cve_id")))), *counts("cwe_id", normalize_cwe(present(F.col("cwe_id")))))


def initialize_sources(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{k}_source": F.when(F.col(f"{k}_id").isNotNull(), F.lit("original")) for k in ("cve", "cwe")})


def _query_values(url: Column, key: str) -> Column:
    """The values of one key in a URL's query, where ';' parts pairs as '&' does."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "[;&]"), lambda p: p.startswith(f"{key}="))
    return F.transform(pairs, lambda p: F.lower(strip(F.try_url_decode(F.substring(p, len(key) + 2, 1 << 20)))))


def _marker_pattern() -> str:
    marks = "|".join(m.replace("+", r"\+") for m in COMMIT_MARKERS)
    return rf"(?i)(?:{marks})([0-9a-f]{{7,40}})(?:\.(?:patch|diff))?(?:[/?#]|$)"


def extract_commit_sha(url: Column) -> Column:
    """The commit that a link names, lower case, 7 to 40 hex digits, else null.

    A path marker decides first. Links that speak of a commit or changeset may name it in a query key (in key order) or hold exactly one 40-digit hex number.
    """
    text = strip(url)
    by_path = F.lower(F.regexp_extract(text, _marker_pattern(), 1))
    keyed = [F.get(F.filter(_query_values(text, k), lambda v: v.rlike(_SHA)), F.lit(0)) for k in COMMIT_QUERY_KEYS]
    whole = extract_sha40s(text)
    rest = F.coalesce(*keyed, F.when(F.size(whole) == 1, F.lower(first(whole))))
    return F.when(by_path != "", by_path).when(F.lower(text).rlike("commit|changeset"), rest)


def extract_sha40s(url: Column) -> Column:
    """All runs of exactly 40 hex digits, in order."""
    return no_strings(F.regexp_extract_all(url, F.lit(r"(?<![0-9a-fA-F])([0-9a-fA-F]{40})(?![0-9a-fA-F])"), F.lit(1)))


def extract_alt_shas(message: Column) -> Column:
    """Commits that a message says it repeats (cherry-pick, backport, upstream, import), in order; "Fixes:" names the culprit and doesn't count."""
    pattern = r"(?i)(?:cherry[\s\-]?picked?\s+from(?:\s+commit)?|back[\s\-]?ported?\s+(?:of|from)(?:\s+commit)?|upstream\s+commit|imported\s+from\s+commit)[\s:]+([0-9a-f]{7,40})(?![0-9a-f])"
    return no_strings(F.array_distinct(F.transform(F.regexp_extract_all(message, F.lit(pattern), F.lit(1)), F.lower)))


def looks_like_commit_url(url: Column, sha: Column) -> Column:
    """Does a URL with this sha point at a change? Loose on purpose: any mention of a commit or changeset is enough."""
    low = F.lower(url)
    marks = [low.contains(m) for m in [*COMMIT_MARKERS, "/patch/", "/pull/", "commit", "changeset"]]
    return F.coalesce(low.contains(F.lower(sha)) & reduce(lambda a, b: a | b, marks), F.lit(False))


def message_cves(message: Column) -> Column:
    return no_strings(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(message, F.lit(r"(?i)\bCVE[-_ ]?\d{4}[-_ ]?\d{4,}\b"), F.lit(0)), _cve_name))))


def message_cwes(message: Column) -> Column:
    return no_strings(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(message, F.lit(r"(?i)\bCWE[-_ ]?(\d{1,5})\b"), F.lit(1)), _cwe_name))))


def row_shas(own: Column, alt: Column) -> Column:
    """array<struct<sha, is_backport>>: the row's own commit first, then the others it repeats."""
    mine = F.when(own.isNotNull(), F.array(F.struct(own.alias("sha"), F.lit(False).alias("is_backport")))).otherwise(F.array().cast("array<struct<sha:string,is_backport:boolean>>"))
    others = F.transform(F.filter(alt, lambda s: own.isNull() | (s != own)), lambda s: F.struct(s.alias("sha"), F.lit(True).alias("is_backport")))
    return F.concat(mine, others)


def full_cves(values: Column) -> Column:
    """The values that are CVE names and nothing else, upper case, sorted: what an advisory's id and aliases say."""
    return no_strings(F.array_sort(F.array_distinct(F.transform(F.filter(values, lambda v: v.rlike(r"(?i)^CVE-\d{4}-\d{4,}$")), F.upper))))


def cwe_list(texts: Column) -> Column:
    """All CWE names in an array of texts, in order of appearance."""
    return no_strings(F.array_distinct(F.flatten(F.transform(F.filter(texts, lambda t: t.isNotNull()), normalize_cwe))))


def nvd_patch_ref(tags: Column) -> Column:
    return F.coalesce(F.exists(tags, lambda t: F.lower(strip(t)) == "patch"), F.lit(False))


def cveorg_patch_ref(tags: Column) -> Column:
    """Tagged "patch", or with a tag that ends in "-patch" or "_patch"."""
    def one(t: Column) -> Column:
        name = F.replace(F.lower(strip(t)), F.lit("_"), F.lit("-"))
        return (name == "patch") | name.endswith("-patch")

    return F.coalesce(F.exists(tags, one), F.lit(False))


def confidence_of(source: Column) -> Column:
    """gold, high or medium; medium for a source that the table doesn't know, null without one."""
    known = F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv])
    return F.when(~is_missing(source), F.coalesce(F.try_element_at(known, source), F.lit("medium")))


def tag_source(source: Column, is_backport: Column) -> Column:
    return F.when(is_backport, F.concat(source, F.lit("_via_backport"))).otherwise(source)


def commit_key(sha: Column, link: Column) -> Column:
    """What rows of one commit share; '' (never null) for a row that has no commit and so must never be grouped."""
    return F.when(F.coalesce(sha, F.lit("")) != "", F.concat(F.lit("sha:"), sha)).when(F.coalesce(strip(link), F.lit("")) != "", F.concat(F.lit("url:"), strip(link))).otherwise(F.lit(""))


def normalize_repo_url(url: Column) -> Column:
    """host/path of a repository: ssh and git forms as https, without user, '.git', commit suffix or closing slash, lower case; null for blank."""
    c = F.lower(strip(url))
    c = F.regexp_replace(c, r"^git@([^:/]+):", "https://$1/")
    c = F.regexp_replace(c, r"^(?:git\+)?(?:ssh|git|https?)://(?:[^@/]*@)?", "")
    c = F.regexp_replace(c, r"/(?:-/)?commits?/.*$", "")
    c = F.regexp_replace(c, r"[?#].*$", "")
    c = F.regexp_replace(F.regexp_replace(c, r"/+$", ""), r"\.git$", "")
    return F.when(c != "", c)


def repo_matches(link: Column, repo: Column) -> Column:
    """Do a commit link and an advisory's repository name the same place? False if one is unknown."""
    return F.coalesce(normalize_repo_url(link) == normalize_repo_url(repo), F.lit(False))


def norm_hash(code: Column) -> Column:
    """MD5 of the code with all white space as single blanks, null for blank code."""
    space = "[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
    flat = F.trim(F.regexp_replace(code, space, " "))
    return F.when(flat != "", F.md5(flat))


def joern_key(before: Column, after: Column, lang: Column) -> Column:
    """SHA-1 over before, after and language, each closed by a NUL; a null is written "None"."""
    parts = [x for c in (before, after, lang) for x in (F.coalesce(c, F.lit("None")), F.lit("\0"))]
    return F.sha1(F.concat(*parts))


def sample_key(content: Column, ratio: float, least: int, n_lines: Column, n_cdg: Column, n_ddg: Column, logic: str) -> Column:
    """Changes whenever an input (``content``: joern_key of before, after and language), a gate, the graph or the version of the labelling logic does."""
    graph = F.when(n_lines.isNull(), F.lit("-")).otherwise(F.concat_ws(":", n_lines, n_cdg, n_ddg))
    parts = [x for c in (content, F.lit(str(ratio)), F.lit(str(least)), graph, F.lit(logic)) for x in (F.coalesce(c, F.lit("None")), F.lit("\0"))]
    return F.sha1(F.concat(*parts))
