"""Readers of samples, advisory sources, the weakness catalog, external line labels and line graphs.

Each reader has a pure part that takes a DataFrame of parsed documents, so that the same rules serve any store. Undecodable records are dropped, not fatal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secdata.functions import language_rules as L
from secdata.functions import normalize as N
from secdata.sources import feeds, sinks

_CWE_HOLDER = "struct<cwe_ids:array<string>,cweIds:array<string>,cwes:array<string>,CWE:struct<id:string>>"
OSV_SCHEMA = f"id string, aliases array<string>, withdrawn string, references array<struct<type:string,url:string>>, affected array<struct<ranges:array<struct<type:string,repo:string,events:array<map<string,string>>>>,database_specific:{_CWE_HOLDER}>>, database_specific {_CWE_HOLDER}"
_WEAKNESS = "array<struct<type:string,description:array<struct<lang:string,value:string>>>>"
_REFS = "array<struct<url:string,tags:array<string>>>"
NVD_ITEM = f"cve struct<id:string,weaknesses:{_WEAKNESS},references:{_REFS},evaluatorComment:string,evaluatorImpact:string,evaluatorSolution:string>"
NVD_SCHEMA = f"vulnerabilities array<struct<{NVD_ITEM.replace('cve struct', 'cve:struct', 1)}>>"
_CONTAINER = f"struct<problemTypes:array<struct<descriptions:array<struct<cweId:string,description:string>>>>,references:{_REFS}>"
CVELIST_SCHEMA = f"cveMetadata struct<cveId:string,state:string>, containers struct<cna:{_CONTAINER},adp:array<{_CONTAINER}>>"
FLAW_COLUMNS = ["func_before", "func_after", "lines_before", "lines_after", "vul", "vul_func_with_fix", "commit_id", "CVE ID", "CWE ID", "codeLink", "project"]
LINE_CHANGE_SCHEMA = "func_name string, func_src_before string, func_src_after string, file_name string, commit_link string, vul_type string, line_changes struct<deleted:array<struct<line_no:int,line:string>>,added:array<struct<line_no:int,line:string>>>"


def read_samples(spark: SparkSession, path: str, order: list[str] | None = None) -> DataFrame:
    """A sample table; ``sample_id`` is taken from the data or numbered over a declared total order."""
    df = spark.read.parquet(path)
    if "sample_id" in df.columns:
        return df
    if not order:
        raise ValueError("without a sample_id column an order must be declared")
    return number_rows(df, order)


#: Rows that are numbered together, and ranges at most.
RANGE_ROWS, MOST_RANGES = 1_000_000, 20_000


def number_rows(df: DataFrame, order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds sample_id 0, 1 .. in the given order; rows that tie in it go by a hash of all their columns.

    The rows are parted by ranges of the order once, with as many ranges as the number of rows asks for, and written with their range. Both the counts of the ranges and the numbers
    within them are taken from that table, so they agree whatever bounds were sampled. The hash is part of the range key: a tie of very many rows is spread over ranges.
    """
    folder, rank = sinks.work_folder(df.sparkSession), [*order, "__h"]
    hashed = df.withColumn("__h", F.xxhash64(*[f"`{c}`" for c in df.columns]))
    runs = max(1, min(MOST_RANGES, -(-hashed.count() // range_rows)))
    ranged = sinks.stage_table(hashed.repartitionByRange(runs, *rank).withColumn("__r", F.spark_partition_id()), folder, "ranged")
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row a range, MOST_RANGES at most
    starts = ranged.groupBy("__r").agg(F.count("*").alias("c")).select("__r", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("__s"))
    numbered = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__r").orderBy(*rank)))
    return numbered.join(F.broadcast(starts), "__r").withColumn("sample_id", F.col("__s") + F.col("__n") - 1).drop("__r", "__n", "__s", "__h")


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents; broken ones and roots that aren't objects are dropped."""
    kept = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json*").withColumn("path", F.col("_metadata.file_path"))
    return parse(kept.withColumnRenamed("value", "json"), schema)


def parse(docs: DataFrame, schema: str) -> DataFrame:
    """Column json to the schema's columns; other columns stay."""
    rest = [c for c in docs.columns if c != "json"]
    read = F.transform(F.array("json"), lambda j: F.when(F.trim(j).startswith("{"), F.from_json(j, f"{schema}, __bad string", {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"})))
    # A filter on a parsed column would be moved below the parsing, with the parsing in it; a generator parses each record once.
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.filter(read, lambda d: d.isNotNull() & d["__bad"].isNull()))).drop("__bad")


def read_osv(spark: SparkSession, path: str) -> DataFrame:
    return osv_live(_json(spark, path, OSV_SCHEMA))


def osv_live(records: DataFrame) -> DataFrame:
    """Records that aren't withdrawn, with cves (from id and aliases) and cwes (root and affected, sorted)."""
    def held(c: Column) -> Column:
        return F.flatten(F.array(*[N.no_strings(c[k]) for k in ("cwe_ids", "cweIds", "cwes")], N.no_strings(F.when(c["CWE"]["id"].isNotNull(), F.array(c["CWE"]["id"])))))

    texts = F.concat(held(F.col("database_specific")), F.coalesce(F.flatten(F.transform("affected", lambda a: held(a["database_specific"]))), F.array().cast("array<string>")))
    return records.where(F.coalesce("withdrawn", F.lit("")) == "").withColumns({"cves": N.full_cves(F.concat(F.array("id"), N.no_strings(F.col("aliases")))), "cwes": F.array_sort(N.cwe_list(texts))})


def osv_references(records: DataFrame) -> DataFrame:
    """(cve, cwes, primary_cwes, url, kind) for every CVE of a record and every reference."""
    r = records.select(F.explode("cves").alias("cve"), "cwes", "references").select("cve", "cwes", F.explode("references").alias("r"))
    return r.select("cve", "cwes", F.col("cwes").alias("primary_cwes"), "r.url", F.col("r.type").alias("kind"))


def osv_events(records: DataFrame) -> DataFrame:
    """(cve, cwes, repo, event, sha) for the events of git ranges."""
    ranges = records.select(F.explode("cves").alias("cve"), "cwes", F.explode("affected").alias("a")).select("cve", "cwes", F.explode("a.ranges").alias("g")).where("upper(g.type) = 'GIT'")
    events = ranges.select("cve", "cwes", F.col("g.repo").alias("repo"), F.explode("g.events").alias("e"))
    return events.select("cve", "cwes", "repo", F.explode("e").alias("event", "sha"))


def read_nvd(spark: SparkSession, path: str) -> DataFrame:
    """The records of all feeds below ``path``. Files are ranked by name, so over yearly feeds the last record of a CVE is the one in the latest year's file."""
    items = parse(feeds.read_feed(spark, path, "vulnerabilities"), NVD_ITEM)
    return nvd_items(items.select(feeds.ordinal().alias("ordinal"), "cve"))


def nvd_records(whole: DataFrame) -> DataFrame:
    """As ``nvd_items``, of feeds that stand whole in rows: column vulnerabilities, and file_rank where there are several feeds (else each row is taken as the only one)."""
    rank = F.col("file_rank") if "file_rank" in whole.columns else F.lit(0)
    each = whole.select(rank.cast("int").alias("file_rank"), F.posexplode("vulnerabilities").alias("position", "v"))
    return nvd_items(each.select(F.struct("file_rank", F.col("position").cast("long").alias("position")).alias("ordinal"), F.col("v.cve").alias("cve")))


def nvd_items(items: DataFrame) -> DataFrame:
    """(cve, cwes, primary_cwes, evaluator_cwes, references, ordinal) of records (ordinal, cve) with valid CVE ids, upper case."""
    v = items.select("ordinal", "cve.*").where(F.col("id").rlike(r"(?i)^CVE-\d{4}-\d{4,}$"))

    def texts(kind: str | None) -> Column:
        w = F.col("weaknesses") if kind is None else F.filter("weaknesses", lambda x: x["type"] == kind)
        return F.flatten(F.transform(w, lambda x: F.transform(x["description"], lambda d: d["value"])))

    notes = F.concat_ws(" ", "evaluatorComment", "evaluatorImpact", "evaluatorSolution")
    return v.select(F.upper("id").alias("cve"), F.array_sort(N.cwe_list(texts(None))).alias("cwes"), F.array_sort(N.cwe_list(texts("Primary"))).alias("primary_cwes"), N.normalize_cwe(notes).alias("evaluator_cwes"), "references", "ordinal")


def nvd_references(records: DataFrame) -> DataFrame:
    r = records.select("cve", "cwes", "primary_cwes", F.explode("references").alias("r"))
    return r.select("cve", "cwes", "primary_cwes", "r.url", F.when(N.nvd_patch_ref(F.col("r.tags")), F.lit("patch")).otherwise(F.lit("other")).alias("kind"))


def read_cvelist(spark: SparkSession, path: str) -> DataFrame:
    return cvelist_records(_json(spark, path, CVELIST_SCHEMA).where(F.col("path").contains("/cves/")))


def containers() -> Column:
    """The assigner's container first, then the others in order."""
    other = F.coalesce(F.transform("containers.adp", lambda c, i: F.struct(F.concat(F.lit("adp"), i.cast("string")).alias("name"), c.alias("c"))), F.array())
    return F.concat(F.array(F.struct(F.lit("cna").alias("name"), F.col("containers.cna").alias("c"))), other)


def cvelist_records(records: DataFrame) -> DataFrame:
    """One row per container of each record that isn't rejected: (cve, container, cwes, primary_cwes (the first seen), references)."""
    good = records.where((F.upper(F.coalesce("cveMetadata.state", F.lit(""))) != "REJECTED") & F.col("cveMetadata.cveId").rlike(r"(?i)^CVE-\d{4}-\d{4,}$"))
    c = good.select(F.upper("cveMetadata.cveId").alias("cve"), F.explode(containers()).alias("x")).select("cve", F.col("x.name").alias("container"), "x.c")
    texts = F.flatten(F.transform("c.problemTypes", lambda p: F.flatten(F.transform(p["descriptions"], lambda d: F.array(d["cweId"], d["description"])))))
    seen = N.cwe_list(texts)
    return c.select("cve", "container", F.array_sort(seen).alias("cwes"), F.slice(seen, 1, 1).alias("primary_cwes"), F.col("c.references").alias("references"))


def cvelist_references(records: DataFrame) -> DataFrame:
    r = records.select("cve", "cwes", "primary_cwes", F.explode("references").alias("r"))
    return r.select("cve", "cwes", "primary_cwes", "r.url", F.when(N.cveorg_patch_ref(F.col("r.tags")), F.lit("patch")).otherwise(F.lit("other")).alias("kind"))


def read_flaw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The known columns that the files have; unreadable files are skipped."""
    df = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(path)
    kept = df.select(*[F.col(f"`{c}`") for c in FLAW_COLUMNS if c in df.columns], F.col("_metadata.file_path").alias("file"))
    return kept.withColumn("h", N.norm_hash(F.col("func_before")))


def read_line_changes(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in a folder per split."""
    df = spark.read.schema(LINE_CHANGE_SCHEMA).json(path, recursiveFileLookup=True, pathGlobFilter="*.jsonl").withColumn("path", F.col("_metadata.file_path"))
    return line_changes(df)


def line_changes(df: DataFrame) -> DataFrame:
    """Adds split (parent folder), language, cwe_id, deleted and added (sorted line numbers), deleted_text."""
    numbers = {k: F.array_sort(F.transform(f"line_changes.{k}", lambda x: x["line_no"])) for k in ("deleted", "added")}
    return df.withColumns({"split": F.element_at(F.split("path", "/"), -2), "language": L.language_from_path(F.col("file_name")), "cwe_id": N.first(N.normalize_cwe(F.col("vul_type"))), **numbers, "deleted_text": F.transform("line_changes.deleted", lambda x: x["line"])})


_WEAKNESS_XML = "_ID string, _Name string, _Abstraction string, Description string, Related_Weaknesses struct<Related_Weakness:array<struct<_Nature:string,_CWE_ID:string,_View_ID:string>>>"
_MEMBER = "struct<_Nature:string,_CWE_ID:string,_View_ID:string>"
_CATEGORY_XML = f"_ID string, _Name string, Summary string, Relationships struct<Has_Member:array<{_MEMBER}>,Member_Of:array<{_MEMBER}>,Relationship:array<{_MEMBER}>>"


def read_cwe_catalog(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    w = spark.read.format("xml").option("rowTag", "Weakness").schema(_WEAKNESS_XML).load(path)
    c = spark.read.format("xml").option("rowTag", "Category").schema(_CATEGORY_XML).load(path)
    return catalog(w, c)


def read_cwe_hierarchy(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """What the pillars need: node (id, name, kind, abstraction), parent (ChildOf) and member_of (a category's MemberOf). A catalog for ``taxonomy.top_ancestors``."""
    whole = read_cwe_catalog(spark, path)
    return {"node": whole["node"].drop("text"), "parent": whole["parent"], "member_of": whole["member_of"]}


def catalog(weaknesses: DataFrame, categories: DataFrame) -> dict[str, DataFrame]:
    """node, parent (ChildOf in view 1000 or without a view), child (reversed, plus category members), cat699, member_of (categories' MemberOf)."""
    node = weaknesses.select(F.col("_ID").alias("id"), F.col("_Name").alias("name"), F.col("Description").alias("text"), F.lit("weakness").alias("kind"), F.col("_Abstraction").alias("abstraction"))
    node = node.unionByName(categories.select(F.col("_ID").alias("id"), F.col("_Name").alias("name"), F.col("Summary").alias("text"), F.lit("category").alias("kind"), F.lit(None).cast("string").alias("abstraction")))
    rel = weaknesses.select(F.col("_ID").alias("child"), F.explode("Related_Weaknesses.Related_Weakness").alias("r"))
    parent = rel.where("r._Nature = 'ChildOf' AND coalesce(r._View_ID, '1000') = '1000'").select("child", F.col("r._CWE_ID").alias("parent")).distinct()
    member = categories.select(F.col("_ID").alias("category"), F.explode("Relationships.Has_Member").alias("m")).select(F.col("m._CWE_ID").alias("member"), "category", F.col("m._View_ID").alias("view"))
    # A membership is an element of that name, or one of another name whose nature says so.
    kept = [F.coalesce(F.col("Relationships.Member_Of"), F.array()), *[F.coalesce(F.filter(f"Relationships.{x}", lambda m: m["_Nature"] == "MemberOf"), F.array()) for x in ("Has_Member", "Relationship")]]
    member_of = categories.select(F.col("_ID").alias("child"), F.explode(F.concat(*kept)).alias("m")).select("child", F.col("m._CWE_ID").alias("parent")).distinct()
    child = parent.select("parent", "child").unionByName(member.select(F.col("category").alias("parent"), F.col("member").alias("child"))).distinct()
    return {"node": node, "parent": parent, "child": child, "cat699": member.where("view = '699'").select("member", "category").distinct(), "member_of": member_of}


def read_line_graphs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, lang string, offset int, lines string, cdg string, rd string").parquet(path)


def enrichment_map(docs: DataFrame, shape: str) -> DataFrame:
    """(cve, cwes) from one JSON object keyed by CVE (column json): shape ``list`` (arrays of CWEs), ``vendor`` ({cwe, _http}) or ``third`` (arrays of {cweID})."""
    value = {"list": "array<string>", "vendor": "struct<cwe:string,_http:int>", "third": "array<struct<cweID:string>>"}[shape]
    e = docs.select(F.explode(F.from_json("json", f"map<string,{value}>")).alias("cve", "v"))
    texts = {"list": lambda: F.col("v"), "vendor": lambda: F.array("v.cwe"), "third": lambda: F.transform("v", lambda x: x["cweID"])}[shape]()
    return e.select(F.upper(F.trim("cve")).alias("cve"), N.cwe_list(texts).alias("cwes")).where(F.size("cwes") > 0)


def scan_counters(raw: DataFrame, records: DataFrame, references: DataFrame) -> DataFrame:
    """One row of counts of a scan: documents, kept records, references, patch references."""
    a, b = raw.agg(F.count("*").alias("scanned")), records.agg(F.count("*").alias("kept"))
    c = references.agg(F.count("*").alias("refs"), F.count_if(F.lower("kind").isin("patch", "fix")).alias("patch_refs"))
    return a.crossJoin(b).crossJoin(c)  # three single rows
