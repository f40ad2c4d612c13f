"""CWEs from CVEs: source tables, the tiered fill, and the final ranked ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secdata.functions import normalize as N
from secdata.functions import rules

# The ladder's local tables in order.
LADDER = ["nvd_primary", "cna_primary", "nvd_evaluator", "osv", "nvd_all", "cna_all", "observed_examples"]


def clean_table(table: DataFrame) -> DataFrame:
    """(cve, cwes): CVEs trimmed and upper case, CWE texts normalised; CVEs without a real CWE are dropped."""
    cwes = N.cwe_list(F.col("cwes"))
    return table.select(F.upper(F.trim("cve")).alias("cve"), cwes.alias("cwes")).where(F.size("cwes") > 0)


def merge_sets(records: DataFrame) -> DataFrame:
    """(cve, cwes): the sorted union of all records of a CVE."""
    return records.select("cve", F.explode("cwes").alias("cwe")).groupBy("cve").agg(F.array_sort(F.collect_set("cwe")).alias("cwes"))


def last_record(records: DataFrame, keep_empty: bool = True) -> DataFrame:
    """(cve, cwes) of the record with the highest ``ordinal``; keep_empty False lets only records with CWEs count."""
    rows = records if keep_empty else records.where(F.size("cwes") > 0)
    return rows.groupBy("cve").agg(F.max_by("cwes", "ordinal").alias("cwes"))


def pivot_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per CVE with a column of CWEs for each table (null where a table doesn't know the CVE).

    The tables are stacked and grouped once, instead of one join each.
    """
    stacked = None
    for name, table in tables.items():
        rows = table.select("cve", F.lit(name).alias("t"), "cwes")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked.groupBy("cve").agg(*[F.first(F.when(F.col("t") == name, F.col("cwes")), ignorenulls=True).alias(name) for name in tables])


def _size(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def cve_to_cwe(rows: DataFrame, tables: dict[str, DataFrame], only_single: bool = False) -> DataFrame:
    """Fills missing CWEs from tables nvd_primary, cna_primary, nvd_evaluator, osv, nvd_all, cna_all; adds cwe_candidates.

    A tier counts only with exactly one CWE; then the only CWE over all sources, or (unless only_single) the first one in string order. cwe_candidates is the sorted union,
    for every row with a CVE that any source knows, also where the row has a CWE already.
    """
    wide = pivot_tables(tables)
    j = rows.withColumn("__cve", F.upper(F.trim("cve_id"))).join(wide.withColumnRenamed("cve", "__cve"), "__cve", "left")
    every = F.array_sort(F.array_distinct(F.flatten(F.array(*[N.no_strings(F.col(t)) for t in ("nvd_all", "cna_all", "osv", "nvd_evaluator")]))))
    tiers = [("nvd_primary", "nvd_cve_primary"), ("cna_primary", "cveorg_cve_primary"), ("nvd_evaluator", "nvd_evaluator_note"), ("osv", "osv_cve_cwe_ids")]
    picks = [F.when(_size(t) == 1, F.struct(F.col(t)[0].alias("cwe"), F.lit(s).alias("source"))) for t, s in tiers]
    picks.append(F.when(F.size(every) == 1, F.struct(every[0].alias("cwe"), F.lit("cve_cwe_single").alias("source"))))
    if not only_single:
        picks.append(F.when(F.size(every) > 1, F.struct(every[0].alias("cwe"), F.lit("cve_cwe_ambiguous").alias("source"))))
    take = F.col("cwe_id").isNull() & F.col("cve_id").isNotNull()
    j = j.withColumn("__pick", F.when(take, F.coalesce(*picks)))
    return j.withColumns(
        {
            "cwe_candidates": F.when(F.col("cve_id").isNotNull(), F.array_join(every, ";")).otherwise(F.lit("")),
            "cwe_source": F.coalesce(F.col("__pick.source"), F.col("cwe_source")),
            "cwe_id": F.coalesce(F.col("cwe_id"), F.col("__pick.cwe")),
        }
    ).drop("__cve", "__pick", *tables)


def resolve_final_cwe(rows: DataFrame, ladder: dict[str, DataFrame], vendor: DataFrame, third_party: DataFrame, coarse: bool = False) -> DataFrame:
    """Adds cwe_label_final with _source, _all, _rule, _acc, _conf and has_cwe_label_final.

    Existing label, then each table with exactly one CWE, the only CWE of all tables, the vendor's first, the third party's first (its CWEs are candidates always), the
    description rule, and the first of several candidates. Candidates stand in ladder order, then those of the deciding steps.
    """
    names = list(ladder)
    wide = pivot_tables(ladder | {"__vendor": vendor, "__third": third_party})
    j = rows.withColumn("__cve", F.upper(N.strip(F.col("cve_id")))).join(wide.withColumnRenamed("cve", "__cve"), "__cve", "left")
    arr = {t: N.no_strings(F.col(t)) for t in [*names, "__vendor", "__third"]}
    local = F.array_distinct(F.flatten(F.array(*[arr[t] for t in names])))
    existing = N.normalize_cwe(F.col("cwe_id"))
    has = F.size(existing) > 0
    rule = rules.predict_from_description(F.col("cve_description"), coarse)
    none = F.lit(None)

    def pick(when: Column, cwe: Column, source: str) -> Column:
        return F.when(when, F.struct(cwe.alias("cwe"), F.lit(source).alias("source")))

    j = j.withColumns({"__local": local, "__rule": F.when(~has, rule)})
    steps = [pick(_size(t) == 1, F.col(t)[0], t) for t in names]
    steps.append(pick(F.size("__local") == 1, F.col("__local")[0], "all_sources_single"))
    j = j.withColumn("__by_table", F.coalesce(*steps))
    before_rule = F.coalesce(F.col("__by_table"), pick(_size("__vendor") > 0, F.col("__vendor")[0], "vendor_api"), pick(_size("__third") > 0, F.col("__third")[0], "third_party"))
    j = j.withColumn("__early", before_rule)
    by_rule = F.col("__early").isNull() & F.col("__rule").isNotNull()
    cands = F.array_distinct(
        F.flatten(
            F.array(
                F.col("__local"),
                F.when(F.col("__by_table").isNull(), arr["__vendor"]).otherwise(N.strings()),
                arr["__third"],
                F.when(by_rule, F.array(F.col("__rule.cwe"))).otherwise(N.strings()),
            )
        )
    )
    j = j.withColumn("__cands", F.when(has, F.array_distinct(F.concat(F.col("__local"), existing))).otherwise(cands))
    choice = F.when(has, F.struct(existing[0].alias("cwe"), F.lit("pipeline_cwe_id").alias("source"))).otherwise(
        F.coalesce(F.col("__early"), pick(by_rule, F.col("__rule.cwe"), "description_rule"), pick(F.size("__cands") > 1, F.col("__cands")[0], "multi_source_ambiguous"))
    )
    own_conf = F.col("cwe_confidence") if "cwe_confidence" in rows.columns else F.lit("high")
    j = j.withColumn("__c", choice)
    ruled = F.col("__c.source") == "description_rule"
    conf = F.when(F.col("__c").isNull(), none).when(has, own_conf).when(F.col("__c.source") == "third_party", F.lit("third_party")).when(F.col("__c.source").isin("description_rule", "multi_source_ambiguous"), F.lit("medium")).otherwise(F.lit("high"))
    return j.withColumns(
        {
            "cwe_label_final": F.col("__c.cwe"),
            "cwe_label_final_source": F.col("__c.source"),
            "cwe_label_final_all": F.array_join("__cands", ";"),
            "cwe_label_final_rule": F.when(ruled, F.col("__rule.rule")).otherwise(F.lit("")),
            "cwe_label_final_acc": F.when(ruled, F.col("__rule.accuracy")),
            "cwe_label_final_conf": conf,
            "has_cwe_label_final": F.col("__c").isNotNull(),
        }
    ).drop("__cve", "__local", "__rule", "__by_table", "__early", "__cands", "__c", *names, "__vendor", "__third")


def first_hit_ladder(rows: DataFrame, ladder: dict[str, DataFrame]) -> DataFrame:
    """Variant: the first table that knows any CWE gives its first; adds cwe_first and cwe_first_source."""
    wide = pivot_tables(ladder)
    j = rows.withColumn("__cve", F.upper(N.strip(F.col("cve_id")))).join(wide.withColumnRenamed("cve", "__cve"), "__cve", "left")
    pick = F.coalesce(*[F.when(_size(t) > 0, F.struct(F.col(t)[0].alias("cwe"), F.lit(t).alias("source"))) for t in ladder])
    return j.withColumn("__p", pick).withColumns({"cwe_first": F.col("__p.cwe"), "cwe_first_source": F.col("__p.source")}).drop("__cve", "__p", *ladder)


def rescue_gap(rows: DataFrame, observed: DataFrame, vendor: DataFrame) -> DataFrame:
    """Rows with a CVE and no CWE: observed examples, vendor table, description rule, coarse rule; adds rescued_cwe, rescue_source, rescue_conf."""
    wide = pivot_tables({"__o": observed, "__v": vendor})
    j = rows.where("cve_id IS NOT NULL AND cwe_id IS NULL").withColumn("__cve", F.upper(N.strip(F.col("cve_id")))).join(wide.withColumnRenamed("cve", "__cve"), "__cve", "left")
    rule = rules.predict_from_description(F.col("cve_description"), coarse=True)
    coarse = F.col("__rule.rule") == rules.COARSE_RULE[0]
    source = F.when(coarse, F.lit("coarse_rule")).otherwise(F.lit("description_rule"))
    j = j.withColumn("__rule", rule)
    pick = F.coalesce(
        F.when(_size("__o") > 0, F.struct(F.col("__o")[0].alias("cwe"), F.lit("observed_examples").alias("source"), F.lit("high").alias("conf"))),
        F.when(_size("__v") > 0, F.struct(F.col("__v")[0].alias("cwe"), F.lit("vendor_api").alias("source"), F.lit("high").alias("conf"))),
        F.when(F.col("__rule").isNotNull(), F.struct(F.col("__rule.cwe").alias("cwe"), source.alias("source"), F.when(coarse, F.lit("low")).otherwise(F.lit("medium")).alias("conf"))),
    )
    return j.withColumn("__p", pick).withColumns({"rescued_cwe": F.col("__p.cwe"), "rescue_source": F.col("__p.source"), "rescue_conf": F.col("__p.conf")}).drop("__cve", "__rule", "__p", "__o", "__v")
