"""Reports over labelled samples; each is one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def per_cwe_audit(rows: DataFrame, dim: DataFrame, column: str = "cwe_label_final") -> DataFrame:
    """(cwe, n, classes, rule) for each final CWE."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("cwe")).agg(F.count("*").alias("n"))
    return counts.join(dim, "cwe", "left").select("cwe", "n", F.array_join("classes", ";").alias("classes"), "rule")


def class_report(rows: DataFrame, prefix: str) -> DataFrame:
    """(class, primary_rows, any_rows): rows whose first class it is, and rows that have it among several."""
    primary = rows.where(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("class")).agg(F.count("*").alias("primary_rows"))
    every = rows.select(F.explode(F.filter(F.split(f"{prefix}_all", ";"), lambda x: x != "")).alias("class")).groupBy("class").agg(F.count("*").alias("any_rows"))
    return every.join(primary, "class", "full_outer").select("class", F.coalesce("primary_rows", F.lit(0)).alias("primary_rows"), F.coalesce("any_rows", F.lit(0)).alias("any_rows"))


def class_balance(rows: DataFrame, prefix: str) -> DataFrame:
    """One row: classified rows, coverage in percent, rows with several classes, size ratio of the largest and smallest class."""
    sizes = rows.where(F.col(prefix).isNotNull()).groupBy(prefix).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"))
    a = rows.agg(F.count("*").alias("n_rows"), F.count(prefix).alias("classified"), F.count_if(F.col(f"n_{prefix}") > 1).alias("several"))
    return a.crossJoin(sizes).select("n_rows", "classified", "several", F.round(F.try_divide(100.0 * F.col("classified"), F.col("n_rows")), 4).alias("coverage_pct"), F.round(F.try_divide("most", "least"), 4).alias("imbalance"))  # single rows


def size_report(rows: DataFrame, column: str, small: int = 10) -> DataFrame:
    """One row: distinct values of a label, those with fewer than ``small`` rows, the largest."""
    n = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_classes"), F.count_if(F.col("n") < small).alias("n_small"), F.max("n").alias("largest"))


def gap_by(rows: DataFrame, key: str) -> DataFrame:
    """(key, rows with a CVE but no CWE, of those with a usable description)."""
    g = rows.where("cve_id IS NOT NULL AND cwe_id IS NULL")
    return g.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.length(F.trim("cve_description")) > 0).alias("with_description"))


def pillar_report(rows: DataFrame, tops: DataFrame, cwe: str = "cwe_id") -> DataFrame:
    """(pillar, n_rows, n_cwes) by the nearest parentless ancestor."""
    named = tops.select("cwe", F.get(F.split("tops", ";"), F.lit(0)).alias("pillar"))
    return rows.where(F.col(cwe).isNotNull()).join(named, F.col(cwe) == F.col("cwe")).groupBy("pillar").agg(F.count("*").alias("n_rows"), F.countDistinct("cwe").alias("n_cwes"))


def top_per_group(rows: DataFrame, group: str, value: str, n: int = 3) -> DataFrame:
    """(group, value, rows, rank) of each group's ``n`` most frequent values (ties: smallest)."""
    counts = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("rows"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("rows"), value))).where(F.col("rank") <= n)


def flaw_line_coverage(rows: DataFrame) -> DataFrame:
    """(language, n, matched, pct) of external flaw lines."""
    g = rows.groupBy("language").agg(F.count("*").alias("n"), F.count_if("matched").alias("matched"))
    return g.withColumn("pct", F.round(100.0 * F.col("matched") / F.col("n"), 4))


def line_count_histogram(rows: DataFrame, most: int = 11) -> DataFrame:
    return rows.where("matched").groupBy(F.least("line_count", F.lit(most)).alias("bin")).agg(F.count("*").alias("n"))


def line_count_stats(rows: DataFrame) -> DataFrame:
    return rows.where("matched").agg(F.round(F.avg("line_count"), 6).alias("mean"), F.median("line_count").alias("median"), F.max("line_count").alias("max"))


def coverage(status: DataFrame) -> DataFrame:
    """(label_source, n, density, mean_lines): labelled rows by source, with labelled over union lines."""
    return status.groupBy("label_source").agg(F.count("*").alias("n"), F.round(F.try_divide(F.sum("n_vul"), F.sum("n_lines")), 6).alias("density"), F.round(F.avg("n_vul"), 6).alias("mean_lines"))


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("n_vul") > 0).alias("usable"))


def by_language(status: DataFrame) -> DataFrame:
    return status.groupBy("lang").agg(F.count("*").alias("n"), F.round(100.0 * F.avg((F.col("n_vul") > 0).cast("int")), 4).alias("usable_pct"), F.round(F.avg("n_lines"), 6).alias("mean_lines"), F.round(F.avg("n_cdg"), 6).alias("mean_cdg"), F.round(F.avg("n_ddg"), 6).alias("mean_ddg"))


def failure_reasons(status: DataFrame, reasons: list[str]) -> DataFrame:
    """Language by reason, one column for each of the given reasons."""
    return status.groupBy("lang").agg(*[F.count_if(F.col("status") == r).alias(r) for r in reasons])


def per_cwe_lines(status: DataFrame) -> DataFrame:
    return status.groupBy("cwe").agg(F.count("*").alias("rows"), F.sum("n_vul").alias("lines"), F.median("n_vul").alias("median"))


def origin_share(lines: DataFrame) -> DataFrame:
    """One row: labelled lines from removal, from dependence alone."""
    return lines.agg(F.count_if("from_removed").alias("from_removed"), F.count_if(F.expr("from_depadd AND NOT from_removed")).alias("from_depadd"))


def case_counts(rows: DataFrame, column: str) -> DataFrame:
    """(case, n) of a pass's decisions."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("case")).agg(F.count("*").alias("n"))
