"""Writers: full results, audit projections, review slices, stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_full(df: DataFrame, path: str, csv: bool = True) -> None:
    """Parquet, and CSV with arrays joined by ';'."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    if csv:
        flat = df.select(*[F.array_join(f.name, ";").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema.fields])
        flat.write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of an audit list that exist, in the list's order."""
    return df.select(*[c for c in columns if c in df.columns])


def missing_both(df: DataFrame) -> DataFrame:
    return df.where("cve_id IS NULL AND cwe_id IS NULL")


def ambiguous(df: DataFrame, statuses: list[str]) -> DataFrame:
    """Rows without a CVE of which any source's status says that evidence was ambiguous."""
    return df.where(F.col("cve_id").isNull() & F.greatest(*[F.coalesce(F.col(s).contains("ambiguous"), F.lit(False)) for s in statuses], F.lit(False)))


def cwe_conflict(df: DataFrame, candidates: str = "cwe_candidates") -> DataFrame:
    """Rows whose CWE isn't among a database's candidates."""
    c = F.filter(F.split(F.coalesce(candidates, F.lit("")), ";"), lambda x: x != "")
    return df.where(F.col("cwe_id").isNotNull() & (F.size(c) > 0) & ~F.array_contains(c, F.col("cwe_id")))


def trainable(df: DataFrame) -> DataFrame:
    return df.where("cwe_label_final IS NOT NULL")


def gap(df: DataFrame) -> DataFrame:
    return df.where("cve_id IS NOT NULL AND cwe_label_final IS NULL")


def failures(df: DataFrame) -> DataFrame:
    return df.where(~F.col("has_line_label"))


def stage_table(df: DataFrame, folder: str, name: str, fresh: bool = True) -> DataFrame:
    """A stage's result as Parquet in ``folder``, and read back: cuts lineage, and a later run can resume (fresh False) from what is there."""
    spark: SparkSession = df.sparkSession
    df.write.mode("overwrite" if fresh else "ignore").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def counted_table(df: DataFrame, folder: str, name: str, counts: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """As ``stage_table``, and how many rows meet each condition, counted while the rows are written: no second pass. Null is not met; ``rows`` counts all."""
    seen = Observation(name)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()])
    made = stage_table(watched, folder, name)
    return made, {k: int(v or 0) for k, v in seen.get.items()}


def write_slices(df: DataFrame, slices: dict[str, Column], path: str, csv: list[str] | None = None) -> dict[str, int]:
    """All rows, and each slice's rows, in one job: Parquet parted by ``slice`` ("all" and the names given); returns the rows of each. A row is written once for "all" and once for each slice that it is in.

    csv: the columns of an audit list, written as CSV from the same table; those that the rows have, in the list's order, arrays joined by ';'.
    """
    if "all" in slices or "slice" in df.columns:
        raise ValueError("'all' is every row's slice, and slice the name of its column")
    held = F.filter(F.array(F.lit("all"), *[F.when(c, F.lit(k)) for k, c in slices.items()]), lambda x: x.isNotNull())
    seen = Observation("slices")
    each = df.withColumn("slice", F.explode(held)).observe(seen, *[F.count_if(F.col("slice") == k).alias(k) for k in ("all", *slices)])
    each.write.mode("overwrite").partitionBy("slice").parquet(path)
    if csv is not None:
        rows = read_slice(df.sparkSession, path, "all")
        flat = audit(rows, csv)
        flat.select(*[F.array_join(f.name, ";").alias(f.name) if f.dataType.typeName() == "array" else F.col(f"`{f.name}`") for f in flat.schema.fields]).write.mode("overwrite").option("header", True).csv(f"{path}.csv")
    return {k: int(v or 0) for k, v in seen.get.items()}


def read_slice(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One slice's rows; the other slices' files aren't read."""
    return spark.read.parquet(path).where(F.col("slice") == name).drop("slice")


def label_counts() -> dict[str, Column]:
    """The conditions of label statistics, for tables with cve_id and cwe_id."""
    cve, cwe = F.col("cve_id").isNotNull(), F.col("cwe_id").isNotNull()
    return {"cve": cve, "cwe": cwe, "any_label": cve | cwe, "both": cve & cwe, "missing_both": ~cve & ~cwe}


def review_slices(statuses: list[str]) -> dict[str, Column]:
    """The review slices of recovered labels that the columns ``statuses``, cwe_candidates and cwe_label_final decide; see the functions of the same names."""
    some = F.greatest(*[F.coalesce(F.col(s).contains("ambiguous"), F.lit(False)) for s in statuses], F.lit(False))
    known = F.filter(F.split(F.coalesce(F.col("cwe_candidates"), F.lit("")), ";"), lambda x: x != "")
    return {
        "missing_both": F.col("cve_id").isNull() & F.col("cwe_id").isNull(),
        "ambiguous": F.col("cve_id").isNull() & some,
        "cwe_conflict": F.col("cwe_id").isNotNull() & (F.size(known) > 0) & ~F.array_contains(known, F.col("cwe_id")),
        "trainable": F.col("cwe_label_final").isNotNull(),
        "gap": F.col("cve_id").isNotNull() & F.col("cwe_label_final").isNull(),
    }


def _at(spark: SparkSession, path: str):
    """A path and its file system, as Spark sees them."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there. What was made from its tables must have been written before."""
    place, files = _at(spark, path)
    files.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, null if there is none."""
    place, files = _at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in its place whole."""
    place, files = _at(spark, path)
    draft, _ = _at(spark, f"{path}.draft")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(place, False)
    files.rename(draft, place)


def work_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, for stage tables: ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``. Only a local session may do without."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder and sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="stages-")
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: a folder that all executors share is needed")
    return f"{folder.rstrip('/')}/stages-{uuid.uuid4()}"
