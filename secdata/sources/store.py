"""A store of results by key, for incremental jobs: what was computed once is read back, and only what is missing is computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.sources import sinks

BUCKET = "bucket"


class ResultStore:
    """A Parquet table of one result per key (``schema``: its columns as DDL), parted by the first ``digits`` hex digits of the key (a hash), so that a put rewrites only the partitions that it touches, each as ``files`` files.

    Every row has ``load``, the number of the put that wrote it; of equal keys the one put last stays. A put first writes the merged partitions to the shared work folder, then swaps
    them in by dynamic partition overwrite: a job that breaks before the swap leaves the store as it was. Should the swap itself break, partitions may be missing, and their keys are
    pending again: a store only ever saves work.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "sample_key", digits: int = 2, files: int = 4):
        schema = T.StructType.fromDDL(schema)
        if key not in schema.names or {BUCKET, "load"} & set(schema.names):
            raise ValueError(f"the schema needs {key}; {BUCKET} and load are the store's own")
        self.spark, self.path, self.key, self.digits, self.files = spark, path.rstrip("/"), key, digits, files
        self.columns = schema.names
        self.schema = T.StructType([*schema.fields, T.StructField("load", T.LongType()), T.StructField(BUCKET, T.StringType())])

    def bucket(self) -> Column:
        return F.lower(F.substring(self.key, 1, self.digits))

    def rows(self) -> DataFrame:
        """All results; none if nothing was put yet."""
        if not sinks.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        # Empty Parquet files keep a store readable whose partitions were all swapped out.
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)

    def last_load(self) -> int:
        return self.rows().agg(F.max("load")).first()[0] or 0

    def pending(self, rows: DataFrame) -> DataFrame:
        """One row for each key of ``rows`` that has no result. Rows without a key are left out. Only keys of the partitions that ``rows`` touches are read."""
        asked = rows.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).withColumn(BUCKET, self.bucket())
        known = self.rows().select(BUCKET, self.key)
        return asked.join(known, [BUCKET, self.key], "left_anti").drop(BUCKET).select(*rows.columns)

    def put(self, fresh: DataFrame) -> int:
        """Adds results (the schema's columns); returns the number of the put. Copies of a key in ``fresh`` must agree: one of them stays."""
        load, folder = self.last_load() + 1, sinks.work_folder(self.spark)
        new = fresh.where(F.col(self.key).isNotNull()).select(*self.columns, F.lit(load).cast("long").alias("load"), self.bucket().alias(BUCKET))
        new = sinks.stage_table(new, folder, "fresh")
        touched = new.select(BUCKET).distinct()  # 16 ** digits at most
        merged = self.rows().join(F.broadcast(touched), BUCKET, "left_semi").unionByName(new)
        best = merged.groupBy(BUCKET, F.col(self.key).alias("__key")).agg(F.max_by(F.struct(*[f"`{c}`" for c in self.columns], "load"), "load").alias("__row"))
        # Spark can't overwrite what it reads, so the merged partitions are a table of their own first.
        ready = sinks.stage_table(best.select("__row.*", BUCKET), folder, "merged")
        ready.repartition(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.files))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        sinks.delete(self.spark, folder)
        self.spark.catalog.refreshByPath(self.path)
        return load

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the results of their keys (null where there is none) and ``load``."""
        found = self.rows().drop(BUCKET)
        clash = (set(found.columns) & set(rows.columns)) - {self.key}
        if clash:
            raise ValueError(f"columns of rows and results clash: {sorted(clash)}")
        return rows.join(found, self.key, "left")
