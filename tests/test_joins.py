"""The join for hot keys: same rows as a plain join, no task with a hot key alone."""

import pytest
from pyspark.sql import functions as F

from secdata.operators import propagate
from secdata.operators.joins import hot_keys, join_hot


def _rows(spark, n=100_000):
    """Half of the rows have one key, a fifth none."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 < 2, None).otherwise(F.concat(F.lit("k"), F.col("id") % 9000))
    return spark.range(n).select(F.col("id").alias("sample_id"), key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [0, 1_000_000])
def test_equals_a_plain_join(spark, how, small):
    rows, table = _rows(spark, 20_000), _rows(spark, 3000).select("k").distinct().where("k IS NOT NULL").withColumn("v", F.md5("k"))
    table = table.unionByName(spark.createDataFrame([("hot", "second row"), (None, "no key")], "k string, v string"))
    got, want = join_hot(rows, table, "k", how, small=small), rows.join(table, "k", how).select("k", "sample_id", "v")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert hot_keys(rows, "k", small=small) == ([] if small else ["hot"])
    assert join_hot(rows.limit(0), table, "k", how, small=small).count() == 0


def test_the_largest_task_has_a_small_share_of_one_commit(spark, monkeypatch):
    rows = _rows(spark).withColumns({"commit_link": F.concat(F.lit("https://x/"), "k"), "cve_id": F.when(F.col("sample_id") % 1000 == 0, "CVE-2020-0001"), "cwe_id": F.lit(None).cast("string")})
    rows = rows.withColumns({"cve_source": F.lit(None).cast("string"), "cwe_source": F.lit(None).cast("string")})
    monkeypatch.setattr(propagate, "join_hot", lambda *a, **k: join_hot(*a, **k, small=0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        out = propagate.same_commit(rows)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        filled = out.where("cve_id IS NOT NULL").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 100_000 and filled == 50_000
    assert max(sizes) < 0.06 * 100_000, max(sizes)  # a plain join puts half of the rows into one task
