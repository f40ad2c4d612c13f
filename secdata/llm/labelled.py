"""Bounded samples of labelled rows, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label_col: str, per_label: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of about ``per_label`` rows for each of the labels 0 and 1, chosen by a hash of the id; all if there are fewer.

    Other and null labels are skipped. Only the sampled ids are broadcast; their number is bounded by ``per_label``, so the texts aren't shuffled.
    """
    rows = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    limit = F.when(F.col("label") == 1, min(1.0, per_label / sizes.get(1, 1))).otherwise(min(1.0, per_label / sizes.get(0, 1)))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < limit * (1 << 30))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(chosen), "id")
