"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly, equal texts stay together.

A group is all rows with one text. Its vector is (bytes, tokens, rows). Placing groups one by one can't be a distributed step if there
are billions, so what is placed is a bounded number of units: every group above a fraction of a shard is a unit of its own, and the
others are hashed, whole, into ``bundles`` units. A unit goes to the shard where the dot product of its vector and the
residual capacity is highest, among shards whose bytes still have room. A group that is larger than a whole shard can't stay together; it is cut, by a hash of
the ids, into pieces of a sixteenth of a shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secdata.llm.shared import settle

DIMS = ("__b", "__t", "__r")


def place(units: list[tuple[str, int, int, int]], shards: int, room: float = 1.0005) -> dict[str, int]:
    """The shard of every unit (name, bytes, tokens, rows)."""
    if not units:
        return {}
    vector = np.array([u[1:] for u in units], float)
    share = vector / np.maximum(vector.sum(0), 1) * shards  # 1 in each dimension is a shard's fair part
    order = sorted(range(len(units)), key=lambda i: (-share[i].max(), units[i][0]))
    left = np.ones((shards, share.shape[1]))
    out = {}
    for i in order:
        dot = left @ share[i]
        fits = left[:, 0] - share[i, 0] >= 1 - room
        s = int(np.where(fits, dot, -np.inf).argmax()) if fits.any() else int(left[:, 0].argmax())
        left[s] -= share[i]
        out[units[i][0]] = s
    return out


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", bundles: int = 4096, rows_per_run: int = 1024) -> DataFrame:
    """All rows and columns of ``docs`` plus size, shard (0 .. shards - 1) and slot (0, 1 .. within the shard); columns of these names are replaced, others may have any
    names but those of the helpers (``__b __t __r __key __cut __unit __run __rank __start __n``).

    A row's size is its text's UTF-8 bytes plus 1. Rows without text belong to no group. Rows with equal ids are told apart by their text; slots of
    fully equal rows are interchangeable. An empty table gives an empty result.
    """
    docs = docs.drop("size", "shard", "slot")
    text, key, ident = F.col(text_col), F.col("__key"), F.col(id_col)
    with_key = docs.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
            "__key": F.when(text.isNull(), F.xxhash64(ident, F.lit("no text"))).otherwise(F.xxhash64(text)),
        }
    )
    blanks = F.length(text) - F.length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    tokens = F.when(text.isNull() | (text == ""), 0).otherwise(blanks + 1)
    groups = settle(with_key.groupBy(key).agg(F.sum("size").alias("__b"), F.sum(tokens).cast("long").alias("__t"), F.count("*").alias("__r")))
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS]).first()

    def above(part: float) -> F.Column:
        return F.greatest(*[F.col(d) * (shards / max(1, total[d])) for d in DIMS]) > part

    large = groups.where(above(8 / bundles)).withColumn("cut", F.when(above(1.0), F.ceil(F.greatest(*[F.col(d) * (16 * shards / max(1, total[d])) for d in DIMS]))).otherwise(1).cast("int"))
    lone = large.select("__key", "cut").collect()  # at most 3 * shards * bundles / 8 groups
    spark = docs.sparkSession
    cuts = spark.createDataFrame([(r[0], r[1]) for r in lone], "__key long, __cut int")
    unit = F.when(F.col("__cut").isNull(), F.concat(F.lit("b"), F.pmod(key, F.lit(bundles)))).otherwise(F.concat_ws("_", key, F.pmod(F.xxhash64(ident), F.greatest("__cut", F.lit(1)))))
    whole = groups.join(F.broadcast(cuts.where("__cut = 1 OR __cut IS NULL")), "__key", "left").join(F.broadcast(cuts.where("__cut > 1").select("__key")), "__key", "left_anti")
    units = whole.select(F.when(F.col("__cut").isNull(), F.concat(F.lit("b"), F.pmod(key, F.lit(bundles)))).otherwise(F.concat(key, F.lit("_0"))).alias("u"), *DIMS)
    if any(r[1] > 1 for r in lone):
        cut = with_key.join(F.broadcast(cuts.where("__cut > 1")), "__key").join(F.broadcast(large.where("cut > 1").select("__key", *[(F.col(d) / F.col("__r")).alias(d) for d in DIMS])), "__key")
        units = units.unionByName(cut.groupBy(unit.alias("u")).agg(*[F.sum(d).cast("long").alias(d) for d in DIMS]))
    sums = units.groupBy("u").agg(*[F.sum(d).alias(d) for d in DIMS]).collect()  # bundles, and the lone groups' pieces
    where = spark.createDataFrame(list(place([tuple(r) for r in sums], shards).items()), "__unit string, shard int")
    placed = with_key.join(F.broadcast(cuts), "__key", "left").withColumn("__unit", unit).join(F.broadcast(where), "__unit")

    runs = max(1, -(-total["__r"] // (shards * rows_per_run)))
    placed = placed.withColumn("__run", F.pmod(F.xxhash64(ident, F.lit("run")), F.lit(runs)))
    before = Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "__run").agg(F.count("*").alias("__n")).select("shard", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__run").orderBy(id_col, "__key")
    ranked = placed.withColumn("__rank", F.row_number().over(within)).join(starts, ["shard", "__run"])
    return ranked.select(*[F.col(f"`{c}`") for c in docs.columns], "size", "shard", (F.col("__start") + F.col("__rank") - 1).cast("long").alias("slot"))
