"""Joins that stand keys with very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: So many rows one task may get for one key without further ado.
SMALL_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, parts: int = 1000, small: int = SMALL_ROWS) -> list:
    """The keys with more than a ``parts``-th of the rows (so there are fewer than ``parts``); none in a table of at most ``small`` rows. Null is no key."""
    n = rows.count()
    if n <= small:
        return []
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") > n // parts).select(key).collect()]


def join_hot(rows: DataFrame, table: DataFrame, key: str, how: str = "left", parts: int = 1000, salts: int = 256, small: int = SMALL_ROWS) -> DataFrame:
    """``rows`` joined with ``table`` on ``key`` (inner or left), as one join in which no task gets the rows of a hot key, or those without a key, alone.

    Rows of hot keys, and rows whose key is null, are dealt to ``salts`` places by a hash of their columns (rows alike in all columns share a place); the table's rows of
    hot keys, at most those of ``parts`` keys, are repeated for each place. The hash depends on the row alone, so a task that runs again deals alike.
    Results are those of a plain join. Small tables are joined plainly, but for the rows without a key.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    hot = hot_keys(rows, key, parts, small)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    place = F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]), F.lit(salts)).cast("int")
    mine = rows.withColumn("__salt", F.when(F.col(key).isNull() | is_hot, place).otherwise(F.lit(0)))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    theirs = table.withColumn("__salt", F.explode(every)) if hot else table.withColumn("__salt", F.lit(0))
    return mine.join(theirs, [key, "__salt"], how).drop("__salt")
