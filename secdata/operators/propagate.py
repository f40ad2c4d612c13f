"""Labels shared by rows of one commit, and labels stated in commit messages.

Every function takes and returns samples: sample_id, commit_link, commit_message, cve_id, cwe_id, cve_source, cwe_source (others pass through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secdata.functions import normalize as N
from secdata.operators.joins import join_hot

LABELS = ("cve_id", "cwe_id")


def _source(label: str) -> str:
    return label.replace("_id", "_source")


def majority(rows: DataFrame, key: str, value: Column, mode: str = "majority") -> DataFrame:
    """(key, winner, n_values) for rows with a key and a value.

    The winner is the value with most rows, of equals the one seen first in ``sample_id`` order; in mode ``unambiguous`` only a
    key's sole value wins. Rows are counted per (key, value) before values of a key meet, so a huge commit costs one row per distinct value.
    """
    if mode not in ("majority", "unambiguous"):
        raise ValueError("mode must be 'majority' or 'unambiguous'")
    usable = rows.where((F.coalesce(F.col(key), F.lit("")) != "") & ~N.is_missing(value)).select(F.col(key), N.strip(value).alias("v"), "sample_id")
    counts = usable.groupBy(key, "v").agg(F.count("*").alias("n"), F.min("sample_id").alias("at"))
    best = counts.groupBy(key).agg(F.max_by("v", F.struct("n", -F.col("at"))).alias("winner"), F.count("*").alias("n_values"))
    return best.where("n_values = 1") if mode == "unambiguous" else best


def fill(rows: DataFrame, found: DataFrame, key: str, label: str, source: str) -> DataFrame:
    """Missing labels from ``found`` (key, winner); the source column tells where they come from."""
    joined = join_hot(rows.withColumn("__k", F.col(key)), found.select(F.col(key).alias("__k"), "winner"), "__k")
    take = F.col(label).isNull() & F.col("winner").isNotNull()
    filled = joined.withColumns({_source(label): F.when(take, F.lit(source)).otherwise(F.col(_source(label))), label: F.coalesce(F.col(label), F.col("winner"))})
    return filled.drop("__k", "winner")


def majorities(rows: DataFrame, key: str, mode: str = "majority") -> DataFrame:
    """(key, cve_id, cwe_id): the winners of both labels by the rules of ``majority``, in one aggregation; null where a label has none."""
    if mode not in ("majority", "unambiguous"):
        raise ValueError("mode must be 'majority' or 'unambiguous'")
    values = F.array(*[F.when(~N.is_missing(F.col(x)), F.struct(F.lit(x).alias("label"), N.strip(F.col(x)).alias("v"))) for x in LABELS])
    usable = rows.where(F.coalesce(F.col(key), F.lit("")) != "").select(key, "sample_id", F.explode(values).alias("x")).where("x IS NOT NULL").select(key, "sample_id", "x.*")
    counts = usable.groupBy(key, "label", "v").agg(F.count("*").alias("n"), F.min("sample_id").alias("at"))
    winners = []
    for x in LABELS:
        mine = F.col("label") == x
        best = F.max_by(F.when(mine, F.col("v")), F.when(mine, F.struct("n", -F.col("at"))))
        winners.append((F.when(F.count_if(mine) == 1, best) if mode == "unambiguous" else best).alias(x))
    return counts.groupBy(key).agg(*winners)


def fill_labels(rows: DataFrame, found: DataFrame, key: str, source: str) -> DataFrame:
    """Both missing labels from ``found`` (key, cve_id, cwe_id) in one join. Rows with both labels, and those without a key, match nothing and are spread; so are the rows of a commit with very many."""
    needs = (F.coalesce(F.col(key), F.lit("")) != "") & (F.col("cve_id").isNull() | F.col("cwe_id").isNull())
    known = found.select(F.col(key).alias("__k"), *[F.col(x).alias(f"__{x}") for x in LABELS])
    joined = join_hot(rows.withColumn("__k", F.when(needs, F.col(key))), known, "__k")
    made = {}
    for x in LABELS:
        made[x] = F.coalesce(F.col(x), F.col(f"__{x}"))
        made[_source(x)] = F.when(F.col(x).isNull() & F.col(f"__{x}").isNotNull(), F.lit(source)).otherwise(F.col(_source(x)))
    return joined.withColumns(made).select(*rows.columns)


def same_commit(rows: DataFrame, original: DataFrame | None = None, mode: str = "majority") -> DataFrame:
    """Fills missing labels with the commit's majority; the majority is taken over ``original`` (default: the rows as they come)."""
    base = (rows if original is None else original).withColumn("__link", N.strip(F.col("commit_link")))
    rows = rows.withColumn("__link", N.strip(F.col("commit_link")))
    return fill_labels(rows, majorities(base, "__link", mode), "__link", "same_commit").drop("__link")


def commit_conflicts(rows: DataFrame) -> DataFrame:
    """Number of commits with a label, and of those with several different ones, for each label."""
    keyed = rows.withColumn("__link", N.strip(F.col("commit_link")))
    return _stack([majority(keyed, "__link", F.col(x)).agg(F.count("*").alias("commits"), F.count_if(F.col("n_values") > 1).alias("conflicts")).select(F.lit(x).alias("label"), "*") for x in LABELS])


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def commit_message(rows: DataFrame) -> DataFrame:
    """Fills a missing label that the message states, if it states exactly one."""
    for label, values in (("cve_id", N.message_cves(F.col("commit_message"))), ("cwe_id", N.message_cwes(F.col("commit_message")))):
        take = F.col(label).isNull() & (F.size(values) == 1)
        rows = rows.withColumns({label: F.when(take, N.first(values)).otherwise(F.col(label)), _source(label): F.when(take, F.lit("commit_message_explicit")).otherwise(F.col(_source(label)))})
    return rows


def add_commit_ids(rows: DataFrame) -> DataFrame:
    """commit_sha, alt_shas and commit_key."""
    rows = rows.withColumns({"commit_sha": N.extract_commit_sha(F.col("commit_link")), "alt_shas": N.extract_alt_shas(F.col("commit_message"))})
    return rows.withColumn("commit_key", N.commit_key(F.col("commit_sha"), F.col("commit_link")))


def propagate_same_commit(rows: DataFrame, max_rounds: int = 5, mode: str = "majority") -> DataFrame:
    """Fills missing labels from rows with the same ``commit_key``, using current labels; rows with an empty key take no part.

    One round is the fixpoint: afterwards every keyed row has a label if any row of its key has (in mode ``unambiguous``, if they all agree), and filled rows repeat what
    won. So at most one round runs, whatever ``max_rounds`` allows.
    """
    if max_rounds < 1:
        return rows
    return fill_labels(rows, majorities(rows, "commit_key", mode), "commit_key", "same_commit_propagated")


def with_any_label(rows: DataFrame) -> DataFrame:
    """The rows that have a CVE or a CWE."""
    return rows.where(F.col("cve_id").isNotNull() | F.col("cwe_id").isNotNull())


def label_stats(rows: DataFrame, name: str | None = None) -> DataFrame:
    """One row: counts and percentages of rows with a CVE, a CWE, any, both and neither."""
    cve, cwe = F.col("cve_id").isNotNull(), F.col("cwe_id").isNotNull()
    tests = {"cve": cve, "cwe": cwe, "any_label": cve | cwe, "both": cve & cwe, "missing_both": ~cve & ~cwe}
    out = rows.agg(F.count("*").alias("n_rows"), *[F.count_if(t).alias(k) for k, t in tests.items()])
    out = out.select("n_rows", *tests, *[F.round(F.try_divide(100.0 * F.col(k), F.col("n_rows")), 4).alias(f"{k}_pct") for k in tests])
    return out if name is None else out.select(F.lit(name).alias("stage"), "*")


def stage_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: labels that a stage added, rows it rescued (had none, now has one) and completed (now has both)."""
    b = before.select("sample_id", F.col("cve_id").isNotNull().alias("v0"), F.col("cwe_id").isNotNull().alias("w0"))
    a = after.select("sample_id", F.col("cve_id").isNotNull().alias("v1"), F.col("cwe_id").isNotNull().alias("w1"))
    return b.join(a, "sample_id").agg(
        F.count_if(F.expr("v1 AND NOT v0")).alias("new_cve"),
        F.count_if(F.expr("w1 AND NOT w0")).alias("new_cwe"),
        F.count_if(F.expr("(v1 OR w1) AND NOT (v0 OR w0)")).alias("rescued"),
        F.count_if(F.expr("(v1 AND w1) AND NOT (v0 AND w0)")).alias("new_complete"),
        F.count_if(F.expr("(v0 AND NOT v1) OR (w0 AND NOT w1)")).alias("lost"),
    )


def method_overlap(rows: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows without labels that only method a rescues, only b, both, and either; with what each touched."""
    def flags(df: DataFrame, k: str) -> DataFrame:
        return df.select("sample_id", (F.col("cve_id").isNotNull() | F.col("cwe_id").isNotNull()).alias(k), F.struct("cve_id", "cwe_id").alias(f"{k}_pair"))

    j = flags(rows, "had").join(flags(a, "a"), "sample_id").join(flags(b, "b"), "sample_id")
    ra, rb = F.expr("a AND NOT had"), F.expr("b AND NOT had")
    return j.agg(
        F.count_if(ra & ~rb).alias("rescued_only_a"),
        F.count_if(rb & ~ra).alias("rescued_only_b"),
        F.count_if(ra & rb).alias("rescued_both"),
        F.count_if(ra | rb).alias("rescued_union"),
        F.count_if(~F.col("a_pair").eqNullSafe(F.col("had_pair"))).alias("touched_a"),
        F.count_if(~F.col("b_pair").eqNullSafe(F.col("had_pair"))).alias("touched_b"),
    )


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) of a column; null is a value."""
    counts = rows.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("value", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


def own_cve_to_cwe(rows: DataFrame) -> DataFrame:
    """Fills a missing CWE with the majority CWE of other rows that have the same CVE (ties: the smallest)."""
    have = rows.where("cve_id IS NOT NULL AND cwe_id IS NOT NULL").groupBy("cve_id", "cwe_id").agg(F.count("*").alias("n"))
    best = have.groupBy("cve_id").agg(F.min_by("cwe_id", F.struct(-F.col("n"), "cwe_id")).alias("winner"))
    return fill(rows, best, "cve_id", "cwe_id", "cve_map")


def smallest_mode(rows: DataFrame, key: str, label: str) -> DataFrame:
    """(key, winner): the most frequent value, of equals the smallest."""
    counts = rows.where((F.coalesce(F.col(key), F.lit("")) != "") & F.col(label).isNotNull()).groupBy(key, label).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(label, F.struct(-F.col("n"), label)).alias("winner"))


def quick_recovery(rows: DataFrame) -> DataFrame:
    """Commit majority (ties: smallest value), then the first CVE in the message, then CWEs from the rows' own CVE -> CWE map."""
    rows = rows.withColumn("__link", N.strip(F.col("commit_link")))
    for label in LABELS:
        rows = fill(rows, smallest_mode(rows, "__link", label), "__link", label, "commit")
    values = N.message_cves(F.col("commit_message"))
    take = F.col("cve_id").isNull() & (F.size(values) > 0)
    rows = rows.withColumns({"cve_id": F.when(take, N.first(values)).otherwise(F.col("cve_id")), "cve_source": F.when(take, F.lit("message")).otherwise(F.col("cve_source"))})
    return own_cve_to_cwe(rows.drop("__link"))
