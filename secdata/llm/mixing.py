"""Mixing sources to target weights: temperature mixing, with DataFrame operations only.

A source with the share p of the tokens gets a weight in proportion to p ** a. At a = 1 the mix is the corpus, at 0 all sources weigh the same.
The exponent is the largest in [0, 1] whose weights reach a target entropy, raised as far as the repetition limit asks; both quantities are monotone in it,
so an interval is narrowed: each round weighs the ends of its ``SECTIONS`` parts in one aggregation over the sources.

Weights become rows by budgeted block permutations. A source's part of the budget is a number of whole epochs and a rest. In the epoch with the rest,
the source's rows are dealt by hash into a block for each ``BLOCK_ROWS`` (at most ``MOST_BLOCKS``), the blocks are permuted, and whole blocks are taken as long as the budget lasts; the
block at the border is permuted by rows and taken in part. Only sums per block are ever put in order, so no source's rows meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secdata.llm.shared import settle

SECTIONS, ROUNDS, MOST_BLOCKS, BLOCK_ROWS = 16, 6, 65_536, 256
#: Rows of a plan that are broadcast at most.
BROADCAST_ROWS = 50_000
#: With no budget given, sources may be used up until this part of the mix has to come from others, or further until this part of the tokens is kept.
SHORT, LEAST_PART = 0.1, 0.5


def token_count(text: F.Column) -> F.Column:
    """Words parted by single blanks or line ends; 0 for a null or empty text."""
    blanks = F.length(text) - F.length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    return F.when(text.isNull() | (text == ""), 0).otherwise(blanks + 1).cast("long")


def dealt(*parts: F.Column | str) -> F.Column:
    """A number below 16 ** 12 from the MD5 of the parts: a permutation key that any engine can recompute."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("long")


def exponent(sources: DataFrame, entropy: float, repeats: float, budget: float | None) -> float:
    """The exponent for ``sources`` (tokens): entropy is the target as a part of the largest possible; budget None means as many tokens as ``repeats`` allows."""
    total, n = sources.agg(F.sum("tokens"), F.count("*")).first()
    if not total or n < 2:
        return 1.0
    goal = entropy * math.log(n)

    def met(points: list[float], flat: bool) -> list[bool]:
        """For each exponent: is the entropy reached (flat), or is the repetition limit kept?"""
        grid = sources.select(F.col("tokens"), F.explode(F.array(*map(F.lit, points))).alias("a")).withColumn("m", F.pow(F.col("tokens") / F.lit(total), "a"))
        sums = grid.groupBy("a").agg(F.sum("m").alias("z"), F.sum(F.col("m") * F.ln("m")).alias("e"), F.max(F.col("m") / F.col("tokens")).alias("most"))
        test = F.ln("z") - F.col("e") / F.col("z") >= goal if flat else F.col("most") / F.col("z") * F.lit(budget or 0) <= repeats + 1e-9
        got = {r[0]: r[1] for r in sums.select("a", test).collect()}
        return [got[p] for p in points]

    def largest(flat: bool) -> float:
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            good = met(points, flat)
            at = max((i for i, ok in enumerate(good) if ok), default=0) if flat else min((i for i, ok in enumerate(good) if ok), default=SECTIONS)
            low, high = (points[at], points[min(SECTIONS, at + 1)]) if flat else (points[max(0, at - 1)], points[at])
        return low if flat else high

    return max(largest(True), largest(False)) if budget else largest(True)


def largest_scale(weighed: DataFrame, repeats: float) -> float:
    """What the weights ``m`` (tokens, m) are multiplied by if no budget is given. A source gives its tokens ``repeats`` times at most, so a small one is used up whole and
    the others make up for it. The scale is the largest at which such sources lack ``SHORT`` of the mix, or the smallest that keeps ``LEAST_PART`` of the tokens if that is larger."""
    most = F.col("tokens") * F.lit(repeats)
    total, z, low, high = weighed.agg(F.sum("tokens"), F.sum("m"), F.min(most / F.col("m")), F.max(most / F.col("m"))).first()
    if not total or high <= low * (1 + 1e-12):
        return high or 0.0

    def given(points: list[float]) -> list[float]:
        grid = weighed.select("m", most.alias("most"), F.explode(F.array(*map(F.lit, dict.fromkeys(points)))).alias("scale"))
        got = dict(grid.groupBy("scale").agg(F.sum(F.least("most", F.col("m") * F.col("scale")))).collect())
        return [got[p] for p in points]

    def border(met) -> tuple[float, float]:
        """The neighbours between which ``met`` (scale, tokens), true up to a scale, turns false; the highest twice if it never does."""
        a, b = low, high
        for _ in range(ROUNDS):
            points = [a, *(a * (b / a) ** (i / SECTIONS) for i in range(1, SECTIONS)), b]
            at = max((i for i, g in enumerate(given(points)) if met(points[i], g)), default=0)
            a, b = points[at], points[min(SECTIONS, at + 1)]
            if b <= a:
                break
        return a, b

    enough = LEAST_PART * min(1.0, repeats) * total
    return max(border(lambda scale, g: g >= (1 - SHORT) * scale * z * (1 - 1e-9))[0], border(lambda _, g: g < enough)[1])


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", entropy: float = 0.95, repeats: float = 2.0, budget_part: float | None = 1.0, seed: str = "mix", names: tuple[str, str, str] = ("tokens", "epoch", "block")) -> DataFrame:
    """The mixed rows, all columns of ``docs`` plus tokens, epoch (0, 1 ..) and block; columns of these names are replaced (``names`` gives others). Other columns may have any names
    but those that begin with ``__mix_``.

    budget_part is the budget as a part of all tokens (at most ``repeats``). None: sources smaller than their share are used up, ``repeats`` times, and the budget is
    as large as ``largest_scale`` says, so no small source sets it. Sources whose share the limit doesn't touch get floor(weight * budget) tokens, missed by less than the last row that doesn't fit. Rows without tokens or id are left
    out; a null source is a source of its own. Ties in the permutation go by id. An empty table gives an empty result.
    """
    docs = docs.drop(*names)
    tokens, epoch, block = (F.col(f"__mix_{x}") for x in ("tokens", "epoch", "block"))
    rows = docs.withColumn("__mix_tokens", token_count(F.col(text_col))).where((tokens > 0) & F.col(id_col).isNotNull()).withColumn("__mix_s", F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null")))
    sources = settle(rows.groupBy("__mix_s").agg(F.sum(tokens).alias("tokens"), F.count("*").alias("rows"), F.max(tokens).alias("widest")))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    a = exponent(sources, entropy, repeats, None if budget_part is None else float(total) * budget_part)
    weighed = sources.withColumn("m", F.pow(F.col("tokens") / F.lit(max(1, total)), F.lit(a)))
    z = weighed.agg(F.sum("m")).first()[0]
    budget = total * budget_part if budget_part is not None else largest_scale(weighed, repeats) * (z or 0)
    plan = weighed.select(
        "__mix_s",
        F.least(F.floor(F.col("m") / F.lit(z or 1.0) * F.lit(float(budget)) + F.lit(1e-6)).cast("long"), F.floor(F.col("tokens") * F.lit(repeats)).cast("long")).alias("goal"),
        F.col("tokens").alias("all"),
        F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("int").alias("blocks"),
    ).select("__mix_s", F.expr("goal div all").cast("int").alias("__mix_whole"), F.expr("goal % all").alias("__mix_rest"), F.col("blocks").alias("__mix_blocks"))

    # A join by source would bring a large source's rows to one task. So the plan is broadcast, or, of very many sources, the plan of those with more than a thousandth of the rows.
    n_sources, n_rows, n_blocks = sources.join(plan.select("__mix_s", "__mix_blocks"), "__mix_s").agg(F.count("*"), F.sum("rows"), F.sum("__mix_blocks")).first()
    if n_sources <= BROADCAST_ROWS:
        epochs = rows.join(F.broadcast(plan), "__mix_s")
    else:
        large = F.broadcast(plan.join(sources.where(F.col("rows") > n_rows // 1000).select("__mix_s"), "__mix_s", "left_semi"))
        epochs = rows.join(large, "__mix_s").unionByName(rows.join(large.select("__mix_s"), "__mix_s", "left_anti").join(plan, "__mix_s"))
    whole, rest = F.col("__mix_whole"), F.col("__mix_rest")
    epochs = epochs.withColumn("__mix_epoch", F.explode(F.sequence(F.lit(0), whole)))
    epochs = epochs.where((epoch < whole) | (rest > 0)).withColumn("__mix_block", F.pmod(dealt(F.lit(seed), F.col(id_col), epoch), F.col("__mix_blocks")).cast("int"))
    last = epoch == whole
    by_block = ["__mix_s", "__mix_block"]
    sums = epochs.where(last).groupBy(*by_block).agg(F.sum(tokens).alias("n"), F.first(rest).alias("rest"))
    order = Window.partitionBy("__mix_s").orderBy(dealt(F.lit(seed), F.lit("block"), block), "__mix_block")  # at most MOST_BLOCKS rows a source
    sums = sums.withColumn("end", F.sum("n").over(order)).where("end - n < rest").select(*by_block, (F.col("rest") - F.col("end") + F.col("n")).alias("__mix_room"), F.col("n").alias("__mix_n"))
    taken = epochs.where(last).drop("__mix_rest", "__mix_whole", "__mix_blocks").join(F.broadcast(sums) if (n_blocks or 0) <= BROADCAST_ROWS else sums, by_block)
    inside = Window.partitionBy(*by_block).orderBy(dealt(F.lit(seed), F.lit("row"), F.col(id_col)), id_col).rowsBetween(Window.unboundedPreceding, 0)
    out = [*[F.col(f"`{c}`") for c in docs.columns], *[c.alias(n) for c, n in zip((tokens, epoch, block), names, strict=True)]]
    room = F.col("__mix_room")
    border = taken.where(F.col("__mix_n") > room).withColumn("__mix_end", F.sum(tokens).over(inside)).where(F.col("__mix_end") <= room).select(*out)
    return epochs.where(~last).select(*out).unionByName(taken.where(F.col("__mix_n") <= room).select(*out)).unionByName(border)
