"""Links of large groups of near copies: all are found, with few comparisons a class."""

from pyspark.sql import functions as F

from secdata.llm import shared

N, REACH = 400, 100


def test_a_chained_group_costs_few_tests_a_class(spark):
    """Classes 1 to N share a signature, and each is similar to its REACH neighbours only, so that the leader reaches a quarter of them; a second such group isn't linked with the first."""
    classes = spark.range(1, 2 * N + 1).select(F.col("id").alias("class"), F.when(F.col("id") > N, F.col("id") + REACH).otherwise(F.col("id")).alias("place"))
    posts = shared.settle(classes.select(F.lit(7).cast("long").alias("sig"), "class", F.lit(True).alias("up"), F.lit(1).cast("long").alias("leader"), F.lit(2 * N).alias("c")))
    known = shared.settle(classes)
    asked = []

    def tests(needed):
        def similar(pairs):
            asked.append(pairs.count())
            return pairs.where(F.abs(F.col("a") - F.col("b")) <= REACH).where((F.col("a") > N) == (F.col("b") > N))

        return similar

    def near(x, y):
        return F.abs(F.col(f"{x}.place") - F.col(f"{y}.place")) <= 2 * REACH

    links = shared.settle(shared.star_links(posts, known, ["place"], near, tests))
    roots = {r.node: r.root for r in shared.connected(links).collect()}
    assert roots == {k: 1 if k <= N else N + 1 for k in range(1, 2 * N + 1)}
    # The groups' ends are near each other without being similar: these pairs alone have to be tested one by one.
    ends = sum(1 for a in range(N - 2 * REACH, N + 1) for b in range(N + 1, N + 2 * REACH + 1) if b + REACH - a <= 2 * REACH)
    assert sum(asked) <= ends + 12 * 2 * N, (asked, ends)


def test_one_python_step_a_stage(spark, monkeypatch):
    """Two Python steps without a shuffle or table between keep two workers a core, whose memory adds up."""
    from secdata.llm import jaccard_join

    plans = []

    def settle(df, *by):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, *by)

    whole = shared.settle
    monkeypatch.setattr(jaccard_join, "settle", settle)
    monkeypatch.setattr(shared, "settle", settle)
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, "y " + text), (4, "other words")], "doc_id long, text string")
    _, links = jaccard_join.link_classes(docs)
    assert links.count() >= 2
    steps = [part.count("MapInArrow") for plan in plans for part in plan.split("Repartition")]
    assert max(steps) == 1, steps
