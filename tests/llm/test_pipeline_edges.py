"""Stages of the pipeline on clashing names, without labels, and on empty tables."""

import random


def test_stages_keep_columns_and_bear_missing_labels(spark):
    import corpus_pipeline

    r = random.Random(1)
    words = {"en": ["the", "and", "with", "house"], "de": ["der", "und", "mit", "haus"]}
    rows = [(i, " ".join(r.choices(words[k], k=30)), k, f"s{i % 3}", 0.25 + i, "own") for i, k in enumerate(["en", "de"] * 20)] + [(90, None, "en", "s0", 1.0, "own"), (91, "123", None, None, 2.0, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, lang_pred string")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, None)
    assert kept.columns == docs.columns and {(x.doc_id, x.score, x.lang_pred) for x in kept.collect()} == {(i, s, p) for i, _, _, _, s, p in rows[:40]}
    assert stages["language_id"](spark, docs.drop("lang").selectExpr("*", "cast(null as string) AS lang"), None).count() == 42
    for name in ("language_id", "near_duplicates", "source_mixing", "sharding"):
        assert stages[name](spark, docs.limit(0), None).count() == 0, name
    assert stages["decontamination"](spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0


CLASHES = ["rest", "whole", "blocks", "room", "r", "b", "t", "n", "end", "goal", "rows", "u", "cut", "m", "s"]


def test_mixing_and_sharding_bear_clashing_names(spark):
    from pyspark.sql import functions as F

    from secdata.llm import mixing, sharding

    # One text is far larger than a shard, so that it is cut.
    docs = spark.createDataFrame([(i, ("big " * 50) if i < 40 else f"text number {i} with words", f"s{i % 3}") for i in range(80)], "doc_id long, text string, source string")
    plain_mix = {tuple(x) for x in mixing.mix(docs, entropy=0.9, budget_part=0.7).select("doc_id", "tokens", "epoch", "block").collect()}
    plain_shard = {tuple(x) for x in sharding.assign(docs, 4).select("doc_id", "size", "shard", "slot").collect()}
    more = docs.select("*", *[F.concat(F.lit(f"own {c} "), "doc_id").alias(c) for c in CLASHES])
    mixed = mixing.mix(more, entropy=0.9, budget_part=0.7)
    assert mixed.columns == [*more.columns, "tokens", "epoch", "block"]
    assert {(x.doc_id, x["tokens"], x.epoch, x.block) for x in mixed.collect()} == plain_mix
    assert all(x[c] == f"own {c} {x.doc_id}" for x in mixed.collect() for c in CLASHES)
    dealt = sharding.assign(more, 4)
    assert {(x.doc_id, x["size"], x.shard, x.slot) for x in dealt.collect()} == plain_shard
    assert all(x[c] == f"own {c} {x.doc_id}" for x in dealt.collect() for c in CLASHES)


def test_the_mixing_stage_gives_users_columns_back(spark):
    import corpus_pipeline

    rows = [(i, "some words here " * (1 + i % 4), f"s{i % 3}", f"own {i}", i, 2 * i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens string, epoch int, block long")
    kept = corpus_pipeline.source_mixing(spark, docs, None)
    assert kept.columns == docs.columns
    assert kept.count() > 30 and all((x["tokens"], x.epoch, x.block) == (f"own {x.doc_id}", x.doc_id, 2 * x.doc_id) for x in kept.collect())
