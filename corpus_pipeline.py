"""A corpus pipeline of five stages over ``documents``; each works on what the one before kept.

``run`` writes each stage's result as Parquet in the shared folder (``spark.checkpoint.dir``) and reads it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.llm import decontaminate, jaccard_join, langid, mixing, sharding
from secdata.llm.shared import shared_folder

#: A document whose best language holds a smaller share of the evidence than this has no clear language.
LEAST_SHARE = 0.45


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those without a clear language. The filters are fitted on the stage's own input.

    Null and empty texts have no letters, so they go. If no row has a language, nothing can be learned and all documents stay. Long texts are judged whole, copies alike; an empty table stays empty;
    extra columns are kept as they are, whatever their names but ``__lang`` and ``__share``.
    """
    model = langid.fit(docs)
    if not model.langs:
        return docs
    judged = langid.predict(docs, model, lang_out="__lang", score_out="__share")
    return judged.where((F.col("__lang") != "und") & (F.col("__share") >= LEAST_SHARE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, Jaccard 0.75 or more).

    Texts without words, and rows without an id, are linked with nothing and stay; rows with one id count as one document, so all of them stay or go. Long texts are compared whole; an empty table
    stays empty; extra columns aren't touched.
    """
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which ten consecutive words of a benchmark item occur.

    Null and empty texts contain none and stay. Long texts are searched whole, repeated rows alike; an empty table stays empty, an empty benchmark drops nothing; extra columns aren't touched.
    """
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Flattens the sources to nine tenths of the largest entropy, or leaves them if they are flatter. No document is repeated: smaller sources are used up whole, and up to a tenth of the mix comes from others instead.

    Rows without text or id have no tokens and go; a null source is one of its own; a very long text that doesn't fit what is left of its source's part goes. Ties in the permutation go by id. An empty table stays
    empty; columns come back as they are, whatever their names, but for those that begin with ``__mix_``.
    """
    mixed = mixing.mix(docs, entropy=0.9, repeats=1.0, budget_part=None, names=("__mix_out_tokens", "__mix_out_epoch", "__mix_out_block"))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents to eight shards: adds size, shard and slot (columns of these names are replaced). Null texts have size 1; equal texts share a shard; an empty table stays empty."""
    return sharding.assign(docs, shards=8)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shard),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/corpus-pipeline-{uuid.uuid4()}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
