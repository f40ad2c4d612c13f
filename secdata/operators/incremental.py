"""Incremental line labels: only samples whose inputs, graph, gates or logic changed are aligned and labelled again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.functions import normalize as N
from secdata.operators import lines
from secdata.sources import sinks
from secdata.sources.store import ResultStore

#: Part of every key: a change of the labelling logic makes all samples pending.
LOGIC = "1"
LABELS = "sample_key string, status string, confidence string, n_lines long, n_removed long, n_added long, n_cdg long, n_ddg long, n_vul long, vul_lines array<int>, vul_lines_fb array<int>"


def label_store(spark: SparkSession, path: str, digits: int = 2, files: int = 4) -> ResultStore:
    return ResultStore(spark, path, LABELS, digits=digits, files=files)


def contents(samples: DataFrame) -> DataFrame:
    return samples.withColumn("graph_key", N.joern_key(F.col("before"), F.col("after"), F.col("lang")))


def keyed(samples: DataFrame, sizes: DataFrame, ratio: float = lines.MAX_RATIO, least: int = lines.MIN_CHANGED, logic: str = LOGIC) -> DataFrame:
    """Adds graph_key (of before, after and language; graphs are found by it) and sample_key (also of the gates, the graph's size signature and the logic) to samples (before, after, lang).

    sizes (key, n_graph_lines, n_cdg, n_ddg): graphs by graph_key, one row a key.
    """
    s = contents(samples)
    g = sizes.select(F.col("key").alias("graph_key"), *[F.col(c).alias(f"__{c}") for c in ("n_graph_lines", "n_cdg", "n_ddg")])
    j = s.join(g, "graph_key", "left")
    # Of the content its hash: a join that the texts had to pass before the key is known would shuffle them.
    key = N.sample_key(F.col("graph_key"), ratio, least, F.col("__n_graph_lines"), F.col("__n_cdg"), F.col("__n_ddg"), logic)
    return j.withColumn("sample_key", key).select(*samples.columns, "graph_key", "sample_key")


def label_pending(todo: DataFrame, graphs: DataFrame, ratio: float = lines.MAX_RATIO, least: int = lines.MIN_CHANGED, align=lines.align) -> DataFrame:
    """The labels of samples (sample_key, graph_key, before, after, lang), one row a sample_key, as the store takes them. graphs: ``lines.graph_rows`` by graph_key (column key)."""
    rows = align(todo.select("sample_key", "graph_key", "before", "after", "lang"), max_lines=4 * lines.MAX_LINES, compact=True)
    found = lines.sample_labels(rows, graphs, ratio, least, by="graph_key")
    return found.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(LABELS)])


def label_increment(samples: DataFrame, graphs: DataFrame, store: ResultStore, ratio: float = lines.MAX_RATIO, least: int = lines.MIN_CHANGED, logic: str = LOGIC) -> DataFrame:
    """All samples (before, after, lang and others) with sample_key and their labels. Labels of known sample_keys come from the store; the others are computed, once for each key, and put there.

    graphs: line graphs (key, lang, offset, lines, cdg, rd) by graph_key, one row a key. ``load`` tells in which put a sample's labels were computed. Columns named like the labels clash.
    The samples are read for their keys, and once more for their texts if any has no result: a round shuffles the texts once at most, and writes none.
    """
    g = lines.graph_rows(graphs)
    rows = keyed(samples, g, ratio, least, logic)
    folder = sinks.work_folder(samples.sparkSession)
    todo = sinks.stage_table(store.pending(rows.select("graph_key", "sample_key")), folder, "todo")
    if not todo.isEmpty():
        texts = contents(samples).select("graph_key", "before", "after", "lang").join(todo, "graph_key").dropDuplicates(["graph_key", "sample_key"])
        store.put(label_pending(texts, g, ratio, least))
    sinks.delete(samples.sparkSession, folder)
    return store.attach(rows)
