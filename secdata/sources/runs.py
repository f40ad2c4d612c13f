"""Runs of many stages that go on where they broke off: each stage's table stays until what needs it is written."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.sources import sinks


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Changes with the names, sizes or times of the files below the paths. Contents aren't read, and the list stays on Spark: only a sum of hashes comes back."""
    parts = []
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        parts.append(files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first())
    return hashlib.sha256(json.dumps([[p["n"], str(p["h"])] for p in parts]).encode()).hexdigest()


@dataclass(frozen=True)
class Stage:
    """What a stage is called, the stages whose tables it takes, and the function of these tables; counts: conditions whose rows are counted while it is written."""

    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    counts: dict[str, Column] | None = None


class Run:
    """Stage tables in ``folder``, with a manifest: one mark for each stage, written when its table is whole, that names the run's inputs.

    inputs: a fingerprint of what the run reads and of its options; a stage marked with another one is made anew. A broken run, started again with the same folder and inputs, asks
    for the last stage, goes back only to stages with a mark, and reads nothing before them. A table is deleted as soon as all stages that take it are marked.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: str):
        self.spark, self.folder, self.inputs = spark, folder.rstrip("/"), inputs
        self.made: list[str] = []

    def _mark(self, name: str) -> str:
        return f"{self.folder}/marks/{name}.json"

    def marked(self, name: str) -> bool:
        text = sinks.read_text(self.spark, self._mark(name))
        return text is not None and json.loads(text)["inputs"] == self.inputs

    def counters(self, name: str) -> dict[str, int]:
        """What was counted while the stage was written, also by an earlier, broken run; ``rows`` among it."""
        return json.loads(sinks.read_text(self.spark, self._mark(name)))["counts"]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def result(self, stages: list[Stage]) -> DataFrame:
        """The table of the last stage, from what is there and what has to be made. Afterwards it is the only table left."""
        by_name = {s.name: s for s in stages}
        last = stages[-1].name

        def asked(name: str) -> DataFrame:
            if not (self.marked(name) and sinks.exists(self.spark, f"{self.folder}/{name}/_SUCCESS")):
                stage = by_name[name]
                _, counts = sinks.counted_table(stage.make(*[asked(n) for n in stage.needs]), self.folder, name, stage.counts or {})
                sinks.write_text(self.spark, self._mark(name), json.dumps({"stage": name, "inputs": self.inputs, "counts": counts}))
                self.made.append(name)
                for need in stage.needs:
                    if all(self.marked(s.name) for s in stages if need in s.needs):
                        sinks.delete(self.spark, f"{self.folder}/{need}")
            return self.table(name)

        out = asked(last)
        for stage in stages[:-1]:
            sinks.delete(self.spark, f"{self.folder}/{stage.name}")
        return out

    def close(self) -> None:
        """Deletes the folder with all that is left, the result too."""
        sinks.delete(self.spark, self.folder)
