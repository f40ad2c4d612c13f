"""A data source for feeds: JSON files, gzipped or plain, whose root object holds one long array of records.

Spark's own readers take such a file as one value. Here each file is a partition that is decompressed and cut as it is read: a task holds one piece of the file and
the record at hand, never the file. Records come out as text, with the file's rank and the position in it, and are parsed by Spark afterwards.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "json_feed"
SCHEMA = "file string, file_rank int, position long, json string"
PIECE = 1 << 18
#: Rows and bytes of a batch at most, one row at least.
BATCH_ROWS, BATCH_BYTES = 2000, 1 << 20

# A string (group 1 if it is closed; else it goes to the end of what is there) or a bracket.
_PART = re.compile(rb'"(?:[^"\\]|\\.)*(?:(")|\\?\Z)|[{}\[\]]', re.S)


def unzipped(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The pieces of a file as they are, or decompressed if it is gzip (also several members in a row). What a broken archive holds up to the break comes out."""
    engine, head = None, b""
    for piece in pieces:
        if head is not None:
            head += piece
            if len(head) < 2:
                continue
            engine, piece, head = zlib.decompressobj(31) if head[:2] == b"\x1f\x8b" else None, head, None
        if engine is None:
            yield piece
            continue
        while piece:
            try:
                made = engine.decompress(piece, PIECE)
            except zlib.error:
                return
            if made:
                yield made
            piece = engine.unconsumed_tail
            if engine.eof:
                piece, engine = engine.unused_data, zlib.decompressobj(31)
    if head:
        yield head


def records(pieces: Iterable[bytes], array: str) -> Iterator[bytes]:
    """The objects in the root object's member ``array``, as their own text. Other values are passed over; nothing comes from a root that isn't an object, nor behind a break.

    Only strings and brackets are looked at: a string is skipped whole, so brackets in it don't count.
    """
    held, done, depth, begin = b"", 0, 0, -1  # begin: where the record at hand starts in ``held``
    name, inside, wanted = b"", False, json.dumps(array).encode()
    for piece in pieces:
        held += piece
        for part in _PART.finditer(held, done):
            text, at = part.group(), part.start()
            if text[0] == 34:
                if not part[1]:  # cut by the end of the piece: looked at again with the next one
                    done = at
                    break
                if depth == 1:
                    name = text
                continue
            if text in b"{[":
                if depth == 0 and text == b"[":
                    return
                depth += 1
                if depth == 2:
                    inside = text == b"[" and name == wanted
                elif depth == 3 and inside and text == b"{":
                    begin = at
            else:
                depth -= 1
                if depth == 2 and begin >= 0:
                    yield held[begin : part.end()]
                    begin = -1
                elif depth == 1:
                    inside = False
                elif depth <= 0:
                    return
        else:
            done = len(held)
        cut = begin if begin >= 0 else done
        held, done, begin = held[cut:], done - cut, 0 if begin >= 0 else -1


class _File(InputPartition):
    def __init__(self, path: str, rank: int):
        self.path, self.rank = path, rank


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.array = options.get("array", "vulnerabilities")
        self.paths = json.loads(options["paths"])

    def partitions(self) -> list[InputPartition]:
        return [_File(p, i) for i, p in enumerate(self.paths)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        files, place = fs.FileSystem.from_uri(partition.path)
        texts: list[str] = []
        position = size = 0

        def batch() -> pa.RecordBatch:
            n = len(texts)
            columns = [pa.array([partition.path] * n), pa.array([partition.rank] * n, pa.int32()), pa.array(range(position - n, position), pa.int64()), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "file_rank", "position", "json"])

        with files.open_input_stream(place, compression=None) as stream:
            for record in records(unzipped(iter(lambda: stream.read(PIECE), b"")), self.array):
                texts.append(record.decode(errors="replace"))
                position, size = position + 1, size + len(record)
                if len(texts) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield batch()
                    texts, size = [], 0
        if texts:
            yield batch()


class JsonFeed(DataSource):
    """Options: paths (JSON list of URIs, in the order that ranks them) and array (the member of the root object)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def feed_files(spark: SparkSession, path: str, glob: str = "*.json*") -> list[str]:
    """The files below ``path`` as Spark finds them, by file name and then whole path, so that yearly feeds come in the order of their years. One name a feed, so the list is short."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path").collect()
    return sorted((r["path"] for r in found), key=lambda p: (p.rsplit("/", 1)[-1], p))


def read_feed(spark: SparkSession, path: str, array: str) -> DataFrame:
    """(file, file_rank, position, json) of the records of all feeds below ``path``."""
    files = feed_files(spark, path)
    if not files:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(JsonFeed)
    return spark.read.format(NAME).option("paths", json.dumps(files)).option("array", array).load()


def ordinal() -> F.Column:
    """Orders the records of several feeds: the later file wins, in a file the later record."""
    return F.struct("file_rank", "position")
