"""What Parquet files tell of their columns without a data page being read: footers, page headers and dictionaries."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import uri

CHUNKS = "file string, row_group int, column string, n_rows bigint, nulls bigint, low string, high string, candidates array<string>"
_CHUNK_TYPES = pa.schema(
    [("file", pa.string()), ("row_group", pa.int32()), ("column", pa.string()), ("n_rows", pa.int64()), ("nulls", pa.int64())]
    + [("low", pa.string()), ("high", pa.string()), ("candidates", pa.list_(pa.string()))]
)
#: Writers cut longer extrema off, so text of this length or more isn't taken as exact.
EXACT_TEXT = 64
#: Dictionaries beyond so many bytes aren't decoded; their chunks count as insufficient and are scanned.
DICTIONARY_BYTES = 4 << 20

_DICTIONARY = {2, 8}  # PLAIN_DICTIONARY, RLE_DICTIONARY
_HEAD = 1 << 12


def _struct(buf: bytes, at: int) -> tuple[dict[int, object], int]:
    """A struct in Thrift's compact protocol as {field: value}; raises IndexError where the buffer ends early."""

    def varint(at: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            b = buf[at]
            n |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return n, at

    def value(kind: int, at: int) -> tuple[object, int]:
        if kind in (1, 2):
            return kind == 1, at
        if kind == 3:
            return buf[at], at + 1
        if kind in (4, 5, 6):
            n, at = varint(at)
            return (n >> 1) ^ -(n & 1), at
        if kind == 7:
            return struct.unpack_from("<d", buf, at)[0], at + 8
        if kind == 8:
            n, at = varint(at)
            if at + n > len(buf):
                raise IndexError
            return buf[at : at + n], at + n
        if kind in (9, 10):
            head = buf[at]
            n, at = (head >> 4, at + 1) if head >> 4 < 15 else varint(at + 1)
            out = []
            for _ in range(n):
                x, at = value(head & 15, at) if head & 15 not in (1, 2) else (buf[at] == 1, at + 1)
                out.append(x)
            return out, at
        if kind == 12:
            return _struct(buf, at)
        raise ValueError(f"type {kind}")

    out: dict[int, object] = {}
    field = 0
    while head := buf[at]:
        at += 1
        if head >> 4:
            field += head >> 4
        else:
            n, at = varint(at)
            field = (n >> 1) ^ -(n & 1)
        out[field], at = value(head & 15, at)
    return out, at + 1


def dictionary_of(f: pa.NativeFile, chunk: pq.ColumnChunkMetaData) -> list[str] | None:
    """All distinct values of a text chunk, from its dictionary page; None where some data page is encoded otherwise."""
    if chunk.dictionary_page_offset is None or chunk.physical_type != "BYTE_ARRAY" or chunk.total_compressed_size < 1:
        return None
    at, end, values = chunk.dictionary_page_offset, chunk.dictionary_page_offset + chunk.total_compressed_size, None
    while at < end:
        f.seek(at)
        buf = f.read(min(_HEAD, end - at))
        try:
            head, used = _struct(buf, 0)
        except IndexError:
            f.seek(at)
            head, used = _struct(f.read(min(_HEAD << 6, end - at)), 0)
        kind, plain, packed = head[1], head[2], head[3]
        if kind == 2:
            if plain > DICTIONARY_BYTES:
                return None
            f.seek(at + used)
            body = f.read(packed)
            if chunk.compression != "UNCOMPRESSED":
                body = pa.Codec(chunk.compression.lower()).decompress(body, plain, asbytes=True)
            values, k = [], 0
            for _ in range(head[7][1]):
                n = int.from_bytes(body[k : k + 4], "little")
                values.append(body[k + 4 : k + 4 + n].decode("utf-8", "replace"))
                k += 4 + n
        elif kind in (0, 3) and head[5 if kind == 0 else 8][2 if kind == 0 else 4] not in _DICTIONARY:
            return None
        at += used + packed
    return values


def open_file(path: str) -> pa.NativeFile:
    """A file by the name that Spark lists it under."""
    where, name = fs.FileSystem.from_uri(uri(unquote(path)))
    return where.open_input_file(name)


class Chunk(NamedTuple):
    """What a footer, and a dictionary if asked for, tell of one column of a row group. nulls is -1 and extrema and words are None where they aren't exact."""

    n_rows: int
    nulls: int
    low: str | None
    high: str | None
    words: list[str] | None


def chunk_of(f: pa.NativeFile, group: pq.RowGroupMetaData, c: int, dictionary: bool) -> Chunk:
    chunk = group.column(c)
    s = chunk.statistics
    nulls = s.null_count if s is not None and s.has_null_count else -1
    low = high = None
    if s is not None and s.has_min_max:
        low, high = map(text_of, (s.min, s.max))
        cut = chunk.physical_type in ("BYTE_ARRAY", "FIXED_LEN_BYTE_ARRAY") and max(len(low.encode()), len(high.encode())) >= EXACT_TEXT
        if cut or chunk.physical_type in ("FLOAT", "DOUBLE"):
            low = high = None
    return Chunk(group.num_rows, nulls, low, high, dictionary_of(f, chunk) if dictionary else None)


def text_of(x: object) -> str:
    """A value as Spark reads it back from text."""
    return x if isinstance(x, str) else x.decode("utf-8", "replace") if isinstance(x, bytes) else x.isoformat(" ") if isinstance(x, datetime) else str(x)


def group_of(f: pa.NativeFile, meta: pq.FileMetaData, g: int, columns: list[str], dictionaries: list[str]) -> dict[str, Chunk]:
    """The chunks of a row group by column; nested columns have none."""
    group = meta.row_group(g)
    names = {group.column(c).path_in_schema: c for c in range(group.num_columns)}
    return {n: chunk_of(f, group, names[n], n in dictionaries) for n in columns if n in names}


def _listed(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.parquet(path).inputFiles()
    return spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)))


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_group) of a Parquet table, spread over the cores. The names of the files come from a scan of no column, not from a list on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with open_file(file) as f:
                    n = pq.read_metadata(f).num_row_groups
                yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(range(n), pa.int32())], names=["file", "row_group"])

    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.mapInArrow(run, "file string, row_group int").repartition(4 * spark.sparkContext.defaultParallelism)


def chunks(spark: SparkSession, path: str, columns: list[str] | None = None, dictionaries: list[str] | None = None) -> DataFrame:
    """CHUNKS of all files of a Parquet table: a row for each row group and flat column. Files are opened by the executors."""
    df = spark.read.parquet(path)
    columns = df.columns if columns is None else columns
    dictionaries = [c for c in columns if df.schema[c].dataType.simpleString() == "string"] if dictionaries is None else dictionaries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                with open_file(file) as f:
                    meta = pq.read_metadata(f)
                    for g in range(meta.num_row_groups):
                        rows += [(file, g, n, *c) for n, c in group_of(f, meta, g, columns, dictionaries).items()]
                names = ["file", "row_group", "column", "n_rows", "nulls", "low", "high", "candidates"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_CHUNK_TYPES)

    return _listed(spark, path).mapInArrow(run, CHUNKS)
