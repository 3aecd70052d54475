"""Link tables in CSV and record feeds in JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import LINKS


def read_links(spark: SparkSession, path: str | list[str], on_missing: str = "error") -> DataFrame:
    """Link tables, a file or a folder of ``*.csv`` at its top level: LINKS, ``source_file`` and ``line_no``.

    RFC 4180 quotes, UTF-8, quoted line ends; empty cells are ``''`` as written, so a missing column is the only null.
    Files of headers alone give no rows. ``on_missing='empty'`` makes an empty table of a path that isn't there.
    line_no counts rows of a file in order from 1.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError("on_missing is 'error' or 'empty'")
    try:
        df = spark.read.schema(LINKS).option("header", True).option("escape", '"').option("multiLine", True).option("encoding", "UTF-8").option("pathGlobFilter", "*.csv").csv(path)
        df = df.select(
            *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in LINKS.names], F.col("_metadata.file_path").alias("source_file"),
            F.monotonically_increasing_id().alias("_at")
        )
    except AnalysisException as e:
        if on_missing == "empty" and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], LINKS).withColumns({"source_file": F.lit(""), "line_no": F.lit(0).cast("bigint")})
        raise
    # a file is read by one task (multiLine), so ids rise by one along it
    start = F.min("_at").over(Window.partitionBy("source_file"))
    return df.withColumn("line_no", F.col("_at") - start + 1).drop("_at")


_DECODER = json.JSONDecoder(strict=False)


def feed_records(text: str | None) -> Iterator[str]:
    """The records of a feed as JSON texts: of one array, of several written one after another, or of values line by line.

    A rest that is no JSON raises ValueError.
    """
    at, body = 0, text or ""
    while True:
        while at < len(body) and body[at] in " \t\r\n\ufeff,":
            at += 1
        if at == len(body):
            return
        value, at = _DECODER.raw_decode(body, at)
        for x in value if isinstance(value, list) else [value]:
            yield json.dumps(x, ensure_ascii=False)


def explode_feeds(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep..., record_no, raw_json, error): every record of feeds held in a column, numbered from 1; a feed that breaks off gives its records up to there and a last row with the error."""
    shape = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + ["record_no int, raw_json string, error string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, body in enumerate(batch.column(len(keep)).to_pylist()):
                numbers, records, errors, n = [], [], [], 0
                try:
                    for n, r in enumerate(feed_records(body), 1):
                        numbers.append(n)
                        records.append(r)
                        errors.append(None)
                except ValueError as e:
                    numbers.append(n + 1)
                    records.append(None)
                    errors.append(str(e)[:200])
                own = pa.array([i] * len(numbers), pa.int64())
                columns = [pa.array(numbers, pa.int32()), pa.array(records, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(own) for k in range(len(keep))], *columns], names=[*keep, "record_no", "raw_json", "error"]
                )

    return df.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, shape)


def read_feeds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, record_no, raw_json, error) of feed files. A feed file is one page's or country's records and is read whole by one task."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    return explode_feeds(files, ["source_file"], "value")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of image files, read where they are used."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")
