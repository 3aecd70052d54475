"""Where results go: feeds, link tables, an append-only store."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator

import pyarrow.fs as fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import base_name, strip_extension
from ..schema import DETAILS, LINK_COLUMNS
from ..session import materialize, uri

#: Link tables as spreadsheets read them; blanks around a cell are part of it.
_CSV = {"header": True, "escape": '"', "lineSep": "\r\n", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_feed(items: DataFrame, path: str) -> None:
    """Records as JSON lines, replaced as a whole; nulls are kept, so that ``null`` and a missing key stay apart where a schema has both."""
    items.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_array(items: DataFrame, path: str, details: str = "Airport Details") -> int:
    """Records as one JSON array in one file, the form other tools expect; returns their number.

    Null fields of Airport Details are left out, as keys that were absent; other nulls are written. Rows stream through
    the driver partition by partition, so this is for deliveries, not for the corpus.
    """
    where, name = fs.FileSystem.from_uri(uri(path))
    where.create_dir(posixpath.dirname(name))
    n = 0
    with where.open_output_stream(name) as f:
        f.write(b"[")
        for n, row in enumerate(items.toLocalIterator(), 1):
            record = row.asDict(recursive=True)
            if isinstance(record.get(details), dict):
                record[details] = {k: v for k, v in record[details].items() if v is not None or k not in DETAILS}
            f.write((",\n" if n > 1 else "\n").encode() + json.dumps(record, ensure_ascii=False, default=str).encode())
        f.write(b"\n]\n")
    return n


def write_links(links: DataFrame, path: str, group: str = "Country") -> None:
    """Link tables in CSV, a folder for each group, replaced as a whole: header, CRLF, quotes doubled, null as an empty cell."""
    out = links.select(*[F.col(f"`{c}`") for c in LINK_COLUMNS], F.coalesce(F.col(f"`{group}`"), F.lit("")).alias("group"))
    out.write.mode("overwrite").partitionBy("group").options(**_CSV).csv(path)


def write_files(links: DataFrame, path: str, file: str, order: str) -> None:
    """Link tables in CSV, one file for each input file in a folder named after it, rows in the given order. A harvest's file is bounded; many are written side by side."""
    named = links.withColumn("source", strip_extension(base_name(F.col(file)))).repartition("source").sortWithinPartitions("source", order)
    named.select(*[f"`{c}`" for c in LINK_COLUMNS], "source").write.mode("overwrite").partitionBy("source").options(**_CSV).csv(path)


def write_survivors(links: DataFrame, path: str) -> None:
    """What is left of a link table, with its own header, to be read by the next run."""
    links.write.mode("overwrite").options(**_CSV).csv(path)


def append_store(items: DataFrame, path: str) -> None:
    """Appends records to the store; it has no key, so records that come again stand again."""
    items.write.mode("append").parquet(path)


def per_input(items: DataFrame, file: str, path: str) -> None:
    """A folder of JSON for each input file, named after it without its ending."""
    items.withColumn("source", strip_extension(base_name(F.col(file)))).write.mode("overwrite").partitionBy("source").json(path)


def tee(df: DataFrame, *sinks: Callable[[DataFrame], object] | None) -> Iterator[object]:
    """Runs each sink that isn't None on the same rows, computed once if there are several: they are written to the shared folder and read back. Yields what the sinks return."""
    wanted = [sink for sink in sinks if sink is not None]
    df = materialize(df, "tee") if len(wanted) > 1 else df
    for sink in wanted:
        yield sink(df)
