"""Column-level data quality: footers first, dictionaries next, and a scan of only what those leave open.

A chunk is one column of one row group. It is *settled* if all rows of the row group belong to one load and the chunk's
footer and dictionary give all that is asked. ``profile`` gives tasks row groups, and a task reads just the chunks that it
finds unsettled, so neither files nor chunks are listed on the driver. ``checks`` needs the rows of nearly all chunks of its columns, so Spark
scans the files for them, but for columns that are settled throughout a file. What is read is folded to one state for each
load and value before it is shuffled, so a load or value that holds most rows reaches the reducer as a few states.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITE_SPACE, py_strip
from ..session import materialize
from ..sources.footers import Chunk, chunks, group_of, open_file, row_groups, text_of

#: What a cell of each column may be.
PATTERNS: dict[str, str | tuple[str, ...] | None] = {
    "airport_light_intensity": ("NO LIGHT", "LOW", "MEDIUM", "HIGH", "LOW-HIGH", "PILOT CONTROLLED"),
    "customs": ("Yes", "No", "On Request", "Prior Notice"),
    "icao": "[A-Z]{4}",
}
#: The same for all columns of content; None for free text, where each cell that isn't missing is valid. Elevations end below 30,000 feet.
ALL_PATTERNS: dict[str, str | tuple[str, ...] | None] = PATTERNS | {
    "loaded_at": None,
    "airport_link": r"https?://[^/\s]+/Field-Info/\S+-[a-z0-9]{10}",
    "airport_name": None,
    "city": None,
    "country": None,
    "iata": "[A-Z]{3}",
    "airport_of_entry": ("Yes", "No"),
    "slots_required": ("Yes", "No"),
    "open_24_hours": ("Yes", "No"),
    "facility_use": ("Open to the Public", "Military", "Private"),
    "distance_from_city": "[0-9]+ (?:KM|NM) (?:N|NNE|NE|ENE|E|ESE|SE|SSE|S|SSW|SW|WSW|W|WNW|NW|NNW)",
    "variation": "[0-9]{2}[EW]",
    "elevation_ft": "-?[0-9]{1,4}|[12][0-9]{4}",
}
#: Cells that stand for a missing value, stripped.
MISSING = ("", "N/A")
#: Sets of columns to scan that are read apart from each other; files with further ones are read column by column.
SCANS = 6
#: Classes of cells that aren't a valid value.
IS_MISSING, IS_INVALID = "missing", "invalid"
#: Values that one row of a pass holds at most.
VALUES = 10_000


def is_missing(c: Column) -> Column:
    return c.isNull() | py_strip(c).isin(*MISSING)


def is_valid(column: str, c: Column, patterns: dict) -> Column:
    p = patterns[column]
    if p is None:
        return F.lit(True)
    return c.rlike(rf"\A(?:{p})\z") if isinstance(p, str) else c.isin(*p)


def cell_class(column: str, c: Column, patterns: dict) -> Column:
    """IS_MISSING, IS_INVALID, or ``=`` and the valid value; of free text ``#`` and its hash, since only equal values are to meet."""
    p = patterns[column]
    if p is None:
        return F.when(is_missing(c), IS_MISSING).otherwise(F.concat(F.lit("#"), F.xxhash64(c).cast("string")))
    valid, own = is_valid(column, c, patterns), F.concat(F.lit("="), c)
    if isinstance(p, tuple):  # no listed value is a missing one, and most cells hold one
        return F.when(valid, own).when(is_missing(c), IS_MISSING).otherwise(IS_INVALID)
    return F.when(is_missing(c), IS_MISSING).when(valid, own).otherwise(IS_INVALID)


def _plan(stats: DataFrame, load: str, settled: Column) -> tuple[DataFrame, DataFrame]:
    """stats, written once, with ``load`` (null where a row group mixes loads); and for each file and column whether all its chunks are settled."""
    stats = materialize(stats, "footers")
    loads = stats.where(F.col("column") == load).select(
        "file", "row_group", F.when((F.col("low") == F.col("high")) & (F.col("nulls") == 0), F.col("low")).alias("load")
    )
    known = stats.where(F.col("column") != load).join(loads, ["file", "row_group"])
    known = materialize(known.withColumn("settled", F.col("load").isNotNull() & F.coalesce(settled, F.lit(False))), "chunks")
    return known, known.groupBy("file", "column").agg(F.bool_and("settled").alias("settled"))


def _scans(spark: SparkSession, path: str, plan: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """(columns, table of files that need them): each file is read once for every column it needs, and for no other, since its settled ones count from footers.

    There are at most SCANS and a scan for each column. What comes to the driver is a row per file, as a file listing does.
    """
    need = plan.where("not settled").groupBy("file").agg(F.array_sort(F.collect_list("column")).alias("columns")).collect()
    by: dict[tuple, list[str]] = defaultdict(list)
    for r in need:
        by[tuple(r["columns"])].append(r["file"])
    kept = sorted(by, key=lambda k: -len(by[k]))
    if len(kept) > SCANS:
        rest = {k: by.pop(k) for k in kept[SCANS - 1 :]}
        for k, files in rest.items():
            for c in k:
                by[c,].extend(files)
    schema = spark.read.parquet(path).schema
    return [(list(k), spark.read.schema(schema).parquet(*files)) for k, files in by.items()]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _named(number: str, names: list[str]) -> Column:
    """The column's name for its number: rows bear numbers until they are folded."""
    return F.element_at(F.array(*map(F.lit, names)), F.col(number) + 1).alias("column_name")


class Checks(NamedTuple):
    cells: DataFrame
    shares: DataFrame


def checks(spark: SparkSession, path: str, patterns: dict, load: str, key: str) -> Checks:
    """Cells against their column's pattern. cells: (column_name, load, key) of each that is neither missing nor valid; shares: (column_name, load, class, n).

    A file is scanned for a column unless each of its chunks is of one load and holds just nulls, or one value in every
    row, and no invalid one, whose rows' keys are needed. One scan gives both results: rows fold to states by column, load
    and class, in which each invalid cell has its key; the states are written once, and cells and shares are read from them.
    """
    columns = list(patterns)
    typed = spark.read.parquet(path).schema
    stats = chunks(spark, path, [*columns, load], columns)
    class_of = lambda c: F.coalesce(*[F.when(F.col("column") == x, cell_class(x, c, patterns)) for x in columns])
    null, one = F.col("nulls") == F.col("n_rows"), (F.col("nulls") == 0) & (F.size("candidates") == 1)
    known, plan = _plan(stats, load, null | (one & (class_of(F.get("candidates", F.lit(0))) != IS_INVALID)))
    whole = known.join(plan.where("settled").select("file", "column"), ["file", "column"])
    number = F.array_position(F.array(*map(F.lit, columns)), F.col("column")).cast("int") - 1
    states = [
        whole.select(
            number.alias("c"), F.col("load").cast(typed[load].dataType).alias(load), class_of(F.get("candidates", F.lit(0))).alias("class"),
            F.lit(None).cast(typed[key].dataType).alias(key), F.col("n_rows").alias("n"),
        )
    ]
    for cols, df in _scans(spark, path, plan):
        each = F.array(*[F.struct(F.lit(columns.index(c)).alias("c"), cell_class(c, F.col(c).cast("string"), patterns).alias("class")) for c in cols])
        row = df.select(load, key, F.explode(each).alias("x")).select(
            "x.c", load, "x.class", F.when(F.col("x.class") == IS_INVALID, F.col(key)).alias(key)
        )
        states.append(row.groupBy("c", load, "class", key).agg(F.count(F.lit(1)).alias("n")))
    states = materialize(_union(states), "states")
    bad = states.where(F.col("class") == IS_INVALID)
    each_one = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))
    cells = bad.select(_named("c", columns), load, key, each_one.alias("i")).drop("i")
    folded = states.groupBy("c", load, "class").agg(F.sum("n").alias("n"))
    return Checks(cells, materialize(folded.select(_named("c", columns), load, "class", "n"), "shares"))


def shifts(shares: DataFrame, load: str, by: float) -> DataFrame:
    """(column_name, load) whose share of missing cells, of invalid cells or of any one valid value differs by more than ``by`` from the load before (number less one); a load without that one before it has no shift."""
    totals = shares.groupBy("column_name", load).agg(F.sum("n").alias("total"))
    here = shares.join(totals, ["column_name", load]).select(
        "column_name", F.col(load).cast("bigint").alias("at"), "class", (F.col("n") / F.col("total")).alias("share")
    )
    # a share moves by more than `by` only if it is above it in one of the two loads
    here = here.where(F.round("share", 12) > by)
    both = totals.select("column_name", F.col(load).cast("bigint").alias("at")).join(
        totals.select("column_name", (F.col(load) + 1).cast("bigint").alias("at")), ["column_name", "at"]
    )
    wanted = here.select("column_name", "at", "class").unionByName(here.select("column_name", (F.col("at") + 1).alias("at"), "class")).distinct()
    every = shares.join(totals, ["column_name", load]).select(
        "column_name", F.col(load).cast("bigint").alias("at"), "class", (F.col("n") / F.col("total")).alias("share")
    )
    moved = every.select("column_name", "at", "class", F.col("share").alias("d")).unionByName(every.select(
        "column_name", (F.col("at") + 1).alias("at"), "class", (-F.col("share")).alias("d")
    ))
    moved = moved.join(wanted, ["column_name", "at", "class"], "left_semi").groupBy("column_name", "at", "class").agg(F.sum("d").alias("d")).where(F.round(F.abs("d"), 12) > by)
    return moved.join(both, ["column_name", "at"], "left_semi").select("column_name", F.col("at").alias(load)).distinct()


def _spelled(text: str | None) -> bool:
    return text is None or text.strip(WHITE_SPACE) in MISSING


def _one_load(chunk: Chunk) -> bool:
    return chunk.nulls == 0 and chunk.low is not None and chunk.low == chunk.high


def _by_load(table: pa.Table, load: str) -> Iterator[tuple[str | None, pa.Table]]:
    """A row group's rows apart by load; null loads are one."""
    codes = table.column(load).combine_chunks().dictionary_encode()
    number = codes.indices.fill_null(-1).to_numpy()
    order = np.argsort(number, kind="stable")
    edges = np.flatnonzero(np.diff(number[order])) + 1
    sorted_ = table.take(pa.array(order)) if len(edges) else table
    for a, b in zip([0, *edges], [*edges, len(order)]):
        if b > a:
            k = number[order[a]]
            yield None if k < 0 else text_of(codes.dictionary[int(k)].as_py()), sorted_.slice(a, b - a)


def _read(f: pa.NativeFile, meta: pq.FileMetaData, g: int, columns: list[str]) -> pa.Table:
    """The chunks of some columns of a row group, each column once; no other is touched. A column that the file lacks is null."""
    here = [c for c in dict.fromkeys(columns) if c in meta.schema.to_arrow_schema().names]
    table = pq.ParquetFile(f, metadata=meta).read_row_group(g, columns=here)
    for c in dict.fromkeys(columns):
        if c not in here:
            table = table.append_column(c, pa.nulls(meta.row_group(g).num_rows, pa.string()))
    return table


def _facts(f: pa.NativeFile, meta: pq.FileMetaData, g: int, columns: list[str], texts: list[str]) -> dict[str, Chunk]:
    n = meta.row_group(g).num_rows
    found = group_of(f, meta, g, columns, texts)
    return {c: found.get(c, Chunk(n, n, None, None, None)) for c in columns}


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.types)], names=types.names)


def _pass(groups: DataFrame, each: Callable, shape: str) -> DataFrame:
    """The batches that ``each`` (file, metadata, row group) gives, over all row groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(file) as f:
                    yield from each(f, pq.read_metadata(f), g)

    return groups.mapInArrow(run, shape)


def _settled(x: Chunk, text: bool) -> tuple[bool, bool]:
    """Whether footer and dictionary of a chunk settle counts and range, and distinct values, if its row group is of one load."""
    if x.nulls == x.n_rows:
        return True, True
    listed = text and x.words is not None
    ranged = x.nulls >= 0 and (listed and not any(map(_spelled, x.words)) if text else x.low is not None)
    return ranged, listed


def _ends(values: pa.Array) -> tuple[str | None, str | None]:
    """The least and the greatest value as text; as Spark orders numbers, NaN is the greatest."""
    if pa.types.is_floating(values.type) and (nan := pc.any(pc.is_nan(values)).as_py()):
        values = values.filter(pc.invert(pc.is_nan(values)))
        low = pc.min(values).as_py() if len(values) else float("nan")
        return str(low).replace("nan", "NaN"), "NaN" if nan else None
    ends = pc.min_max(values).as_py() if len(values) else {"min": None, "max": None}
    return tuple(None if x is None else str(x).lower() if isinstance(x, bool) else text_of(x) for x in (ends["min"], ends["max"]))


def profile(spark: SparkSession, path: str, load: str) -> DataFrame:
    """(column_name, load, n_rows, n_missing, n_distinct, low, high) of every flat column but ``load``.

    Missing: null, or without outer blanks ``''`` or ``N/A``. low, high: the extremes of the non-null cells in the column's own
    order, written as text. n_distinct: of the non-null cells, exact up to a collision of 128-bit hashes. Null loads form a load.

    A chunk of one load is settled for counts and range by its footer's exact nulls and extrema; a text chunk needs its
    dictionary too, since a missing value may be spelled out there. It is settled for distinct values by its dictionary.
    Two passes, one for either question, read just the chunks that aren't.
    """
    source = spark.read.parquet(path)
    kinds = {
        f.name: f.dataType.simpleString() for f in source.schema if f.name != load and f.dataType.simpleString().split("<")[0] not in ("array", "map", "struct")
    }
    columns, texts = list(kinds), [c for c, t in kinds.items() if t == "string"]
    load_kind = source.schema[load].dataType.simpleString()
    of_range = pa.schema([
        ("c", pa.int32()), ("load", pa.string()), ("n_rows", pa.int64()), ("n_missing", pa.int64()), ("low", pa.string()),
        ("high", pa.string())
    ])

    def ranges(f: pa.NativeFile, meta: pq.FileMetaData, g: int) -> Iterator[pa.RecordBatch]:
        facts = _facts(f, meta, g, [*columns, load], texts)
        one, rows, todo = _one_load(facts[load]), [], []
        for i, c in enumerate(columns):
            x = facts[c]
            if one and _settled(x, c in texts)[0]:
                low, high = (min(x.words), max(x.words)) if x.words else (x.low, x.high)
                rows.append((i, facts[load].low, x.n_rows, x.nulls, *((None, None) if x.nulls == x.n_rows else (low, high))))
            else:
                todo.append((i, c))
        if todo:
            for at, part in _by_load(_read(f, meta, g, [*[c for _, c in todo], load]), load):
                for i, c in todo:
                    cells = part.column(c).combine_chunks()
                    missing = cells.null_count
                    if c in texts:
                        missing += pc.sum(pc.is_in(pc.utf8_trim(cells.drop_null(), WHITE_SPACE), pa.array(MISSING))).as_py() or 0
                    rows.append((i, at, len(cells), missing, *_ends(cells.drop_null())))
        yield _batch(rows, of_range)

    def values(f: pa.NativeFile, meta: pq.FileMetaData, g: int) -> Iterator[pa.RecordBatch]:
        facts = _facts(f, meta, g, [*columns, load], texts)
        one, todo = _one_load(facts[load]), []

        def blocks(i: int, at: str | None, v: pa.Array) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(v), VALUES):
                part = v.slice(k, VALUES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([at], pa.string()), pa.ListArray.from_arrays([0, len(part)], part)],
                    names=["c", "load", "v"]
                )

        for i, c in enumerate(columns):
            x = facts[c]
            if one and _settled(x, c in texts)[1]:
                yield from blocks(i, facts[load].low, pa.array(x.words if x.words and x.nulls < x.n_rows else [], pa.string()))
            else:
                todo.append((i, c))
        if todo:
            for at, part in _by_load(_read(f, meta, g, [*[c for _, c in todo], load]), load):
                for i, c in todo:
                    yield from blocks(i, at, pc.unique(part.column(c)).drop_null().cast(pa.string()))

    groups = row_groups(spark, path)
    parts = _pass(groups, ranges, "c int, load string, n_rows bigint, n_missing bigint, low string, high string")
    listed = _pass(groups, values, "c int, load string, v array<string>")
    hashed = listed.select("c", F.col("load").cast(load_kind).alias("load"), F.explode("v").alias("v")).select(
        "c", "load", F.xxhash64("v").alias("a"), F.xxhash64(F.lit("second"), "v").alias("b")
    )
    distinct = hashed.distinct().groupBy("c", "load").agg(F.count(F.lit(1)).alias("n_distinct"))

    orders = sorted(set(kinds.values()))
    ends = [F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing")]
    for k, t in enumerate(orders):
        own = F.col("c").isin([i for i, c in enumerate(columns) if kinds[c] == t])
        ends += [fold(F.when(own, F.col(x).cast(t))).cast("string").alias(f"{x}{k}") for x, fold in (("low", F.min), ("high", F.max))]
    folded = parts.withColumn("load", F.col("load").cast(load_kind)).groupBy("c", "load").agg(*ends)
    joined = folded.join(
        distinct.withColumnsRenamed({"c": "_c", "load": "_load"}), (F.col("c") == F.col("_c")) & F.col("load").eqNullSafe(F.col("_load")),
        "left"
    )
    low, high = (F.coalesce(*[F.col(f"{x}{k}") for k in range(len(orders))]).alias(x) for x in ("low", "high"))
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("c") + 1).alias("column_name")
    return joined.select(
        name, F.col("load").alias(load), "n_rows", "n_missing", F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"), low,
        high
    )


def settled_chunks(spark: SparkSession, path: str, load: str) -> DataFrame:
    """(column_name, chunks, settled_range, settled_distinct): how many chunks of each flat column footers and dictionaries settle for ``profile``."""
    source = spark.read.parquet(path)
    texts = [f.name for f in source.schema if f.dataType.simpleString() == "string" and f.name != load]
    columns = [c for c in source.columns if c != load]
    types = pa.schema([("c", pa.string()), ("r", pa.bool_()), ("d", pa.bool_())])

    def each(f: pa.NativeFile, meta: pq.FileMetaData, g: int) -> Iterator[pa.RecordBatch]:
        facts = _facts(f, meta, g, [*columns, load], texts)
        one = _one_load(facts[load])
        yield _batch([(c, *(one and s for s in _settled(x, c in texts))) for c, x in facts.items() if c != load], types)

    found = _pass(row_groups(spark, path), each, "c string, r boolean, d boolean")
    return found.groupBy(F.col("c").alias("column_name")).agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if("r").alias("settled_range"), F.count_if("d").alias("settled_distinct")
    )


def table_profile(spark: SparkSession, path: str) -> DataFrame:
    """(column_name, n_rows, nulls, chunks, with_dictionary) from footers and page headers alone; nulls is null where a footer lacks them."""
    stats = chunks(spark, path)
    known = F.bool_and(F.col("nulls") >= 0)
    return stats.groupBy(F.col("column").alias("column_name")).agg(
        F.sum("n_rows").alias("n_rows"), F.when(known, F.sum("nulls")).alias("nulls"), F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.col("candidates").isNotNull()).alias("with_dictionary")
    )
