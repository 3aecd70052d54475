"""The work list: which links are still to be fetched, in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.links import absolutize, host_in
from ..functions.text import py_strip
from ..session import materialize

#: Fixed value: the default column.
LINK = "Airport Link"


def frontier(df: DataFrame, base: str, column: str = LINK, keep: list[str] | None = None) -> DataFrame:
    """(keep..., url): links of one column that are neither null nor empty (blanks stay), absolute, then stripped. A missing column gives no rows."""
    keep = keep or []
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], "url string") if not keep else df.select(*keep, F.lit(None).cast("string").alias("url")).limit(0)
    c = F.col(f"`{column}`")
    return df.where(c.isNotNull() & (c != "")).select(*keep, py_strip(absolutize(F.lit(base), c)).alias("url"))


def first_n(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order; all for None or 0. A negative number is an error: "all but the last" needs the whole table."""
    if n is not None and n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(*order).limit(n) if n else df


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Without repeated requests: one row for each value of the columns."""
    return df.dropDuplicates(list(columns or ["url"]))


def allowed(df: DataFrame, column: str, *domains: str) -> DataFrame:
    """Rows whose link's host is one of the domains or below it."""
    test = F.lit(False)
    for d in domains:
        test = test | host_in(F.col(column), d)
    return df.where(test)


def fetched(status: Column, codes: tuple[int, ...] = (200, 401)) -> Column:
    """Whether a response is one to be parsed."""
    return F.coalesce(status.isin(*codes), F.lit(False))


def logged_in(status: Column, html: Column) -> Column:
    return F.coalesce((status == 200) & F.contains(html, F.lit("Log Out")), F.lit(False))


def remaining(links: DataFrame, column: str, done: DataFrame, done_column: str) -> DataFrame:
    """``links`` whose stripped link isn't among the finished ones, every column and repeated row kept; null links stay.

    Finished links are stripped, empty and null ones dropped, made distinct and written once before the join. So their
    size is known when the join is planned: Spark broadcasts them below its own threshold and shuffles both sides beyond.
    """
    seen = materialize(done.select(py_strip(F.col(done_column)).alias("_seen")).where("_seen <> ''").distinct(), "seen")
    return links.join(seen, py_strip(F.col(f"`{column}`")) == F.col("_seen"), "left_anti")


def without_keys(m: Column, *names: str) -> Column:
    """A map without some keys, as sessions drop what another client can't take."""
    return F.map_filter(m, lambda k, _: ~k.isin(*names))


def progress(links: DataFrame, column: str, left: DataFrame) -> DataFrame:
    """One row: rows in all, rows remaining, distinct stripped links that aren't empty."""
    link = py_strip(F.col(column))
    both = links.select(
        F.lit(1).alias("a"), F.lit(0).alias("r"), F.when(link != "", link).alias("link")
    ).unionAll(left.select(F.lit(0), F.lit(1), F.lit(None).cast("string")))
    return both.agg(F.sum("a").alias("n_links"), F.sum("r").alias("n_remaining"), F.countDistinct("link").alias("n_distinct"))


def ranked(df: DataFrame, column: str) -> DataFrame:
    """(column, rank, n): the distinct values in order, numbered from 1, and how many there are; a null one comes first.

    They are sorted by range, numbered within each range, and shifted by the sizes of the ranges before: the only window
    without a key runs over one row per range. The ranges are written once, since cutting them again might cut elsewhere.
    """
    cut = df.select(column).distinct().repartitionByRange(column).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, "ranges")
    sizes = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("n")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return cut.withColumn("_at", inside).join(F.broadcast(before), "_range").select(column, (F.col("_before") + F.col("_at")).alias("rank"), "n")


def per_file(df: DataFrame, file: str, column: str) -> DataFrame:
    """(file, n_rows, n_links): rows and usable links of each input file."""
    c = F.col(column)
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNotNull() & (c != "")).alias("n_links"))


def status(records: DataFrame, file: str) -> DataFrame:
    """(file, n_records, status, error) of exploded feeds: how many records each input gave, ``ok`` or ``failed``, and why."""
    bad = F.col("error").isNotNull()
    per = records.groupBy(file).agg(F.count_if(~bad).alias("n_records"), F.max("error").alias("error"))
    return per.select(file, "n_records", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "error")
