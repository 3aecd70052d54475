"""Queries p1 to p5 over the project's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.links import page_code
from ..operators import dedup_index, drift, hotkeys, nested, profile
from ..session import materialize, own_folder, table
from .problem_sql import SQL  # noqa: F401


def _nodes(spark: SparkSession, d: str, values: bool) -> DataFrame:
    return nested.flatten(table(spark, d, "airport_items"), "item_id", "raw_json", values)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.links(_nodes(spark, d, False), "item_id")


def p1_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each flat table, and in how many records they lie; p1_parents counts their parents."""
    nodes = _nodes(spark, d, False).where("error is null")
    return nodes.groupBy("schema_path").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_id").alias("n_records"))


def p1_parents(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each flat table, in how many records they lie, and how many distinct objects they are nested in; the records themselves hang from none."""
    nodes = _nodes(spark, d, False).where("error is null").withColumn("parent", F.when(F.col("dewey") != "", nested.parent_dewey()))
    return nodes.groupBy("schema_path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_id").alias("n_records"),
        F.countDistinct("item_id", "parent").alias("n_parents")
    )


def p1_details(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of Airport Details, with the link to its record. A cell written as a list is null here, as in the SQL; its scalars are rows of p1_values."""
    out = nested.table_at(_nodes(spark, d, True), "item_id", "Airport Details", ["Name", "City", "Country", "Link", "ICAO", "IATA"])
    return out.toDF("item_id", "dewey", "parent_dewey", "name", "city", "country", "link", "icao", "iata")


def p1_entries(spark: SparkSession, d: str) -> DataFrame:
    """The entries of grouped Additional Airport Details, each with the label of its group. A Value written as a list is null here, as in the SQL; its scalars are rows of p1_values."""
    out = nested.table_at(_nodes(spark, d, True), "item_id", "Additional Airport Details[]/Entries[]", ["Key", "Value"])
    return out.toDF("item_id", "dewey", "parent_dewey", "entry_key", "entry_value")


def p1_objects(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all flat tables with all their fields, under whatever names, in whatever form a section has; the record itself has dewey ``''``."""
    return nested.all_objects(_nodes(spark, d, True), "item_id")


def p1_fields(spark: SparkSession, d: str) -> DataFrame:
    """Every scalar field of every object of every table, a row each."""
    return nested.all_fields(_nodes(spark, d, True), "item_id")


def p1_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns of every flat table, with the type that all their values have."""
    return nested.columns_of(_nodes(spark, d, True))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """One of the typed tables that nested.tables makes of every schema path: the groups of Additional Airport Details."""
    made = nested.tables(_nodes(spark, d, True), "item_id")
    return made["Additional Airport Details[]"].select("item_id", "dewey", "parent_dewey", F.col("Group").alias("group_name"))


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """The scalars in lists, which are no object's fields: ``["HMUB"]`` under Airport Details/ICAO is one row of 'Airport Details/ICAO[]'."""
    return nested.list_values(_nodes(spark, d, True), "item_id")


def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fields of files, consecutive files, changes)."""
    items, files = table(spark, d, "airport_items"), table(spark, d, "feed_files")
    held = materialize(drift.held_fields(items, "feed_id", "raw_json"), "held")
    sizes = items.groupBy(F.col("feed_id").alias("feed")).agg(F.count(F.lit(1)).alias("records"))
    fields = materialize(drift.existing(held, sizes), "fields")
    pairs = drift.consecutive(files, "feed_id", "series", "load_no")
    return fields, pairs, drift.changes(held, fields, pairs)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _drift(spark, d)[2].toDF("feed_id", "section_name", "change_kind", "old_name", "new_name")


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    """All records in one consistent table, a row each and a typed column for every field of both sections, under the name it bore first in its series."""
    fields, pairs, changed = _drift(spark, d)
    names = materialize(drift.canonical_names(changed, pairs, table(spark, d, "feed_files"), "feed_id", "series", "load_no"), "names")
    return drift.unified(table(spark, d, "airport_items"), "item_id", "feed_id", "raw_json", names, drift.targets(fields, names))


#: The feeds of airport_items arrive in so many runs of consecutive numbers, each accepted as one batch.
FEED_RUNS = 20


def _arrivals(spark: SparkSession, d: str) -> DataFrame:
    """(table_name, id, batch, code) of both tables; a run of feeds arrives along with the batch of link_rows of the same number. Rows without batch or feed arrive last."""
    rows, items = table(spark, d, "link_rows"), table(spark, d, "airport_items")
    listed = rows.select(
        F.lit("link_rows").alias("table_name"), F.col("row_id").alias("id"), F.col("batch_no").cast("bigint").alias("batch"),
        page_code(F.col("airport_link")).alias("code")
    )
    low, high = items.agg(F.min("feed_id"), F.max("feed_id")).first()
    run = F.expr(f"(feed_id - {low or 0}) * {FEED_RUNS} div {(high or 0) - (low or 0) + 1} + 1")
    recorded = drift.record_pages(items, "item_id", "raw_json", "feed_id").select(
        F.lit("airport_items").alias("table_name"), F.col("item_id").alias("id"), run.alias("batch"), F.col("page").alias("code")
    )
    return listed.unionByName(recorded)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every batch in turn against the shards of all before it."""
    return dedup_index.duplicates(_arrivals(spark, d), "table_name")


def p3_index(spark: SparkSession, d: str) -> DataFrame:
    """The graphs of the index once all batches are in: sizes, beams, and what the unwidened beams found of the neighbours that exhaustive search finds."""
    history = dedup_index.History(spark, own_folder(spark, "history"))
    dedup_index.duplicates(_arrivals(spark, d), "table_name", history)
    per = history.graphs().groupBy(F.col("space").alias("table_name"), "ring", "shard")
    return per.agg(
        F.count(F.lit(1)).alias("graphs"), F.sum("nodes").alias("nodes"), F.max("beam").alias("widest_beam"),
        F.sum("sampled").alias("sampled"), F.sum("near").alias("near"), F.sum("found").alias("found")
    )


def _shares(spark: SparkSession, d: str) -> DataFrame:
    return hotkeys.shares(table(spark, d, "link_rows"), "batch_no", "country", table(spark, d, "country_ref"), "country", "also_known")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return hotkeys.heavy(_shares(spark, d), 0.05).select("batch_no", F.col("name").alias("country"))


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every country in every batch, with the batch's total; unknown and missing cells under a null country."""
    return _shares(spark, d).select("batch_no", F.col("name").alias("country"), F.col("n").alias("n_rows"), F.col("total").alias("batch_rows"))


def p4_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per country over all batches: rows, first and last harvest, links missing; algebraic states only."""
    link = F.col("airport_link")
    states = hotkeys.count_states(
        table(spark, d, "link_rows"), [], "country", first_at=F.min("harvested_at"), last_at=F.max("harvested_at"), no_link=F.count_if(link.isNull() | (F.trim(link) == ""))
    )
    named = hotkeys.resolve(states, hotkeys.spellings(table(spark, d, "country_ref"), "country", "also_known"))
    return named.groupBy(F.col("name").alias("country")).agg(
        F.sum("n").alias("n_rows"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        F.sum("no_link").alias("no_link")
    )


def _p5_cases(spark: SparkSession, d: str, patterns: dict) -> DataFrame:
    checked = profile.checks(spark, f"{d}/detail_rows.parquet", patterns, "load_no", "detail_id")
    cells = checked.cells.select(F.lit("cell").alias("case_kind"), "column_name", F.col("load_no").cast("int").alias("load_no"), "detail_id")
    shifts = profile.shifts(checked.shares, "load_no", 0.15).select(
        F.lit("shift").alias("case_kind"), "column_name", F.col("load_no").cast("int").alias("load_no"),
        F.lit(0).cast("bigint").alias("detail_id")
    )
    return cells.unionByName(shifts)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _p5_cases(spark, d, profile.PATTERNS)


def p5_cases(spark: SparkSession, d: str) -> DataFrame:
    """What p5_found gives for three columns, for every column but the row's id and the load."""
    return _p5_cases(spark, d, profile.ALL_PATTERNS)


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every column by load: rows, missing cells, distinct values, and the range in the column's own order."""
    return profile.profile(spark, f"{d}/detail_rows.parquet", "load_no")


def p5_settled(spark: SparkSession, d: str) -> DataFrame:
    """How many chunks of each column p5_profile takes from footers and dictionaries."""
    return profile.settled_chunks(spark, f"{d}/detail_rows.parquet", "load_no")


def p5_footers(spark: SparkSession, d: str) -> DataFrame:
    """What the files' footers and dictionaries tell of each column without reading a data page."""
    return profile.table_profile(spark, f"{d}/detail_rows.parquet")


QUERIES = {f.__name__: f for f in (
    p1_found, p1_tables, p1_parents, p1_details, p1_entries, p1_objects, p1_fields, p1_columns, p1_groups, p1_values, p2_found, p2_unified,
    p3_found, p3_index, p4_found, p4_counts, p4_summary, p5_found, p5_cases, p5_profile, p5_settled, p5_footers
)}
