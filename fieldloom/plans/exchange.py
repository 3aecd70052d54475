"""Queries that write through the sinks and read back through the sources, and their SQL.

Each writes to a folder of its own in the shared folder, which goes when the session ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import text as T
from ..operators import clean, frontier
from ..schema import ITEM, LINK_COLUMNS, read_items
from ..session import own_folder, remove_at_end, table
from ..sources import tables
from .problem_sql import _strip
from .reference import BASE, URL

_OWN = ["icao", "airport_name", "city", "state", "country", "airport_link"]


def _links(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "link_rows")
    return r.select(*[F.col(a).alias(b) for a, b in zip(_OWN, LINK_COLUMNS)], "file_name")


def _counted(links: DataFrame) -> DataFrame:
    return links.select(*[F.col(f"`{c}`").alias(a) for a, c in zip(_OWN, LINK_COLUMNS)]).groupBy(*_OWN).agg(F.count(F.lit(1)).alias("n"))


def csv_by_country(spark: SparkSession, d: str) -> DataFrame:
    """Link tables written by country and read back from all folders: each row as often as it was, empty cells for nulls."""
    path = own_folder(spark, "links")
    sinks.write_links(_links(spark, d), path)
    remove_at_end(spark, path)
    return _counted(tables.read_links(spark, f"{path}/group=*"))


def csv_write_back(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a link table after a run, written and read as the next run's input."""
    path = own_folder(spark, "left")
    done = read_items(table(spark, d, "airport_items"), "item_id", "raw_json").select(F.col("`Airport Details`.Link").alias("link"))
    sinks.write_survivors(frontier.remaining(_links(spark, d), "Airport Link", done, "link").select(*[f"`{c}`" for c in LINK_COLUMNS]), path)
    remove_at_end(spark, path)
    return _counted(tables.read_links(spark, path))


def csv_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Link tables of a folder, a file for each harvest, with each row's line and the rank of its file by name."""
    path = own_folder(spark, "harvests")
    named = table(spark, d, "link_rows").select(*[F.col(a).alias(b) for a, b in zip(_OWN, LINK_COLUMNS)], "file_name", "row_id")
    sinks.write_files(named, path, "file_name", "row_id")
    remove_at_end(spark, path)
    read = tables.read_links(spark, f"{path}/source=*").withColumn("file_name", F.url_decode(F.replace(F.regexp_extract("source_file", "source=([^/]+)", 1), F.lit("+"), F.lit("%2B"))))
    ranks = frontier.ranked(read, "file_name")
    return read.join(ranks, "file_name").select("file_name", "line_no", "rank", F.col("`Airport Name`").alias("airport_name"))


def csv_missing(spark: SparkSession, d: str) -> DataFrame:
    """A link table that isn't there, read as an empty one where the caller asks for that."""
    return tables.read_links(spark, own_folder(spark, "none"), "empty").select(F.col("`Airport Link`").alias("airport_link"), "line_no")


def frontier_defaults(spark: SparkSession, d: str) -> DataFrame:
    """A work list by default parameters: the default column, no limit, repeated links kept."""
    urls = frontier.first_n(frontier.frontier(_links(spark, d), BASE), 0, "url")
    return urls.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def image_files(spark: SparkSession, d: str) -> DataFrame:
    """Image files of a folder with their sizes, read where they are used."""
    path = own_folder(spark, "images")
    made = table(spark, d, "feed_files").select("feed_id", F.concat(F.lit("image "), "feed_id").alias("value"))
    made.write.partitionBy("feed_id").text(path)
    remove_at_end(spark, path)
    found = tables.read_images(spark, f"{path}/feed_id=*")
    return found.select(F.regexp_extract("path", "feed_id=([0-9]+)", 1).cast("bigint").alias("feed_id"), "length", F.decode("content", "UTF-8").alias("content"))


def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Records written as a feed of JSON lines and read back by their schema: names, and how many entries come next to them."""
    path = own_folder(spark, "feed")
    sinks.write_feed(read_items(table(spark, d, "airport_items"), "item_id", "raw_json"), path)
    remove_at_end(spark, path)
    r = spark.read.schema(
        f"item_id bigint, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in ITEM.fields if f.name in ('Hotel Info',))}"
    ).json(path)
    return r.select("item_id", F.coalesce(F.size(F.filter("`Hotel Info`", lambda x: x.isNotNull())), F.lit(0)).alias("hotels"))


def json_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Each feed written as one file holding one array, and read whole by one task: its records by their place."""
    path = own_folder(spark, "arrays")
    feeds = table(spark, d, "airport_items").groupBy("feed_id").agg(F.array_sort(F.collect_list(F.struct("item_id", "raw_json"))).alias("r"))
    feeds.select(
        "feed_id", F.concat(F.lit("[\n"), F.array_join(F.transform("r", lambda x: x["raw_json"]), ",\n"), F.lit("\n]\n")).alias("value")
    ).write.partitionBy("feed_id").text(path)
    remove_at_end(spark, path)
    feed = F.regexp_extract("source_file", "feed_id=([0-9]+)", 1).cast("bigint").alias("feed_id")
    return tables.read_feeds(spark, f"{path}/feed_id=*").select(
        feed, "record_no", F.get_json_object("raw_json", "$['Airport Details'].Country").alias("country")
    )


def feed_status(spark: SparkSession, d: str) -> DataFrame:
    """Feeds with their number of records and whether reading them succeeded; every seventh breaks off in its second record."""
    whole = F.concat(F.lit("["), "raw_json", F.lit(","), "raw_json", F.lit("]"))
    feeds = table(spark, d, "airport_items").select(
        "item_id", F.when(F.col("item_id") % 7 == 0, F.concat(F.lit("["), "raw_json", F.lit("][{"))).otherwise(whole).alias("feed")
    )
    return frontier.status(tables.explode_feeds(feeds, ["item_id"], "feed"), "item_id").select("item_id", "n_records", "status")


def store_twice(spark: SparkSession, d: str) -> DataFrame:
    """The store is append-only: records accepted twice stand in it twice. The second sink is switched off."""
    path = own_folder(spark, "store")
    items = table(spark, d, "airport_items").select("item_id", "feed_id")
    for _ in range(2):
        list(sinks.tee(items, lambda x: sinks.append_store(x, path), None))
    remove_at_end(spark, path)
    return spark.read.schema(items.schema).parquet(path).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


def outputs_per_input(spark: SparkSession, d: str) -> DataFrame:
    """A folder of records for each input file, named after it without its ending."""
    path = own_folder(spark, "per")
    sinks.per_input(table(spark, d, "link_rows").select("row_id", "file_name"), "file_name", path)
    remove_at_end(spark, path)
    return spark.read.schema("row_id bigint, source string").json(path).select("row_id", "source")


def session_live(spark: SparkSession, d: str) -> DataFrame:
    """Responses that are to be parsed, and which of them come from a live session."""
    status = F.when(F.col("n_chars") % 3 == 0, 200).when(F.col("n_chars") % 3 == 1, 401).when(F.col("n_chars") % 3 == 2, 404)
    html = F.when(F.col("n_chars") % 2 == 0, F.concat("text", F.lit("<a>Log Out</a>"))).otherwise(F.col("text"))
    pages = table(spark, d, "documents").select("doc_id", status.alias("status"), html.alias("html"))
    return pages.where(frontier.fetched(F.col("status"))).select("doc_id", frontier.logged_in(F.col("status"), F.col("html")).alias("live"))


def mail_links(spark: SparkSession, d: str) -> DataFrame:
    """Addresses without a leading ``mailto:``, and no other one."""
    given = F.when(F.col("detail_id") % 2 == 0, F.concat(F.lit("mailto:"), "icao", F.lit("@mailto:x"))).otherwise(F.concat("icao", F.lit(" mailto:")))
    return table(spark, d, "detail_rows").select("detail_id", T.cut_mailto(given).alias("email"))


def images_on(spark: SparkSession, d: str) -> DataFrame:
    """Image columns with the flag on."""
    from .reference import conditional_columns

    return conditional_columns(spark, d, True)


def chained(spark: SparkSession, d: str) -> DataFrame:
    """Item pipelines in order of their priority, whatever the order they are given in."""
    steps = (
        (300, lambda x: x.withColumn("icao", F.concat("icao", F.lit("3")))),
        (100, lambda x: x.withColumn("icao", F.concat("icao", F.lit("1")))), (200, lambda x: x.where("icao like '%1'"))
    )
    return clean.chain(table(spark, d, "detail_rows").select("detail_id", "icao"), *steps)


QUERIES = {f.__name__: f for f in (
    csv_by_country, csv_write_back, csv_in_order, csv_missing, frontier_defaults, image_files, json_lines, json_arrays, feed_status, store_twice, outputs_per_input, session_live, mail_links,
    images_on, chained
)}

_CELLS = ", ".join(f"coalesce({c}, '') AS {c}" for c in _OWN)
_DONE = f"(SELECT DISTINCT {_strip('''(CASE WHEN json_type(raw_json, '$.\"Airport Details\"') = 'VARCHAR' THEN (raw_json ->> '$.\"Airport Details\"') ELSE (raw_json -> '$.\"Airport Details\"') END) ->> '$.Link' ''')} AS k FROM airport_items)"
_HOTEL = """CASE WHEN json_type(raw_json, '$."Hotel Info"') = 'VARCHAR' THEN (raw_json ->> '$."Hotel Info"')::JSON ELSE raw_json -> '$."Hotel Info"' END"""

SQL = {
    "csv_by_country": f"SELECT {', '.join(_OWN)}, count(*)::BIGINT AS n FROM (SELECT {_CELLS} FROM link_rows) GROUP BY ALL",
    "csv_write_back": f"""SELECT {', '.join(_OWN)}, count(*)::BIGINT AS n FROM (SELECT {_CELLS} FROM link_rows
  WHERE coalesce({_strip('airport_link')} NOT IN (SELECT k FROM {_DONE} WHERE k <> ''), true)) GROUP BY ALL""",
    "csv_in_order": """SELECT regexp_replace(string_split(file_name, '/')[-1], '\\.[^.]*$', '') AS file_name, row_number() OVER (PARTITION BY file_name ORDER BY row_id) AS line_no,
  dense_rank() OVER (ORDER BY file_name) AS rank, coalesce(airport_name, '') AS airport_name FROM link_rows""",
    "csv_missing": "SELECT airport_link, row_id AS line_no FROM link_rows WHERE false",
    "frontier_defaults": f"SELECT url, count(*)::BIGINT AS n FROM (SELECT {URL} AS url FROM link_rows WHERE airport_link <> '') GROUP BY url",
    "image_files": "SELECT feed_id, (length('image ' || feed_id) + 1)::BIGINT AS length, 'image ' || feed_id || chr(10) AS content FROM feed_files",
    "json_lines": f"""SELECT item_id, CASE json_type(h) WHEN 'OBJECT' THEN 1 WHEN 'ARRAY' THEN len(list_filter(h::JSON[],
  lambda x: json_type(x) = 'OBJECT'))::INT ELSE 0 END AS hotels FROM (SELECT item_id, {_HOTEL} AS h FROM airport_items)""",
    "json_arrays": """SELECT feed_id, (row_number() OVER (PARTITION BY feed_id ORDER BY item_id))::INT AS record_no,
  raw_json ->> '$.\"Airport Details\".Country' AS country FROM airport_items""",
    "feed_status": """SELECT item_id, (CASE WHEN item_id % 7 = 0 THEN 1 ELSE 2 END)::BIGINT AS n_records, CASE WHEN item_id % 7 = 0 THEN 'failed'
  ELSE 'ok' END AS status FROM airport_items""",
    "store_twice": "SELECT item_id, 2::BIGINT AS n FROM airport_items",
    "outputs_per_input": "SELECT row_id, regexp_replace(string_split(file_name, '/')[-1], '\\.[^.]*$', '') AS source FROM link_rows",
    "session_live": "SELECT doc_id, n_chars % 3 = 0 AND n_chars % 2 = 0 AS live FROM documents WHERE n_chars % 3 IN (0, 1)",
    "mail_links": """SELECT detail_id, CASE WHEN detail_id % 2 = 0 THEN icao || '@mailto:x' ELSE CASE WHEN starts_with(icao || ' mailto:', 'mailto:')
  THEN substr(icao || ' mailto:', 8) ELSE icao || ' mailto:' END END AS email FROM detail_rows""",
    "images_on": "SELECT detail_id, airport_link AS referer_url, NULL::VARCHAR AS mode FROM detail_rows",
    "chained": "SELECT detail_id, icao || '13' AS icao FROM detail_rows WHERE icao IS NOT NULL",
}
