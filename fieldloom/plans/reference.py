"""Queries for link tables, work lists, pages and records, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import clean, extract, frontier
from ..schema import ARRAYS, UNCLEANED, read_items
from ..session import table
from ..sources.tables import explode_feeds
from .problem_sql import _NODES, _strip

BASE = "https://www.aerodex.example/list/index"
_MAIL = "CASE WHEN starts_with({0}, 'mailto:') THEN " + _strip("replace({0}, 'mailto:', '')") + " ELSE {0} END"


def _mail(c: str) -> str:
    return _MAIL.replace("{0}", c)


def link_table(spark: SparkSession, d: str) -> DataFrame:
    """The link table with stripped names, the state without its no-break blank, and a usable link."""
    r = table(spark, d, "link_rows")
    return r.where(F.col("airport_link").isNotNull() & (F.col("airport_link") != "")).select(
        "row_id", T.py_strip(F.col("airport_name")).alias("airport_name"), T.py_strip(T.drop_nbsp(F.col("state"))).alias("state"),
        T.blank_to(F.col("icao")).alias("icao")
    )


def frontier_urls(spark: SparkSession, d: str) -> DataFrame:
    return frontier.frontier(table(spark, d, "link_rows"), BASE, "airport_link", ["row_id"])


def frontier_first(spark: SparkSession, d: str) -> DataFrame:
    """The first thousand links in order of file and line."""
    return frontier.first_n(
        frontier.frontier(table(spark, d, "link_rows"), BASE, "airport_link", ["file_name", "line_no", "row_id"]), 1000, "file_name",
        "line_no", "row_id"
    ).select("row_id")


def frontier_unique(spark: SparkSession, d: str) -> DataFrame:
    return frontier.unique(frontier.frontier(table(spark, d, "link_rows"), BASE, "airport_link"))


def allowed_domain(spark: SparkSession, d: str) -> DataFrame:
    return frontier.allowed(table(spark, d, "link_rows"), "airport_link", "aerodex.example").select("row_id")


def resume_left_anti(spark: SparkSession, d: str) -> DataFrame:
    done = read_items(table(spark, d, "airport_items"), "item_id", "raw_json").select(F.col("`Airport Details`.Link").alias("link"))
    return frontier.remaining(table(spark, d, "link_rows"), "airport_link", done, "link").select("row_id", "airport_link")


def resume_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "link_rows")
    return frontier.progress(rows, "airport_link", resume_left_anti(spark, d))


def batch_status(spark: SparkSession, d: str) -> DataFrame:
    return frontier.per_file(table(spark, d, "link_rows"), "file_name", "airport_link")


def file_order(spark: SparkSession, d: str) -> DataFrame:
    """Input files in the order of their names, by bytes, each with its rank and how many there are."""
    out = frontier.ranked(table(spark, d, "link_rows"), "file_name")
    return out.select("file_name", F.col("rank").cast("int").alias("rank"), F.col("n").alias("n_files"))


def union_feed(spark: SparkSession, d: str) -> DataFrame:
    """All harvests in one feed: the link tables and the records' own rows, by name, repeated rows kept."""
    rows = table(spark, d, "link_rows").select("icao", "airport_name", "country")
    return rows.unionByName(
        table(spark, d, "detail_rows").select("icao", "airport_name", "country")
    ).groupBy("icao", "country").agg(F.count(F.lit(1)).alias("n_rows"))


def flag_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "detail_rows").select("detail_id", T.flag(F.col("open_24_hours")).alias("is_open"))


def split_max(spark: SparkSession, d: str) -> DataFrame:
    """City and country out of one heading: at most three parts, the second ``N/A`` where there is none."""
    parts = F.split(F.concat_ws(", ", "city", "country"), ",", 3)
    return table(spark, d, "detail_rows").select(
        "detail_id", T.py_strip(F.get(parts, F.lit(0))).alias("city"),
        F.coalesce(T.py_strip(F.get(parts, F.lit(1))), F.lit("N/A")).alias("country")
    )


def between_markers(spark: SparkSession, d: str) -> DataFrame:
    codes = F.concat(F.lit("ICAO - "), F.coalesce("icao", F.lit("")), F.lit(", IATA - "), F.coalesce("iata", F.lit("")))
    return table(spark, d, "detail_rows").select(
        "detail_id", T.after_marker(codes, "ICAO -", 7, ",").alias("icao"), T.after_marker(codes, "IATA -", 7).alias("iata")
    )


def second_item(spark: SparkSession, d: str) -> DataFrame:
    """The second of a country's other names, null where it has fewer."""
    return table(spark, d, "country_ref").select("country", F.get("also_known", F.lit(1)).alias("second_name"), F.size("also_known").alias("n_names"))


def zip_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Two lists paired by position, the shorter one filled up."""
    r = table(spark, d, "country_ref").select(
        "country", F.posexplode(F.arrays_zip(F.split("country", " ").alias("a"), F.col("also_known").alias("b"))).alias("pos", "p")
    )
    return r.select("country", "pos", F.coalesce("p.a", F.lit("")).alias("word"), T.blank_to(F.col("p.b")).alias("other"))


def strip_unicode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.py_strip(F.col("text")).alias("text"))


def join_nonblank_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.blank_to(T.join_lines(F.split("text", "\n"))).alias("joined"))


def derived_filename(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.coalesce("icao", F.lit("UNKNOWN")), F.lit("_runway_diagram.jpg"))
    link = F.col("airport_link")
    return table(spark, d, "detail_rows").select(
        "detail_id", F.when(link.isNotNull(), name).alias("image_name"),
        F.when(link.isNotNull(), F.concat_ws("/", F.lit("images"), name)).alias("local_path"),
        T.strip_extension(T.base_name(link)).alias("page_name")
    )


def conditional_columns(spark: SparkSession, d: str, images: bool = False) -> DataFrame:
    """Image columns that are null unless images are asked for; the flag folds away."""
    r = table(spark, d, "detail_rows")
    return r.select(
        "detail_id", F.when(F.lit(images), F.col("airport_link")).alias("referer_url"), F.when(~F.lit(images), F.lit("off")).alias("mode")
    )


def map_drop_keys(spark: SparkSession, d: str) -> DataFrame:
    m = F.from_json("props", "map<string,string>")
    kept = F.map_concat(m, F.create_map(F.lit("sameSite"), F.lit("x"), F.lit("type"), F.col("event_type")))
    return table(spark, d, "events").select("event_id", F.explode(frontier.without_keys(kept, "sameSite", "expiry")).alias("k", "v"))


def concat_feed(spark: SparkSession, d: str) -> DataFrame:
    """Feeds of several arrays written one after another, taken apart again."""
    r = table(spark, d, "airport_items").select(
        "item_id", F.concat(F.lit("[\n"), "raw_json", F.lit("\n][\n]["), "raw_json", F.lit(","), "raw_json", F.lit("]")).alias("feed")
    )
    return explode_feeds(r, ["item_id"], "feed").select(
        "item_id", "record_no", F.get_json_object("raw_json", "$['Airport Details'].Country").alias("country")
    )


def _entry_rows(section: str, fields: list[str], kind) -> Column:
    name = next(x for x in ("Name", "CompanyName") if x in fields)
    own = F.coalesce(F.col(f"`{section}`"), F.array().cast(kind))
    return F.transform(own, lambda e: F.struct(F.lit(section).alias("section_name"), e[name].alias("entry_name"), e["Email"].alias("email")))


def items_clean(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned entries of every section that is cleaned: name and e-mail."""
    items = clean.clean(read_items(table(spark, d, "airport_items"), "item_id", "raw_json"))
    sections = [_entry_rows(a, f, items.schema[a].dataType) for a, f in ARRAYS.items() if a != UNCLEANED]
    return items.select("item_id", F.explode(F.concat(*sections)).alias("x")).select("item_id", "x.*")


def contacts(spark: SparkSession, d: str) -> DataFrame:
    """Contact Information as it stands, null elements left out."""
    items = read_items(table(spark, d, "airport_items"), "item_id", "raw_json")
    return clean.entries(items, "item_id", UNCLEANED).where("ContactName is not null").select(
        "item_id", "pos", F.col("ContactName").alias("contact_name"), F.col("Email").alias("email")
    )


def session_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents that show a given mark, as pages of a live session do."""
    status = F.when(F.col("n_chars") > 0, 200).otherwise(404)
    docs = table(spark, d, "documents")
    return docs.where(frontier.fetched(status) & F.coalesce(F.contains("text", F.lit("ICAO")), F.lit(False))).select("doc_id")


def _html(c: str) -> Column:
    out = F.coalesce(F.col(c), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each detail row, with its headings, two tables of keys and values, and a hotel."""
    cell = lambda k, c, w: F.concat(F.lit(f'<div class="table"><div class="bold">{k}</div><div class="{w}">'), _html(c), F.lit("</div></div>"))
    html = F.concat(
        F.lit("<html><body><h1>"), _html("airport_name"), F.lit("</h1><h2>"), _html("city"), F.lit(", "), _html("country"), F.lit("</h2><h3>ICAO - "), _html("icao"), F.lit(", IATA - "), _html("iata"),
        F.lit('</h3><div class="clearfix mb20px mainInfo">'), cell("Customs", "customs", "w45p"), cell("Slots Required", "slots_required", "w38p"), F.lit("</div>"),
        F.lit('<div class="clearboth p3xp bold">Elevation (ft)</div><div class="clearboth p3px">'), _html("elevation_ft"), F.lit("</div>"),
        F.lit('<div class="bluePanelRow clearfix mbGrey noPaddingLR"><div class="fs18px bold">Hotel '), _html("city"), F.lit("</div></div></body></html>"),
    )
    return table(spark, d, "detail_rows").select("detail_id", "airport_link", html.alias("html"))


def page_details(spark: SparkSession, d: str) -> DataFrame:
    """Headings and codes of all pages, by the page pass."""
    x = extract.extract(_pages(spark, d), "detail_id", "airport_link", "html")
    a = F.col("`Airport Details`")
    return x.select(
        "detail_id", a["Name"].alias("name"), a["City"].alias("city"), a["Link"].alias("link"), a["ICAO"].alias("icao"),
        a["IATA"].alias("iata")
    )


def page_sections(spark: SparkSession, d: str) -> DataFrame:
    """Key-value sections and entries of all pages, before and after cleaning: the hotel's shadow among the caterers goes."""
    x = extract.extract(_pages(spark, d), "detail_id", "airport_link", "html")
    y = x.select(
        "detail_id", F.size("`Caterers Information`").alias("caterers_before"), *[c for c in x.columns if c != "detail_id"]
    ).transform(clean.clean)
    m = F.col("`Additional Airport Details`")
    return y.select(
        "detail_id", "caterers_before", F.size("`Caterers Information`").alias("caterers"), F.size("`Hotel Info`").alias("hotels"),
        F.get("`Hotel Info`", F.lit(0))["Email"].alias("hotel_email"), m["Customs"].alias("customs"),
        m["Slots Required"].alias("slots_required")
    )


def page_listing(spark: SparkSession, d: str) -> DataFrame:
    """Link rows harvested from listing pages, one page a row, with the country carried over."""
    html = F.concat(
        F.lit('<div class="result clearfix"><div class="col1 w15p fl p10px">'), _html("icao"), F.lit('</div><div class="col2 w30p fl p10px"><a href="'), F.replace(_html("airport_link"), F.lit('"'), F.lit("&quot;")), F.lit('">'), _html("airport_name"),
        F.lit('</a></div><div class="col3 w15p fl p10px">'), _html("city"), F.lit("<br>"), _html("state"), F.lit("</div></div>"),
    )
    pages = table(spark, d, "link_rows").select(
        "row_id", F.coalesce("country", F.lit("")).alias("country"), F.lit(BASE).alias("url"), html.alias("html")
    )
    x = extract.listing_rows(pages, ["row_id", "country"], "url", "html")
    return x.select(
        "row_id", F.col("country_").alias("country"), F.col("ICAO").alias("icao"), F.col("`Airport Name`").alias("airport_name"),
        F.col("State").alias("state")
    )


QUERIES = {
    f.__name__: f
    for f in (
        link_table, frontier_urls, frontier_first, frontier_unique, allowed_domain, resume_left_anti, resume_counts, batch_status, file_order, union_feed, flag_parse, split_max, between_markers,
        second_item, zip_pairs, strip_unicode, join_nonblank_lines, derived_filename, conditional_columns, map_drop_keys, concat_feed, items_clean, contacts, session_pages, page_details, page_sections, page_listing,
    )
}



def _rooted(c: str, empty: bool = False) -> str:
    """A host's path without dot-dot parts, and without empty ones unless they stay; query and fragment as they are."""
    path = f"regexp_replace(regexp_extract({c}, '^[^?#]*'), '/[^/]+/[.][.]/', '/', 'g')"
    path = path if empty else f"regexp_replace({path}, '/+', '/', 'g')"
    return f"('https://www.aerodex.example' || {path} || regexp_extract({c}, '[?#].*$'))"


_TIDY = "regexp_replace(regexp_replace(airport_link, '[\\t\\r\\n]', '', 'g'), '^[\\x{0}-\\x{20}]+', '')"
URL = f"""{_strip(f'''CASE WHEN starts_with(airport_link, 'http') THEN airport_link
  WHEN lower({_TIDY}) LIKE 'https://%' THEN 'https' || substr({_TIDY}, 6)
  WHEN lower({_TIDY}) LIKE 'http://%' THEN airport_link
  WHEN {_TIDY} = '' THEN '{BASE}'
  WHEN starts_with({_TIDY}, '/') THEN {_rooted(_TIDY, True)}
  WHEN starts_with({_TIDY}, '../') THEN {_rooted(f"substr({_TIDY}, 3)")}
  ELSE {_rooted(f"('/list/' || {_TIDY})")} END''')}"""
_LINKS = f"l AS (SELECT row_id, file_name, line_no, {URL} AS url FROM link_rows WHERE airport_link IS NOT NULL AND airport_link <> '')"
_HOST = "regexp_extract(lower(airport_link), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1)"
_SECTIONS = {
    "FBO Information": "Name", "Handler Inforamtion": "Name", "Handler Information": "Name", "Caterers Information": "Name",
    "Hotel Info": "Name", "Car Rental Info": "CompanyName"
}
_DONE = f"(SELECT DISTINCT {_strip('''(CASE WHEN json_type(raw_json, '$.\"Airport Details\"') = 'VARCHAR' THEN (raw_json ->> '$.\"Airport Details\"') ELSE (raw_json -> '$.\"Airport Details\"') END) ->> '$.Link' ''')} AS k FROM airport_items)"
_LEFT = f"SELECT row_id, airport_link FROM link_rows WHERE coalesce({_strip('airport_link')} NOT IN (SELECT k FROM {_DONE} WHERE k <> ''), true)"

SQL = {
    "link_table": f"""SELECT row_id, {_strip('airport_name')} AS airport_name, {_strip('''replace(state, chr(160), '')''')} AS state,
  coalesce(nullif(icao, ''), 'N/A') AS icao FROM link_rows WHERE airport_link <> ''""",
    "frontier_urls": f"WITH {_LINKS} SELECT row_id, url FROM l",
    "frontier_first": f"WITH {_LINKS} SELECT row_id FROM l ORDER BY file_name, line_no, row_id LIMIT 1000",
    "frontier_unique": f"WITH {_LINKS} SELECT DISTINCT url FROM l",
    "allowed_domain": f"SELECT row_id FROM link_rows WHERE rtrim({_HOST}, '.') = 'aerodex.example' OR rtrim({_HOST}, '.') LIKE '%.aerodex.example'",
    "resume_left_anti": _LEFT,
    "resume_counts": f"""SELECT (SELECT count(*) FROM link_rows)::BIGINT AS n_links, (SELECT count(*) FROM ({_LEFT}))::BIGINT AS n_remaining,
  (SELECT count(DISTINCT nullif({_strip('airport_link')}, '')) FROM link_rows)::BIGINT AS n_distinct""",
    "batch_status": "SELECT file_name, count(*)::BIGINT AS n_rows, (count(*) FILTER (airport_link <> ''))::BIGINT AS n_links FROM link_rows GROUP BY file_name",
    "file_order": """SELECT file_name, (row_number() OVER (ORDER BY file_name))::INT AS rank, (count(*) OVER ())::BIGINT AS n_files
  FROM (SELECT DISTINCT file_name FROM link_rows)""",
    "union_feed": """SELECT icao, country, count(*)::BIGINT AS n_rows FROM (SELECT icao, country FROM link_rows UNION ALL SELECT icao, country
  FROM detail_rows) GROUP BY icao, country""",
    "flag_parse": "SELECT detail_id, lower(open_24_hours) IN ('true', '1', 'yes') AS is_open FROM detail_rows",
    "split_max": f"""WITH t AS (SELECT detail_id, concat_ws(', ', city, country) AS s FROM detail_rows) SELECT detail_id,
  {_strip('''string_split(s, ',')[1]''')} AS city, coalesce({_strip('''string_split(s, ',')[2]''')}, 'N/A') AS country FROM t""",
    "between_markers": f"""SELECT detail_id, {_strip('''split_part(coalesce(icao, '') || ', IATA - ', ',', 1)''')} AS icao,
  {_strip('''coalesce(iata, '')''')} AS iata FROM detail_rows""",
    "second_item": "SELECT country, also_known[2] AS second_name, len(also_known)::INT AS n_names FROM country_ref",
    "zip_pairs": """SELECT country, pos::INT AS pos, coalesce(w[pos + 1], '') AS word, coalesce(nullif(also_known[pos + 1], ''), 'N/A') AS other
  FROM (SELECT country, also_known, string_split(country, ' ') AS w, unnest(range(greatest(len(string_split(country, ' ')),
  len(also_known)))) AS pos FROM country_ref)""",
    "strip_unicode": f"SELECT doc_id, {_strip('text')} AS text FROM documents",
    "join_nonblank_lines": f"""SELECT doc_id, coalesce(nullif(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {_strip('x')}),
  lambda x: x <> ''), ', '), ''), 'N/A') AS joined FROM documents""",
    "derived_filename": """SELECT detail_id, CASE WHEN airport_link IS NOT NULL THEN coalesce(icao, 'UNKNOWN') || '_runway_diagram.jpg' END AS image_name,
  CASE WHEN airport_link IS NOT NULL THEN 'images/' || coalesce(icao, 'UNKNOWN') || '_runway_diagram.jpg' END AS local_path,
  regexp_replace(string_split(airport_link, '/')[-1], '\\.[^.]*$', '') AS page_name FROM detail_rows""",
    "conditional_columns": "SELECT detail_id, NULL::VARCHAR AS referer_url, 'off' AS mode FROM detail_rows",
    "map_drop_keys": """SELECT event_id, e.key AS k, e.value ->> '$' AS v FROM events, json_each(props) e UNION ALL SELECT event_id, 'type', event_type
  FROM events""",
    "concat_feed": "SELECT item_id, unnest([1, 2, 3])::INT AS record_no, raw_json ->> '$.\"Airport Details\".Country' AS country FROM airport_items",
    "items_clean": _NODES
    + f""", e AS (SELECT item_id, v, CASE shape WHEN 'Handler Information[]' THEN 'Handler Inforamtion' WHEN 'Handler Information' THEN 'Handler Inforamtion' ELSE replace(shape, '[]', '') END AS section_name FROM t
  WHERE json_type(v) = 'OBJECT' AND replace(shape, '[]', '') IN ({", ".join(f"'{s}'" for s in _SECTIONS)})),
n AS (SELECT item_id, section_name, CASE WHEN section_name = 'Car Rental Info' THEN v ->> '$.CompanyName' ELSE v ->> '$.Name' END AS entry_name, v ->> '$.Email' AS m FROM e)
SELECT item_id, section_name, entry_name, {_mail("m")} AS email FROM n WHERE entry_name <> 'N/A'""",
    "contacts": _NODES + " SELECT item_id, coalesce(try_cast(regexp_extract(node_path, '/([0-9]+)$', 1) AS INT), 0) AS pos, v ->> '$.ContactName' AS contact_name, v ->> '$.Email' AS email FROM t WHERE json_type(v) = 'OBJECT' AND replace(shape, '[]', '') = 'Contact Information' AND (v ->> '$.ContactName') IS NOT NULL",
    "session_pages": "SELECT doc_id FROM documents WHERE n_chars > 0 AND contains(text, 'ICAO')",
    "page_details": f"""SELECT detail_id, CASE WHEN airport_name <> '' THEN {_strip('airport_name')} END AS name, {_strip('''string_split(coalesce(city, '') || ', ' || coalesce(country, ''), ',')[1]''')} AS city, airport_link AS link,
  {_strip('''split_part(coalesce(icao, '') || ',', ',', 1)''')} AS icao, {_strip('''coalesce(iata, '')''')} AS iata FROM detail_rows""",
    "page_sections": f"""SELECT detail_id, 1 AS caterers_before, 0 AS caterers, 1 AS hotels, NULL::VARCHAR AS hotel_email, CASE WHEN customs <> ''
  THEN {_strip('customs')} END AS customs, CASE WHEN slots_required <> '' THEN {_strip('slots_required')} END AS slots_required
  FROM detail_rows""",
    "page_listing": """SELECT row_id, coalesce(country, '') AS country, nullif(icao, '') AS icao, nullif(airport_name, '') AS airport_name,
  CASE WHEN city <> '' THEN nullif(state, '') END AS state FROM link_rows""",
}
