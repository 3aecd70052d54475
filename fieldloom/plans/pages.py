"""Queries for the sections of captured pages, and their SQL.

There is no table of pages, so a page is written for each row of detail_rows, with every section, and the page pass reads
it back. Their SQL says what the reading rules make of the row's cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, extract
from ..session import table
from .problem_sql import _strip

#: The address that relative links of listing and index pages are resolved against.
BASE = "https://www.aerodex.example/list/index"


def html_of(c: str) -> Column:
    """A cell as markup; null is nothing."""
    out = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _markup(template: str) -> Column:
    """A template with ``{column}`` for a cell's markup."""
    parts = template.replace("}", "{").split("{")
    return F.concat(*[html_of(p) if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])


_PAGE = """<html><body><h1>{airport_name}</h1><h2>{city}, {country}</h2><h3>ICAO - {icao}, IATA - {iata}</h3>
<div class="clearfix mb20px mainInfo"><div class="table"><div class="bold">Customs</div><div class="w45p">{customs}</div></div>
<div class="table"><div class="bold">Slots</div><div class="w38p">{slots_required}</div></div>
<div class="table"><div class="bold">Slots</div><div class="w45p">{open_24_hours}</div></div></div>
<div class="clearboth p3xp bold">Elevation (ft)</div><div class="clearboth p3px">{elevation_ft}</div>
<div class="clearboth p3xp bold">Variation&nbsp;</div><div class="clearboth p3px">{variation}</div><div class="clearboth p3xp bold">Alone</div>
<div class="results-content"><div class="clearfix result"><div class="w31p fl bold">{airport_name}</div><div class="w17p fl p3px"><div>{variation}</div></div>
<div class="w30p fl p3px"><div class="clearfix">Phone</div><div>{elevation_ft}</div><div class="clearfix">Fax</div><div>{distance_from_city}</div></div>
<div class="w22p fl p3px"><div><a href="mailto:{icao}@x.example">m</a></div><a href="{airport_link}">w</a></div></div>
<div class="clearfix result"><div class="w31p fl bold">DESK</div></div></div>
<div class="fbo"><div class="vendor"><div class="vendorName"><a><strong>{airport_name}</strong></a></div><div class="w35p bold">Address</div><div>{city}<br>{country}</div>
<div class="w35p bold">Phone</div><div>{elevation_ft}</div><div class="w35p bold">Tel After Hours</div><div>{variation}</div>
<div class="w35p bold">Email</div><div><a href="{icao}@x.example">m</a></div><div class="w35p bold">Website</div><div><a href="{airport_link}">w</a></div>
<div class="w30p fl"><strong>AFTN</strong><div>{iata}</div></div><div class="w30p fl"><strong>SITA</strong><div>{icao}</div></div></div>
<div class="vendor"><div class="vendorName"><a><strong>SECOND</strong></a></div></div></div>
<div class="bluePanelContent"><div class="vendor"><div class="vendorName"><a><strong>{city}</strong></a></div><div class="w35p bold">Address</div><div>{country}</div>
<div class="w35p bold">Phone</div><div>{variation}</div><div class="w35p bold">Fax</div><div>{elevation_ft}</div>
<div class="w35p bold">Email</div><div><a href="mailto:h@{iata}">m</a></div><div class="w35p bold">Website</div><div><a href="{airport_link}">w</a></div></div></div>
<div class="bluePanelContent"><input type="hidden" value="{detail_id}"><div class="w30p fs18px bold">{facility_use}</div><div class="w35p"><div class="fl w65p">{variation}</div></div>
<div class="w35p"><a href="{airport_link}">w</a></div><div class="fl w35p"><div class="fl w65p">x</div><div><a href="mailto:r@{iata}">m</a></div></div></div>
<div class="bluePanelRow clearfix mbGrey"><div class="clearboth"><a><strong class="fs18px">{country}</strong></a></div>
<div class="fl w35p bold">Phone</div><div>{elevation_ft}</div><div class="fl w35p bold">Fax</div><div>{variation}</div>
<div class="fl w35p bold">Email <a href="mailto:c@{iata}">e</a></div><div>x</div><div class="fl w35p bold">Website</div><div><a href="{airport_link}">w</a></div>
<div class="fl w35p bold">SITA</div><div>{iata}</div></div>
<div class="bluePanelRow clearfix mbGrey noPaddingLR"><div class="fs18px bold">Hotel {city}</div><div>Phone</div><div>{elevation_ft}</div><div>Fax</div><div>{variation}</div>
<div>Website</div><div><a href="{airport_link}">w</a></div><div class="w25p"><div class="fl w100p">{city}<br> <br>{country}</div></div>
<div class="w20p"><div class="fl w100p">{distance_from_city}</div><div class="fl w100p">{variation}</div></div></div>"""
_IMAGE = '<div id="dnn_ctr422_VDC_ctl00_divRunwayDiagram"><p>x<img src="/r/{detail_id}.jpg"></div>'


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each detail row, with all sections; a diagram where the row has an ICAO code."""
    image = F.when(F.col("icao").isNotNull(), _markup(_IMAGE)).otherwise("")
    return table(spark, d, "detail_rows").select("detail_id", "airport_link", F.concat(_markup(_PAGE), image, F.lit("</body></html>")).alias("html"))


def _section(spark: SparkSession, d: str, section: str) -> DataFrame:
    x = extract.extract(_pages(spark, d), "detail_id", "airport_link", "html", sections=[section])
    rows = clean.entries(x, "detail_id", section)
    return rows.toDF(*[{
        "ContactName": "contact_name", "PriceRange": "price_range", "SupplierId": "supplier_id", "CompanyName": "company_name"
    }.get(c, c.lower()) for c in rows.columns])


def page_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Contact Information of all pages, an entry a row."""
    return _section(spark, d, "Contact Information")


def page_fbos(spark: SparkSession, d: str) -> DataFrame:
    """FBO Information of all pages, an entry a row."""
    return _section(spark, d, "FBO Information")


def page_handlers(spark: SparkSession, d: str) -> DataFrame:
    """Handler Inforamtion of all pages, an entry a row."""
    return _section(spark, d, "Handler Inforamtion")


def page_caterers(spark: SparkSession, d: str) -> DataFrame:
    """Caterers Information of all pages before cleaning: each hotel has a shadow among them."""
    return _section(spark, d, "Caterers Information")


def page_hotels(spark: SparkSession, d: str) -> DataFrame:
    """Hotel Info of all pages, an entry a row."""
    return _section(spark, d, "Hotel Info")


def page_rentals(spark: SparkSession, d: str) -> DataFrame:
    """Car Rental Info of all pages: panels with a name or a phone."""
    return _section(spark, d, "Car Rental Info")


def page_maps(spark: SparkSession, d: str) -> DataFrame:
    """The two sections of keys and values: the last value of a key that comes twice, and lists paired by position."""
    x = extract.extract(_pages(spark, d), "detail_id", "airport_link", "html", sections=["Additional Airport Details", "Airport Information"])
    a, i = F.col("`Additional Airport Details`"), F.col("`Airport Information`")
    return x.select(
        "detail_id", a["Customs"].alias("customs"), a["Slots"].alias("slots"), i["Elevation (ft)"].alias("elevation_ft"),
        i["Variation"].alias("variation"), i["Alone"].alias("alone")
    )


def _images(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(_pages(spark, d), "detail_id", "airport_link", "html", images=True, folder="images", sections=[])


def page_images(spark: SparkSession, d: str) -> DataFrame:
    """Image columns, asked for: address, file name, local path and referer."""
    names = ("Runway Diagram Url", "image_url"), ("Runway Diagram Image Name", "image_name"), ("Runway Diagram Local Path", "local_path"), ("Referer Url", "referer_url")
    return _images(spark, d).select("detail_id", *[F.col(f"`{a}`").alias(b) for a, b in names])


def page_image_paths(spark: SparkSession, d: str) -> DataFrame:
    """Records with the path of the image that was fetched for them, where fetching succeeded."""
    link = F.col("airport_link")
    url = F.concat(F.coalesce(F.regexp_extract(link, r"^https?://[^/?#]+", 0), F.lit("")), F.lit("/r/"), F.col("detail_id"), F.lit(".jpg"))
    fetched = table(spark, d, "detail_rows").select(
        url.alias("url"), F.concat(F.lit("full/"), F.col("detail_id"), F.lit(".jpg")).alias("path"),
        (F.col("detail_id") % 3 != 0).alias("ok")
    )
    return clean.with_images(_images(spark, d), fetched).select("detail_id", "runway_diagram_path")


def index_links(spark: SparkSession, d: str) -> DataFrame:
    """The countries' links of index pages, one page a country, with a relative link each."""
    html = _markup('<div class="byCountry"><ul><li><a href="../c/{icao_prefix}"> {country} </a></li></ul></div>')
    pages = table(spark, d, "country_ref").select("area", F.lit(BASE).alias("url"), html.alias("html"))
    return extract.index_links(pages, ["area"], "url", "html")


def listing_links(spark: SparkSession, d: str) -> DataFrame:
    """The absolute links of listing pages; a row without a link has the page's own address."""
    name = F.when(F.col("icao").isNotNull(), _markup('<a href="../info/{row_id}">{airport_name}</a>')).otherwise(html_of("airport_name"))
    html = F.concat(
        F.lit('<div class="result clearfix"><div class="col2 w30p fl p10px">'), name,
        _markup('</div><div class="col4 w25p fl p10px">{country}</div></div>')
    )
    pages = table(spark, d, "link_rows").select("row_id", F.lit(BASE).alias("url"), html.alias("html"))
    return extract.listing_rows(pages, ["row_id"], "url", "html").select(
        "row_id", F.col("Country").alias("country"), F.col("`Airport Link`").alias("link")
    )


QUERIES = {f.__name__: f for f in (
    page_contacts, page_fbos, page_handlers, page_caterers, page_hotels, page_rentals, page_maps, page_images, page_image_paths,
    index_links, listing_links
)}


def _text(c: str, default: str = "'N/A'") -> str:
    """First text, stripped: an empty cell has no text, a blank one an empty text."""
    return f"CASE WHEN {c} <> '' THEN {_strip(c)} ELSE {default} END"


def _full(text: str) -> str:
    return f"coalesce(nullif({_strip(text)}, ''), 'N/A')"


def _rows(*entries: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT detail_id, {k}::INT AS pos, {', '.join(e)} FROM detail_rows" for k, e in enumerate(entries))


def _na(*names: str) -> list[str]:
    return [f"'N/A' AS {n}" for n in names]


_LINK = "coalesce(airport_link, '') AS website"
_TIDY = "replace({}, chr(160), '')"
_LISTED = "list_filter([elevation_ft, variation], lambda x: x <> '')"
_NEAR = "list_filter([distance_from_city, variation], lambda x: x <> '')"
_PLACE = "list_filter([{}, {}], lambda x: x <> '')".format(_strip("city"), _strip("country"))
_ICAO = _strip("split_part(coalesce(icao, '') || ',', ',', 1)")
_IMAGE_URL = "coalesce(regexp_extract(airport_link, '^https?://[^/?#]+'), '') || '/r/' || detail_id || '.jpg'"

SQL = {
    "page_contacts": _rows(
        [f"{_text('airport_name')} AS contact_name", f"{_text('variation')} AS frequency", f"{_text('elevation_ft')} AS phone", f"{_text('distance_from_city')} AS fax",
         "coalesce(icao, '') || '@x.example' AS email", "CASE WHEN starts_with(airport_link, 'http') THEN airport_link ELSE 'N/A' END AS website"],
        ["'DESK' AS contact_name", *_na("frequency", "phone", "fax", "email", "website")],
    ),
    "page_fbos": _rows(
        [f"{_text('airport_name')} AS name", f"{_full('''concat_ws(' ', nullif(city, ''), nullif(country, ''))''')} AS address", f"{_text('elevation_ft')} AS phone", f"{_text('variation')} AS tel",
         "coalesce(icao, '') || '@x.example' AS email", _LINK, f"{_text('iata')} AS aftn", f"{_text('icao')} AS sita"],
        ["'SECOND' AS name", *_na("address", "phone", "tel", "email", "website", "aftn", "sita")],
    ),
    "page_handlers": _rows([f"{_text('city')} AS name", f"{_full('''coalesce(country, '')''')} AS address", f"{_text('variation')} AS phone", f"{_text('elevation_ft')} AS fax", "'h@' || coalesce(iata, '') AS email", _LINK]),
    "page_caterers": _rows(
        [f"{_text('country')} AS name", f"{_text('elevation_ft')} AS phone", f"{_text('variation')} AS fax", "'c@' || coalesce(iata, '') AS email", _LINK, f"{_text('iata')} AS sita"],
        _na("name", "phone", "fax", "email", "website", "sita"),
    ),
    "page_hotels": _rows(
        [f"{_strip('''('Hotel ' || coalesce(city, ''))''')} AS name", f"{_text('elevation_ft')} AS phone", f"{_text('variation')} AS fax", _LINK, f"coalesce(nullif(array_to_string({_PLACE}, ', '), ''), 'N/A') AS address",
         f"{_full(_NEAR + '[1]')} AS distance", f"{_full(_NEAR + '[2]')} AS price_range"],
    ),
    "page_rentals": _rows([f"detail_id::VARCHAR AS supplier_id", f"{_text('facility_use')} AS company_name", f"{_text('variation', chr(39) + 'x' + chr(39))} AS phone", "'r@' || coalesce(iata, '') AS email", _LINK]),
    "page_maps": f"""SELECT detail_id, CASE WHEN customs <> '' THEN {_strip('customs')} END AS customs,
  CASE WHEN open_24_hours <> '' THEN {_strip('open_24_hours')} WHEN slots_required <> '' THEN {_strip('slots_required')} END AS slots,
  coalesce({_TIDY.format(_strip(_LISTED + '[1]'))}, 'N/A') AS elevation_ft, coalesce({_TIDY.format(_strip(_LISTED + '[2]'))}, 'N/A') AS variation, 'N/A' AS alone FROM detail_rows""",
    "page_images": f"""SELECT detail_id, CASE WHEN icao IS NOT NULL THEN {_IMAGE_URL} END AS image_url, CASE WHEN icao IS NOT NULL THEN {_ICAO} || '_runway_diagram.jpg' END AS image_name,
  CASE WHEN icao IS NOT NULL THEN 'images/' || {_ICAO} || '_runway_diagram.jpg' END AS local_path, airport_link AS referer_url FROM detail_rows""",
    "page_image_paths": f"""WITH i AS (SELECT detail_id, icao, {_IMAGE_URL} AS url FROM detail_rows), g AS (SELECT url, min('full/' || detail_id || '.jpg') AS path FROM i WHERE detail_id % 3 <> 0 GROUP BY url)
SELECT i.detail_id, CASE WHEN icao IS NOT NULL THEN path END AS runway_diagram_path FROM i LEFT JOIN g ON i.url = g.url""",
    "index_links": f"SELECT area, {_strip('country')} AS country, 'https://www.aerodex.example/c/' || coalesce(icao_prefix, '') AS link FROM country_ref",
    "listing_links": f"SELECT row_id, nullif(country, '') AS country, CASE WHEN icao IS NOT NULL THEN 'https://www.aerodex.example/info/' || row_id ELSE '{BASE}' END AS link FROM link_rows",
}
