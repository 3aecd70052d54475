"""Captured pages to records: one Arrow pass parses each page once and fills all sections.

What a page holds is described by tables of selectors; a field is (name, selector, way of reading it). A failing page
gives the sections read before the failure, and the reason.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator
from itertools import zip_longest
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..schema import ARRAYS, IMAGE, ITEM, LINK_COLUMNS, MAPS
from ..session import spread
from .dom import Element, first, parse, select

NA = "N/A"


def text(e: Element, s: str) -> str:
    """First text, stripped; ``N/A`` without one, ``''`` for a blank one."""
    return first(e, s, NA).strip()


def raw(e: Element, s: str) -> str:
    return first(e, s, NA)


def mail(e: Element, s: str) -> str:
    """First value without a leading ``mailto:``; ``N/A`` without one or for an empty one."""
    return (first(e, s) or NA).removeprefix("mailto:")


def joined(e: Element, s: str) -> str:
    return " ".join(select(e, s)).strip() or NA


def lines(e: Element, s: str) -> str:
    return ", ".join(x.strip() for x in select(e, s) if x.strip()) or NA


def nth(k: int) -> Callable[[Element, str], str]:
    return lambda e, s: (select(e, s)[k : k + 1] or [""])[0].strip() or NA


# Selectors of the pages' markup.
SECTIONS = {
    "Contact Information": ("div.results-content div.clearfix.result", [
        ("ContactName", "div.w31p.fl.bold::text", text),
        ("Frequency", "div.w17p.fl.p3px div::text", text),
        ("Phone", 'div.w30p.fl.p3px div.clearfix:contains("Phone") + div::text', text),
        ("Fax", 'div.w30p.fl.p3px div.clearfix:contains("Fax") + div::text', text),
        ("Email", "div.w22p.fl.p3px div a::attr(href)", mail),
        ("Website", 'div.w22p.fl.p3px a[href^="http"]::attr(href)', raw),
    ]),
    "FBO Information": ("div.fbo div.vendor", [
        ("Name", "div.vendorName a strong::text", text),
        ("Address", 'div.w35p.bold:contains("Address") + div::text', joined),
        ("Phone", 'div.w35p.bold:contains("Phone") + div::text', text),
        ("Tel", 'div.w35p.bold:contains("Tel After Hours") + div::text', text),
        ("Email", 'div.w35p.bold:contains("Email") + div a::attr(href)', mail),
        ("Website", 'div.w35p.bold:contains("Website") + div a::attr(href)', raw),
        ("Aftn", 'div.w30p.fl strong:contains("AFTN") + div::text', text),
        ("Sita", 'div.w30p.fl strong:contains("SITA") + div::text', text),
    ]),
    "Handler Inforamtion": ("div.bluePanelContent div.vendor", [
        ("Name", "div.vendorName a strong::text", text),
        ("Address", 'div.w35p.bold:contains("Address") + div::text', joined),
        ("Phone", 'div.w35p.bold:contains("Phone") + div::text', text),
        ("Fax", 'div.w35p.bold:contains("Fax") + div::text', text),
        ("Email", 'div.w35p.bold:contains("Email") + div a::attr(href)', mail),
        ("Website", 'div.w35p.bold:contains("Website") + div a::attr(href)', raw),
    ]),
    "Caterers Information": ("div.bluePanelRow.clearfix.mbGrey", [
        ("Name", "div.clearboth a strong.fs18px::text", text),
        ("Phone", 'div.fl.w35p.bold:contains("Phone") + div::text', text),
        ("Fax", 'div.fl.w35p.bold:contains("Fax") + div::text', text),
        ("Email", 'div.fl.w35p.bold:contains("Email") a::attr(href)', mail),
        ("Website", 'div.fl.w35p.bold:contains("Website") + div a::attr(href)', raw),
        ("SITA", 'div.fl.w35p.bold:contains("SITA") + div::text', text),
    ]),
    "Hotel Info": (".bluePanelRow.clearfix.mbGrey.noPaddingLR", [
        ("Name", ".fs18px.bold::text", text),
        ("Phone", 'div:contains("Phone") + div::text', text),
        ("Fax", 'div:contains("Fax") + div::text', text),
        ("Website", 'div:contains("Website") + div a::attr(href)', raw),
        ("Address", ".w25p .fl.w100p::text", lines),
        ("Distance", ".w20p .fl.w100p::text", nth(0)),
        ("PriceRange", ".w20p .fl.w100p::text", nth(1)),
    ]),
    "Car Rental Info": ("div.bluePanelContent", [
        ("SupplierId", 'input[type="hidden"]::attr(value)', raw),
        ("CompanyName", "div.w30p.fs18px.bold::text", text),
        ("Phone", "div.w35p div.fl.w65p::text", text),
        ("Email", "div.fl.w35p div.fl.w65p + div a::attr(href)", mail),
        ("Website", "div.w35p a::attr(href)", raw),
    ]),
}
ONE_OF = {"Car Rental Info": ("div.w30p.fs18px.bold::text", "div.w35p div.fl.w65p::text")}
ADDITIONAL = (".clearfix.mb20px.mainInfo .table", ".bold::text", ".w45p::text, .w38p::text")
INFORMATION = ("div.clearboth.p3xp.bold::text", "div.clearboth.p3px::text")
IMAGE_AT = "#dnn_ctr422_VDC_ctl00_divRunwayDiagram img::attr(src)"
INDEX_AT, LISTING_AT = "div.byCountry ul li a", "div.result.clearfix"
LISTING = (
    "div.col1.w15p.fl.p10px::text", "div.col2.w30p.fl.p10px a::text", "div.col3.w15p.fl.p10px::text", "div.col4.w25p.fl.p10px::text",
    "div.col2.w30p.fl.p10px a::attr(href)"
)
MARKERS = {"ICAO": ("ICAO -", ","), "IATA": ("IATA -", None)}


def details(page: Element, link: str | None) -> dict[str, str]:
    """Name, place and codes; a missing heading leaves its fields out."""
    out: dict[str, str] = {}
    if name := first(page, "h1::text"):
        out["Name"] = name.strip()
    if place := first(page, "h2::text"):
        parts = place.split(",", 2)
        out |= {"City": parts[0].strip(), "Country": parts[1].strip() if len(parts) > 1 else NA}
    out["Link"] = link
    codes = first(page, "h3::text") or ""
    for field, (marker, end) in MARKERS.items():
        if (at := codes.find(marker)) >= 0:
            rest = codes[at + len(marker) + 1 :]
            out[field] = (rest.split(end, 1)[0] if end else rest).strip()
    return out


def additional(page: Element) -> dict[str, str]:
    rows, key, value = ADDITIONAL
    pairs = ((first(e, key), first(e, value)) for e in select(page, rows))
    return {k.strip(): v.strip() for k, v in pairs if k and v}


def information(page: Element) -> dict[str, str]:
    """Keys and values paired by position."""
    tidy = lambda x: x.strip().replace("\xa0", "")
    keys, values = (select(page, s) for s in INFORMATION)
    return {tidy(k): tidy(v) if v else NA for k, v in zip_longest(keys, values, fillvalue="") if k}


def section(page: Element, name: str) -> list[dict[str, str]]:
    rows, fields = SECTIONS[name]
    found = select(page, rows)
    if name in ONE_OF:
        found = [e for e in found if any(first(e, s) for s in ONE_OF[name])]
    return [{f: how(e, s) for f, s, how in fields} for e in found]


def image(page: Element, url: str | None, icao: str | None, folder: str, referer: str | None) -> dict[str, str | None]:
    src = first(page, IMAGE_AT)
    out: dict[str, str | None] = dict.fromkeys(IMAGE) | {"Referer Url": referer}
    if src:
        name = f"{'UNKNOWN' if icao is None else icao}_runway_diagram.jpg"
        out |= {
            "Runway Diagram Url": urljoin(url or "", src), "Runway Diagram Image Name": name,
            "Runway Diagram Local Path": posixpath.join(folder, name)
        }
    return out


def item(html: str | None, link: str | None, images: bool = False, folder: str = "downloaded_images", wanted: frozenset[str] | None = None) -> dict:
    """A page as a record of ITEM, and ``_error``. A null page has empty sections; without ``images`` the image fields are null, and so are sections that aren't ``wanted``."""
    asked = lambda name: wanted is None or name in wanted
    empty = {"Airport Details": {}, **{m: {} for m in MAPS}, **{a: [] for a in ARRAYS}}
    out: dict = {**{n: x if asked(n) else None for n, x in empty.items()}, **dict.fromkeys(IMAGE), "_error": None}
    try:
        page = parse(html or "")
        found = details(page, link) if asked("Airport Details") or images else {}
        if asked("Airport Details"):
            out["Airport Details"] = found
        for m, read in zip(MAPS, (additional, information)):
            if asked(m):
                out[m] = read(page)
        for a in ARRAYS:
            if asked(a):
                out[a] = section(page, a)
        if images:
            out |= image(page, link, found.get("ICAO"), folder, link)
    except Exception as e:  # noqa: BLE001  a page never takes its batch with it
        out["_error"] = f"{type(e).__name__}: {e}"
    return out


def extract(
    pages: DataFrame, key: str, link: str, html: str, images: bool = False, folder: str = "downloaded_images", sections: list[str] | None = None
) -> DataFrame:
    """``key``, the columns of ITEM and ``_error``: one record a page, and of ITEM's sections only ``sections``, if given.

    Filters and joins belong before this pass, as none is pushed through it.
    """
    wanted = None if sections is None else frozenset(sections)
    kept = [f for f in ITEM.fields if wanted is None or f.name in wanted or images and f.name in IMAGE]
    types = [(f.name, to_arrow_type(f.dataType)) for f in kept] + [("_error", pa.string())]
    shape = ", ".join([f"key {pages.schema[key].dataType.simpleString()}", *[f"`{f.name}` {_ddl(f.dataType)}" for f in kept], "_error string"])
    plain = lambda v, t: list(v.items()) if pa.types.is_map(t) else v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [item(h, u, images, folder, wanted) for u, h in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                columns = [pa.array([plain(r[n], t) for r in rows], t) for n, t in types]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["key", *[n for n, _ in types]])

    out = spread(pages.select(
        F.col(key).alias("key"), F.col(link).cast("string").alias("link"), F.col(html).cast("string").alias("html")
    )).mapInArrow(run, shape)
    return out.withColumnRenamed("key", key)


def _ddl(t) -> str:
    kind = t.simpleString()
    if kind.startswith("array"):
        return "array<" + _ddl(t.elementType) + ">"
    if kind.startswith("struct"):
        return "struct<" + ", ".join(f"`{f.name}`: string" for f in t.fields) + ">"
    return kind


def _harvest(pages: DataFrame, keep: list[str], url: str, html: str, fields: list[str], read: Callable[[Element, str], list[tuple]]) -> DataFrame:
    taken = {f.lower() for f in fields}
    kept = [k + "_" * (k.lower() in taken) for k in keep]  # a clashing name gets _ appended
    shape = ", ".join([f"`{n}` {pages.schema[k].dataType.simpleString()}" for k, n in zip(keep, kept)] + [f"`{f}` string" for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own = [], []
            for i, (u, h) in enumerate(zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist())):
                found = read(parse(h or ""), u or "")
                rows += found
                own += [i] * len(found)
            cols = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(j).take(pa.array(own, pa.int64())) for j in range(len(keep))] + [pa.array(c, pa.string()) for c in cols],
                names=[*kept, *fields]
            )

    return spread(pages.select(*keep, F.col(url).cast("string").alias("_url"), F.col(html).cast("string").alias("_html"))).mapInArrow(run, shape)


def index_links(pages: DataFrame, keep: list[str], url: str, html: str) -> DataFrame:
    """(keep..., country, link): a row for each country's link of an index page, its text stripped, its address absolute."""
    return _harvest(
        pages, keep, url, html, ["country", "link"], lambda page,
        u: [((first(a, "::text") or "").strip(), urljoin(u, a.attrs.get("href", ""))) for a in select(page, INDEX_AT)]
    )


def listing_rows(pages: DataFrame, keep: list[str], url: str, html: str) -> DataFrame:
    """(keep..., LINK_COLUMNS): a row for each airport of a listing page; columns of the page, as its country, carry over by ``keep``.

    Texts aren't stripped; State is the second text of the city's cell, null without one; a row without address has the
    page's own.
    """

    def read(page: Element, u: str) -> list[tuple]:
        out = []
        for e in select(page, LISTING_AT):
            icao, name, place, country, href = (select(e, s) for s in LISTING)
            pick = lambda found, k=0: found[k] if len(found) > k else None
            out.append((pick(icao), pick(name), pick(place), pick(place, 1), pick(country), urljoin(u, pick(href) or "")))
        return out

    return _harvest(pages, keep, url, html, LINK_COLUMNS, read)
