"""Schemas of link tables and airport records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of columns, sections and fields, as the records bear them.
LINK_COLUMNS = ["ICAO", "Airport Name", "City", "State", "Country", "Airport Link"]
DETAILS = ["Name", "City", "Country", "Link", "ICAO", "IATA"]
MAPS = ["Additional Airport Details", "Airport Information"]
ARRAYS = {
    "Contact Information": ["ContactName", "Frequency", "Phone", "Fax", "Email", "Website"],
    "FBO Information": ["Name", "Address", "Phone", "Tel", "Email", "Website", "Aftn", "Sita"],
    "Handler Inforamtion": ["Name", "Address", "Phone", "Fax", "Email", "Website"],
    "Caterers Information": ["Name", "Phone", "Fax", "Email", "Website", "SITA"],
    "Hotel Info": ["Name", "Phone", "Fax", "Website", "Address", "Distance", "PriceRange"],
    "Car Rental Info": ["SupplierId", "CompanyName", "Phone", "Email", "Website"],
}
IMAGE = ["Runway Diagram Url", "Runway Diagram Local Path", "Referer Url", "Runway Diagram Image Name"]
#: Older records' names for sections, and for the parts of Runway Diagram.
RENAMED = {"Handler Information": "Handler Inforamtion"}
OLD_IMAGE = {
    "url": "Runway Diagram Url", "local_path": "Runway Diagram Local Path", "image_name": "Runway Diagram Image Name",
    "referer": "Referer Url"
}
#: The section that cleaning leaves alone.
UNCLEANED = "Contact Information"


def record(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


LINKS = record(LINK_COLUMNS)
_OPEN = T.MapType(T.StringType(), T.StringType())
ITEM = T.StructType(
    [T.StructField("Airport Details", record(DETAILS))]
    + [T.StructField(m, _OPEN) for m in MAPS]
    + [T.StructField(a, T.ArrayType(record(f))) for a, f in ARRAYS.items()]
    + [T.StructField(i, T.StringType()) for i in IMAGE]
)


def read_items(df: DataFrame, key: str, raw: str) -> DataFrame:
    """``key`` and the columns of ITEM from records as text, in either layout.

    One scan of each text finds its sections; each is then parsed by its own schema. A section written into a string
    counts as what it holds, a lone object as a list of one, grouped entries as a map by Key; null elements stay in
    lists. A missing or malformed section is null, and so are all of them for a text that is no JSON object.
    """
    names = ["Airport Details", *MAPS, *ARRAYS, *IMAGE, *RENAMED, "Runway Diagram"]
    cells = {n: f"s{i}" for i, n in enumerate(names)}
    parts = df.select(F.col(key).alias("key"), F.json_tuple(F.col(raw), *names).alias(*cells.values()))
    cell = lambda n: F.col(cells[n])
    out = [F.from_json(cell("Airport Details"), record(DETAILS)).alias("Airport Details")]
    entry = T.ArrayType(T.StructType([T.StructField("Entries", T.ArrayType(record(["Key", "Value"])))]))
    for m in MAPS:
        pairs = F.filter(
            F.flatten(F.transform(F.from_json(cell(m), entry), lambda g: F.coalesce(g["Entries"], F.array().cast("array<struct<Key:string,Value:string>>")))),
            lambda e: e["Key"].isNotNull()
        )
        first = F.filter(pairs, lambda e, i: F.array_position(F.transform(pairs, lambda x: x["Key"]), e["Key"]) == i + 1)
        out.append(F.when(F.ltrim(cell(m)).startswith("["), F.map_from_entries(first)).otherwise(F.from_json(cell(m), _OPEN)).alias(m))
    for a, fields in ARRAYS.items():
        old = [o for o, n in RENAMED.items() if n == a]
        text = F.coalesce(cell(a), *map(cell, old))
        out.append(F.from_json(
            F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text), T.ArrayType(record(fields))
        ).alias(a))
    image = F.from_json(cell("Runway Diagram"), record(list(OLD_IMAGE)))
    out += [F.coalesce(cell(n), image[o]).alias(n) for n in IMAGE for o, to in OLD_IMAGE.items() if to == n]
    return parts.select(F.col("key").alias(key), *out)
