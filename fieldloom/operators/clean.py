"""Cleaning of records' array sections, with higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_mailto
from ..schema import ARRAYS, UNCLEANED


def named(entry: Column, fields: list[str]) -> Column:
    """Whether an entry bears a Name or CompanyName; an empty one counts, null and ``N/A`` don't."""
    test = F.lit(False)
    for f in ("Name", "CompanyName"):
        if f in fields:
            test = test | F.coalesce(entry[f] != "N/A", F.lit(False))
    return test


def clean_section(section: Column, fields: list[str]) -> Column:
    """Unnamed and null entries go, ``mailto:`` goes from Email, and entries without Email get a null one. A null section stays null."""
    kept = F.filter(section, lambda e: e.isNotNull() & named(e, fields))
    email = (lambda e: strip_mailto(e["Email"])) if "Email" in fields else (lambda e: F.lit(None).cast("string"))
    return F.transform(kept, lambda e: e.withField("Email", email(e)))


def clean(items: DataFrame) -> DataFrame:
    """Every array section but Contact Information cleaned; all else as it is. Idempotent."""
    out = {}
    for f in items.schema.fields:
        if f.name in ARRAYS and f.name != UNCLEANED and isinstance(f.dataType, T.ArrayType):
            out[f.name] = clean_section(F.col(f"`{f.name}`"), f.dataType.elementType.names)
    return items.withColumns(out)


def entries(items: DataFrame, key: str, section: str) -> DataFrame:
    """An array section as a table: key, pos, and the entry's fields; a clashing name gets ``_`` appended."""
    fields = items.schema[section].dataType.elementType.names
    rows = items.select(F.col(key).alias("key"), F.posexplode(F.col(f"`{section}`")).alias("pos", "e"))
    return rows.select(F.col("key").alias(key), "pos", *[F.col("e").getField(f).alias(f + "_" * (f.lower() in (key.lower(), "pos"))) for f in fields])


def with_images(items: DataFrame, manifest: DataFrame) -> DataFrame:
    """Items with ``runway_diagram_path``: of the images fetched for their url (manifest: url, path, ok), the first that succeeded, where a local path was asked for."""
    good = manifest.where("ok").groupBy("url").agg(F.min("path").alias("_path"))
    joined = items.join(good, F.col("`Runway Diagram Url`") == F.col("url"), "left").drop("url")
    asked = F.coalesce(F.col("`Runway Diagram Local Path`") != "", F.lit(False))
    return joined.withColumn("runway_diagram_path", F.when(asked, F.col("_path"))).drop("_path")


def chain(items: DataFrame, *steps) -> DataFrame:
    """Item pipelines in order of their priority: (priority, function) each."""
    for _, step in sorted(steps, key=lambda s: s[0]):
        items = items.transform(step)
    return items
