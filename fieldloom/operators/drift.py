"""Schemas that drift between files: one consistent table, and a report of each change.

Each file's schema is a small graph: sections, the fields nested in them, their types, and the names nested in objects.
The graphs of consecutive files are matched by similarity flooding. Of the fields that go and come, each one's best
matches are its candidates; these are held against the contents of records present in both files, and a consistent
one-to-one set is selected. Only fields that this leaves without a match have their other pairs verified too, so flooding
decides what is compared, and first, but no rename is lost to it. Records are never gathered by file: they are folded to
counts per file and field, and contents meet by file pair, candidate and page.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.links import link_page_of
from ..session import materialize, spread
from .nested import json_text, parse, unfold

SECTIONS = ("Airport Details", "Additional Airport Details")
#: In the order of the alphabet: of types equally frequent in a field the first one counts.
TYPES = ("boolean", "list", "number", "object", "string")
#: A field exists in a file if at least one in so many of its records holds it.
EXISTS_IN = 5
#: Least share of pages in both files whose content must be the same for a rename, and least sum of that agreement beyond
#: chance (1 for full agreement, 0 for what the values' frequencies make likely) and the flooding's score.
SAME_CONTENT, EVIDENCE = 0.6, 0.6
#: Two fields are candidates for a rename if each is among so many best matches of the other by flooding.
CANDIDATES = 2

_KIND = {t: TYPES.index(k) for t, k in ((str, "string"), (int, "number"), (float, "number"), (bool, "boolean"), (dict, "object"), (list, "list"))}


def section_fields(section: object) -> dict[str, object]:
    """The fields of a section with their values: its direct names, or in grouped form the Keys with their Values.

    A section or group written into a string counts as what it holds; a lone group or entry counts as a list of one;
    null elements count for nothing. Of a Key that comes twice the first value that isn't null counts.
    """
    section = unfold(section)
    if isinstance(section, dict) and "Entries" not in section:
        return section
    out: dict[str, object] = {}
    todo = [section] if isinstance(section, dict) else section if isinstance(section, list) else []
    for group in map(unfold, todo):
        if not isinstance(group, dict):
            continue
        entries = unfold(group.get("Entries")) if "Entries" in group else group
        for entry in map(unfold, [entries] if isinstance(entries, dict) else entries if isinstance(entries, list) else []):
            if isinstance(entry, dict) and isinstance(name := entry.get("Key"), str) and out.get(name) is None:
                out[name] = entry.get("Value")
    return out


def page_of(details: dict[str, object]) -> str | None:
    """The page code of a record: of the first field of Airport Details that is a page link, under whatever name."""
    for value in details.values():
        if code := link_page_of(value):
            return code
    return None


def _leaf(value: object) -> str:
    """The first scalar in a value, such that a number, a flag and their writing as text agree."""
    while isinstance(value, (dict, list)):
        value = next(iter(value.values() if isinstance(value, dict) else value), "")
    text = {True: "yes", False: "no"}[value] if isinstance(value, bool) else str(value).strip().lower()
    try:
        return repr(float(text))
    except ValueError:
        return {"true": "yes", "false": "no", "y": "yes", "n": "no"}.get(text, text)


def _content(value: object) -> tuple[int, int]:
    """Hashes of a value as a whole, links by their page, and of its first scalar."""
    code = link_page_of(value)
    whole = "page " + code if code else "s" + value if type(value) is str else json.dumps(value, sort_keys=True)
    return _hash(whole), _hash(code or _leaf(value))


@lru_cache(50_000)
def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _records(part: pa.RecordBatch, column: int) -> Iterator[tuple[int, dict]]:
    """(place, record) of each record that is an object."""
    for i, text in enumerate(part.column(column).to_pylist()):
        try:
            item = unfold(parse(text))
        except ValueError:
            continue
        if isinstance(item, dict):
            yield i, item


def held_fields(items: DataFrame, feed: str, record: str) -> DataFrame:
    """feed, page, section, field, type, inner, whole, leaf: a row for each field a record holds with a non-null value.

    type: its number in TYPES; page: the number of the page's code. A record that is null, no JSON or no object holds no
    field. One Arrow pass, no shuffle.
    """
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    names = ["page", "section", "field", "type", "inner", "whole", "leaf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows, own = [], []
                for i, item in _records(part, 1):
                    code = page_of(section_fields(item.get(SECTIONS[0])))
                    page = int(code, 36) if code else None
                    for section in SECTIONS:
                        for name, value in section_fields(item.get(section)).items():
                            if value is not None:
                                inner = ",".join(value) if type(value) is dict else ""
                                rows.append((page, section, name, _KIND[type(value)], inner, *_content(value)))
                                own.append(i)
                cols = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(own, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, kinds)]], names=["feed", *names]
                )

    shape = f"feed {items.schema[feed].dataType.simpleString()}, page bigint, section string, field string, type int, inner string, whole bigint, leaf bigint"
    return spread(items.select(F.col(feed).alias("feed"), F.col(record).cast("string").alias("record"))).mapInArrow(run, shape)


def existing(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """feed, section, field, type, inner, n, exists: the fields of each file with the type of most of their values, and whether enough records hold them.

    ``sizes``: feed, records. Folded map-side to one state per file and field.
    """
    of_type = [F.count_if(F.col("type") == k).alias(f"n{k}") for k in range(len(TYPES))]
    counts = held.groupBy("feed", "section", "field").agg(F.count(F.lit(1)).alias("n"), *of_type)
    most = F.greatest(*[F.col(f"n{k}") for k in range(len(TYPES))])
    typed = counts.withColumn("type", F.coalesce(*[F.when(F.col(f"n{k}") == most, k) for k in range(len(TYPES))]))
    nested = held.where(F.col("type") == TYPES.index("object")).groupBy("feed", "section", "field").agg(F.max("inner").alias("inner"))
    there = typed.join(sizes, "feed").join(nested, ["feed", "section", "field"], "left")
    return there.select(
        "feed", "section", "field", "type", F.coalesce("inner", F.lit("")).alias("inner"), "n",
        (F.col("n") * EXISTS_IN >= F.col("records")).alias("exists")
    )


def schemas(fields: DataFrame) -> DataFrame:
    """feed, fields: the existing fields of each file. The list is bounded, since at most EXISTS_IN times as many fields can exist as a record holds on average."""
    return fields.where("exists").groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("section", "field", "type", "inner"))).alias("fields"))


@lru_cache(100_000)
def name_likeness(a: str, b: str) -> float:
    """Dice coefficient of letter pairs, at least 0.01, whatever case and punctuation."""
    pairs = lambda s: {s[i : i + 2] for i in range(len(s) - 1)} or {s}
    x, y = (pairs("".join(c for c in s.lower() if c.isalnum())) for s in (a, b))
    return max(0.01, 2 * len(x & y) / (len(x) + len(y)))


def flood(old: list[tuple], new: list[tuple], rounds: int = 60, still: float = 1e-3) -> np.ndarray:
    """Similarity flooding between two schemas of (section, field, type, inner): match scores of all field pairs, the largest 1.

    Pair nodes: sections, fields, types and nested names. A field pair is linked to the pairs of its sections, of its types
    and of the names nested in it; every node passes its score on in equal parts per kind of link. Repeated as
    s0 + s + flow(s0 + s), normalised, until no score moves by more than ``still``.
    """
    def graph(schema: list[tuple]) -> tuple[list[np.ndarray], list[list[str]]]:
        parts, labels = [], []
        for k in (0, 2, 3):
            named = [[x[k]] if k < 3 else x[k].split(",") if x[k] else [] for x in schema]
            own = sorted({n for x in named for n in x})
            m = np.zeros((len(schema), len(own)))
            for i, x in enumerate(named):
                for n in x:
                    m[i, own.index(n)] = 1
            parts.append(m)
            labels.append(own)
        return parts, labels

    (a, la), (b, lb) = graph(old), graph(new)
    start = np.array([[name_likeness(x[1], y[1]) for y in new] for x in old])
    hubs0 = [np.array([[1.0 if x == y else 0.1 for y in lb[k]] for x in la[k]]).reshape(len(la[k]), len(lb[k])) for k in range(3)]
    fan = [np.maximum(1, np.outer(a[k].sum(0), b[k].sum(0))) for k in range(3)]
    score, hubs = start, hubs0
    for _ in range(rounds):
        s, h = start + score, [x + y for x, y in zip(hubs0, hubs)]
        flow = sum(a[k] @ (h[k] / fan[k]) @ b[k].T for k in range(3))
        up = [a[k].T @ (s / np.maximum(1, np.outer(a[k].sum(1), b[k].sum(1)))) @ b[k] for k in range(3)]
        s, h = s + flow, [x + y for x, y in zip(h, up)]
        top = s.max()
        hubs = [x / max(x.max(initial=0), 1e-9) for x in h]
        moved, score = np.abs(s / top - score).max(), s / top
        if moved < still:
            break
    return score


def _ranks(score: np.ndarray) -> np.ndarray:
    """The place of each pair among those of its row, and of its column, whichever is worse; equal scores by position, so that places are distinct."""
    rows, columns = (-score).argsort(1, kind="stable").argsort(1), (-score).argsort(0, kind="stable").argsort(0)
    return np.maximum(rows, columns)


def compare(old: list[tuple], new: list[tuple], match: Callable = flood) -> Iterator[tuple]:
    """(section, kind, old name, new name, score) between two schemas. kind ``match``: a candidate for a rename, by flooding; ``rest``: any other pair of a field that goes and one that comes."""
    was, now = {x[:2]: x for x in old}, {x[:2]: x for x in new}
    for k in was.keys() & now.keys():
        if was[k][2] != now[k][2]:
            yield k[0], "retyped", k[1], k[1], 0.0
    gone, come = [k for k in was if k not in now], [k for k in now if k not in was]
    yield from ((s, "removed", n, "", 0.0) for s, n in gone)
    yield from ((s, "added", "", n, 0.0) for s, n in come)
    if {s for s, _ in gone} & {s for s, _ in come}:
        score = match(list(was.values()), list(now.values()))
        i, j = ({k: n for n, k in enumerate(d)} for d in (was, now))
        for s in SECTIONS:
            here, there = [k for k in gone if k[0] == s], [k for k in come if k[0] == s]
            if here and there:
                own = score[np.ix_([i[k] for k in here], [j[k] for k in there])]
                rank = _ranks(own)
                for a, (_, n) in enumerate(here):
                    yield from ((s, "match" if rank[a, b] < CANDIDATES else "rest", n, m, float(own[a, b])) for b, (_, m) in enumerate(there))


def _compare_pass(match: Callable) -> Callable:
    key = lambda fields: [(x["section"], x["field"], x["type"], x["inner"] or "") for x in fields or []]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = (batch.column(k).to_pylist() for k in ("old", "new"))
            rows, own = [], []
            for i, (x, y) in enumerate(zip(old, new)):
                found = list(compare(key(x), key(y), match))
                rows += found
                own += [i] * len(found)
            cols = list(zip(*rows)) or [()] * 5
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("feed").take(at), batch.column("before").take(at), *[pa.array(c, t) for c, t in zip(cols, [pa.string()] * 4 + [pa.float64()])]],
                names=["feed", "before", "section", "kind", "old_name", "new_name", "score"],
            )

    return run


def consecutive(files: DataFrame, feed: str, series: str, order: str) -> DataFrame:
    """(feed, before) of each file that has one before it in its series; files without series or number stand alone."""
    w = Window.partitionBy(series).orderBy(order, feed)
    known = files.where(F.col(series).isNotNull() & F.col(order).isNotNull() & F.col(feed).isNotNull())
    return known.select(F.col(feed).alias("feed"), F.lag(feed).over(w).alias("before")).where("before is not null")


def _select_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One consistent set of renames for each file, candidates of flooding first, then by agreement and score; and the changes that they leave."""
    for batch in batches:
        rows, own = [], []
        for i, (changes, matches) in enumerate(zip(batch.column("changes").to_pylist(), batch.column("matches").to_pylist())):
            gone, come = set(), set()
            for m in sorted(
                matches or [], key=lambda m: (m["kind"] != "match", -m["share"] - m["score"], m["section"], m["old_name"], m["new_name"])
            ):
                old, new = (m["section"], m["old_name"]), (m["section"], m["new_name"])
                if old not in gone and new not in come:
                    gone.add(old)
                    come.add(new)
                    rows.append((m["section"], "renamed", m["old_name"], m["new_name"]))
                    own.append(i)
            for c in changes or []:
                s = c["section"]
                if not (c["kind"] == "removed" and (s, c["old_name"]) in gone or c["kind"] == "added" and (s, c["new_name"]) in come):
                    rows.append((s, c["kind"], c["old_name"], c["new_name"]))
                    own.append(i)
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("feed").take(pa.array(own, pa.int64())), *[pa.array(c, pa.string()) for c in cols]],
            names=["feed", "section", "kind", "old_name", "new_name"]
        )


def verified(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """(feed, section, kind, old_name, new_name, score, share) of the pairs whose contents agree well enough.

    pairs: feed, before, section, kind, old_name, new_name, score. The contents of both fields meet by file, pair and page,
    so a file that holds a third of all records is spread over its pages. Of a page that comes several times in a file the
    least contents count.
    """
    key = F.xxhash64("section", "old_name", "new_name").alias("pair")
    side = lambda k, feed, name: pairs.select(F.col(feed).alias("feed"), "section", F.col(name).alias("field"), F.col("feed").alias("at"), key, F.lit(k).alias("side"))
    sides = side(0, "before", "old_name").unionAll(side(1, "feed", "new_name"))
    content = held.where("page is not null").select(
        "feed", "section", "field", "page", "type", "whole", "leaf"
    ).join(sides, ["feed", "section", "field"])
    each = [F.min(F.when(F.col("side") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("type", "whole", "leaf")]
    both = content.groupBy("at", "pair", "page").agg(*each).where("type0 is not null and type1 is not null")
    same = (F.col("whole0") == F.col("whole1")) | ((F.col("type0") != F.col("type1")) & (F.col("leaf0") == F.col("leaf1")))
    by_value = both.groupBy("at", "pair", "leaf0").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("agree"))
    agreed = by_value.groupBy("at", "pair").agg(
        (F.sum("agree") / F.sum("n")).alias("share"), (F.sum(F.col("n") * F.col("n")) / F.sum("n") / F.sum("n")).alias("chance")
    )
    beyond = F.when(F.col("share") == 1, 1.0).when(F.col("chance") < 1, (F.col("share") - F.col("chance")) / (1 - F.col("chance"))).otherwise(0.0)
    named = pairs.withColumn("pair", key).join(agreed.withColumnRenamed("at", "feed"), ["feed", "pair"])
    return named.where(
        (F.col("share") >= SAME_CONTENT) & (beyond + F.col("score") >= EVIDENCE)
    ).select("feed", "section", "kind", "old_name", "new_name", "score", "share")


def changes(held: DataFrame, fields: DataFrame, pairs: DataFrame, match: Callable = flood) -> DataFrame:
    """(feed, section, kind, old_name, new_name): every change of each file against the one before it in its series.

    ``held`` and ``fields`` should be materialised, since they are read several times. A rename must hold the same
    content in at least SAME_CONTENT of the pages that are in both files with a value under either name, and reach EVIDENCE,
    so that two flags that agree often by chance are no rename; without such a page it is a removal and an addition. A
    file without records compares as one without fields. ``match`` scores the pairs of two schemas' fields.
    """
    kind = pairs.schema["feed"].dataType.simpleString()
    known, shape = schemas(fields), f"feed {kind}, section string, kind string, old_name string, new_name string"
    sides = pairs.join(known.withColumnRenamed("fields", "new"), "feed", "left").join(
        known.select(F.col("feed").alias("before"), F.col("fields").alias("old")), "before", "left"
    )
    found = sides.mapInArrow(
        _compare_pass(match), f"feed {kind}, before {kind}, section string, kind string, old_name string, new_name string, score double"
    )
    found = materialize(found, "changes")
    listed = lambda df, name, *c: df.groupBy("feed").agg(F.collect_list(F.struct(*c)).alias(name))
    of_match = ["section", "kind", "old_name", "new_name", "score", "share"]
    good = materialize(verified(held, found.where("kind = 'match'")), "matches")
    none = F.array().cast("array<struct<section:string,kind:string,old_name:string,new_name:string>>").alias("changes")
    taken = listed(good, "matches", *of_match).select("feed", none, "matches").mapInArrow(_select_pass, shape)
    rest = found.where("kind = 'rest'").join(taken, ["feed", "section", "old_name"], "left_anti").join(taken, ["feed", "section", "new_name"], "left_anti")
    late = verified(held, materialize(rest, "rest"))
    plain = listed(found.where("kind not in ('match', 'rest')"), "changes", "section", "kind", "old_name", "new_name")
    return plain.join(listed(good.unionByName(late), "matches", *of_match), "feed", "left").mapInArrow(_select_pass, shape)


def canonical_names(changed: DataFrame, pairs: DataFrame, files: DataFrame, feed: str, series: str, order: str) -> DataFrame:
    """(feed, section, field, name): for fields renamed at or before a file, the name they bore first in its series.

    Gathers per series its files' numbers and its renames, never its records.
    """
    kind = files.schema[feed].dataType.simpleString()
    renamed = changed.where("kind = 'renamed'").groupBy("feed").agg(F.collect_list(F.struct("section", "old_name", "new_name")).alias("renames"))
    loads = files.where(F.col(series).isNotNull() & F.col(order).isNotNull()).select(
        F.col(feed).alias("feed"), F.col(series).alias("series"), F.col(order).alias("load")
    )
    per = loads.join(renamed, "feed", "left").groupBy("series").agg(
        F.array_sort(F.collect_list(F.struct("load", "feed", "renames"))).alias("loads")
    ).where(F.exists("loads", lambda x: x["renames"].isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for loads in batch.column("loads").to_pylist():
                now: dict[tuple, str] = {}
                for x in loads:
                    moved = [((r["section"], r["old_name"]), (r["section"], r["new_name"])) for r in x["renames"] or []]
                    first = {new: now.get(old, old[1]) for old, new in moved}
                    now = {k: v for k, v in now.items() if k not in {old for old, _ in moved}} | first
                    rows += [(x["feed"], s, n, v) for (s, n), v in now.items() if n != v]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [feed_type, *[pa.string()] * 3])], names=["feed", "section", "field", "name"]
            )

    feed_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return per.mapInArrow(run, f"feed {kind}, section string, field string, name string")


class Target(NamedTuple):
    """A column of the consistent table."""

    column: str
    section: str
    name: str
    type: str


def targets(fields: DataFrame, names: DataFrame) -> list[Target]:
    """The columns of the consistent table: every name that exists in some file, with the type of most of its values over all files.

    What comes to the driver is bounded by the schema's names, as any table's schema is.
    """
    named = fields.join(names, ["feed", "section", "field"], "left").withColumn("name", F.coalesce("name", "field"))
    counts = named.groupBy("section", "name").agg(
        F.bool_or("exists").alias("exists"),
        *[F.sum(F.when(F.col("type") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(len(TYPES))]
    )
    out, taken = [], {}
    for r in sorted(counts.where("exists").collect(), key=lambda r: (SECTIONS.index(r["section"]), r["name"])):
        words = re.sub(r"[^0-9a-z]+", "_", re.sub(r"([a-z])([A-Z])", r"\1_\2", r["name"]).lower()).strip("_")
        column = ("details_", "additional_")[SECTIONS.index(r["section"])] + (words or "field")
        taken[column] = taken.get(column, 0) + 1  # names that differ in case and blanks alone are numbered
        most = max(range(len(TYPES)), key=lambda k: (r[f"n{k}"], -k))
        out.append(Target(column + f"_{taken[column]}" * (taken[column] > 1), r["section"], r["name"], TYPES[most]))
    return out


_TRUTH = {"yes": True, "y": True, "true": True, "no": False, "n": False, "false": False}


def _cast(value: object, to: str) -> object:
    """A value as a cell of a column of type ``to``; None where it doesn't fit."""
    if to == "string":
        return json_text(value[0] if type(value) is list and len(value) == 1 and type(value[0]) is str else value)
    if to == "number":
        try:
            number = float(value) if type(value) in (int, float, str) else None
        except (ValueError, OverflowError):
            return None
        return number if number is not None and number == number and abs(number) != float("inf") else None
    if to == "boolean":
        return value if type(value) is bool else _TRUTH.get(value.strip().lower()) if type(value) is str else None
    if to == "list":
        return json.dumps(value if type(value) is list else [value], ensure_ascii=False)
    return json.dumps(value, ensure_ascii=False) if type(value) is dict else None


def unified(items: DataFrame, key: str, feed: str, record: str, names: DataFrame, columns: list[Target]) -> DataFrame:
    """(key, feed, a column for each target, other): all records in one consistent table, a row each.

    A field comes under the name it bore first in its series, cast to its column's type: numbers double, flags boolean
    (``Yes`` and ``No`` too), lists and objects as JSON, all else text (a list of one text as that text, other lists and objects
    as JSON); a single value in a list's column is a list of one.
    other: by section and name, as JSON, what has no column or doesn't fit its type, so nothing is lost; of two values for
    one column the second. Records that are no JSON object are rows of nulls. Nulls of the record are null. A record's
    cells need only its own file's names, so no value is shuffled.
    """
    kinds = [items.schema[c].dataType.simpleString() for c in (key, feed)]
    spark_type = {"number": ("double", pa.float64()), "boolean": ("boolean", pa.bool_())}
    at = {(t.section, t.name): (i, t.type) for i, t in enumerate(columns)}
    renamed = names.groupBy(F.col("feed").alias("_feed")).agg(F.collect_list(F.struct("section", "field", "name")).alias("renames"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                cells, other = [[None] * part.num_rows for _ in columns], [[] for _ in range(part.num_rows)]
                renames = [{(r["section"], r["field"]): r["name"] for r in x or []} for x in part.column(3).to_pylist()]
                for i, item in _records(part, 2):
                    for section in SECTIONS:
                        for name, value in section_fields(item.get(section)).items():
                            if value is None:
                                continue
                            name = renames[i].get((section, name), name)
                            place, to = at.get((section, name), (None, None))
                            fit = _cast(value, to) if to and cells[place][i] is None else None
                            if fit is None:
                                other[i].append((f"{section}/{name}", json.dumps(value, ensure_ascii=False)))
                            else:
                                cells[place][i] = fit
                maps = pa.array([list(dict(x).items()) for x in other], pa.map_(pa.string(), pa.string()))
                arrays = [pa.array(c, spark_type.get(t.type, ("", pa.string()))[1]) for c, t in zip(cells, columns)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *arrays, maps], names=[key, feed, *[t.column for t in columns], "other"]
                )

    shape = ", ".join([
        f"`{key}` {kinds[0]}", f"`{feed}` {kinds[1]}", *[f"`{t.column}` {spark_type.get(t.type, ('string',))[0]}" for t in columns],
        "other map<string,string>"
    ])
    rows = spread(items.select(key, feed, F.col(record).cast("string").alias("record"))).join(renamed, F.col(feed) == F.col("_feed"), "left")
    return rows.select(key, feed, "record", "renames").mapInArrow(run, shape)


def record_pages(items: DataFrame, key: str, record: str, batch: str) -> DataFrame:
    """(key, batch, page): the page of each record's Airport Details, null where it has none."""
    kinds = {c: items.schema[c].dataType.simpleString() for c in (key, batch)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            pages = []
            for text in part.column(2).to_pylist():
                try:
                    item = unfold(parse(text))
                    pages.append(page_of(section_fields(item.get(SECTIONS[0]))) if isinstance(item, dict) else None)
                except ValueError:
                    pages.append(None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(pages, pa.string())], names=[key, batch, "page"])

    return spread(
        items.select(key, batch, F.col(record).cast("string").alias("record"))
    ).mapInArrow(run, f"`{key}` {kinds[key]}, `{batch}` {kinds[batch]}, page string")
