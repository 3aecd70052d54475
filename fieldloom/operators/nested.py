"""Nested records to related flat tables by Dewey labels.

Every node of a record gets the ordinal path that leads to it (``0.2.1``); a parent's label is its child's, truncated;
objects with one schema path (names, with ``[]`` for list positions) form one table. One Arrow pass parses each record
once, without a shuffle: its cost is that of its own records and no task depends on another's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

NODES = "dewey string, up int, node_path string, cut int, schema_path string, fields map<string,string>, element boolean, value string"

_SCAN = json.JSONDecoder(strict=False)
#: Numbers beyond the interpreter's digits stay text.
_WIDE = json.JSONDecoder(strict=False, parse_int=lambda s: int(s) if len(s) < 4000 else s)
_OPENS = re.compile(r"[ \t\r\n]*[\[{]")


def parse(text: str | None) -> object:
    """The JSON value of a text; ValueError where it is none. Nesting deeper than the parser's stack is such a case."""
    if text is None:
        raise ValueError("null")
    body = text.strip(" \t\r\n\ufeff")
    try:
        value, end = _SCAN.raw_decode(body)
    except RecursionError:
        raise ValueError("too deep") from None
    except ValueError:
        try:
            value, end = _WIDE.raw_decode(body)
        except RecursionError:
            raise ValueError("too deep") from None
    if end != len(body):
        raise ValueError("more than one value")
    return value


def unfold(value: object) -> object:
    """A string that is itself the text of a JSON object or list, as what it holds, however often it was wrapped."""
    while type(value) is str and _OPENS.match(value):
        try:
            value = parse(value)
        except ValueError:
            break
    return value


def json_text(value: object) -> str | None:
    """A scalar as a table cell: strings bare, null as null, others as JSON."""
    return value if type(value) is str or value is None else json.dumps(value, ensure_ascii=False)


def objects(root: object, values: bool) -> Iterator[tuple]:
    """(dewey, up, node_path, cut, schema_path, fields, element, value) of each object, the root's own included, and with ``values`` of each scalar in a list.

    element: whether it is such a scalar, which has its text as value, no fields, and the path and label of its place in
    the list; a JSON null in a list is one with a null value. up: how many ordinals lie between the object and the nearest object around it; cut: the length of that object's
    node_path. Iterative, so depth is bounded by that of the parser, see parse.
    """
    root = unfold(root)
    stack = [("", 0, "", 0, "", root)]
    while stack:
        dewey, up, path, cut, shape, node = stack.pop()
        dot, slash = dewey and dewey + ".", path and path + "/"
        if type(node) is dict:
            fields = {} if values else None
            edge = shape and shape + "/"
            for i, (name, value) in enumerate(node.items()):
                kind = type(value)
                if kind is str and value and value[0] in "{[ \t\r\n":
                    value = unfold(value)
                    kind = type(value)
                if kind is dict or kind is list:
                    label = name.replace("~", "~0").replace("/", "~1") if "/" in name or "~" in name else name
                    stack.append((f"{dot}{i}", 1, slash + name, len(path), edge + label, value))
                elif values:
                    fields[name] = json_text(value)
            yield dewey, up, path, cut, shape, fields, False, None
        elif type(node) is list:
            shape += "[]"
            for i, value in enumerate(node):
                value = unfold(value)
                if type(value) is dict or type(value) is list:
                    stack.append((f"{dot}{i}", up + 1, f"{slash}{i}", cut, shape, value))
                elif values:
                    yield f"{dot}{i}", up + 1, f"{slash}{i}", cut, shape, None, True, json_text(value)


def flatten(df: DataFrame, key: str, record: str, values: bool = True) -> DataFrame:
    """Nodes: one row per JSON object of each record, and with ``values`` one per scalar in a list, as ``key``, NODES and ``error``.

    The root of a record has dewey and node_path ``''``. fields: an object's scalars by name, null where ``values`` is off.
    A scalar in a list belongs to no object's fields: its row has ``element`` true and its text as ``value``. A null record, or a text that isn't one JSON value, comes out as one row
    with null labels and the reason in ``error``; a record that is a scalar gives no row. Other columns of ``df`` are
    not read, so their names can't clash. Rows that stand twice come out twice.
    """
    kind = df.schema[key].dataType.simpleString()
    typed = pa.map_(pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, len(keys), 512):
                rows, own = [], []
                for i, text in enumerate(texts[at : at + 512].to_pylist(), at):
                    try:
                        found = list(objects(parse(text), values))
                        rows += [(*x, None) for x in found]
                    except ValueError as e:
                        found = [()]
                        rows.append((None,) * 8 + (str(e)[:200],))
                    own += [i] * len(found)
                cols = list(zip(*rows)) or [()] * 9
                fields = [None if m is None else list(m.items()) for m in cols[5]]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(own, pa.int64())), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.string()), pa.array(fields, typed), pa.array(cols[6], pa.bool_()), pa.array(cols[7], pa.string()), pa.array(cols[8], pa.string())],
                    names=["key", "dewey", "up", "node_path", "cut", "schema_path", "fields", "element", "value", "error"],
                )

    out = spread(df.select(
        F.col(key).alias("key"), F.col(record).cast("string").alias("record")
    )).mapInArrow(run, f"key {kind}, {NODES}, error string")
    return out.withColumnRenamed("key", key)


def parent_path() -> Column:
    """The nearest object around a node, by truncating its path at that object's own end."""
    return F.substring(F.col("node_path"), F.lit(1), F.col("cut"))


def parent_dewey() -> Column:
    """The label of the nearest object around a node: its own without the last ``up`` ordinals."""
    parts = F.split(F.col("dewey"), r"\.")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - F.col("up"), F.lit(0))), ".")


def links(nodes: DataFrame, key: str) -> DataFrame:
    """Each object below a record's root with the object it is nested in."""
    return nodes.where("dewey <> '' and not element").select(key, parent_path().alias("parent_path"), "node_path")


def table_at(nodes: DataFrame, key: str, schema_path: str, columns: list[str]) -> DataFrame:
    """The flat table of one schema path: key, dewey, parent_dewey, and a string column for each field asked for.

    Absent fields and JSON nulls are null, ``''`` and ``'N/A'`` stay as they are. A column named like the key or a label
    gets ``_`` appended.
    """
    taken = {key, "dewey", "parent_dewey"}
    return nodes.where((F.col("schema_path") == schema_path) & ~F.col("element")).select(
        key, "dewey", parent_dewey().alias("parent_dewey"), *[F.col("fields").getItem(c).alias(c + "_" * (c in taken)) for c in columns]
    )


def all_objects(nodes: DataFrame, key: str) -> DataFrame:
    """Every object of every table with its labels, schema path and all of its scalar fields by name. Nodes must be flattened with values."""
    return nodes.where("not element").select(key, "dewey", parent_dewey().alias("parent_dewey"), "schema_path", "fields")


def list_values(nodes: DataFrame, key: str) -> DataFrame:
    """The child table of lists: each scalar in one, with the label of its place, that of the object around the list, and the list's schema path. Nodes must be flattened with values."""
    return nodes.where("element").select(key, "dewey", parent_dewey().alias("parent_dewey"), "schema_path", "value")


#: Texts of whole numbers and of numbers. Leading zeros make a text, as in codes.
_WHOLE, _NUMBER = r"\A-?(?:0|[1-9][0-9]{0,17})\z", r"\A-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?\z"


def all_fields(nodes: DataFrame, key: str) -> DataFrame:
    """(key, dewey, schema_path, field_name, value): a row for each scalar field of each object. Nodes must be flattened with values."""
    rows = nodes.where("not element").select(F.col(key).alias("key"), "dewey", "schema_path", F.explode("fields").alias("field_name", "value"))
    return rows.withColumnRenamed("key", key)


def columns_of(nodes: DataFrame) -> DataFrame:
    """(schema_path, field_name, type, n_rows, n_values): the columns of every flat table.

    type: bigint, double or boolean if all values that aren't null are written as such, else string; a column of nulls is
    a string.
    """
    fields = nodes.where("not element").select("schema_path", F.explode("fields").alias("field_name", "value"))
    v = F.col("value")
    tests = {"bigint": v.rlike(_WHOLE), "double": v.rlike(_NUMBER), "boolean": v.isin("true", "false")}
    fits = [F.count_if(t).alias(n) for n, t in tests.items()]
    per = fields.groupBy("schema_path", "field_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), *fits)
    kind = F.coalesce(*[F.when((F.col("n_values") > 0) & (F.col(n) == F.col("n_values")), n) for n in tests], F.lit("string"))
    return per.select("schema_path", "field_name", kind.alias("type"), "n_rows", "n_values")


def tables(nodes: DataFrame, key: str) -> dict[str, DataFrame]:
    """The flat table of every schema path: key, dewey, parent_dewey, and a typed column for each of its fields.

    Nodes are written once, a folder for each path, so a table reads its own rows only. What comes to the driver are the
    tables' columns. A column named like the key, a label or another column but for case gets a number. Absent fields
    and JSON nulls are null. The scalars in a list are the table of the list's path: key, dewey, parent_dewey, value.
    """
    path = F.concat(F.lit("$"), F.col("schema_path"), F.when(F.col("element"), ":values").otherwise(""))
    rows = nodes.where("error is null").select(
        F.col(key).alias("_key"), "dewey", parent_dewey().alias("parent_dewey"), "schema_path", "element", "fields", "value",
        path.alias("of")
    )
    rows = materialize(rows, "nodes", "of")
    columns: dict[str, list] = {r["schema_path"]: [] for r in rows.where("not element").select("schema_path").distinct().collect()}
    for r in sorted(columns_of(rows).collect(), key=lambda r: (r["schema_path"], r["field_name"])):
        columns[r["schema_path"]].append(r)
    labels = [F.col("_key").alias(key), "dewey", "parent_dewey"]
    out = {}
    for p, own in columns.items():
        taken, cells = {key.lower(): 1, "dewey": 1, "parent_dewey": 1}, []
        for r in own:
            name = r["field_name"]
            taken[name.lower()] = n = taken.get(name.lower(), 0) + 1
            cells.append(F.col("fields").getItem(r["field_name"]).cast(r["type"]).alias(f"{name}_{n}" if n > 1 else name))
        out[p] = rows.where(F.col("of") == "$" + p).select(*labels, *cells)
    for r in rows.where("element").select("schema_path").distinct().collect():
        out[r["schema_path"] + ":values"] = rows.where(F.col("of") == f"${r['schema_path']}:values").select(*labels, "value")
    return out


def write_tables(nodes: DataFrame, key: str, path: str) -> dict[str, str]:
    """Writes every flat table, typed, to a folder of its own; returns the folders by schema path. Their number is that of the schema's objects and lists of scalars."""
    out = {}
    for i, (p, df) in enumerate(sorted(tables(nodes, key).items())):
        out[p] = f"{path}/{i:04d}-" + (re.sub("[^A-Za-z0-9]+", "_", p).strip("_") or "record")
        df.write.mode("overwrite").parquet(out[p])
    return out
