"""Duplicates of each new batch against all history, by graph index shards.

The history is a folder of shards. Every accepted batch adds one: navigable small-world graphs (see ``smallworld``) of
the pages it brought, cut into segments by a hash of the half of a code that leads in the graph's metric. A batch is
routed by the same hash, so a task opens just the graphs of its own segment, straight from the shared folder: no graph
and no earlier row is shuffled, and a small batch leaves all other segments unread. Shards of one size class are merged,
so there are few; a merged shard has more segments, so that no graph outgrows its bound.

Two codes that differ in one place share a half, so each page has a node in two graphs, one for either half leading.
Only pages are nodes: a mistyped code is resolved to its page and needs none. A page that holds a third of all rows is
one node and one query.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.links import CODE_LENGTH
from ..session import materialize, own_folder, parallelism, remove_at_end, uri
from .smallworld import HALF_CODES, Graph, turn

#: Nodes that a graph holds on average at most; a shard has the power of two of segments that this takes.
SEGMENT_NODES = 1 << 15
#: Shards of one size class (a power of FAN) are merged when there are so many.
FAN = 4

_GRAPH = "space string, ring int, segment int, nodes int, beam int, sampled int, near int, found int, keys binary, firsts binary, sizes binary, links binary"
_GRAPH_TYPES = pa.schema(
    [("space", pa.string())] + [(n, pa.int32()) for n in ("ring", "segment", "nodes", "beam", "sampled", "near", "found")] + [(n, pa.binary()) for n in ("keys", "firsts", "sizes", "links")]
)
_MIX, _BITS = 2654435769, 32


def code_number(code: Column) -> Column:
    """A page code as the number its letters and digits make to the base 36; null for anything but a whole code in lower case."""
    return F.when(code.rlike(rf"\A[a-z0-9]{{{CODE_LENGTH}}}\z"), F.conv(code, 36, 10).cast("bigint"))


def segment_bits(nodes: int) -> int:
    """Of how many bits of the hash a shard of so many nodes makes its segments."""
    return max(0, (-(-nodes // SEGMENT_NODES) - 1).bit_length())


def on_rings(codes: DataFrame, bits: int, *keep: str) -> DataFrame:
    """(space, ring, segment, key, keep...): each code under either half leading, and the segment that half is routed to."""
    half, rest = F.expr(f"number div {HALF_CODES}"), F.col("number") % HALF_CODES
    node = lambda ring, key, lead: F.struct(F.lit(ring).alias("ring"), key.alias("key"), lead.alias("lead"))
    both = F.explode(F.array(node(0, F.col("number"), half), node(1, rest * HALF_CODES + half, rest)))
    mixed = (F.col("n.lead") * _MIX).bitwiseAND((1 << _BITS) - 1)
    return codes.select("space", both.alias("n"), *keep).select(
        "space", "n.ring", F.shiftright(mixed, _BITS - bits).cast("int").alias("segment"), "n.key", *keep
    )


def _segments(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys // HALF_CODES * _MIX & ((1 << _BITS) - 1)) >> (_BITS - bits)


def _folder(space: str, ring: int, segment: int) -> str:
    return f"graph={space.encode().hex()}-{ring}-{segment}"


def _open(root: str, shard: str, space: str, ring: int, segment: int) -> Graph | None:
    """One graph of a shard; None where the shard has no node in that segment."""
    where, path = fs.FileSystem.from_uri(root)
    folder = posixpath.join(path, shard, _folder(space, ring, segment))
    rows = []
    for f in where.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if f.path.endswith(".parquet"):
            rows += pq.ParquetFile(where.open_input_file(f.path)).read().to_pylist()
    return Graph.unpack(rows[0]) if rows else None


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, dict[str, np.ndarray]]]:
    """(space, ring, segment, columns) of what a task was given."""
    parts = list(batches)
    if not parts or not sum(p.num_rows for p in parts):
        return
    t = pa.Table.from_batches(parts)
    names = t.column("space").combine_chunks().dictionary_encode()
    cols = {c: t.column(c).to_numpy() for c in t.column_names if c != "space"}
    which = names.indices.to_numpy()
    order = np.lexsort((cols["key"], cols["segment"], cols["ring"], which))
    edge = np.zeros(len(order), bool)
    for c in (which, cols["ring"], cols["segment"]):
        edge |= np.r_[True, np.diff(c[order]) != 0]
    starts = [*np.flatnonzero(edge).tolist(), len(order)]
    for a, b in zip(starts, starts[1:]):
        own = order[a:b]
        yield names.dictionary[int(which[own[0]])].as_py(), int(cols["ring"][own[0]]), int(cols["segment"][own[0]]), {c: v[own] for c, v in cols.items()}


def _graph_batch(space: str, ring: int, segment: int, graph: Graph) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"space": space, "ring": ring, "segment": segment, **graph.pack()}], schema=_GRAPH_TYPES)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for space, ring, segment, c in _groups(batches):
        yield _graph_batch(space, ring, segment, Graph.build(c["key"], c["own_id"]))


class History:
    """The persistent index: shards in a folder, and a manifest of those that count.

    A shard is a folder of graphs, one for each space, ring and segment. ``accept`` checks a batch and adds its shard,
    ``compact`` merges shards. The manifest is replaced last, so that a lost job leaves the index as it was; a batch
    accepted again adds no node twice. Spaces are apart from each other.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, uri(path.rstrip("/"))
        self.shards: list[dict] = self._load()

    def _load(self) -> list[dict]:
        where, root = fs.FileSystem.from_uri(self.path)
        try:
            with where.open_input_stream(posixpath.join(root, "manifest.json")) as f:
                return json.loads(f.read())["shards"]
        except FileNotFoundError:
            return []

    def _save(self, shards: list[dict]) -> None:
        where, root = fs.FileSystem.from_uri(self.path)
        where.create_dir(root)
        with where.open_output_stream(posixpath.join(root, "manifest.new")) as f:
            f.write(json.dumps({"shards": shards}).encode())
        where.move(posixpath.join(root, "manifest.new"), posixpath.join(root, "manifest.json"))
        self.shards = shards

    def _next(self) -> str:
        return f"shard-{1 + max([int(s['name'].split('-')[1]) for s in self.shards], default=0):06d}"

    def _write(self, graphs: DataFrame, name: str) -> None:
        folder = F.concat_ws("-", F.lower(F.hex(F.encode("space", "UTF-8"))), "ring", "segment")
        graphs.withColumn("graph", folder).write.mode("overwrite").partitionBy("graph").parquet(f"{self.path}/{name}")

    def _tasks(self, nodes: int) -> int:
        return max(1, min(4 * parallelism(self.spark), -(-nodes // (SEGMENT_NODES // 4))))

    def resolve(self, rows: DataFrame, expected: int | None = None, into: str | None = None) -> DataFrame:
        """(space, number, own_id, first_id) of a batch's distinct codes: the first row of each in the batch, and of its page in all that arrived; pages not seen before become a shard.

        rows: id (rising with arrival), number, and space if there are several; null numbers are no case. ``expected``:
        how many rows there are, counted if not given; ``into``: the folder the result is written to.
        """
        rows = rows.where(F.col("number").isNotNull())
        rows = rows if "space" in rows.columns else rows.withColumn("space", F.lit(""))
        expected = rows.count() if expected is None else expected
        codes = rows.groupBy("space", "number").agg(F.min("id").alias("own_id"))
        bits = max([segment_bits(expected), *[s["bits"] for s in self.shards]])
        shards, root = [(s["name"], bits - s["bits"]) for s in self.shards], self.path

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for space, ring, segment, c in _groups(batches):
                key, own = c["key"], c["own_id"]
                first, seen = own.copy(), np.zeros(len(key), bool)
                for name, fewer in shards:
                    graph = _open(root, name, space, ring, segment >> fewer)
                    if graph is not None:
                        asked = graph.asked(key)
                        q, node = graph.search(key[asked])
                        np.minimum.at(first, asked[q], graph.firsts[node])
                        seen[asked[q]] = True
                graph = Graph.build(key, own)
                q, node = graph.search(key)
                np.minimum.at(first, q, graph.firsts[node])
                n = len(key)
                columns = [pa.array([space] * n, pa.string()), pa.array(turn(key) if ring else key), pa.array(own), pa.array(first), pa.array(seen)]
                yield pa.RecordBatch.from_arrays(columns, names=["space", "number", "own_id", "first_id", "seen"])

        tasks = self._tasks(2 * expected)
        routed = on_rings(codes, bits, "own_id").repartition(tasks, "space", "ring", "segment")
        near = routed.mapInArrow(search, "space string, number bigint, own_id bigint, first_id bigint, seen boolean")
        known = near.groupBy("space", "number").agg(
            F.min("own_id").alias("own_id"), F.min("first_id").alias("first_id"), F.bool_or("seen").alias("seen")
        )
        fresh = (F.col("own_id") == F.col("first_id")) & ~F.col("seen")
        new = Observation()
        known = materialize(known.observe(new, F.count_if(fresh).alias("n")), "known", path=into)
        nodes = new.get["n"]
        if nodes:
            name, own_bits = self._next(), segment_bits(nodes)
            graphs = on_rings(known.where(fresh), own_bits, "own_id").repartition(self._tasks(2 * nodes), "space", "ring", "segment").mapInArrow(_build, _GRAPH)
            self._write(graphs, name)
            self._save([*self.shards, {"name": name, "nodes": nodes, "bits": own_bits}])
        return known.drop("seen")

    def accept(self, batch: DataFrame) -> DataFrame:
        """([space,] first_id, later_id) of a batch's rows ([space,] id, code) whose page is known, from history or from earlier in the batch; its new pages become a shard."""
        rows = batch.withColumn("number", code_number(F.col("code"))).drop("code")
        known = self.resolve(rows)
        keep = ["space"] * ("space" in batch.columns)
        return _later(rows if keep else rows.withColumn("space", F.lit("")), known).select(*keep, "first_id", "later_id")

    def compact(self) -> int:
        """Merges each size class that has FAN shards or more, with all smaller shards, and the class above if that fills it, in one pass; returns how many shards remain. The merged folders are removed."""
        size_class = lambda s: int(np.log(max(s["nodes"], 1)) / np.log(FAN))
        now = [{**s, "of": [s["name"]]} for s in self.shards]
        while True:
            by: dict[int, list[dict]] = {}
            for s in now:
                by.setdefault(size_class(s), []).append(s)
            full = next((c for c in sorted(by) if len(by[c]) >= FAN), None)
            if full is None:
                break
            old = [s for s in now if size_class(s) <= full]  # smaller ones along with them: few nodes, but as many graphs to open
            now = [s for s in now if size_class(s) > full] + [{"nodes": sum(s["nodes"] for s in old), "of": [n for s in old for n in s["of"]]}]
        for s in [s for s in now if len(s["of"]) > 1]:
            self._merge(s["of"], s["nodes"])
        return len(self.shards)

    def _merge(self, names: list[str], nodes: int) -> None:
        where, path = fs.FileSystem.from_uri(self.path)
        old = [s for s in self.shards if s["name"] in names]
        bits, root, name = segment_bits(nodes), self.path, self._next()
        listed = {
            f.base_name.removeprefix("graph=") for s in old for f in where.get_file_info(fs.FileSelector(posixpath.join(path, s["name"]))) if f.base_name.startswith("graph=")
        }
        groups = sorted({(bytes.fromhex(x).decode(), int(r), k) for x, r, _ in (g.split("-") for g in listed) for k in range(1 << bits)})
        parts = [(s["name"], s["bits"]) for s in old]

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g in batch.to_pylist():
                    keys, firsts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                    for shard, own in parts:
                        segments = [g["segment"] >> (bits - own)] if own <= bits else range(
                            g["segment"] << (own - bits), (g["segment"] + 1) << (own - bits)
                        )
                        for k in segments:
                            graph = _open(root, shard, g["space"], g["ring"], k)
                            if graph is not None:
                                here = _segments(graph.keys, bits) == g["segment"]
                                keys.append(graph.keys[here])
                                firsts.append(graph.firsts[here])
                    if sum(map(len, keys)):
                        yield _graph_batch(g["space"], g["ring"], g["segment"], Graph.build(np.concatenate(keys), np.concatenate(firsts)))

        todo = self.spark.createDataFrame(groups, "space string, ring int, segment int").repartition(
            min(len(groups), 4 * parallelism(self.spark)), "space", "ring", "segment"
        )
        self._write(todo.mapInArrow(merge, _GRAPH), name)
        self._save([s for s in self.shards if s["name"] not in names] + [{"name": name, "nodes": nodes, "bits": bits}])
        for gone in names:
            where.delete_dir(posixpath.join(path, gone))

    def graphs(self) -> DataFrame:
        """(shard, space, ring, segment, nodes, beam, sampled, near, found) of each graph: its size, and how its beam was tuned against exhaustive search."""
        named = [
            self.spark.read.schema(_GRAPH).parquet(f"{self.path}/{s['name']}").select(F.lit(s["name"]).alias("shard"), *_GRAPH_TYPES.names[:8]) for s in self.shards
        ]
        return reduce(DataFrame.unionAll, named) if named else self.spark.createDataFrame([], "shard string, " + _GRAPH.split(", keys")[0])


def _later(rows: DataFrame, known: DataFrame, *also: str) -> DataFrame:
    on = ["space", "number", *also]
    return rows.join(known.drop("own_id", "seen"), on).where("id > first_id").select("space", "first_id", F.col("id").alias("later_id"))


def runs(batches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first batch, last batch, rows) of the runs that batches (number, rows; in order) are accepted in.

    A run is closed once it holds a FAN-th of the rows before it. So large batches are runs of their own, while the runs
    of many small ones grow with the history: their number is a logarithm of the rows, and the history read for all of
    them stays in proportion to the rows however many batches there are.
    """
    out: list[tuple[int, int, int]] = []
    first, held, before = None, 0, 0
    for batch, n in batches:
        first, held = batch if first is None else first, held + n
        if FAN * held >= before:
            out.append((first, batch, held))
            first, held, before = None, 0, before + held
    return out if first is None else [*out, (first, batches[-1][0], held)]


def arrive(rows: DataFrame, history: History) -> tuple[DataFrame, DataFrame]:
    """(rows, known): all batches of ``rows`` accepted one after another, in the order of their numbers, small ones by runs.

    rows: space, id, batch, number; null numbers are no case, rows without a batch arrive last. They are written once, a
    folder for each batch, so that a batch is read without the others. What comes to the driver is a row per batch.
    Within a run the earlier row counts, as within a batch, so results don't depend on where runs are cut.
    Out come rows: space, id, number, batch, run; known: run, space, number, own_id, first_id, as resolved when the run arrived.
    """
    rows = rows.where(F.col("number").isNotNull()).select("space", "id", "number", F.coalesce("batch", F.lit((1 << 63) - 1)).alias("batch"))
    rows = materialize(rows, "codes", "batch")
    path, shape = own_folder(rows.sparkSession, "resolved"), "space string, number bigint, own_id bigint, first_id bigint, seen boolean, run int"
    cut = runs(sorted(map(tuple, rows.groupBy("batch").count().collect())))
    for k, (first, last, n) in enumerate(cut):
        history.resolve(rows.where(F.col("batch").between(first, last)).drop("batch"), n, f"{path}/run={k}")
        history.compact()
    run = reduce(Column.__add__, [(F.col("batch") > last).cast("int") for _, last, _ in cut], F.lit(0))
    read = rows.sparkSession.read.schema(shape)
    return rows.withColumn("run", run), (read.parquet(path) if cut else rows.sparkSession.createDataFrame([], shape))


def duplicates(rows: DataFrame, space: str = "space", history: History | None = None) -> DataFrame:
    """(space, first_id, later_id): each row whose page an earlier row of its space leads to, with that page's first row.

    rows: space, id (unique in its space, rising with arrival), batch, code (null, or no whole code: no case). Batch by batch,
    small batches by runs, through ``history``, a new one in the shared folder if none is given. At the end the rows join what
    their own run resolved their code to; a hot code's rows are spread over the runs, and further by adaptive skew handling.
    """
    spark = rows.sparkSession
    if history is None:
        path = own_folder(spark, "history")
        history = History(spark, path)
    rows, known = arrive(
        rows.select(F.col(space).cast("string").alias("space"), "id", F.col("batch").cast("bigint").alias("batch"), code_number(F.col("code")).alias("number")),
        history
    )
    if history.shards:
        remove_at_end(spark, history.path)
    return _later(rows, known, "run").withColumnRenamed("space", space)
