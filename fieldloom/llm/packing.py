"""Packing whole documents into containers of a fixed capacity, with every window at the target mixture of sources.

Each source is a queue. Deficit round-robin serves queue s at its target rate w_s and carries what it is short of from
one window to the next. Served in fluid form, the round in which an item's turn comes is (tokens of its queue before
it) / w_s, so the deficits carried across partitions and windows are prefix sums of token counts: two small folds and a
window function over bounded buckets, with no task that holds a queue as a whole. A source falls short of its target by
less than one item at any window's end. Inside a window, which is bounded in tokens, items are placed by best fit,
largest first.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, parallelism

#: Containers a window has room for, and items a bucket of a queue should hold.
WINDOW_CONTAINERS, BUCKET_ITEMS = 256, 20_000
#: Container ids are window times this plus the place in the window.
WINDOW_IDS = 1 << 20
#: Windows that a prefix sum takes in one go.
BLOCK_WINDOWS = 10_000


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item, numbered from 0: largest first, each into the fullest container with room; of equals the first opened."""
    out, rooms, opened = [0] * len(sizes), [], 0  # rooms: (room, container), ascending
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(rooms, (sizes[i], -1))
        if at == len(rooms):
            room, c, opened = capacity, opened, opened + 1
        else:
            room, c = rooms.pop(at)
        out[i] = c
        if room > sizes[i]:
            insort(rooms, (room - sizes[i], c))
    return out


def _served(turn: Column, listed: list[tuple[float, float]]) -> Column:
    """All tokens served when every queue has had ``turn``: each queue its rate times the turn, until it is empty."""
    out = F.lit(0.0)
    for total, rate in listed:
        out = out + F.least(F.lit(float(total)), turn * F.lit(float(rate)))
    return out


class Rates(NamedTuple):
    """How queues are served: the named ones' totals and rates, and those of all others together."""

    named: dict[str, tuple[float, float]]
    rest: tuple[float, float]
    total: float

    @property
    def listed(self) -> list[tuple[float, float]]:
        return [*self.named.values(), self.rest]

    def turn(self, position: Column) -> Column:
        """The turn at which so many tokens have been served in all, from the turns at which queues run empty."""
        ends = sorted({0.0, *[t / r for t, r in self.listed if t > 0]})
        served = lambda x: sum(min(t, r * x) for t, r in self.listed)
        out = F.lit(ends[-1])
        for a, b in zip(reversed(ends[:-1]), reversed(ends[1:])):
            slope = (served(b) - served(a)) / (b - a)
            out = F.when(position < served(b), F.lit(a) + (position - F.lit(served(a))) / F.lit(slope)).otherwise(out)
        return out


def rates(totals: DataFrame, mixture: dict[str, float]) -> Rates:
    """totals: (queue, m). Collects the totals of the named queues."""
    named = {"=" + s: float(w) for s, w in mixture.items() if w > 0}
    have = {r["queue"]: r["m"] for r in totals.where(F.col("queue").isin(*named)).groupBy("queue").agg(F.sum("m").alias("m")).collect()}
    total = totals.agg(F.sum("m")).first()[0] or 0
    rest = total - sum(have.values())
    rest_rate = max(1 - sum(named.values()), 0) or (rest / max(total, 1)) or 1.0
    return Rates({q: (float(have.get(q, 0)), w) for q, w in named.items()}, (float(rest), rest_rate), float(total))


def _queue(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def pack(
    sizes: DataFrame, key: str, source: str, tokens: str, capacity: int, mixture: dict[str, float] | None = None,
    window_containers: int = WINDOW_CONTAINERS
) -> DataFrame:
    """(key, piece_no, start_token, n_tokens, source, window_no, container_id): each document in one container.

    ``sizes`` should be materialised, as it is read three times. A document of more than ``capacity`` tokens is cut into
    full containers and one rest, numbered from 0; no other is. Documents without tokens (or with a null count) take no
    room and lie in the first container of a window. ``mixture``: target shares of sources in every window, the sources
    it doesn't name sharing what is left of 1 (or, where nothing is left, coming in their own proportion with the rest);
    without it, the corpus's own shares. Queues that run empty leave their share to the others. Null sources are a queue.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = sizes.sparkSession
    buckets = max(parallelism(spark), -(-sizes.count() // BUCKET_ITEMS))
    docs = sizes.select(F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("n"))
    docs = docs.withColumn("queue", _queue(F.col("source"))).withColumn("mark", F.xxhash64("key")).withColumn("bucket", F.pmod("mark", F.lit(buckets)).cast("int"))
    # prefix sums, first over buckets, then within
    folded = docs.where("n > 0").groupBy("queue", "bucket").agg(F.sum("n").alias("m"))
    by_bucket = Window.partitionBy("queue").orderBy("bucket")
    before = folded.select(
        "queue", "bucket", (F.sum("m").over(by_bucket) - F.col("m")).alias("ahead"),
        F.sum("m").over(Window.partitionBy("queue")).alias("queue_total")
    )
    total = folded.agg(F.sum("m")).first()[0] or 0
    windows = max(1, round(total / (capacity * window_containers)))
    cap = F.lit(capacity)
    inside = Window.partitionBy("queue", "bucket").orderBy("mark", "key", "n").rowsBetween(Window.unboundedPreceding, -1)
    items = docs.where("n > 0").withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, ["queue", "bucket"])
    items = items.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / cap).cast("bigint") - 1)))
    items = items.withColumn("start_token", F.col("piece_no") * cap).withColumn(
        "size", F.least(cap.cast("bigint"), F.col("n") - F.col("start_token"))
    )
    done = F.col("ahead") + F.col("local") + F.col("start_token")
    if mixture:
        plan = rates(folded, mixture)
        rate = F.lit(plan.rest[1] / max(plan.rest[0], 1)) * F.col("queue_total")
        for q, (_, w) in plan.named.items():
            rate = F.when(F.col("queue") == q, F.lit(w)).otherwise(rate)
        position = _served(done / rate, plan.listed)
    else:
        position = done / F.col("queue_total") * F.lit(float(total))
    items = items.withColumn("window_no", F.least(F.floor(position * windows / F.lit(float(max(total, 1)))), F.lit(windows - 1)).cast("bigint"))
    kind, source_kind = sizes.schema[key].dataType.simpleString(), sizes.schema[source].dataType.simpleString()

    def place(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("mark", "ascending"), ("piece_no", "ascending")])
        slots = np.array(best_fit(t.column("size").to_pylist(), capacity), np.int64)
        return t.drop_columns(["size", "mark"]).append_column("n_tokens", t.column("size")).append_column(
            "container_id", pa.array(slots + t.column("window_no")[0].as_py() * WINDOW_IDS)
        )

    shape = f"key {kind}, source {source_kind}, piece_no bigint, start_token bigint, window_no bigint, n_tokens bigint, container_id bigint"
    placed = items.select("key", "source", "piece_no", "start_token", "window_no", "size", "mark").groupBy("window_no").applyInArrow(place, shape)
    # documents without tokens lie in the first containers, spread over the windows
    lone = F.pmod("mark", F.lit(windows)).cast("bigint")
    empty = docs.where("n <= 0").select(
        "key", "source", F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("start_token"), lone.alias("window_no"),
        F.lit(0).cast("bigint").alias("n_tokens"), (lone * WINDOW_IDS).alias("container_id")
    )
    out = placed.unionByName(empty)
    return out.select(
        F.col("key").alias(key), "piece_no", "start_token", "n_tokens", F.col("source").alias(source if source != key else source + "_"),
        "window_no", "container_id"
    )


def balance(packed: DataFrame, source: str, mixture: dict[str, float]) -> DataFrame:
    """(window_no, queue, n_tokens, target, deficit): for each window and each source of ``mixture``, and ``rest`` for all others, the tokens it was given, those it was due, and those it is short of at the window's end, carried on.

    ``packed`` should be materialised. A source is due its rate for the window's turns until its queue is empty; then the
    others share what it leaves. Prefix sums go over blocks of windows first, then within, so no task holds a source's
    windows as a whole.
    """
    there = packed.where("n_tokens > 0").select("window_no", _queue(F.col(source)).alias("queue"), "n_tokens")
    plan = rates(there.groupBy("queue").agg(F.sum("n_tokens").alias("m")), mixture)
    named = F.when(F.col("queue").isin(*plan.named), F.col("queue")).otherwise("rest")
    given = there.groupBy("window_no", named.alias("queue")).agg(F.sum("n_tokens").alias("n_tokens"))
    windows = (packed.agg(F.max("window_no")).first()[0] or 0) + 1
    each = F.explode(F.array(*[
        F.struct(F.lit(q).alias("queue"), F.lit(t).alias("total"), F.lit(r).alias("rate")) for q,
        (t, r) in [*plan.named.items(), ("rest", plan.rest)]
    ]))
    grid = packed.select("window_no").distinct().select("window_no", each.alias("q")).select("window_no", "q.*")
    due = lambda w: F.least(F.col("total"), F.col("rate") * plan.turn(w * F.lit(plan.total / windows)))
    rows = grid.join(given, ["window_no", "queue"], "left").withColumn(
        "n_tokens", F.coalesce("n_tokens", F.lit(0).cast("bigint"))
    ).withColumn("block", F.expr(f"window_no div {BLOCK_WINDOWS}"))
    rows = materialize(
        rows.withColumn("to_end", due(F.col("window_no") + 1)).withColumn("target", F.col("to_end") - due(F.col("window_no"))), "windows"
    )
    blocks = rows.groupBy("queue", "block").agg(F.sum("n_tokens").alias("m"))
    ahead = blocks.select("queue", "block", (F.sum("m").over(Window.partitionBy("queue").orderBy("block")) - F.col("m")).alias("ahead"))
    inside = F.sum("n_tokens").over(Window.partitionBy("queue", "block").orderBy("window_no"))
    out = rows.withColumn("inside", inside).join(ahead, ["queue", "block"])
    return out.select(
        "window_no", F.regexp_replace("queue", "^=", "").alias("queue"), "n_tokens", "target",
        (F.col("to_end") - F.col("ahead") - F.col("inside")).alias("deficit")
    )


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, share of their room that is filled, and the fullest container."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return per.agg(
        F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"),
        (F.sum("used") / (F.count(F.lit(1)) * F.lit(capacity))).alias("filled"), F.max("used").alias("fullest")
    )
