"""Per-key results where a few keys hold most records.

Spark's hash aggregation is the bounded map-side table of this method: each task folds its rows into a fixed-size hash
map of mergeable states and spills sorted runs beyond it, and only one state per key and task is shuffled. A key that
holds a third of all rows thus reaches the reducer as as many rows as there are map tasks, whatever the data's size.
So every aggregate here is algebraic (count, sum, min, max, sketches), and names are resolved after the first fold, on
distinct spellings rather than on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key


def spellings(ref: DataFrame, name: str, others: str) -> DataFrame:
    """(key, name) for each name of a reference list and each of its other names; a key two names share goes to the one bearing it itself, then to the lesser."""
    own = ref.select(
        F.col(name).alias("name"),
        F.explode(F.concat(F.array(F.struct(F.lit(0).alias("rank"), F.col(name).alias("as"))), F.transform(F.coalesce(F.col(others), F.array().cast("array<string>")), lambda x: F.struct(F.lit(1).alias("rank"), x.alias("as"))))).alias("e")
    )
    keyed = own.where("name is not null").select(name_key(F.col("e.as")).alias("key"), F.struct("e.rank", "name").alias("best")).where("key <> ''")
    return keyed.groupBy("key").agg(F.min("best").alias("best")).select("key", F.col("best.name").alias("name"))


def count_states(df: DataFrame, keys: list[str], cell: str, **aggregates: Column) -> DataFrame:
    """First fold: ``n`` and the given aggregates for each of ``keys`` and spelling of ``cell``."""
    return df.groupBy(*keys, F.col(cell).alias("cell")).agg(F.count(F.lit(1)).alias("n"), *[c.alias(a) for a, c in aggregates.items()])


def resolve(states: DataFrame, names: DataFrame) -> DataFrame:
    """``states`` with the name their cell stands for, null where it names none. Adaptive execution broadcasts the names if they are few; what would be shuffled otherwise are states, not rows."""
    keyed = states.withColumn("key", name_key(F.col("cell")))
    return keyed.join(names, "key", "left").drop("key")


def shares(df: DataFrame, group: str, cell: str, ref: DataFrame, name: str, others: str) -> DataFrame:
    """(group, name, n, total): rows of each name in each group, and all rows of the group.

    Null groups form a group. Rows whose cell is null, blank or unknown count in the total and come out under the name
    null. An empty table gives no rows. The total is summed over a
    group's names, of which there are no more than the reference list has and the null one, so the table is scanned once.
    """
    states = resolve(count_states(df.select(group, cell), [group], cell), spellings(ref, name, others))
    per_name = states.groupBy(group, "name").agg(F.sum("n").alias("n"))
    return per_name.select(group, "name", "n", F.sum("n").over(Window.partitionBy(group)).alias("total"))


def heavy(counted: DataFrame, share: float) -> DataFrame:
    """Names that hold at least ``share`` of their group's rows."""
    return counted.where(F.col("name").isNotNull() & (F.col("n") >= F.lit(share) * F.col("total")))
