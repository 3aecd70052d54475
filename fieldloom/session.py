"""Shared folder and written intermediate tables: how this library cuts lineage on a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset and the master is local, as in single-machine tests, a temporary folder is made and set; on a
    cluster a machine's own folder would not be shared, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="fieldloom-")
        spark.conf.set("spark.checkpoint.dir", found)
        remove_at_end(spark, found)
    return found.rstrip("/")


def uri(path: str) -> str:
    """A path as Spark writes it, with its scheme as other libraries want it."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else "file://" + path


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Removes a folder when the session's JVM ends; until then results that are read lazily may need it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def own_folder(spark: SparkSession, name: str) -> str:
    """A new name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", by: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder (to ``path``, if given) and read back; ``by`` makes a folder of each value of a column.

    The written files outlive lost executors, are computed once however often the result is used,
    end the lineage, and go when the session ends. ``DataFrame.checkpoint`` would compute an uncached plan twice.
    """
    path = path or own_folder(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """A scanned table in at least as many partitions as there are cores, before a pass that computes much per row.

    Only a table of fewer, larger splits is shuffled; a large one has its splits already and stays as it is, and so does
    what a shuffle made, whose partitions can't be counted without running it.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
