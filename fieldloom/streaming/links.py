"""Link tables as they arrive: the frontier and the page history as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.links import page_code
from ..operators.dedup_index import History
from ..schema import LINKS


def link_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files that appear in a folder, in micro-batches of one file."""
    reader = spark.readStream.schema(LINKS).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.option("encoding", "UTF-8").option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", 1).csv(path)


def deduplicated(stream: DataFrame, history: History, out: str, checkpoint: str, link: str = "Airport Link") -> StreamingQuery:
    """Appends to ``out`` the (batch, first_id, later_id) of rows whose page is in the history; each micro-batch becomes a shard.

    A row's id is its micro-batch times 2^44 plus its place, so ids rise with arrival: a place has 33 bits in each of up to
    2,048 partitions, and a micro-batch of one file is one. A micro-batch that is run again after a failure replaces its
    own output and adds no page twice.
    """

    def accept(batch: DataFrame, number: int) -> None:
        rows = batch.select(
            page_code(F.col(f"`{link}`")).alias("code"), (F.monotonically_increasing_id() + F.lit(number) * F.lit(1 << 44)).alias("id")
        )
        history.accept(rows).write.mode("overwrite").parquet(f"{out}/batch={number}")
        history.compact()

    return stream.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
