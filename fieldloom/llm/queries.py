"""Queries p6 to p8 over documents, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, table
from . import encoder, packing, splitting
from .lexicon import vocabulary_path

#: Production parameters, in tokens of the vocabulary byte_bpe_50k.
CAPACITY, LIMIT, OVERLAP = 2_048, 1_024, 64
#: Target shares of the kinds of source in every window of p7_mixture; what is left of 1 goes to documents of no such kind.
MIXTURE = {"briefings": 0.25, "field_notes": 0.2, "handler_desk": 0.2, "page_text": 0.15, "ramp_log": 0.1, "crew_guide": 0.08}


def _fitted(spark: SparkSession, docs: DataFrame) -> encoder.Encoder:
    return encoder.fit(spark, docs, "doc_id", "text")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return encoder.encode(docs, "doc_id", "text", _fitted(spark, docs))


def p6_text(spark: SparkSession, d: str) -> DataFrame:
    """The texts that the ids stand for: the round trip of every document."""
    return encoder.decode(p6_ids(spark, d), "doc_id", "ids", vocabulary_path())


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("kind", F.regexp_extract("source", "_(.+)$", 1))
    return materialize(encoder.token_counts(docs, ["doc_id", "source", "kind"], "text", _fitted(spark, docs)), "sizes")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document in its container; those beyond the capacity in several."""
    return packing.pack(_sizes(spark, d), "doc_id", "source", "n_tokens", CAPACITY)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill(p7_containers(spark, d), CAPACITY)


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Windows filled to MIXTURE: what each kind of source got in each window, what it was due, and the deficit it carries on."""
    packed = materialize(packing.pack(_sizes(spark, d), "doc_id", "kind", "n_tokens", CAPACITY, MIXTURE), "packed")
    return packing.balance(packed, "kind", MIXTURE)


def p7_documents(spark: SparkSession, d: str) -> DataFrame:
    """One row a document: whether its pieces hold all of its tokens in order, whether it is whole if it fits, and whether all of its containers keep the capacity."""
    sizes = _sizes(spark, d)
    packed = materialize(packing.pack(sizes, "doc_id", "source", "n_tokens", CAPACITY), "packed")
    used = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    own = packed.join(used, "container_id").groupBy("doc_id").agg(
        F.sum("n_tokens").alias("held"), F.count(F.lit(1)).alias("pieces"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"),
        F.min("start_token").alias("start"), F.max("used").alias("used"), F.count_distinct("container_id").alias("containers"),
    )
    n = F.col("n_tokens")
    kept = (F.col("held") == n) & (F.col("end") == n) & (F.col("start") == 0)
    whole = (F.col("pieces") == F.greatest(F.lit(1), F.ceil(n / CAPACITY))) & (F.col("containers") == F.col("pieces"))
    return sizes.join(own, "doc_id", "left").select(
        "doc_id", F.coalesce(kept, F.lit(False)).alias("kept"), F.coalesce(whole, F.lit(False)).alias("whole"),
        F.coalesce(F.col("used") <= CAPACITY, F.lit(False)).alias("fits")
    )


def _split(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    docs = table(spark, d, "documents")
    return splitting.split_documents(docs, "doc_id", "text", _fitted(spark, docs), LIMIT, OVERLAP, with_text)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d, False).where((F.col("n_pieces") > 1) & (F.col("piece_no") == 0)).select("doc_id")


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All pieces of all documents, with their texts."""
    return _split(spark, d, True)


def p8_text(spark: SparkSession, d: str) -> DataFrame:
    """The documents put together from their pieces, and whether the pieces keep the limit, come in order and overlap."""
    piece = F.struct("piece_no", "n_pieces", "start_char", "end_char", "n_tokens", "text")
    per = _split(spark, d, True).groupBy("doc_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    before = lambda i: F.get("p", i - 1)
    rest = F.transform("p", lambda x, i: F.when(i == 0, x["text"]).otherwise(F.substr(x["text"], before(i)["end_char"] - x["start_char"] + 1)))
    in_order = F.forall(
        F.transform("p", lambda x, i: (x["piece_no"] == i) & (x["n_pieces"] == F.size("p")) & ((i == 0) | (before(i)["start_char"] < x["start_char"]) & (x["start_char"] < before(i)["end_char"]) & (before(i)["end_char"] < x["end_char"]))),
        lambda ok: ok
    )
    within = F.forall("p", lambda x: x["n_tokens"] <= LIMIT)
    return per.select(
        "doc_id", F.when(F.get("p", F.lit(0))["text"].isNotNull(), F.array_join(rest, "")).alias("text"), in_order.alias("in_order"),
        within.alias("within")
    )


QUERIES = {f.__name__: f for f in (p6_ids, p6_text, p7_containers, p7_fill, p7_mixture, p7_documents, p8_found, p8_pieces, p8_text)}
SQL: dict[str, str] = {
    "p6_text": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p7_documents": "SELECT doc_id, true AS kept, true AS whole, true AS fits FROM documents",
    "p8_text": "SELECT doc_id, text, true AS in_order, true AS within FROM documents",
}
