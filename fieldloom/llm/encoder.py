"""Encoding of a whole corpus by a lexicon transducer, with exact merging of what it lacks.

The lexicon holds the most frequent words of all documents and only decides how fast a word is found: every word outside
it is merged by the vocabulary's own rules, so ids are exact for any text and any lexicon.
"""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, shared_dir, spread
from .lexicon import Lexicon, compile_lexicon, merge, ranks, vocabulary_path
from .pretokens import Words, split

#: How many words the lexicon has at most; distinct words that a task counts together before it hands them on.
LEXICON_WORDS, COUNTED_WORDS = 60_000, 200_000
#: Words longer than this are merged, not looked up; merged words kept by a worker; bytes of text worked on at a time.
LONGEST_WORD, KEPT_WORDS, BLOCK_BYTES = 48, 300_000, 2 << 20


class Encoder(NamedTuple):
    """What workers need: the lexicon's file, shipped by Spark, and the vocabulary's path."""

    file: str
    vocabulary: str


def _word_counts(texts: pa.Array) -> pa.Table:
    """(word, n): the distinct words of a block of texts, without those beyond LONGEST_WORD."""
    w = split(texts)
    words = pa.Array.from_buffers(pa.large_binary(), len(w.edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(w.edges)), pa.py_buffer(np.ascontiguousarray(w.data))])
    found = words.value_counts()
    kept = pa.table({"word": found.field(0), "n": found.field(1)})
    return kept.filter(pa.compute.less_equal(pa.compute.binary_length(kept["word"]), LONGEST_WORD))


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["word", "n"])


def fit(
    spark: SparkSession, docs: DataFrame, key: str, text: str, vocabulary: str | None = None, sample: int | None = None, words: int = LEXICON_WORDS
) -> Encoder:
    """Compiles the most frequent words of all documents, with the vocabulary's ids, into a transducer.

    With ``sample`` words are counted in a hash sample of about so many documents only, drawn by their keys, not by their
    texts, so a text that a third of the corpus repeats is in it in proportion; no query does so. The file goes to the
    session's shared folder and from there to every executor, which map it into memory. What comes to the driver is
    bounded by ``words`` and a row for each count that occurs, what a task holds by COUNTED_WORDS and a block's words.
    Where more words than are left tie at the lowest count, none of them is taken.
    """
    vocabulary = vocabulary or vocabulary_path()
    share = 1.0 if sample is None else min(1.0, sample / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(key), F.lit(1 << 53)) < F.lit(int(share * (1 << 53)))
    kept = docs.where(F.col(text).isNotNull() & drawn) if share < 1 else docs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held = 0
        for batch in batches:
            for part in blocks(batch.column(0)):
                parts.append(_word_counts(part))
                held += len(parts[-1])
                if held > COUNTED_WORDS:
                    parts = [_summed(parts)]
                    held = len(parts[0])
                    if held > COUNTED_WORDS // 2:
                        yield from handed(parts.pop())
                        held = 0
        if parts:
            yield from handed(_summed(parts))

    def handed(t: pa.Table) -> list[pa.RecordBatch]:
        return t.cast(pa.schema([("word", pa.binary()), ("n", pa.int64())])).combine_chunks().to_batches()

    each = spread(kept.select(F.col(text).cast("string").alias("text"))).mapInArrow(count, "word binary, n bigint")
    counted = materialize(each.groupBy("word").agg(F.sum("n").alias("n")), "words")
    least, held = (1 << 63) - 1, 0  # a row for each count comes first: a limit's sort would send as many words from every partition
    for n, more in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):
        held += more
        if held > words:
            break
        least = n
    top = counted.where(F.col("n") >= least).collect()
    block = compile_lexicon({bytes(r["word"]): merge(bytes(r["word"]), vocabulary) for r in top})
    name = f"lexicon-{hashlib.sha256(block).hexdigest()[:16]}.bin"
    where, root = fs.FileSystem.from_uri(shared_dir(spark) if "://" in shared_dir(spark) else "file://" + shared_dir(spark))
    where.create_dir(root)
    with where.open_output_stream(posixpath.join(root, name)) as f:
        f.write(block)
    spark.sparkContext.addFile(f"{shared_dir(spark)}/{name}")
    return Encoder(name, vocabulary)


@lru_cache(4)
def _lexicon(file: str) -> Lexicon:
    path = SparkFiles.get(file)
    return Lexicon(path)


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about BLOCK_BYTES of text each; a longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, "right"))
        to = max(at + 1, to)
        yield texts.slice(at, to - at)
        at = to


class Coder:
    """Ids of words on a worker: lexicon first, merged words kept up to a bound after that."""

    def __init__(self, encoder: Encoder, lexicon: Lexicon | None = None):
        self.lexicon = _lexicon(encoder.file) if lexicon is None else lexicon
        self.vocabulary = encoder.vocabulary
        ranks(self.vocabulary)
        self.merged: dict[bytes, list[int]] = {}

    def ids(self, word: bytes) -> list[int]:
        """The ids of one word, by merging."""
        ids = self.merged.get(word)
        if ids is None:
            ids = merge(word, self.vocabulary)
            if len(word) <= LONGEST_WORD:
                if len(self.merged) > KEPT_WORDS:
                    self.merged.clear()
                self.merged[word] = ids
        return ids

    def encode(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids): how many ids each word has, and all ids in order."""
        lex = self.lexicon
        n = len(w.edges) - 1
        number = np.empty(n, np.int32)
        for a in range(0, n, 1 << 16):  # a block's arrays stay in the processor's cache
            b = min(n, a + (1 << 16))
            number[a:b] = lex.numbers(w.data, w.edges[a:b], w.edges[a + 1 : b + 1])
        unseen = np.flatnonzero(number < 0)
        number[unseen] = 0 if len(lex) else -1
        known = np.maximum(number, 0)
        counts = (lex.offsets[known + 1] - lex.offsets[known]).astype(np.int64) if len(lex) else np.zeros(n, np.int64)
        extra: list[list[int]] = []
        if len(unseen):
            raw = w.data.tobytes()
            for a, b in zip(w.edges[unseen].tolist(), w.edges[unseen + 1].tolist()):
                extra.append(self.ids(raw[a:b]))
            counts[unseen] = [len(x) for x in extra]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if n else 0
        if not total:
            return counts, np.empty(0, np.int32)
        # ids[k] of a word lie side by side in the lexicon: its offset plus the place in the word
        start = lex.offsets[known].astype(np.int64) if len(lex) else np.zeros(n, np.int64)
        start[unseen] = 0
        place = np.repeat((start - (ends - counts)).astype(np.int64), counts) + np.arange(total)
        if len(unseen):
            hole = np.zeros(n, bool)
            hole[unseen] = True
            hole = np.repeat(hole, counts)
            place[hole] = 0
            ids = lex.ids[place] if len(lex) else np.zeros(total, np.int32)
            ids[hole] = np.fromiter((i for x in extra for i in x), np.int32, int(hole.sum()))
        else:
            ids = lex.ids[place]
        return counts, ids


def encode(docs: DataFrame, key: str, text: str, encoder: Encoder) -> DataFrame:
    """(key, ids): the token ids of each text, without special tokens; a null or empty text has the empty list. Rows that stand twice, and null keys, come out as they are."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or Coder(encoder)
            at = 0
            for part in blocks(batch.column(1)):
                w = split(part)
                counts, ids = coder.encode(w)
                offsets = np.concatenate([[0], np.cumsum(counts)])[w.first].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), lists], names=["key", "ids"])
                at += len(part)

    return spread(docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text")
    )).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def token_counts(docs: DataFrame, keep: list[str], text: str, encoder: Encoder) -> DataFrame:
    """``keep`` columns and ``n_tokens``, 0 for null and empty texts."""
    kinds = ", ".join(f"c{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or Coder(encoder)
            sums = []
            for part in blocks(batch.column(len(keep))):
                w = split(part)
                counts, _ = coder.encode(w)
                sums.append(np.diff(np.concatenate([[0], np.cumsum(counts)])[w.first]))
            n = pa.array(np.concatenate(sums) if sums else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], n], names=[*batch.schema.names[: len(keep)], "n_tokens"])

    out = spread(docs.select(
        *[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)], F.col(text).cast("string").alias("text")
    )).mapInArrow(run, f"{kinds}, n_tokens bigint")
    return out.toDF(*keep, "n_tokens")


@lru_cache(4)
def _tokens(vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all tokens in the order of their ids, where each begins)."""
    words = sorted(ranks(vocabulary).items(), key=lambda x: x[1])
    starts = np.zeros(words[-1][1] + 2, np.int64)
    for w, i in words:
        starts[i + 1] = len(w)
    return np.frombuffer(b"".join(w for w, _ in words), np.uint8), np.cumsum(starts)


def decode(encoded: DataFrame, key: str, ids: str, vocabulary: str) -> DataFrame:
    """(key, text): the text that each list of ids stands for; bytes that are no text become U+FFFD, a null list is null."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts = _tokens(vocabulary)
        for batch in batches:
            texts: list[str | None] = []
            for own in batch.column(1):
                if own.values is None:
                    texts.append(None)
                    continue
                i = own.values.to_numpy(zero_copy_only=False)
                long = starts[i + 1] - starts[i]
                ends = np.cumsum(long)
                at = np.repeat(starts[i] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)
                texts.append(data[at].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return encoded.select(F.col(key).alias("key"), F.col(ids)).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
