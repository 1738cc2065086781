"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def schema_with(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` without the named columns, then those."""
    kept = [f for f in df.schema.fields if f.name not in kinds]
    return T.StructType(kept + [T.StructField(n, T._parse_datatype_string(k)) for n, k in kinds.items()])


def row_ids(n: int, before: int) -> np.ndarray:
    """Numbers for the next ``n`` rows of this task, unique over all tasks of the job."""
    return (np.int64(TaskContext.get().partitionId()) << np.int64(36)) + np.arange(before, before + n, dtype=np.int64)


def joined_words(text: str | None) -> bytes:
    """A-Z lower-cased, words between single spaces."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def word_bytes(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """:func:`joined_words`, and each word's first byte and the byte after it."""
    joined = joined_words(text)
    if not joined:
        return joined, np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))


def shingle_hashes(text: str | None, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``width`` words, in order; of the whole sequence if it is shorter; none without words."""
    joined, starts, ends = word_bytes(text)
    if not len(starts):
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(starts) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    spans = zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.fromiter((digest(joined[i:j], seed) for i, j in spans), np.uint64, len(starts) - width + 1)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few, so that little of a batch of long texts is in Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def add_columns(
    make: Callable[[pa.RecordBatch, int], dict[str, pa.Array]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: every batch with the columns that ``make(batch, rows seen before)`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in small(batches):
            new = make(batch, seen)
            seen += batch.num_rows
            kept = {n: batch.column(n) for n in batch.schema.names if n not in new}
            yield pa.RecordBatch.from_pydict(kept | new)

    return run


def lowest_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of n nodes joined by links a[i]-b[i], the lowest node that each can reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label[a] == label[b]).all():
            return label


def _digest(edges: DataFrame) -> tuple[int, int]:
    got = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return got["n"], got["h"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``links``, for every node other than that smallest.

    Alternating large-star and small-star rounds (Kiveris et al., 2014), a logarithmic number of them in
    practice. Each half round is a minimum per node, combined before its shuffle, written, and joined back; both join
    sides are plain exchanges, so AQE splits the rows of a hub. Links and labels stay in the shared folder.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    edges = stored(pairs, "links")
    before = _digest(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stored(
            both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large"
        )
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        inner = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(inner.union(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
