"""Exact top-k by inner product, with Fagin's threshold algorithm over sorted per-dimension lists.

Every row block holds one list per dimension, its rows by that component. A query goes down all lists together, each from the end that its
own sign there favours. Rows met are scored in full; the threshold, the score of a row that would stand at the present depth in
every list, bounds all rows not met. The search of a block ends when the k-th score is above the threshold. A first pass over one seed block
gives every query a k-th score to start from in all the others, so most of them can end early.

Rows are dealt to blocks by their id's hash and queries to blocks of their own; each pair of blocks is one group of bounded size,
whatever the data look like, and a window keeps the best k of a query. Depths double, so a block costs at most twice its entries.

Components are floor(scale * x), x in double precision. Scores are exact: where doubles might not hold them, a block is scored whole in
whole numbers, and a score that is no long is an error, as is a component that is infinite when scaled. Vectors that are null, empty or hold a
null or non-finite component take no part; neither do rows without an id. Vectors meet those of their own length; each length
is a search of its own. Equal scores go to the smaller id.
A query's candidates are all rows but those with its own id; with fewer than k, all are returned. An empty table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.llm.common import stored

ROWS, QUERIES, FIRST_DEPTH = 4096, 1024, 16
# Doubles below hold every whole number; those above have no fraction.
_EXACT = 2.0**53


def quantised(vectors: DataFrame, ids: str, vector: str, scale: int) -> DataFrame:
    """(id, v): whole-number components of the vectors that take part."""
    raw = F.col(vector).cast("array<double>")
    sound = F.forall(raw, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & (F.size(raw) > 0)
    told = F.concat(F.lit("a component times the scale is beyond a double, and its scores beyond a long: id "), F.col(ids).cast("string"))
    scaled = lambda x: F.when(F.abs(F.lit(float(scale)) * x) == float("inf"), F.raise_error(told).cast("double")).otherwise(F.lit(float(scale)) * x)
    whole = F.transform(raw, lambda x: F.when(F.abs(scaled(x)) < _EXACT, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    return vectors.filter(F.col(ids).isNotNull() & sound).select(F.col(ids).cast("long").alias("id"), whole.alias("v"))


class SortedLists:
    """A block of rows with its list per dimension, smallest component first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.lists = np.argsort(rows, axis=0, kind="stable").T
        self.values = np.take_along_axis(rows, self.lists.T, axis=0).T

    def exact_top(self, query: np.ndarray, own: int, k: int, floor: float, size: float) -> tuple[np.ndarray, np.ndarray]:
        """As ``top``, for scores of up to ``size``."""
        at = np.flatnonzero(self.ids != own)
        if size < 2.0**62:
            scores = (self.rows[at].astype(np.int64) * query.astype(np.int64)).sum(axis=1).tolist()
        else:
            whole = [int(x) for x in query]
            scores = [sum(int(x) * y for x, y in zip(row, whole)) for row in self.rows[at]]
        least = floor if abs(floor) < _EXACT else np.nextafter(floor, -np.inf)  # a floor that was rounded up bars no row
        found = [(-score, i) for score, i in zip(scores, self.ids[at].tolist()) if score >= least]
        found = sorted(found)[:k]
        return np.array([i for _, i in found], np.int64), np.array([-score for score, _ in found], np.int64)

    def top(self, query: np.ndarray, own: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k whose score is at least ``floor``, best first."""
        size = np.abs(self.rows).max(initial=0) * np.abs(query).max(initial=0) * len(query)
        if not size < _EXACT:
            return self.exact_top(query, own, k, floor, size)
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        met[self.ids == own] = True
        ids, scores, depth = np.empty(0, np.int64), np.empty(0, np.int64), FIRST_DEPTH
        before = 0
        while True:
            depth = min(depth, n)
            new = np.concatenate((self.lists[up, n - depth : n - before].ravel(), self.lists[down, before:depth].ravel()))
            fresh = np.zeros(n, bool)
            fresh[new] = True
            fresh &= ~met
            if depth == n:
                fresh = ~met  # dimensions where the query is zero tell nothing
            rows = np.flatnonzero(fresh)
            met |= fresh
            found = (self.rows[rows] @ query).astype(np.int64)
            good = found >= floor
            ids, scores = np.concatenate((ids, self.ids[rows[good]])), np.concatenate((scores, found[good]))
            if len(ids) > k:
                first = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[first], scores[first]
            if depth == n:
                break
            threshold = self.values[up, n - depth] @ query[up] + self.values[down, depth - 1] @ query[down]
            kth = scores.min() if len(scores) >= k else floor
            if (kth > threshold if len(scores) >= k else threshold < floor) or met.all():
                break
            before, depth = depth, 2 * depth
        first = np.lexsort((ids, -scores))[:k]
        return ids[first], scores[first]


def _block_top(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            lists = SortedLists(left["id"].to_numpy(), np.stack(left["v"].to_numpy()))
            for own, v, floor in zip(right["id"].to_numpy(), right["v"], right["floor"].to_numpy()):
                ids, scores = lists.top(np.asarray(v), own, k, floor)
                out.append((np.full(len(ids), own), ids, scores))
        q, i, s = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
        return pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    return run


def _search(rows: DataFrame, queries: DataFrame, blocks: int, query_blocks: int, k: int, only: int | None) -> DataFrame:
    """Best k in each block of ``rows``: in the seed block ``only``, or in all."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")
    left = rows.withColumn("block", block)
    left = left.filter(F.col("block") == only) if only is not None else left
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    met = F.array(F.lit(only)) if only is not None else F.sequence(F.lit(0), F.lit(blocks - 1))
    right = queries.withColumn("part", own).withColumn("block", F.explode(met))
    pairs = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    return pairs.applyInPandas(_block_top(k), "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, is_query: Column, ids: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` holds, among rows of the query's length."""
    rows = stored(quantised(vectors, ids, vector, scale), "whole")
    asked = stored(quantised(vectors.filter(is_query), ids, vector, scale), "asked")
    lengths = sorted(r[0] for r in asked.select(F.size("v")).distinct().collect())
    found = [_top_of_length(*(df.filter(F.size("v") == n) for df in (rows, asked)), k) for n in lengths]
    nothing = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, found) if found else nothing


def _top_of_length(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    blocks, query_blocks = -(-rows.count() // ROWS), -(-asked.count() // QUERIES)
    unbounded = asked.withColumn("floor", F.lit(float("-inf")))
    # A k-th score reached by k rows of one block is a lower bound of the k-th score over all.
    seeds = stored(_search(rows, unbounded, blocks, query_blocks, k, 0), "seeds")
    reached = seeds.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("kth"))
    reached = stored(reached.filter(F.col("n") >= k).select(F.col("query_id").alias("id"), "kth"), "floors")
    bounded = asked.join(reached, "id", "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
    found = _search(rows, bounded, blocks, query_blocks, k, None)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


TOP_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
    FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""
