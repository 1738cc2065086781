"""Approximate nearest neighbours by cosine, with a hierarchical k-means tree searched best bin first.

The tree is fitted on at most ``SAMPLE`` unit vectors (those whose id hashes lowest) by splitting every node in ``BRANCH`` by k-means
until nodes are small; its size is bounded by the sample. Every row is then put in the leaf that it falls to. A query walks the
tree with a priority queue of nodes, nearest centre first, and so puts the leaves in its own order of visit. How many leaves to
visit is calibrated: for ``TRIALS`` held-out sample rows the true neighbours are found by comparing them with every row, and
visits are widened until ``recall`` of those neighbours lie in leaves visited.

Queries meet rows by (leaf, block of rows, block of queries); blocks are sized from counts, so a leaf with a third of all rows is
many small tasks' work. Each block pair gives the best k of its own; a window keeps the best k of a query. Scores are summed in one
order of components in double precision, so equal vectors have equal scores, and ties go to the smaller id.

Vectors that are null, zero or hold a null or non-finite component take no part; neither do rows without an id. Vectors meet those of their own length; each length
is a search of its own. Rows that repeat an id
are candidates each, save for the query's own id. A query with fewer than k candidates in the visited leaves gets what all leaves
have. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.llm.common import stored

SAMPLE = 20_000
TRIALS = 200
BRANCH = 8
LEAF = 64
ROWS, QUERIES = 8192, 2048


def usable(vectors: DataFrame, ids: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, in double precision."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(ids).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & sound)
    return rows.filter(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.float64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(m: np.ndarray) -> np.ndarray:
    biggest = np.abs(m).max(axis=1, keepdims=True)
    m = m / biggest
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


@dataclass
class Tree:
    """Nodes by number: the centres of a node's children, and their numbers; a leaf has neither."""

    children: dict[int, np.ndarray] = field(default_factory=dict)
    centres: dict[int, np.ndarray] = field(default_factory=dict)
    leaves: list[int] = field(default_factory=list)

    def leaf_of(self, m: np.ndarray) -> np.ndarray:
        """The leaf each unit vector falls to."""
        at = np.zeros(len(m), np.int64)
        moving = np.isin(at, list(self.children))
        while moving.any():
            for node in np.unique(at[moving]):
                rows = np.flatnonzero(at == node)
                at[rows] = self.children[node][(m[rows] @ self.centres[node].T).argmax(axis=1)]
            moving = np.isin(at, list(self.children))
        return at

    def visit(self, q: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in the order in which best-bin-first reaches them."""
        queue, out = [(0.0, 0)], []
        while queue and (most is None or len(out) < most):
            _, node = heapq.heappop(queue)
            if node not in self.children:
                out.append(node)
                continue
            for far, child in zip((1 - self.centres[node] @ q).tolist(), self.children[node].tolist()):
                heapq.heappush(queue, (far, child))
        return out


def fit_tree(sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, rounds: int = 8) -> Tree:
    """Spherical k-means, node by node, from unit vectors."""
    tree, rng, made = Tree(), np.random.default_rng(1), 1
    waiting = [(0, np.arange(len(sample)))]
    while waiting:
        node, rows = waiting.pop()
        points = sample[rows]
        centres = np.unique(points[rng.choice(len(rows), min(branch, len(rows)), replace=False)], axis=0) if len(rows) else points
        if len(rows) <= leaf or len(centres) < 2:
            tree.leaves.append(node)
            continue
        for _ in range(rounds):
            near = (points @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
        near = (points @ centres.T).argmax(axis=1)
        full = np.unique(near)
        if len(full) < 2:
            tree.leaves.append(node)
            continue
        tree.centres[node], tree.children[node] = centres[full], np.arange(made, made + len(full))
        made += len(full)
        waiting += [(int(tree.children[node][i]), rows[near == c]) for i, c in enumerate(full)]
    return tree


def best(q: np.ndarray, q_ids: np.ndarray, m: np.ndarray, m_ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(query ids, ids, scores) of each query's k nearest of ``m``, its own id left out; exact ties by smaller id."""
    for at in range(0, len(q), 256):
        part, own = q[at : at + 256], q_ids[at : at + 256]
        rough = part @ m.T
        rough[own[:, None] == m_ids[None, :]] = -np.inf
        kth = np.partition(rough, -min(k, len(m)), axis=1)[:, -min(k, len(m))] if len(m) > k else np.full(len(part), -2.0)
        # The product's last places depend on the place in the matrix; near the kth, sum again in one order.
        r, c = np.nonzero((rough >= kth[:, None] - 1e-9) & np.isfinite(rough))
        exact = np.zeros(len(r))
        for d in range(m.shape[1]):
            exact += part[r, d] * m[c, d]
        order = np.lexsort((m_ids[c], -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        top = rank < k
        yield own[r[top]], m_ids[c[top]], exact[top]


def _put_in_leaves(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.leaf_of(unit(matrix(batch.column("v"))))
                yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "v": batch.column("v"), "leaf": pa.array(leaf)})

    return run


def _visits(tree, most: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                leaves = [tree.value.visit(q, most) for q in unit(matrix(batch.column("v")))]
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column("id"), "v": batch.column("v"), "leaves": pa.array(leaves, pa.list_(pa.int64()))}
                )

    return run


def _trials(q_ids: np.ndarray, q: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaf = batch.column("id").to_numpy(), batch.column("leaf").to_numpy()
            where = np.arange(len(ids))
            for own, found, score in best(q, q_ids, unit(matrix(batch.column("v"))), ids, k):
                first = where[np.argsort(ids, kind="stable")]
                at = first[np.searchsorted(ids[first], found)]
                yield pa.RecordBatch.from_pydict(
                    {"q": pa.array(own), "id": pa.array(found), "s": pa.array(score), "leaf": pa.array(leaf[at])}
                )

    return run


def calibrate(tree: Tree, placed: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int, recall: float) -> int:
    """The number of leaves after whose visit ``recall`` of the true neighbours of the trial queries have been met."""
    found = placed.mapInArrow(_trials(q_ids, q, k), "q long, id long, s double, leaf long")
    nearest = Window.partitionBy("q").orderBy(F.desc("s"), "id")
    truth = found.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k).select("q", "leaf").toPandas()
    orders = {int(i): {leaf: n for n, leaf in enumerate(tree.visit(v), 1)} for i, v in zip(q_ids, q)}
    needed = np.sort([orders[a][b] for a, b in zip(truth["q"], truth["leaf"])])
    return int(needed[int(np.ceil(recall * len(needed))) - 1]) if len(needed) else len(tree.leaves)


def _block_best(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            m, m_ids = unit(matrix(left["v"])), left["id"].to_numpy()
            out = list(best(unit(matrix(right["v"])), right["id"].to_numpy(), m, m_ids, k))
        q, i, s = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))
        return pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    return run


def _search(placed: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Each query's best k of the leaves in ``visits`` (id, v, leaf)."""
    per_leaf = placed.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("row_blocks"))
    per_visit = visits.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("query_blocks"))
    # One row per leaf; their number is bounded by the tree.
    blocks = F.broadcast(stored(per_leaf.join(per_visit, "leaf"), "blocks"))

    def spread(df: DataFrame, mine: str, others: str) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.col(f"{mine}_blocks")).cast("int").alias(mine)
        each = F.explode(F.sequence(F.lit(0), F.col(f"{others}_blocks") - 1)).alias(others)
        return df.join(blocks, "leaf").select("id", "v", "leaf", own, each)

    by = ("leaf", "row", "query")
    pairs = spread(placed, "row", "query").groupBy(*by).cogroup(spread(visits, "query", "row").groupBy(*by))
    found = pairs.applyInPandas(_block_best(k), "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    ids: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    recall: float = 0.97,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` holds, among rows of the query's length; ``score`` is the cosine."""
    rows, asked = usable(vectors, ids, vector), usable(vectors.filter(is_query), ids, vector)
    lengths = sorted(r[0] for r in asked.select(F.size("v")).distinct().collect())
    found = [_nearest_of_length(*(df.filter(F.size("v") == n) for df in (rows, asked)), k, recall, sample) for n in lengths]
    nothing = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found) if found else nothing


def _nearest_of_length(rows: DataFrame, queries: DataFrame, k: int, recall: float, sample: int) -> DataFrame:
    spark = rows.sparkSession
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    m, m_ids = unit(matrix(drawn["v"])), drawn["id"].to_numpy()
    held = max(1, min(TRIALS, len(m) // 4))
    tree = fit_tree(m[held:] if len(m) > held else m)
    shared = spark.sparkContext.broadcast(tree)
    placed = stored(rows.mapInArrow(_put_in_leaves(shared), "id long, v array<double>, leaf long"), "leaves")
    most = calibrate(tree, placed, m_ids[:held], m[:held], k, recall)
    ordered = queries.mapInArrow(_visits(shared, most), "id long, v array<double>, leaves array<long>")
    visits = stored(ordered.select("id", "v", F.explode("leaves").alias("leaf")), "visits")
    found = stored(_search(placed, visits, k), "nearest")
    # The few queries whose leaves hold fewer than k rows look everywhere.
    enough = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = stored(queries.join(enough, "id", "left_anti"), "short")
    if not short.isEmpty():
        every = short.mapInArrow(_visits(shared, None), "id long, v array<double>, leaves array<long>")
        more = _search(placed, stored(every.select("id", "v", F.explode("leaves").alias("leaf")), "visits"), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(more)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
