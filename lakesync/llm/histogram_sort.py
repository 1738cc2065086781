"""Sharding by histogram sort: shards are ranges of one key, cut so that their bytes come out nearly equal.

The key is 64 bits: 40 of the text's hash, then 24 of a hash of the id and the row's own place, so equal texts lie side by side, and even a group of
copies larger than a shard can be cut, also where all its rows are alike. A row's place is its file and number there; where the rows do not come straight
from files that tell it, they are written once with a number each, and both passes read that. Splitters are found by counting: every round counts the exact bytes and rows below a set of candidate keys
in all partitions, then probes finer inside the interval where a target lies, until each splitter is within its tolerance of
its target or its interval is a single key. Only counts per candidate reach the driver, a few thousand in each round. Then rows are exchanged once, into pieces of shards that are
ranges themselves; a row's slot is the number of rows before its piece, known from the counts, plus its place in it.

Null texts have size 1 like empty ones. A null id hashes as null. Repeated rows are told apart by their place and spread like others. An empty table gives
an empty table. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.llm.common import schema_with, stored

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
# Candidate keys probed inside each open interval and round.
PROBES = 63
_MADE = {"size", "shard", "slot"}


def placed(docs: DataFrame, ids: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``__place``: a hash of the id and of where the row stands, the same whenever it is read again."""
    where = ("_metadata.file_path", "_metadata.row_index")
    try:
        return docs.select(*keep, F.xxhash64(ids, *where).alias("__place"))
    except AnalysisException:  # not rows of files that number them
        numbered = stored(docs.select(*keep, F.monotonically_increasing_id().alias("__row")), "rows")
        return numbered.select(*keep, F.xxhash64(ids, "__row").alias("__place"))


def shard_key(text: str) -> Column:
    low = (1 << 24) - 1
    high = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit(~low))
    return high.bitwiseOR(F.col("__place").bitwiseAND(F.lit(low)))


def _histogram(probes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column("key").to_numpy(), side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(sizes, at, batch.column("size").to_numpy())
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict(
            {"bin": pa.array(some), "size": pa.array(sizes[some]), "n": pa.array(rows[some])}
        )

    return run


def counts_below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the sorted ``probes``, and in all, as the last entry."""
    found = keys.mapInArrow(_histogram(probes), "bin long, size long, n long")
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in found.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect():
        sizes[r["bin"]], rows[r["bin"]] = r["size"], r["n"]
    return np.cumsum(sizes), np.cumsum(rows)


def splitters(keys: DataFrame, targets: int, every: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """(``targets - 1`` keys, rows below each) that cut ``keys`` (key, size) into parts of nearly equal bytes.

    Every ``every``-th one, a shard's boundary, is within ``tolerance`` of a shard's bytes of its target; the others, which only
    share out work, within a quarter of a part. Of the candidates inside the tolerance the nearest is taken.
    """
    probes = np.linspace(_LEAST, _MOST, max(256, 4 * targets) + 1)[1:-1].astype(np.int64)
    low = np.full(targets - 1, _LEAST, object)
    high = np.full(targets - 1, _MOST, object)
    chosen, below = np.full(targets - 1, _MOST, np.int64), np.zeros(targets - 1, np.int64)
    error = np.full(targets - 1, np.inf)
    while True:
        sizes, rows = counts_below(keys, probes)
        total = int(sizes[-1])
        wanted = total * np.arange(1, targets) / targets
        allowed = np.where(np.arange(1, targets) % every == 0, tolerance * every, 0.25) * total / targets
        for i in range(targets - 1):
            at = int(np.searchsorted(sizes[:-1], wanted[i]))
            for j in (at - 1, at):
                if 0 <= j < len(probes) and abs(sizes[j] - wanted[i]) < error[i]:
                    chosen[i], below[i], error[i] = probes[j], rows[j], abs(sizes[j] - wanted[i])
            if at > 0:
                low[i] = max(low[i], int(probes[at - 1]))
            if at < len(probes):
                high[i] = min(high[i], int(probes[at]))
        open_ = [i for i in range(targets - 1) if error[i] > allowed[i] and high[i] - low[i] > 1]
        if not open_ or not total:
            break
        spans = {(low[i], high[i]) for i in open_}
        finer = {lo + (hi - lo) * k // (PROBES + 1) for lo, hi in spans for k in range(1, PROBES + 1)}
        probes = np.array(sorted(finer), np.int64)
    # Targets inside one heavy key may have chosen in any order.
    order = np.lexsort((below, chosen))
    return chosen[order], below[order]


def _assign(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = np.searchsorted(cuts, batch.column("__key").to_numpy(), side="right").astype(np.int32)
            kept = {n: batch.column(n) for n in batch.schema.names}
            yield pa.RecordBatch.from_pydict(kept | {"__piece": pa.array(piece)})

    return run


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    ids: str = "doc_id",
    text: str = "text",
    tolerance: float = 0.001,
    pieces_per_shard: int | None = None,
) -> DataFrame:
    """``docs`` with ``size`` (bytes of the text in UTF-8, plus one), ``shard`` and ``slot`` (from 0 without gaps in each shard).

    ``pieces_per_shard`` sets how many tasks sort a shard; by default enough for about 64 MB each, at least as many as make
    all shards together one piece per shuffle partition.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in _MADE]
    kept = placed(docs, ids, columns)
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    keys = stored(kept.select(shard_key(text).alias("key"), size.alias("size")), "keys")
    if pieces_per_shard is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        heavy = (keys.agg(F.sum("size")).first()[0] or 0) // (64 << 20) // shards
        pieces_per_shard = max(1, -(-parts // shards), heavy)
    cuts, below = splitters(keys, shards * pieces_per_shard, pieces_per_shard, tolerance)
    firsts = np.concatenate(([0], below))
    bounds = firsts[:: pieces_per_shard]
    offsets = [int(n - bounds[i // pieces_per_shard]) for i, n in enumerate(firsts)]
    marked = kept.withColumn("size", size).withColumn("__key", shard_key(text))
    dealt = marked.mapInArrow(_assign(cuts), schema_with(marked, __piece="int"))
    # One exchange, by piece. The offsets are two literal arrays with an entry per piece.
    shard = F.element_at(F.lit([i // pieces_per_shard for i in range(len(offsets))]), F.col("__piece") + 1)
    offset = F.element_at(F.lit(offsets).cast("array<long>"), F.col("__piece") + 1)
    place = F.row_number().over(Window.partitionBy("__piece").orderBy("__key", "__place"))
    numbered = dealt.withColumn("slot", offset + place - 1).withColumn("shard", shard.cast("int"))
    return numbered.select(*columns, "size", "shard", "slot")
