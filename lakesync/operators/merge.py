"""Merging by key: latest row, upsert, delete, de-duplication.

Skew is met by construction. The latest row per key is a row_number window, for which Spark keeps
one row per key in every map task before the shuffle, so a key holding a third of the table sends
one row per task. Key filters (upsert, delete, semi join) look for hot keys first, in one pass over
the key columns, and spread only the rows of those, and rows without a key, over many join groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.spec import key_list

# A key is hot when it holds this share of the rows, so there are never more than 1 / HOT_SHARE.
HOT_SHARE = 1 / 64
# Groups that the rows of a hot key are spread over.
SPREAD = 256
_TRACKED = 8192
_FLAG = "__is_delta"
_RANK = "__rank"
_PART = "__part"
_UNORDERED = (T.MapType, T.VariantType)


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _has_key(keys: Sequence[str]) -> Column:
    return _all_of([F.col(k).isNotNull() for k in keys])


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, _UNORDERED):
        return False
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return True


def _latest_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(newest_first)).filter(F.col(_RANK) == 1).drop(_RANK)


def _latest_all(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    # The join is on key and timestamp, not key alone: the versions of a hot key fall apart by time,
    # and a moment that is hot itself is spread like a hot key.
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    hot = _hot_hashes(df, [*keys, ts])
    return _filter_by_keys(df, newest, [*keys, ts], "left_semi", hot, null_safe=[ts])


def keep_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    tie_breakers: Sequence[str | Column] | None = None,
    ties: str = "one",
    null_keys: str = "keep",
) -> DataFrame:
    """The newest row of every key.

    ``ties="one"`` keeps one row when several share the newest timestamp: ``tie_breakers`` decide,
    the largest value first, and all remaining sortable columns when none are given, so that a
    retried task picks the same row. ``ties="all"`` keeps all of them. Rows without a key are no
    versions of one another: ``null_keys="keep"`` passes them through, ``"drop"`` removes them.
    """
    keys = key_list(keys)
    if ties not in ("one", "all") or null_keys not in ("keep", "drop"):
        raise ValueError("ties is 'one' or 'all', null_keys is 'keep' or 'drop'")
    keyed = df.filter(_has_key(keys))
    if ties == "all":
        latest = _latest_all(keyed, keys, ts)
    else:
        if tie_breakers is None:
            tie_breakers = [f.name for f in df.schema.fields if f.name not in (*keys, ts) and _sortable(f.dataType)]
        order = [F.col(c) if isinstance(c, str) else c for c in (ts, *tie_breakers)]
        latest = _latest_one(keyed, keys, [c.desc_nulls_last() for c in order])
    if null_keys == "drop":
        return latest
    # A separate branch: one shuffle group must not receive every row without a key. Its scan is
    # a pushed IS NULL filter, which skips all row groups that hold none.
    return latest.unionByName(df.filter(~_has_key(keys)))


def dedupe_latest(
    df: DataFrame, keys: str | Sequence[str], ts: str, tie_breakers: Sequence[str | Column] | None = None
) -> DataFrame:
    """Reduce every repeated key to its newest row; rows without a key stay."""
    return keep_latest(df, keys, ts, tie_breakers)


def union_all(base: DataFrame, delta: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Both inputs, columns matched by name."""
    if not allow_missing:
        missing = sorted(set(base.columns) ^ set(delta.columns))
        if missing:
            raise ValueError(f"columns on one side only: {', '.join(missing)}")
    return base.unionByName(delta, allowMissingColumns=allow_missing)


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Pages whose column sets differ; absent columns are NULL."""
    if not pages:
        raise ValueError("no pages")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def reconcile_latest(
    base: DataFrame,
    delta: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    tie_breakers: Sequence[str | Column] | None = None,
    ties: str = "one",
    null_keys: str = "keep",
    allow_missing: bool = False,
) -> DataFrame:
    """Base and delta together, newest row per key; at equal timestamps the delta wins."""
    keys = key_list(keys)
    both = union_all(base.withColumn(_FLAG, F.lit(0)), delta.withColumn(_FLAG, F.lit(1)), allow_missing)
    if tie_breakers is None:
        fields = both.schema.fields
        tie_breakers = [f.name for f in fields if f.name not in (*keys, ts, _FLAG) and _sortable(f.dataType)]
    return keep_latest(both, keys, ts, [_FLAG, *tie_breakers], ties, null_keys).drop(_FLAG)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _hot_hashes(df: DataFrame, columns: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    most = int(1 / share)
    sketch = F.expr(f"approx_top_k(__hash, {most}, {_TRACKED})")
    hashes = df.select(_key_hash(columns).alias("__hash"))
    row = hashes.agg(F.count("*").alias("n"), sketch.alias("top")).first()
    return [entry["item"] for entry in row["top"] or [] if entry["count"] >= share * row["n"]]


def hot_keys(df: DataFrame, keys: str | Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows: 1 / share of them at most.

    Runs one aggregation without a shuffle of rows over the key columns alone. The sketch counts up to
    3.5 / 8192 of the rows wrong, far below the share, so no hot key is missed. The hashes only steer
    where rows go; no result depends on them.
    """
    keys = key_list(keys)
    return _hot_hashes(df.filter(_has_key(keys)), keys, share)


def _typed_keys(key_rows: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in the types of ``df``, for equal values must hash alike on both sides."""
    out = []
    for k in keys:
        mine, theirs = df.schema[k].dataType, key_rows.schema[k].dataType
        if mine == theirs:
            out.append(F.col(k))
        elif isinstance(mine, T.IntegralType) and isinstance(theirs, T.IntegralType):
            # A number that does not fit becomes NULL, and matches nothing, as it should.
            out.append(F.col(k).try_cast(mine).alias(k))
        else:
            raise TypeError(f"key {k} is {theirs.simpleString()} on one side and {mine.simpleString()} on the other")
    return key_rows.select(*out)


def _filter_by_keys(
    df: DataFrame,
    key_rows: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: Sequence[int],
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Semi or anti join on keys, with hot keys spread.

    Rows of a hot key go to the group given by their input partition's number, which a repeated task
    sees again; on the key side, distinct before the shuffle, only hot keys are repeated per group. Rows
    without a key match nothing, so they can go anywhere. No broadcast is asked for: Spark picks one
    when its size estimate allows.
    """
    other = {k: f"__k{i}" for i, k in enumerate(keys)}
    needed = [k for k in keys if k not in null_safe]
    right = _typed_keys(key_rows, df, keys).filter(_has_key(needed)).distinct()
    is_hot = _key_hash(keys).isin([int(h) for h in hot]) if hot else F.lit(False)
    groups = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))) if hot else None
    right = right.withColumn(_PART, F.explode(groups) if hot else F.lit(0))
    right = right.withColumnsRenamed({**other, _PART: "__p"})
    scattered = F.when(is_hot | ~_has_key(needed), F.pmod(F.spark_partition_id(), F.lit(SPREAD))).otherwise(F.lit(0))
    left = df.withColumn(_PART, scattered)
    same = [F.col(k).eqNullSafe(F.col(o)) if k in null_safe else F.col(k) == F.col(o) for k, o in other.items()]
    return left.join(right, _all_of([*same, F.col(_PART) == F.col("__p")]), how).select(*df.columns)


def delete_using(
    df: DataFrame, key_rows: DataFrame, keys: str | Sequence[str], hot: Sequence[int] | None = None
) -> DataFrame:
    """Rows whose key is not among ``key_rows``. A NULL key matches nothing, so its row stays.

    ``hot`` is what :func:`hot_keys` found in ``df``; without it the search is done here, so ``df`` should
    be a stored table. An empty list says that there are none.
    """
    keys = key_list(keys)
    return _filter_by_keys(df, key_rows, keys, "left_anti", hot_keys(df, keys) if hot is None else hot)


def semi_join_keys(
    df: DataFrame, key_rows: DataFrame, keys: str | Sequence[str], hot: Sequence[int] | None = None
) -> DataFrame:
    """Rows whose key is among ``key_rows``, each once; ``hot`` as for :func:`delete_using`."""
    keys = key_list(keys)
    keyed = df.filter(_has_key(keys))
    return _filter_by_keys(keyed, key_rows, keys, "left_semi", hot_keys(df, keys) if hot is None else hot)


def upsert(
    base: DataFrame,
    delta: DataFrame,
    keys: str | Sequence[str],
    latest_by: str | None = None,
    allow_missing: bool = False,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Delete the base rows whose key occurs in the delta, then add every delta row.

    With ``latest_by`` the delta is first reduced to its newest row per key. ``hot`` as for
    :func:`delete_using`.
    """
    if latest_by:
        delta = keep_latest(delta, keys, latest_by)
    return union_all(delete_using(base, delta, keys, hot), delta, allow_missing)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``row_count``."""
    keys = key_list(keys)
    return (
        df.filter(_has_key(keys)).groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication. Maps and variants have no equality, so they become JSON text."""
    as_text = {f.name: F.to_json(f.name) for f in df.schema.fields if not _sortable(f.dataType)}
    return df.withColumns(as_text).distinct() if as_text else df.distinct()


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
