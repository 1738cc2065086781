"""Merging into a large table by rewriting the files that a delta touches.

The manifest keeps, for each file of such a table, the least and greatest value of its first key column and its rows. A delta meets
only files whose range holds one of its keys: those are read, merged with it and written anew, all others are carried over
to the new version as they are. With the table laid out by key, a delta of few keys rewrites few files; with keys all over the
table it rewrites all of them, as a plain merge does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators.merge import upsert
from lakesync.operators.schema import conformed
from lakesync.plans.manifest import Conflict, State, continued
from lakesync.plans.publish import SnapshotStore
from lakesync.session import shared_dir
from lakesync.spec import key_list

Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class TouchedMerge:
    """What a merge did: files rewritten, carried over and written."""

    rewritten: int
    carried: int
    written: int


def _comparable(c: Column, kind: T.DataType) -> Column:
    """A key as a number or text of the same order; text for kinds whose order neither has, which then count as touched."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return c
    raise TypeError(f"files have no ranges of {kind.simpleString()} keys")


def file_facts(store: SnapshotStore, folder: str, schema: T.StructType, key: str) -> dict[str, dict[str, Any]]:
    """By file of a folder: least and greatest key and number of rows. Reads the key column alone."""
    rows = store.spark.read.schema(schema).parquet(folder)
    value = _comparable(F.col(f"`{key}`"), schema[key].dataType)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    found = rows.groupBy(name.alias("name")).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("rows"))
    out = {}
    for r in found.collect():
        path = folder if folder.endswith("/" + r["name"]) else f"{folder}/{r['name']}"
        out[path] = {"key": key, "lo": r["lo"], "hi": r["hi"], "rows": r["rows"]}
    return out


def _toucher(lo: np.ndarray, hi: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched = np.zeros(len(lo), bool)
        for batch in batches:
            keys = np.unique(np.array(batch.column(0).drop_null().to_pylist(), dtype=lo.dtype))
            touched |= np.searchsorted(keys, lo, side="left") < np.searchsorted(keys, hi, side="right")
        yield pa.RecordBatch.from_pydict({"number": pa.array(np.flatnonzero(touched), pa.int64())})

    return run


def touched_files(delta: DataFrame, key: str, facts: dict[str, dict[str, Any]]) -> list[str]:
    """The files whose range of keys holds a key of ``delta``. Each task tells which files its keys fall into."""
    ranged = [p for p, told in facts.items() if told["lo"] is not None]
    if not ranged:
        return []
    kind = object if isinstance(facts[ranged[0]]["lo"], str) else np.int64
    lo, hi = (np.array([facts[p][side] for p in ranged], dtype=kind) for side in ("lo", "hi"))
    keys = delta.select(_comparable(F.col(f"`{key}`"), delta.schema[key].dataType).alias("key"))
    numbers = keys.mapInArrow(_toucher(lo, hi), "number bigint").distinct()
    return [ranged[r["number"]] for r in numbers.collect()]


def merge_touched(store: SnapshotStore, table: str, delta: DataFrame, keys: str | Sequence[str], merge: Merge) -> TouchedMerge:
    """Publish ``merge(rows of the touched files, delta)`` and the other files as they are.

    ``merge`` must leave rows alone whose key the delta does not have, and see them as often as the delta's rows alone would have it: upsert, and
    reconciling into a table that was reconciled. If another version is published meanwhile the merge is done again on that. Changes that
    wait for a :class:`~lakesync.plans.changed.ChangedTable` stay changes, and still win.
    """
    key = key_list(keys)[0]
    current = store.table_state(table).current
    if current is None:
        raise LookupError(f"no version of {table}")
    schema = store.read_version(current).schema
    landing = shared_dir(store.spark, f"touching-{table}")
    conformed(delta, schema).write.parquet(landing)
    delta = store.spark.read.schema(schema).parquet(landing)
    while True:
        facts: dict[str, dict[str, Any]] = {}
        for path in current.paths:
            told = current.facts.get(path, {})
            facts |= {path: told} if told.get("key") == key else file_facts(store, path, schema, key)
        touched = set(touched_files(delta, key, facts))
        carried = {p: told for p, told in facts.items() if p not in touched}
        base = store.spark.read.schema(schema).parquet(*touched) if touched else store.spark.createDataFrame([], schema)
        folder = store.stage(table, merge(base, delta), key_list(keys))
        made = file_facts(store, folder, schema, key)

        def build(state: State, on: int = current.seq, new: dict = carried | made) -> list[dict[str, Any]]:
            now = state.table(table).current
            if now is None or now.seq != on:
                raise Conflict(f"{table} was published anew meanwhile")
            # A table without rows still has its columns.
            return [continued(table, now, paths=list(new) or [folder], facts=new)]

        try:
            store.manifest.publish(build)
            return TouchedMerge(len(touched), len(carried), len(made))
        except Conflict:
            store.discard(folder)
            current = store.table_state(table).current
            if current is None or store.read_version(current).schema.simpleString() != schema.simpleString():
                raise


def upsert_touched(
    store: SnapshotStore, table: str, delta: DataFrame, keys: str | Sequence[str], latest_by: str | None = None
) -> TouchedMerge:
    """Upsert into a published table, rewriting only files that may hold a key of the delta."""
    return merge_touched(store, table, delta, keys, lambda base, new: upsert(base, new, keys, latest_by))
