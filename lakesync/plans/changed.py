"""Tables kept as a published base plus batches of changes.

A batch is written as one folder and entered in the store's manifest; the base is not rewritten for it, so a
batch costs what it holds. Reading merges base and changes, later batches winning; ``compact`` folds the
changes into a new base once in a while. A batch is known by its source and that source's number for it, so
a repeated one is skipped, and two streams never meet each other's numbers. Changes belong to the base they came
after: when a new copy of the table is published, they are history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators.merge import keep_latest, upsert
from lakesync.operators.schema import conformed
from lakesync.plans.manifest import TableState
from lakesync.plans.publish import SnapshotStore
from lakesync.session import shared_dir
from lakesync.spec import key_list

_BATCH = "lakesync_batch"
_SEQ = "lakesync_seq"


class ChangedTable:
    """A table as a published base plus the batches that came after it.

    With ``ts``, a batch is reduced to its newest row per key before it is written; without, all its rows are kept. Among batches
    the later one wins, whatever its timestamps say: a change replaces what was there, as an upsert does.
    A batch with other columns than the table's is an error, or brings new columns with ``allow_new``.
    """

    def __init__(
        self, store: SnapshotStore, name: str, keys: str | Sequence[str], ts: str | None = None, allow_new: bool = False
    ):
        self.store = store
        self.name = name
        self.keys = key_list(keys)
        self.ts = ts
        self.allow_new = allow_new
        self._changes_root = f"{store.root}/{name}/changes"

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def merge_batch(self, df: DataFrame, batch_id: int, source: str = "") -> None:
        """Write one batch of a source. The same batch again changes nothing."""
        state = self._state()
        if state.has_batch(source, batch_id):
            return
        df = conformed(df, self._schema(state), self.allow_new)
        if self.ts:
            # Landed first: reading the newest rows takes two passes, and the source is asked once.
            landing = shared_dir(df.sparkSession, f"batch-{self.name}")
            df.write.parquet(landing)
            df = keep_latest(df.sparkSession.read.schema(df.schema).parquet(landing), self.keys, self.ts)
        path = f"{self._changes_root}/{_BATCH}=b{uuid.uuid4().hex}"
        df.write.mode("error").parquet(path)
        self.store.add_change(self.name, path, source, batch_id, self.ts is not None, df.schema)

    def _state(self) -> TableState:
        state = self.store.table_state(self.name)
        if state.current is None:
            raise LookupError(f"no version of {self.name}")
        return state

    def _schema(self, state: TableState) -> T.StructType:
        """The base's columns, then those that changes brought."""
        fields = list(self.store.read_version(state.current).schema.fields)
        for change in state.changes_to(state.current):
            known = {f.name for f in fields}
            fields += [f for f in T.StructType.fromJson(json.loads(change.schema)).fields if f.name not in known]
        return T.StructType(fields)

    def _read(self, state: TableState) -> DataFrame:
        """The rows of the changes in all their columns, with the number of their entry."""
        entries = state.changes_to(state.current)
        reader = self.spark.read.options(basePath=self._changes_root).schema(self._schema(state))
        rows = reader.parquet(*[e.path for e in entries])
        names = [e.path.rsplit("=", 1)[1] for e in entries]
        numbers = F.create_map(*reduce(add, [[F.lit(n), F.lit(e.seq).cast("bigint")] for n, e in zip(names, entries)]))
        return rows.withColumn(_SEQ, F.element_at(numbers, F.col(_BATCH))).drop(_BATCH)

    def _merged(self, state: TableState) -> DataFrame:
        base, entries = self.store.read_version(state.current), state.changes_to(state.current)
        if not entries:
            return base
        changes = self._read(state)
        if all(e.reduced for e in entries):
            # One batch holds a key once, so the number alone decides.
            newest = keep_latest(changes, self.keys, _SEQ, tie_breakers=[])
        else:
            newest = keep_latest(changes, self.keys, _SEQ, ties="all")
        return upsert(base, newest.drop(_SEQ), self.keys, allow_missing=True)

    def changes(self) -> DataFrame:
        """Changes that the base does not hold yet, with the number of their entry."""
        state = self._state()
        if state.changes_to(state.current):
            return self._read(state)
        schema = T.StructType([*self._schema(state).fields, T.StructField(_SEQ, T.LongType())])
        return self.spark.createDataFrame([], schema)

    def seen(self, column: str) -> DataFrame:
        """One column of all rows that ever arrived, for a high-water mark: nothing is joined for it."""
        state = self._state()
        base = self.store.read_version(state.current).select(column)
        return base.unionByName(self._read(state).select(column)) if state.changes_to(state.current) else base

    def current(self) -> DataFrame:
        """Base and changes merged: a change replaces every row of its key."""
        return self._merged(self._state())

    def compact(self) -> bool:
        """Fold the changes into a new base. Those that arrive meanwhile stay changes of the new one.

        False, with nothing switched, if another version was published meanwhile: a fresh copy needs no old changes.
        """
        state = self._state()
        entries = state.changes_to(state.current)
        if not entries:
            return True
        merged = self._merged(state)
        path = self.store.stage(self.name, merged, self.keys)
        done = self.store.fold(self.name, path, merged.schema, state.current, entries[-1].seq)
        if not done:
            self.store.discard(path)
        return done
