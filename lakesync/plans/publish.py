"""Publishing: a new version of a table is written aside and then switched to.

A version is one or more Parquet folders ``<root>/<table>/v=<id>``. The manifest says which folders are current; a set of tables
switches together because one publication is one entry of it. Readers keep the previous version until the switch, and it stays
as backup. Appending publishes the old folders plus a new one and copies nothing.

Batches of changes to a table are entries of the same manifest, so their order is the manifest's. They belong
to the line of versions they came after: a new copy starts without any, and going back to a version brings back its own changes only.

Publications from several threads or drivers go on top of one another: an append takes whatever is current when it is entered,
and a version that was built on another than the current one can be refused (``built_on``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators.layout import clustered_layout
from lakesync.operators.schema import conformed
from lakesync.plans.manifest import Change, Conflict, Manifest, State, TableState, Version
from lakesync.plans.manifest import continued, reachable, same_version, version_entry

_AUDIT = "seq bigint, table string, load_id string, files string, row_count bigint, error_count bigint, starttime string"
_AUDIT_COLUMNS = [c.split(" ")[0] for c in _AUDIT.split(", ")]


@dataclass(frozen=True)
class PromotionResult:
    table: str
    path: str | None
    error: str | None


class SnapshotStore:
    """The versions of a set of tables below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = Manifest(spark, self.root)

    # -- manifest -----------------------------------------------------------------------------------

    def table_state(self, table: str) -> TableState:
        """Versions and changes of a table as they are now."""
        return self.manifest.state().table(table)

    def _current(self, table: str) -> Version:
        current = self.table_state(table).current
        if current is None:
            raise LookupError(f"no version of {table}")
        return current

    def current_seq(self, table: str) -> int:
        """The number of the publication that made the current version; 0 without one."""
        current = self.table_state(table).current
        return current.seq if current else 0

    def switch(
        self,
        paths: Mapping[str, str | Sequence[str]],
        schemas: Mapping[str, T.StructType] | None = None,
        built_on: Mapping[str, int] | None = None,
        facts: Mapping[str, Mapping[str, Any]] | None = None,
        loads: Sequence[Mapping[str, Any]] = (),
    ) -> int | None:
        """Make the given folders current, all at once, as new copies of their tables. Returns the publication's number.

        ``built_on`` gives for a table the version (:meth:`current_seq`) that its new one was made from; if it is no
        longer current, :class:`Conflict` is raised and nothing is switched. ``loads`` are audit rows of the same publication.
        """

        def build(state: State) -> list[dict[str, Any]] | None:
            entries = []
            for table, given in paths.items():
                same_version(state, table, (built_on or {}).get(table))
                folders = [given] if isinstance(given, str) else list(given)
                schema = (schemas or {}).get(table)
                entries.append(version_entry(table, folders, schema.json() if schema else None, facts=facts))
            return entries + [{"kind": "load", **x} for x in loads] or None

        return self.manifest.publish(build)

    def add_change(self, table: str, path: str, source: str, batch: int, reduced: bool, schema: T.StructType) -> int | None:
        """Enter a folder of changes, number ``batch`` of ``source``. Nothing is entered for a batch seen before."""

        def build(state: State) -> list[dict[str, Any]] | None:
            mine = state.table(table)
            if mine.has_batch(source, batch):
                return None
            if mine.current is None:
                raise LookupError(f"no version of {table}")
            told = {"path": path, "source": source, "batch": batch, "reduced": reduced, "schema": schema.json()}
            return [{"kind": "change", "table": table, "lineage": mine.current.lineage, **told}]

        return self.manifest.publish(build)

    def has_change(self, table: str, source: str, batch: int) -> bool:
        """Whether this batch of this source was ever entered."""
        return self.table_state(table).has_batch(source, batch)

    def changes_since(self, table: str) -> list[Change]:
        """The entries of changes that the current version does not hold, oldest first."""
        return self.table_state(table).changes_to(self._current(table))

    def fold(self, table: str, path: str, schema: T.StructType, built_on: Version, held: int) -> bool:
        """Make ``path`` current: ``built_on`` with its changes up to entry ``held`` folded in.

        If another version is current by then, nothing is switched, for that version would be lost.
        """

        def build(state: State) -> list[dict[str, Any]] | None:
            current = state.table(table).current
            if current is None or current.seq != built_on.seq:
                return None
            return [continued(table, current, paths=[path], schema=schema.json(), held=held, facts={})]

        return self.manifest.publish(build) is not None

    def load_audit(self, table: str | None = None) -> DataFrame:
        """One row per published load: each was entered by the publication that made its rows readable."""
        rows = [r for r in self.manifest.loads() if table is None or r["table"] == table]
        found = self.spark.createDataFrame([tuple(r.get(c) for c in _AUDIT_COLUMNS) for r in rows], _AUDIT)
        return found.withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))

    def was_loaded(self, table: str, load_id: str) -> bool:
        return any(r["table"] == table and r["load_id"] == load_id for r in self.manifest.loads())

    # -- data ---------------------------------------------------------------------------------------

    def stage(self, table: str, df: DataFrame, layout_keys: Sequence[str] | None = None) -> str:
        """Write a version that nobody reads yet."""
        path = f"{self.root}/{table}/v={uuid.uuid4().hex}"
        out = clustered_layout(df, layout_keys) if layout_keys else df
        out.write.mode("error").parquet(path)
        return path

    def discard(self, path: str) -> None:
        """Delete a staged folder that was not published."""
        used = reachable(self.manifest.state().tables.values())
        if any(p == path or p.startswith(path + "/") for p in used):
            raise ValueError(f"{path} is published")
        self.manifest.files.delete(path)

    def replace(
        self,
        table: str,
        df: DataFrame,
        layout_keys: Sequence[str] | None = None,
        built_on: int | None = None,
        load: Mapping[str, Any] | None = None,
    ) -> str:
        """Full copy/replace of one table. ``df`` may read the table's own current version, which ``built_on`` then names.

        Where another version came in between, :class:`Conflict` is raised and nothing is published.
        """
        path = self.stage(table, df, layout_keys)
        on = None if built_on is None else {table: built_on}
        try:
            self.switch({table: path}, {table: df.schema}, on, loads=[load] if load else [])
        except Conflict:
            self.discard(path)
            raise
        return path

    def append(self, table: str, df: DataFrame, load: Mapping[str, Any] | None = None) -> str:
        """Add rows, matched by name, in the table's types. Only the new rows are written.

        Appends side by side all take effect. Where the table got other columns meanwhile, :class:`Conflict` is raised.
        """
        before = self.table_state(table).current
        wanted = self._schema(before) if before else df.schema
        if before:
            df = conformed(df, wanted)
        path = self.stage(table, df)

        def build(state: State) -> list[dict[str, Any]]:
            current = state.table(table).current
            audit = [{"kind": "load", **load}] if load else []
            if current is None:
                return [version_entry(table, [path], df.schema.json()), *audit]
            newer = current.seq != (before.seq if before else 0)
            if newer and self._schema(current).simpleString() != df.schema.simpleString():
                raise Conflict(f"{table} got other columns meanwhile")
            return [continued(table, current, paths=[*current.paths, path]), *audit]

        try:
            self.manifest.publish(build)
        except Conflict:
            self.discard(path)
            raise
        return path

    def exists(self, table: str) -> bool:
        return self.table_state(table).current is not None

    def current_paths(self, table: str) -> list[str]:
        return list(self._current(table).paths)

    def _previous(self, state: TableState, table: str) -> Version:
        if len(state.versions) < 2:
            raise LookupError(f"no previous version of {table}")
        return state.versions[1]

    def _schema(self, version: Version) -> T.StructType:
        if version.schema is None:
            return self.spark.read.parquet(*version.paths).schema
        return T.StructType.fromJson(json.loads(version.schema))

    def read_version(self, version: Version) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(self._schema(version)) if version.schema else reader).parquet(*version.paths)

    def read(self, table: str) -> DataFrame:
        return self.read_version(self._current(table))

    def read_previous(self, table: str) -> DataFrame:
        """The version before the current one."""
        return self.read_version(self._previous(self.table_state(table), table))

    def rollback(self, table: str) -> list[str]:
        """Switch back to the previous version; the failed one becomes the backup.

        Changes made to the failed version go with it, unless it was an append to the previous one, or that with changes folded in.
        """
        paths: list[str] = []

        def build(state: State) -> list[dict[str, Any]]:
            previous = self._previous(state.table(table), table)
            paths[:] = previous.paths
            return [continued(table, previous)]

        self.manifest.publish(build)
        return paths

    def release(self, before: datetime) -> list[str]:
        """Delete folders that no reader can reach any more, and publications that written states stand for.

        The current and the previous version of every table stay, and the changes to either. ``before`` is a moment (UTC if it
        has no zone) after which nothing is touched: a folder written later may be a version about to be published, and a reader may have opened
        a version that was current until then. Returns the deleted folders.
        """
        moment = before if before.tzinfo else before.replace(tzinfo=timezone.utc)
        limit, files = int(moment.timestamp() * 1000), self.manifest.files
        self.manifest.write_state()
        # Listed before the state is read: what is published in between is in the state.
        found = []
        for table in self.manifest.state().tables:
            for place in (f"{self.root}/{table}", f"{self.root}/{table}/changes"):
                names = [n for n, changed in files.list(place) if changed < limit]
                found += [f"{place}/{n}" for n in names if n.startswith(("v=", "lakesync_batch=", "sums="))]
        state = self.manifest.state()
        kept = reachable(state.tables.values())
        kept |= {told["sums"] for t in state.tables.values() for v in t.versions for told in v.facts.values() if "sums" in told}
        # A version may hold single files of a folder: the others of it go.
        shared = {p.rsplit("/", 1)[0] for p in kept}
        gone = [p for p in found if p not in kept and p not in shared]
        for folder in shared & set(found) - kept:
            names = [n for n, changed in files.list(folder) if changed < limit and n.startswith("part-")]
            gone += [f"{folder}/{n}" for n in names if f"{folder}/{n}" not in kept]
        for path in gone:
            files.delete(path)
        self.manifest.prune(limit)
        return gone

    # -- catalog ------------------------------------------------------------------------------------

    def create_views(self, database: str, tables: Sequence[str], backup: str | None = None) -> None:
        """Point the catalog's views at the current versions, and backup views at the previous ones."""
        for table in tables:
            for place, paths in zip((database, backup), (v.paths for v in self.table_state(table).versions)):
                if place:
                    folders = " UNION ALL ".join(f"SELECT * FROM parquet.`{p}`" for p in paths)
                    self.spark.sql(f"CREATE OR REPLACE VIEW `{place}`.`{table}` AS {folders}")


def side_by_side(spark: SparkSession, one: Callable[[Any], Any], items: Sequence[Any], workers: int) -> list[Any]:
    """``one`` of every item, in order, from a few driver threads, so that small tables share the cluster."""
    with ThreadPoolExecutor(max(1, min(workers, len(items)))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), items))


def publish_swap(
    store: SnapshotStore, frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None, workers: int = 8
) -> int | None:
    """Write all tables aside, side by side, then switch all of them together. A failed write switches none."""
    tables = list(frames)
    staged = side_by_side(store.spark, lambda t: store.stage(t, frames[t], (keys or {}).get(t)), tables, workers)
    return store.switch(dict(zip(tables, staged)), {t: frames[t].schema for t in tables})


def promote_tables(
    source: SnapshotStore,
    target: SnapshotStore,
    tables: Mapping[str, Sequence[str]],
    read: Callable[[str], DataFrame] | None = None,
    workers: int = 8,
) -> list[PromotionResult]:
    """Copy tables to another store, side by side, clustered by key. A failing table is reported; the rest go on."""

    def one(table: str) -> PromotionResult:
        try:
            df = read(table) if read else source.read(table)
            return PromotionResult(table, target.replace(table, df, list(tables[table]) or None), None)
        except Exception as failure:  # noqa: BLE001 - one table must not stop the others
            return PromotionResult(table, None, str(failure))

    return side_by_side(target.spark, one, list(tables), workers)


def replace_table(df: DataFrame, name: str, layout_keys: Sequence[str] | None = None) -> None:
    """Full copy/replace of a catalog table that the frame does not read."""
    out = clustered_layout(df, layout_keys) if layout_keys else df
    out.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table, columns matched by name, in the table's types."""
    conformed(df, df.sparkSession.table(name).schema).write.mode("append").saveAsTable(name)


def apply_post_load(df: DataFrame, post_load: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    return post_load(df) if post_load else df
