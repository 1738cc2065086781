"""Replication of source tables: full copies, keyed upserts, latest-row reconciliation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakesync.operators.checks import Report, validate_replica
from lakesync.operators.merge import keep_latest, reconcile_latest, upsert
from lakesync.operators.schema import store_as_text
from lakesync.operators.watermark import read_high_water_mark, since_high_water
from lakesync.plans.changed import ChangedTable
from lakesync.plans.publish import PromotionResult, SnapshotStore, apply_post_load, promote_tables, side_by_side
from lakesync.plans.touched import merge_touched
from lakesync.session import shared_dir
from lakesync.sources.jdbc import JdbcSource, Slices, jdbc_incremental_scan, jdbc_table_scan
from lakesync.spec import HighWaterMark, TableSpec

Merge = Callable[[DataFrame, DataFrame, TableSpec], DataFrame]


@dataclass(frozen=True)
class TableResult:
    """What happened to one table: ``full``, ``bootstrap``, ``merged``, ``unchanged`` or ``failed``."""

    table: str
    action: str
    since: datetime | None = None
    error: str | None = None


class ImportFailed(RuntimeError):
    """Some tables failed; ``results`` says what became of each."""

    def __init__(self, results: Sequence[TableResult]):
        self.results = list(results)
        super().__init__("; ".join(f"{r.table}: {r.error}" for r in results if r.error))


@dataclass
class ReplicationResult:
    tables: list[TableResult] = field(default_factory=list)
    promoted: list[PromotionResult] = field(default_factory=list)
    reports: dict[str, Report] = field(default_factory=dict)

    @property
    def unvalidated(self) -> list[str]:
        """Promoted tables that were not compared with a source."""
        return [p.table for p in self.promoted if p.error is None and p.table not in self.reports]

    @property
    def ok(self) -> bool | None:
        """Whether nothing failed; None when that is so but some table was not validated."""
        failed = any(t.error for t in self.tables) or any(p.error for p in self.promoted)
        if failed or not all(r.ok for r in self.reports.values()):
            return False
        return None if self.unvalidated else True


def jdbc_extract(
    source: JdbcSource, table: str, mark: HighWaterMark | None = None, slices: Slices | None = None
) -> Callable[[SparkSession, datetime | None], DataFrame]:
    """An extract hook that reads a database table, past the mark when there is one."""

    def extract(spark: SparkSession, since: datetime | None) -> DataFrame:
        if mark is None:
            return store_as_text(jdbc_table_scan(spark, source, table, slices))
        return store_as_text(jdbc_incremental_scan(spark, source, table, mark, since, slices))

    return extract


def frame_extract(
    read: Callable[[SparkSession], DataFrame], mark: HighWaterMark | None = None
) -> Callable[[SparkSession, datetime | None], DataFrame]:
    """An extract hook over any frame, filtered past the mark."""
    def extract(spark: SparkSession, since: datetime | None) -> DataFrame:
        df = read(spark)
        return since_high_water(df, mark, since) if mark else df

    return extract


def _staged(spark: SparkSession, spec: TableSpec, since: datetime | None) -> DataFrame:
    # Written once: the source is asked once, and the planner knows the delta's true size.
    folder = shared_dir(spark, f"delta-{spec.name}")
    spec.extract(spark, since).write.parquet(folder)
    return spark.read.parquet(folder)


def full_import(
    store: SnapshotStore, specs: Sequence[TableSpec], on_empty: str = "replace", workers: int = 8
) -> list[TableResult]:
    """Copy whole tables and switch all of them together.

    An empty source empties its target, or leaves it alone with ``on_empty="skip"``.
    """

    def staged(spec: TableSpec) -> tuple[str, DataFrame, bool]:
        df = apply_post_load(spec.extract(store.spark, None), spec.post_load)
        path = store.stage(spec.name, df, spec.key_columns[:1] if spec.keys else None)
        # Told from what was written: the source is asked once.
        return path, df, on_empty == "skip" and store.spark.read.schema(df.schema).parquet(path).isEmpty()

    found = side_by_side(store.spark, staged, specs, workers)
    kept = {s.name: (path, df) for s, (path, df, skipped) in zip(specs, found) if not skipped}
    if kept:
        store.switch({t: path for t, (path, _) in kept.items()}, {t: df.schema for t, (_, df) in kept.items()})
    for path, _, skipped in found:
        if skipped:
            store.discard(path)
    return [TableResult(s.name, "full" if s.name in kept else "unchanged") for s in specs]


def _merge_import(store: SnapshotStore, spec: TableSpec, merge: Merge) -> TableResult:
    spark = store.spark
    if not store.exists(spec.name):
        # A first load takes everything, so there is nothing to merge afterwards.
        df = apply_post_load(spec.extract(spark, spec.mark.default if spec.mark else None), spec.post_load)
        store.replace(spec.name, df)
        return TableResult(spec.name, "bootstrap")
    seen, base = store.current_seq(spec.name), store.read(spec.name)
    since = read_high_water_mark(base, spec.mark) if spec.mark else None
    delta = _staged(spark, spec, since)
    if delta.isEmpty():
        return TableResult(spec.name, "unchanged", since)
    # Built on the version read above: one that came in between is not written over.
    store.replace(spec.name, apply_post_load(merge(base, delta, spec), spec.post_load), built_on=seen)
    return TableResult(spec.name, "merged", since)


def _import_touched(store: SnapshotStore, spec: TableSpec, merge: Merge) -> TableResult:
    if spec.post_load:
        raise ValueError(f"{spec.name}: post_load works on the merged table, which is only written with rewrite=True")
    if not store.exists(spec.name):
        store.replace(spec.name, spec.extract(store.spark, spec.mark.default if spec.mark else None), spec.key_columns)
        return TableResult(spec.name, "bootstrap")
    since = read_high_water_mark(store.read(spec.name), spec.mark) if spec.mark else None
    delta = _staged(store.spark, spec, since)
    if delta.isEmpty():
        return TableResult(spec.name, "unchanged", since)
    merge_touched(store, spec.name, delta, spec.keys, lambda base, new: merge(base, new, spec))
    return TableResult(spec.name, "merged", since)


def changed_table(store: SnapshotStore, spec: TableSpec) -> ChangedTable:
    return ChangedTable(store, spec.name, spec.keys)


def _import_changes(store: SnapshotStore, spec: TableSpec, latest: bool) -> TableResult:
    if spec.post_load:
        raise ValueError(f"{spec.name}: post_load works on the merged table, which is only written with rewrite=True")
    default = spec.mark.default if spec.mark else None
    if not store.exists(spec.name):
        store.replace(spec.name, spec.extract(store.spark, default))
        return TableResult(spec.name, "bootstrap")
    table = changed_table(store, spec)
    since = read_high_water_mark(table.seen(spec.mark.column), spec.mark) if spec.mark else None
    delta = _staged(store.spark, spec, since)
    if delta.isEmpty():
        return TableResult(spec.name, "unchanged", since)
    if latest:
        delta = keep_latest(delta, spec.keys, spec.mark.column)
    # Every run is a source of its own: it asks for what comes after the mark, and is no repetition.
    table.merge_batch(delta, 0, f"import-{uuid.uuid4().hex}")
    return TableResult(spec.name, "merged", since)


def _side_by_side(
    spark: SparkSession, specs: Sequence[TableSpec], one: Callable[[TableSpec], TableResult], workers: int
) -> list[TableResult]:
    """Tables imported from a few driver threads, so that small ones share the cluster; failures apart."""

    def guarded(spec: TableSpec) -> TableResult:
        try:
            return one(spec)
        except Exception as failure:  # noqa: BLE001 - one table must not stop the others
            return TableResult(spec.name, "failed", error=f"{type(failure).__name__}: {failure}")

    results = side_by_side(spark, guarded, specs, workers)
    if any(r.error for r in results):
        raise ImportFailed(results)
    return results


def incremental_import(
    store: SnapshotStore, specs: Sequence[TableSpec], rewrite: bool | str = True, latest: bool = False, workers: int = 8
) -> list[TableResult]:
    """Per table: rows past the target's mark, upserted by key.

    All rows of a key that the extract holds are kept, or the newest with ``latest``. ``rewrite=True`` publishes the
    merged table each time. With ``rewrite=False`` only the changes are written, and merged when :func:`changed_table`
    is read: for tables that are large next to their changes. ``rewrite="touched"`` writes the files that the changes fall into, and
    carries the others over. All give the same rows. All tables are tried;
    then :class:`ImportFailed` is raised if any failed.
    """

    def merge(base: DataFrame, delta: DataFrame, spec: TableSpec) -> DataFrame:
        return upsert(base, delta, spec.keys, spec.mark.column if latest else None)

    def one(spec: TableSpec) -> TableResult:
        if rewrite == "touched":
            return _import_touched(store, spec, merge)
        return _merge_import(store, spec, merge) if rewrite else _import_changes(store, spec, latest)

    return _side_by_side(store.spark, specs, one, workers)


def incremental_reconcile(
    store: SnapshotStore, specs: Sequence[TableSpec], workers: int = 8, rewrite: bool | str = True
) -> list[TableResult]:
    """Per table: rows past the target's mark, newest row per key kept. Failures as in :func:`incremental_import`.

    ``rewrite="touched"`` writes only the files that the changes fall into: for tables whose rows are the newest of their keys already.
    """

    def newest(base: DataFrame, delta: DataFrame, spec: TableSpec) -> DataFrame:
        column = spec.mark.column
        return reconcile_latest(base, delta, spec.keys, column, spec.tie_breakers, spec.ties, spec.null_keys)

    one = _import_touched if rewrite == "touched" else _merge_import
    return _side_by_side(store.spark, specs, lambda spec: one(store, spec, newest), workers)


def replicate(
    store: SnapshotStore,
    public: SnapshotStore,
    full: Sequence[TableSpec] = (),
    incremental: Sequence[TableSpec] = (),
    sources: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
    tolerance: float = 0.05,
    rewrite: bool | str = True,
) -> ReplicationResult:
    """Everything: upserts, full copies, promotion of the upserted tables, validation against sources.

    ``sources`` holds the source side of tables to validate; ``now`` is the moment freshness is judged at. A table
    whose upsert fails is reported, and not promoted. Full copies that fail are reported together, since they switch together.
    """
    result = ReplicationResult()
    try:
        result.tables += incremental_import(store, incremental, rewrite)
    except ImportFailed as some:
        result.tables += some.results
    done = {t.table for t in result.tables if t.error is None}
    incremental = [s for s in incremental if s.name in done]
    try:
        result.tables += full_import(public, full)
    except Exception as failure:  # noqa: BLE001 - the upserts are published, so their results are due
        result.tables += [TableResult(s.name, "failed", error=f"{type(failure).__name__}: {failure}") for s in full]
    by_name = {s.name: s for s in incremental}
    result.promoted = promote_tables(
        store,
        public,
        {s.name: s.key_columns for s in incremental},
        read=None if rewrite else lambda name: changed_table(store, by_name[name]).current(),
    )
    for spec in incremental:
        if sources and now and spec.name in sources and public.exists(spec.name):
            source, target = sources[spec.name], public.read(spec.name)
            row = validate_replica(
                source, target, spec.key_columns[0], spec.mark.column, now, tolerance
            ).first()
            report = Report()
            for check in ("count_ok", "avg_ok", "fresh_ok"):
                report.add(check, bool(row[check]), row.asDict())
            result.reports[spec.name] = report
    return result
