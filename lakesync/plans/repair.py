"""Loading delimited text into a table, widening the table until everything fits."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators.checks import Report, validate_load
from lakesync.operators.schema import RepairError, SchemaChange, cast_to_schema, conformed, error_profile, evolve_schema
from lakesync.plans.distinct import append_distinct, replace_distinct
from lakesync.plans.publish import SnapshotStore, apply_post_load
from lakesync.session import shared_dir
from lakesync.sources.delimited import ERRORS, LoadOptions, check_max_error, good_rows, load_delimited, load_errors
from lakesync.sources.delimited import numbered, parse_placed, repairable_errors, without_headers


@dataclass
class LoadResult:
    """Good rows and the error log of one load, both read from one parsed copy in shared storage."""

    rows: DataFrame
    errors: DataFrame
    schema: T.StructType
    load_id: str | None = None
    changes: list[SchemaChange] = field(default_factory=list)
    # How often the files were parsed.
    passes: int = 1


def _staged(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, table: str, options: LoadOptions, judge_longer: bool = False
) -> DataFrame:
    """The lines of files, parsed once into shared storage and read from there."""
    folder = shared_dir(spark, f"load-{table}")
    read = load_delimited if options.multiline else parse_placed
    wanted = read(spark, paths, schema, options, judge_longer)
    wanted.write.parquet(folder)
    return spark.read.schema(wanted.schema).parquet(folder)


def _without_headers(parsed: DataFrame, options: LoadOptions) -> DataFrame:
    return without_headers(parsed) if options.header and not options.multiline else parsed


def _result(
    parsed: DataFrame, schema: T.StructType, table: str, options: LoadOptions, load_start: datetime | None, passes: int = 1
) -> LoadResult:
    lines = _without_headers(parsed, options)
    rejected = lines if options.multiline else numbered(parsed, lines.filter(F.size(ERRORS) > 0))
    return LoadResult(good_rows(lines), load_errors(rejected, table, load_start), schema, passes=passes)


def staged_load(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    table: str,
    options: LoadOptions | None = None,
    load_start: datetime | None = None,
) -> LoadResult:
    """Parse files once into shared storage; good rows and errors, with line numbers, are reads of that copy.

    Records that span lines (``multiline``) have no line numbers.
    """
    options = options or LoadOptions()
    return _result(_staged(spark, paths, schema, table, options), schema, table, options, load_start)


def _audit_row(
    table: str, load_id: str, paths: str | list[str], rows: DataFrame, errors: DataFrame, load_start: datetime | None
) -> dict[str, object]:
    return {
        "table": table,
        "load_id": load_id,
        "files": paths if isinstance(paths, str) else ",".join(paths),
        "row_count": rows.count(),
        "error_count": errors.count(),
        "starttime": load_start.isoformat(sep=" ") if load_start else None,
    }


def copy_into(
    store: SnapshotStore,
    table: str,
    paths: str | list[str],
    schema: T.StructType,
    options: LoadOptions | None = None,
    dedupe: bool = True,
    load_start: datetime | None = None,
    load_id: str | None = None,
    post_load: Callable[[DataFrame], DataFrame] | None = None,
) -> LoadResult:
    """Add the rows of files to a table, whole rows made distinct unless told otherwise. The target is not rewritten.

    Refused, with nothing published, when the errors reach ``options.max_error``. The publication that makes the rows readable
    enters an audit row as well, under ``load_id``; a load of that id which is there already changes nothing. ``post_load``
    works on the good rows before they are published.
    """
    options, load_id = options or LoadOptions(), load_id or uuid.uuid4().hex
    result = staged_load(store.spark, paths, schema, table, options, load_start)
    check_max_error(result.errors, options.max_error)
    result.load_id = load_id
    result.rows = apply_post_load(result.rows, post_load)
    if store.was_loaded(table, load_id):
        return result
    audit = _audit_row(table, load_id, paths, result.rows, result.errors, load_start)
    if dedupe:
        append_distinct(store, table, result.rows, audit)
    else:
        store.append(table, result.rows, audit)
    return result


def load_and_validate(
    store: SnapshotStore,
    table: str,
    paths: str | list[str],
    schema: T.StructType,
    options: LoadOptions | None = None,
    max_error: int = 0,
    load_start: datetime | None = None,
    load_id: str | None = None,
    post_load: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[LoadResult, Report]:
    """Load, check, publish, and look up that it was published: one path, whose report says how each check came out.

    Files with over ``max_error`` rejected fields publish nothing; the report then fails and the audit has no row. So do rows that
    ``post_load`` leaves in other columns or types than the table's.
    """
    options, load_id = options or LoadOptions(), load_id or uuid.uuid4().hex
    result = staged_load(store.spark, paths, schema, table, options, load_start)
    result.load_id = load_id
    result.rows = apply_post_load(result.rows, post_load)
    before = validate_load(result.errors, max_error=max_error)
    if store.exists(table):
        try:
            conformed(result.rows, store.read(table).schema)
            before.add("structure", True)
        except (TypeError, ValueError) as other:
            before.add("structure", False, str(other))
    if before.ok and not store.was_loaded(table, load_id):
        append_distinct(store, table, result.rows, _audit_row(table, load_id, paths, result.rows, result.errors, load_start))
    committed = validate_load(audit=store.load_audit(table), load_id=load_id)
    return result, before.add("committed", committed.ok, committed.details["committed"])


def load_with_repair(
    store: SnapshotStore,
    table: str,
    paths: str | list[str],
    schema: T.StructType,
    options: LoadOptions | None = None,
    add_columns: bool = True,
    change_types: bool = True,
    load_start: datetime | None = None,
    load_id: str | None = None,
) -> LoadResult:
    """Load files; if there are errors, widen the schema by what failed and parse again.

    The first pass also judges the fields of lines that have more of them than the table, so it sees all that fails and each column gets
    the type that holds its old values and all bad ones: files are parsed once if they fit, else twice. Should errors remain, more passes follow.
    Then loaded rows that the table does not hold are added; if its schema got wider, old rows are cast and all are written
    anew. The version before stays readable. An error no change can cure raises and publishes nothing.
    """
    spark, options = store.spark, options or LoadOptions()
    changes: list[SchemaChange] = []
    passes = 3 * len(schema.fields) + 10
    for done in range(1, passes + 1):
        parsed = _staged(spark, paths, schema, table, options, judge_longer=True)
        failed = repairable_errors(_without_headers(parsed, options))
        profiles = [r.asDict() for r in error_profile(failed, digits=True).collect()]
        if not profiles:
            break
        wider, made = evolve_schema(schema, profiles, add_columns, change_types)
        if not made:
            raise RepairError(f"errors remain in {table} that no schema change cures")
        schema = wider
        changes += made
    else:
        raise RepairError(f"{table} still has errors after {passes} passes")
    result = _result(parsed, schema, table, options, load_start, done)
    load_id = load_id or uuid.uuid4().hex
    audit = _audit_row(table, load_id, paths, result.rows, result.errors, load_start)
    current = store.table_state(table).current
    if current is None or store.read_version(current).schema.simpleString() == schema.simpleString():
        append_distinct(store, table, result.rows, audit)
    else:
        rows = cast_to_schema(store.read_version(current), schema).unionByName(result.rows)
        replace_distinct(store, table, rows, current, audit)
    return LoadResult(result.rows, result.errors, schema, load_id, changes, done)
