"""Checks of loads and replicas. Each is a DataFrame; a Report gathers outcomes and can raise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.operators.merge import semi_join_keys
from lakesync.spec import key_list

TOLERANCE = 0.05
MAX_AGE = timedelta(days=1)


class CheckFailed(AssertionError):
    """At least one check of a report did not pass."""


@dataclass
class Report:
    """Named outcomes; passes only when all of them do."""

    outcomes: dict[str, bool] = field(default_factory=dict)
    details: dict[str, object] = field(default_factory=dict)

    def add(self, name: str, ok: bool, detail: object = None) -> Report:
        self.outcomes[name] = bool(ok)
        self.details[name] = detail
        return self

    @property
    def ok(self) -> bool:
        return all(self.outcomes.values())

    def assert_ok(self) -> Report:
        if failed := [n for n, passed in self.outcomes.items() if not passed]:
            raise CheckFailed("; ".join(f"{n}: {self.details[n]}" for n in failed))
        return self


def within_band(source: Column, target: Column, tolerance: float = TOLERANCE) -> Column:
    """The source may exceed the target by the tolerance, a share of its size, and must not fall below it."""
    return (source >= target) & (source <= target + F.abs(target) * F.lit(tolerance))


def _side(df: DataFrame, label: str, other: str, measures: dict[str, Column]) -> DataFrame:
    # Aggregated before anything meets: one row per side.
    row = df.agg(*[m.alias(n) for n, m in measures.items()])
    mine = [F.col(n).alias(f"{label}_{n}") for n in measures]
    theirs = [F.lit(None).cast(row.schema[n].dataType).alias(f"{other}_{n}") for n in measures]
    return row.select(*mine, *theirs)


def _both_sides(source: DataFrame, target: DataFrame, measures: dict[str, Column]) -> DataFrame:
    left = _side(source, "source", "target", measures)
    right = _side(target, "target", "source", measures)
    both = left.unionByName(right)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def count_parity(source: DataFrame, target: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    row = _both_sides(source, target, {"count": F.count("*")})
    return row.withColumn("ok", within_band(F.col("source_count"), F.col("target_count"), tolerance))


def avg_parity(source: DataFrame, target: DataFrame, column: str, tolerance: float = TOLERANCE) -> DataFrame:
    row = _both_sides(source, target, {"avg": F.avg(column)})
    return row.withColumn("ok", within_band(F.col("source_avg"), F.col("target_avg"), tolerance))


def freshness(df: DataFrame, ts: str, now: datetime, max_age: timedelta = MAX_AGE) -> DataFrame:
    """Whether the newest row is younger than ``max_age`` at ``now``, which the caller states."""
    oldest = F.lit((now - max_age).isoformat(sep=" ")).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("newest"))
    return newest.withColumn("ok", F.coalesce(F.col("newest") > oldest, F.lit(False)))


def validate_replica(
    source: DataFrame,
    target: DataFrame,
    key: str,
    ts: str,
    now: datetime,
    tolerance: float = TOLERANCE,
    max_age: timedelta = MAX_AGE,
) -> DataFrame:
    """Freshness, average and count in one pass over each side: one row, ``ok`` when all hold."""
    measures = {"count": F.count("*"), "avg": F.avg(key), "newest": F.max(F.col(ts).cast("timestamp_ntz"))}
    row = _both_sides(source, target, measures)
    oldest = F.lit((now - max_age).isoformat(sep=" ")).cast("timestamp_ntz")
    return (
        row.withColumn("count_ok", within_band(F.col("source_count"), F.col("target_count"), tolerance))
        .withColumn("avg_ok", within_band(F.col("source_avg"), F.col("target_avg"), tolerance))
        .withColumn("fresh_ok", F.coalesce(F.col("target_newest") > oldest, F.lit(False)))
        .drop("source_newest")
        .withColumn("ok", F.col("count_ok") & F.col("avg_ok") & F.col("fresh_ok"))
    )


def committed_loads(
    commits: DataFrame, queries: DataFrame, utility: DataFrame, table: str, since: datetime
) -> DataFrame:
    """Committed loads of a table since a moment, by status: ``status, success, load_count``.

    ``commits(query, status)``, ``queries(query, xid, querytxt, starttime)``, ``utility(xid, text)``. A
    load counts when its transaction has a COMMIT record. The table name is matched literally.
    """
    start = F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")
    of_table = queries.filter(F.contains("querytxt", F.lit(table)) & (F.col("starttime") >= start))
    committed = utility.filter(F.rtrim("text") == "COMMIT").select("xid")
    # One load may have committed most of the files, so commits are counted before they meet anything.
    files = commits.groupBy("query", "status").agg(F.count("*").alias("files"))
    loads = files.join(semi_join_keys(of_table.select("query", "xid"), committed, "xid"), "query")
    return (
        loads.groupBy("status")
        .agg(F.sum("files").alias("load_count"))
        .select("status", (F.col("status") == 1).alias("success"), "load_count")
    )


def page_completeness(pages: DataFrame, resource: Sequence[str], received: Column, declared: Column) -> DataFrame:
    """Per resource: records received over all pages against the total the pages declare."""
    return (
        pages.groupBy(*resource)
        .agg(
            F.count("*").alias("page_count"),
            F.sum(received.cast("bigint")).alias("received"),
            F.max(declared.cast("bigint")).alias("declared"),
        )
        .withColumn("complete", F.coalesce(F.col("received") >= F.col("declared"), F.lit(True)))
    )


def envelope_ok(body: Column, expected: dict[str, str]) -> Column:
    """Whether a JSON page carries the marks of a good answer, such as ``object: list``."""
    tests = [F.coalesce(F.get_json_object(body, f"$.{k}") == v, F.lit(False)) for k, v in expected.items()]
    no_error = F.get_json_object(body, "$.error").isNull()
    return reduce(lambda a, b: a & b, tests, no_error)


def infer_key(df: DataFrame, candidates: Sequence[str | Sequence[str]]) -> DataFrame:
    """Which column sets could be a key: no NULL and no value twice.

    One narrow aggregation per candidate; repeated values are combined before the shuffle.
    """
    out = []
    for candidate in candidates:
        keys = key_list(candidate)
        counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        out.append(
            counts.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count_if(~has_null).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_keys"),
            ).select(
                F.lit(",".join(keys)).alias("candidate"),
                "row_count",
                "distinct_keys",
                "null_keys",
                (F.col("row_count") == F.col("distinct_keys")).alias("is_key"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def validate_load(
    errors: DataFrame | None = None,
    structure: DataFrame | None = None,
    max_error: int = 0,
    audit: DataFrame | None = None,
    load_id: str | None = None,
) -> Report:
    """Runs the given checks; passes only when all pass.

    ``errors`` is an error log: at most ``max_error`` entries. ``structure`` is the result of a structure check: every position
    fine. ``audit`` holds the audit rows of a store's loads: ``load_id`` is among them once, so its rows were published.
    """
    report = Report()
    if errors is not None:
        found = errors.limit(max_error + 1).count()
        report.add("load_errors", found <= max_error, f"{found} error(s)")
    if structure is not None:
        bad = [r.asDict() for r in structure.filter(~F.col("ok")).collect()]
        report.add("structure", not bad, bad)
    if audit is not None:
        rows = [r.asDict() for r in audit.filter(F.col("load_id") == load_id).limit(2).collect()]
        report.add("committed", len(rows) == 1, rows)
    return report
