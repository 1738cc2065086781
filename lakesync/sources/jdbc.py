"""JDBC scans. Filters and column choices made on the returned frames are pushed to the database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakesync.spec import HighWaterMark


@dataclass(frozen=True)
class JdbcSource:
    """A database: URL and connection properties such as user, password, driver, fetchsize."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Slices:
    """Parallel reading: one query per value range of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int

    @property
    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.count),
        }


def table_options(source: JdbcSource, table: str, slices: Slices | None = None) -> dict[str, str]:
    options = {"url": source.url, "dbtable": table, **source.properties}
    return {**options, **(slices.options if slices else {})}


def since_subquery(table: str, mark: HighWaterMark, value: datetime | None) -> str:
    """The table's rows past the mark, as a subquery the database filters itself."""
    if value is None:
        return table
    sign = ">=" if mark.inclusive else ">"
    return f"(SELECT * FROM {table} WHERE {mark.column} {sign} TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}') sub"


def query_options(source: JdbcSource, sql: str) -> dict[str, str]:
    return {"url": source.url, "query": sql, **source.properties}


def jdbc_table_scan(spark: SparkSession, source: JdbcSource, table: str, slices: Slices | None = None) -> DataFrame:
    """A whole table. Without ``slices`` one task reads all of it, so large tables need them."""
    return spark.read.format("jdbc").options(**table_options(source, table, slices)).load()


def jdbc_incremental_scan(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    mark: HighWaterMark,
    value: datetime | None,
    slices: Slices | None = None,
) -> DataFrame:
    """Rows past a high-water mark; everything when there is none yet."""
    return jdbc_table_scan(spark, source, since_subquery(table, mark, value), slices)


def jdbc_query_scan(spark: SparkSession, source: JdbcSource, sql: str) -> DataFrame:
    """The rows of any query, under the query's own column names."""
    return spark.read.format("jdbc").options(**query_options(source, sql)).load()
