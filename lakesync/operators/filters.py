"""Filters and report queries described as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The operator names a filter may use.
OPERATORS = {
    "equals": lambda c, v: c == v,
    "not equals": lambda c, v: c != v,
    "less than": lambda c, v: c < v,
    "less or equal": lambda c, v: c <= v,
    "greater than": lambda c, v: c > v,
    "greater or equal": lambda c, v: c >= v,
    "like": lambda c, v: c.like(v),
    "in": lambda c, v: c.isin(_values(v)),
    "not in": lambda c, v: ~c.isin(_values(v)),
}


def _values(value: str | Sequence[str]) -> list[str]:
    return [v.strip() for v in value.split(",")] if isinstance(value, str) else list(value)


def bare_name(column: str) -> str:
    """``table.column`` to ``column``."""
    return column.split(".", 1)[-1]


def filter_spec(filters: Sequence[Mapping[str, object]]) -> Column:
    """The conjunction of ``{"column", "operator", "value"}`` entries; no entry means all rows.

    Values are texts; Spark converts them to the column's type.
    """
    conditions = []
    for entry in filters:
        operator = str(entry["operator"]).lower().strip()
        if operator not in OPERATORS:
            raise ValueError(f"unknown operator: {operator}")
        conditions.append(OPERATORS[operator](F.col(bare_name(str(entry["column"]))), entry["value"]))
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def report_to_query(df: DataFrame, columns: Sequence[str], filters: Sequence[Mapping[str, object]] = ()) -> DataFrame:
    """The detail rows of a report over one table: its filters, then its columns."""
    if len({c.split(".", 1)[0] for c in columns if "." in c}) > 1:
        raise ValueError("all columns must come from the same table")
    return df.filter(filter_spec(filters)).select(*[bare_name(c) for c in columns])
