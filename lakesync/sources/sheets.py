"""Spreadsheets: rows of text, the first of which names the columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.names import normalize_names, sheet_name
from lakesync.functions.text import fill_empty


def _drop_header(df: DataFrame, header: Sequence[str]) -> DataFrame:
    # Null-safe: an empty cell equals an empty cell.
    same = [F.col(f"`{c}`").eqNullSafe(F.lit(h)) for c, h in zip(df.columns, header)]
    return df.filter(~reduce(lambda a, b: a & b, same))


def header_promote(df: DataFrame, ordinal: str, rule: Callable[[str], str] = sheet_name) -> DataFrame:
    """Rows of text with a row number: the first names the columns, all rows equal to it go.

    Only that one row reaches the driver. Rows are compared to the header as it was written, before
    ``rule`` cleans the names.
    """
    cells = [c for c in df.columns if c != ordinal]
    first = df.select(ordinal, *cells).orderBy(ordinal).first()
    if first is None:
        raise ValueError("the sheet is empty")
    header = [first[c] for c in cells]
    rows = _drop_header(df.select(*cells), header)
    return normalize_names(rows.toDF(*["" if h is None else h for h in header]), rule)


def sheet_rows(
    spark: SparkSession, rows: Sequence[Sequence[str]], rule: Callable[[str], str] = sheet_name
) -> DataFrame:
    """A sheet as its API delivers it: a list of rows, a size that a person typed in."""
    header = list(rows[0])
    body = [list(r) for r in rows if list(r) != header]
    slots = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
    return normalize_names(spark.createDataFrame(body, T.StructType(slots)).toDF(*header), rule)


def read_sheet(spark: SparkSession, path: str, rule: Callable[[str], str] = sheet_name) -> DataFrame:
    """A sheet exported as CSV, all columns text; an empty cell is ''."""
    df = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    return normalize_names(fill_empty(_drop_header(df, df.columns)), rule)
