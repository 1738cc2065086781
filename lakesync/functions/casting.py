"""Text to typed values without failing: a value that does not fit is NULL."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.text import INTEGER_TEXT, NUMBER_TEXT

# The words for true and false.
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")

# Tried in this order after the ISO layouts.
DATE_LAYOUTS = (
    "yyyyMMdd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MMM dd, yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
)

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_date(kind: T.DataType) -> bool:
    return isinstance(kind, _DATES)


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.VarcharType, T.CharType))


def text_width(kind: T.DataType) -> int | None:
    return kind.length if isinstance(kind, (T.VarcharType, T.CharType)) else None


def layout_shape(layout: str) -> str:
    """A pattern for texts that a date layout could read: digits for numbers, letters for names."""
    out = ""
    for run in re.findall(r"[A-Za-z]+|[^A-Za-z]+", layout):
        if run.startswith("MMM"):
            out += "[A-Za-z]+"
        else:
            out += f"[0-9]{{{len(run)}}}" if run[0].isalpha() else re.escape(run)
    return f"^{out}$"


def _as_date(c: Column, kind: T.DataType, layouts: Sequence[str]) -> Column:
    # Shorter texts, a bare year say, are no date although a cast would take them as one.
    # A cast to date would also take any text behind the day.
    moment = c.try_cast("timestamp_ntz").cast(kind) if isinstance(kind, T.DateType) else c.try_cast(kind)
    iso = F.when((F.substring(c, 5, 1) == "-") & (F.length(c) >= 8), moment)
    if not layouts:
        return iso
    # A failed parse is costly, so the shape of the text decides which layout is tried.
    layout = reduce(lambda found, f: found.when(c.rlike(layout_shape(f)), f), layouts, F.when(c.isNull(), None))
    return F.coalesce(iso, F.try_to_timestamp(c, layout).cast(kind))


def cast_text(c: Column, kind: T.DataType, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """The value of a text in a column type, NULL when it has none. Blanks around numbers are ignored."""
    if is_text(kind):
        return c
    if is_date(kind):
        return _as_date(F.trim(c), kind, layouts)
    # A cast that fails costs a hundred times one that works, so hopeless ones are not tried. The pattern
    # also keeps out spellings such as 1d, NaN or 0x1p3, which a cast would read as numbers.
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(c.rlike(NUMBER_TEXT), c.try_cast(kind))
    if isinstance(kind, T.IntegralType):
        return F.when(c.rlike(INTEGER_TEXT), c.try_cast(kind))
    if isinstance(kind, T.BooleanType):
        word = F.lower(F.trim(c))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return c.try_cast(kind)
