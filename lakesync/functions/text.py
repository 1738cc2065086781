"""Cleaning expressions: Column in, Column out. All of them are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def int_or_null(c: Column, kind: T.DataType | None = None) -> Column:
    """A whole number, or NULL when the value is not one. Numbers lose their fraction, true is 1.

    ``kind`` is the column's type; text is assumed when it is left out. A variant counts as what it holds,
    so that the JSON number 3.7 is 3 and the JSON text "3.7" is no whole number.
    """
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(c, "$", "bigint")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("bigint")
    if isinstance(kind, T.NumericType):
        return c.try_cast("bigint")
    # A cast that fails costs a hundred times one that works, so hopeless ones are not tried.
    return F.when(c.rlike(INTEGER_TEXT), c.try_cast("bigint"))


def strip_quotes(c: Column) -> Column:
    """Remove double and single quotes."""
    return F.translate(c, "\"'", "")


def strip_commas_slashes(c: Column) -> Column:
    """Remove commas, then every ``//``."""
    return F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("//"), F.lit(""))


def iso_to_space(c: Column) -> Column:
    """``2024-01-02T03:04:05Z`` to ``2024-01-02 03:04:05``: every T is a space, every Z goes."""
    return F.translate(c, "TZ", " ")


def ascii_only(c: Column) -> Column:
    """Drop every character outside ASCII."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def fill_empty(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL to the empty string, in the string columns."""
    return df.na.fill("", columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def to_epoch(c: Column) -> Column:
    """Whole seconds since 1970-01-01. A plain timestamp counts as UTC whatever the session zone."""
    span = c.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return span.cast("interval second").cast("bigint")


def to_second(c: Column) -> Column:
    """Cut a plain timestamp to the second."""
    ts = c.cast("timestamp_ntz")
    fraction = F.extract(F.lit("SECOND"), ts) % F.lit(1)
    return ts - F.make_dt_interval(secs=fraction)


def date_shift(c: Column, hours: int = 0, days: int = 0) -> Column:
    """Move a timestamp by whole hours and days; negative goes back."""
    return c.cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))


def format_seconds(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def stringify(c: Column) -> Column:
    """Nested values as JSON text."""
    return F.to_json(c)


def concat_all(values: Column) -> Column:
    """Join the text of every non-NULL array element, without separator; nothing gives ''."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), "")


def type_base_name(c: Column) -> Column:
    """``VARCHAR(40)`` to ``varchar``."""
    return F.trim(F.lower(F.split_part(c, F.lit("("), F.lit(1))))


def trim_text(c: Column) -> Column:
    return F.trim(c)


def like_contains(c: Column, text: str) -> Column:
    """LIKE '%text%' with the text taken literally."""
    return F.contains(c, F.lit(text))


def classify_value(c: Column) -> Column:
    """The narrowest of INTEGER, FLOAT, TIMESTAMP, VARCHAR that holds the text; NULL stays NULL."""
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.rlike(INTEGER_TEXT) & F.trim(c).try_cast("bigint").isNotNull(), "INTEGER")
        .when(c.rlike(NUMBER_TEXT), "FLOAT")
        .when(c.rlike(r"^\s*[0-9]{4}-") & F.trim(c).try_cast("timestamp").isNotNull(), "TIMESTAMP")
        .otherwise("VARCHAR")
    )


def xml_tag(c: Column, tag: str) -> Column:
    """Text of the first ``<tag>``, NULL without one. An unclosed tag gives what follows it."""
    opened = F.split_part(c, F.lit(f"<{tag}>"), F.lit(2))
    return F.when(F.contains(c, F.lit(f"<{tag}>")), F.split_part(opened, F.lit(f"</{tag}>"), F.lit(1)))


def xml_tags(c: Column, tag: str) -> Column:
    """Text of every closed ``<tag>`` element, as an array in document order."""
    return F.regexp_extract_all(c, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def json_path(c: Column, path: str) -> Column:
    """Scalar under a dotted path in a JSON text column, as text."""
    return F.get_json_object(c, "$." + path)
