"""Tolerant loading of delimited text, with every rejected field on record."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.casting import DATE_LAYOUTS, cast_text, is_date, is_text, text_width
from lakesync.operators.merge import semi_join_keys
from lakesync.operators.schema import (
    BLANK_LINE,
    EXTRA_COLUMN,
    INVALID_CHARACTERS,
    INVALID_DATE,
    INVALID_DIGIT,
    MISSING_FIELDS,
    TOO_LONG,
    UNKNOWN_BOOLEAN,
)

ERRORS = "_errors"
LATER = "_later"
RAW_LINE = "_raw_line"
FILE = "_file"
# Where a line stands: the first byte of its split of the file, and a number that rises by one along each split.
SPLIT = "_split"
PLACE = "_place"

# Put behind every line as one more field: where it lands tells how many fields the line has.
_END = "\u0001\u0002"
_WRITTEN_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# What is written for doubles that are no finite numbers.
NO_NUMBERS = ("NaN", "Infinity", "-Infinity")
_REPLACEMENT = "�"
# Splits smaller than this share a task, and the file that it writes.
_TASK_BYTES = 64 << 20

_ERROR_TYPE = (
    "array<struct<err_reason:string,colname:string,type:string,col_length:string,"
    "raw_field_value:string,field_count:bigint>>"
)


@dataclass(frozen=True)
class LoadOptions:
    """How forgiving a load is. The defaults are strict."""

    delimiter: str = ","
    header: bool = False
    trim_blanks: bool = False
    blanks_as_null: bool = False
    empty_as_null: bool = False
    truncate_columns: bool = False
    replace_invalid: bool = False
    accept_any_date: bool = False
    date_layouts: Sequence[str] = DATE_LAYOUTS
    max_error: int = 1
    multiline: bool = False

    @classmethod
    def tolerant(cls, delimiter: str = ",", header: bool = False, **other) -> LoadOptions:
        """The forgiving set that every feed of this library uses."""
        return cls(
            delimiter,
            header,
            trim_blanks=True,
            blanks_as_null=True,
            empty_as_null=True,
            truncate_columns=True,
            replace_invalid=True,
            accept_any_date=True,
            **other,
        )

    @property
    def csv(self) -> dict[str, str]:
        return {"sep": self.delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


class LoadError(RuntimeError):
    """Too many rejected fields."""


def write_delimited(
    df: DataFrame,
    path: str,
    delimiter: str = "|",
    header: bool = False,
    compression: str = "gzip",
    mode: str = "error",
) -> None:
    """Stage rows as delimited text, NULL as an empty field, timestamps with six digits of the second."""
    times = {"timestampFormat": _WRITTEN_TIME + "XXX", "timestampNTZFormat": _WRITTEN_TIME}
    writer = df.write.mode(mode).options(**times).option("sep", delimiter).option("header", header).option("compression", compression)
    # The writer would trim blanks unless told not to.
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": ""}
    writer.option("quote", '"').option("escape", '"').options(**kept).csv(path)


def _prepared(c: Column, kind: T.DataType, options: LoadOptions) -> Column:
    """A field's text after the options for blanks; NULL is a field without value."""
    if not is_text(kind):
        return F.when(F.trim(c) != "", c)
    # The parser makes an empty field NULL.
    c = F.coalesce(c, F.lit(""))
    kept = F.rtrim(c) if options.trim_blanks else c
    if options.blanks_as_null and options.empty_as_null:
        return F.when(F.trim(c) != "", kept)
    if options.blanks_as_null:
        return F.when((F.trim(c) != "") | (c == ""), kept)
    return F.when(c != "", kept) if options.empty_as_null else kept


def _stored(c: Column, kind: T.DataType, options: LoadOptions) -> Column:
    if is_text(kind):
        if options.replace_invalid:
            c = F.replace(c, F.lit(_REPLACEMENT), F.lit("?"))
        width = text_width(kind)
        return F.substring(c, 1, width) if width and options.truncate_columns else c
    value = cast_text(c, kind, options.date_layouts)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c.isin(*NO_NUMBERS), c.try_cast(kind)).otherwise(value)
    return value


def _failures(t: Column, v: Column, kind: T.DataType, options: LoadOptions) -> list[tuple[str, Column]]:
    """The ways a field of this type can fail: reason and condition over its text and its value."""
    if is_text(kind):
        out = []
        width = text_width(kind)
        if width and not options.truncate_columns:
            out.append((TOO_LONG, F.char_length(t) > width))
        if not options.replace_invalid:
            out.append((INVALID_CHARACTERS, F.contains(t, F.lit(_REPLACEMENT))))
        return out
    if is_date(kind):
        reason = INVALID_DATE
        if options.accept_any_date:
            return []
    else:
        reason = UNKNOWN_BOOLEAN if isinstance(kind, T.BooleanType) else INVALID_DIGIT
    return [(reason, t.isNotNull() & v.isNull())]


def _line_error(reason: str, raw: Column, count: Column) -> Column:
    nothing = F.lit(None).cast("string")
    values = (F.lit(reason), F.lit(""), F.lit(""), nothing, raw, count)
    return F.array(F.struct(*values)).cast(_ERROR_TYPE)


def _field_errors(schema: T.StructType, options: LoadOptions) -> Column:
    """An array with an error per bad field.

    Good lines, nearly all of them, only pay for the conditions: what an error says is put together
    from constant lists once a condition holds.
    """
    tests = []
    for i, f in enumerate(schema.fields):
        for reason, failed in _failures(F.col(f"t{i}"), F.col(f"v{i}"), f.dataType, options):
            width = text_width(f.dataType)
            tests.append((failed, i, reason, f.name, f.dataType.simpleString(), str(width) if width else None))
    none = F.array().cast(_ERROR_TYPE)
    if not tests:
        return none
    conditions, positions, reasons, names, types, widths = zip(*tests)

    def constant(values: Sequence[object]) -> Column:
        return F.array(*[F.lit(v).cast("string") for v in values])

    texts = F.array(*[F.col(f"t{i}") for i in positions])

    def entry(test: Column) -> Column:
        def pick(values: Column) -> Column:
            return F.get(values, test)

        reason, raw, kind = pick(constant(reasons)), pick(texts), pick(constant(types))
        quoted = F.concat(reason, F.lit(", Value '"), raw, F.lit("', Type: "), kind)
        said = F.when(reason == INVALID_DIGIT, quoted).otherwise(reason)
        return F.struct(said, pick(constant(names)), kind, pick(constant(widths)), raw, F.col("n"))

    failed = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
    any_failed = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])
    return F.when(any_failed, F.transform(failed, entry).cast(_ERROR_TYPE)).otherwise(none)


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    options: LoadOptions | None = None,
    line: str = "line",
    file: str | None = None,
    keep: Sequence[str] = (),
    judge_longer: bool = False,
) -> DataFrame:
    """Lines of delimited text as typed rows, with the errors of each line in an array column.

    Adds ``_errors``, ``_raw_line`` (of rejected lines only) and ``_file``, and columns of ``lines`` that ``keep`` names. A line without
    errors is a good row. Nothing is shuffled: every line is parsed once, where it was read.

    A line with more fields than the table has that one error. ``judge_longer`` adds ``_later``: the errors that its fields would have
    if the table had columns for the others.
    """
    options = options or LoadOptions()
    width = len(schema.fields)
    slots = [f"f{i}" for i in range(width + 1)]

    def record(text: Column, names: Sequence[str]) -> Column:
        ended = F.concat(text, F.lit(options.delimiter + _END))
        return F.from_csv(ended, ", ".join(f"{s} string" for s in names), options.csv)

    # Unnesting a one-element array keeps the optimizer from copying the parse into every use of a
    # field, and a later filter on errors from copying the casts.
    parsed = lines.select(
        F.col(line).alias(RAW_LINE),
        (F.col(file) if file else F.lit(None).cast("string")).alias(FILE),
        *keep,
        F.inline(F.array(record(F.col(line), slots))),
    )
    counted = parsed.select("*", (F.array_position(F.array(*slots), _END) - 1).alias("n"))
    texts = [_prepared(F.col(s), f.dataType, options).alias(f"t{i}") for i, (s, f) in enumerate(zip(slots, schema.fields))]
    prepared = counted.select(RAW_LINE, FILE, *keep, "n", F.col(slots[-1]).alias("extra"), *texts)
    values = [_stored(F.col(f"t{i}"), f.dataType, options).alias(f"v{i}") for i, f in enumerate(schema.fields)]
    typed = prepared.select("*", *values)

    n = F.col("n")
    # Only lines with more fields than the table are searched for how many they have: delimiters outside quotes.
    start = f"(^|{re.escape(options.delimiter)})"
    unquoted = F.regexp_replace(F.col(RAW_LINE), start + r'"(?:[^"]|"")*+"', "$1")
    total = F.when(n < 0, F.size(F.split(unquoted, re.escape(options.delimiter), -1)).cast("bigint"))
    # A line whose quote never closes holds its end mark within a field; it then has too few of them.
    too_many = (n < 0) & (total > width) & ~unquoted.rlike(start + '"')
    errors = (
        F.when(n == width, _field_errors(schema, options))
        .when(F.trim(RAW_LINE) == "", _line_error(BLANK_LINE, F.lit(""), n))
        .when(too_many, _line_error(EXTRA_COLUMN, F.coalesce("extra", F.lit("")), total))
        .otherwise(_line_error(MISSING_FIELDS, F.lit(""), n))
    )
    if width == 1:
        # A blank line is then one blank field.
        errors = F.when(F.trim(RAW_LINE) == "", _line_error(BLANK_LINE, F.lit(""), n)).otherwise(errors)
    # Where the fields of a line are not as many as the table's, its end mark stands among them.
    columns = [F.when(n == width, F.col(f"v{i}")).alias(f.name) for i, f in enumerate(schema.fields)]
    later = [F.when(too_many, _field_errors(schema, options)).alias(LATER)] if judge_longer else []
    judged = typed.select(F.inline(F.array(F.struct(*columns, errors.alias(ERRORS), RAW_LINE, FILE, *keep, *later))))
    return judged.withColumn(RAW_LINE, F.when(F.size(ERRORS) > 0, F.col(RAW_LINE)))


def _read_lines(spark: SparkSession, paths: str | list[str], width: int, options: LoadOptions) -> DataFrame:
    file = F.col("_metadata.file_path").alias("file")
    if options.multiline:
        # Only the CSV reader finds the end of a record that spans lines. It keeps the text of those
        # with another field count than expected; the text of all others is put together again.
        names = [f"x{i}" for i in range(width)]
        records = (
            spark.read.options(**options.csv)
            .options(multiLine=True, header=options.header, columnNameOfCorruptRecord="bad")
            .schema(", ".join(f"{x} string" for x in (*names, "bad")))
            .csv(paths)
        )
        again = F.to_csv(F.struct(*names), options.csv)
        return records.select(F.coalesce(F.rtrim(F.col("bad"), F.lit("\r\n")), again).alias("line"), file)
    lines = spark.read.text(paths).select(F.col("value").alias("line"), file)
    if not options.header:
        return lines
    # The CSV reader drops the first line of each file. It finds nothing to split or unquote in the others, and
    # passes blank ones over, which come from a scan of their own.
    whole = {"sep": "\u0001", "quote": "", "escape": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    rest = spark.read.options(**whole, header=True).schema("line string, bad string").csv(paths)
    rest = rest.select(F.coalesce("bad", "line").alias("line"), file)
    return rest.unionByName(lines.filter(F.trim("line") == ""))


def load_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    options: LoadOptions | None = None,
    judge_longer: bool = False,
) -> DataFrame:
    """Files of delimited text, parsed by :func:`parse_lines`. Gzip is known by the file suffix.

    A gzip file is read by one task, so large exports should come in many files.
    """
    options = options or LoadOptions()
    lines = _read_lines(spark, paths, len(schema.fields), options)
    return parse_lines(lines, schema, options, "line", "file", judge_longer=judge_longer)


def _tasks(spark: SparkSession, paths: str | list[str]) -> int:
    """The most tasks that reading files is worth: of ``_TASK_BYTES``, or some for each core. No content is read for it."""
    size = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    return max(-(-size // _TASK_BYTES), 4 * spark.sparkContext.defaultParallelism)


def parse_placed(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    options: LoadOptions | None = None,
    judge_longer: bool = False,
) -> DataFrame:
    """All lines of files, parsed in one scan, each with its file, split and place, for :func:`numbered`.

    A header is parsed like any other line. Store the result before it is numbered: places are those of one scan.
    """
    options = options or LoadOptions()
    if options.multiline:
        raise ValueError("records that span lines have no places")
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias(SPLIT),
    )
    # Many small splits are read by few tasks, each split after another: places rise along each all the same.
    lines = lines.coalesce(_tasks(spark, paths)).select("*", F.monotonically_increasing_id().alias(PLACE))
    return parse_lines(lines, schema, options, "line", "file", (SPLIT, PLACE), judge_longer)


def _splits(placed: DataFrame) -> DataFrame:
    """(file, split, first place, lines before the split in its file): a row per split, from counts made where the lines are."""
    counts = placed.groupBy(FILE, SPLIT).agg(F.min(PLACE).alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(FILE, SPLIT, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def without_headers(placed: DataFrame) -> DataFrame:
    """Lines without the first one of each file. Only the first place of each file meets the lines."""
    headers = placed.filter(F.col(SPLIT) == 0).groupBy(FILE).agg(F.min(PLACE).alias("header"))
    return placed.join(headers.select("header"), F.col(PLACE) == F.col("header"), "left_anti")


def numbered(placed: DataFrame, rejected: DataFrame) -> DataFrame:
    """``rejected``, some lines of the stored ``placed``, with ``line_number`` in their files, from 1 and headers included.

    A line's number is the number of lines in the splits before its own, from running sums per file, and its place in its
    split. Only rejected lines are joined.
    """
    found = rejected.join(_splits(placed), [FILE, SPLIT])
    return found.withColumn("line_number", F.col("before") + F.col(PLACE) - F.col("first") + 1).drop("before", "first")


def good_rows(parsed: DataFrame) -> DataFrame:
    """The rows of a parsed load that have no error."""
    return parsed.filter(F.size(ERRORS) == 0).drop(ERRORS, LATER, RAW_LINE, FILE, SPLIT, PLACE)


def repairable_errors(parsed: DataFrame) -> DataFrame:
    """The rejected fields of a load parsed with ``judge_longer``, those included that show only once the table has columns for all
    fields of a line; as :func:`~lakesync.operators.schema.error_profile` takes them."""
    rejected = parsed.filter(F.size(ERRORS) > 0)
    every = F.concat(ERRORS, F.coalesce(LATER, F.array().cast(_ERROR_TYPE)))
    return rejected.select(F.inline(every))


def load_errors(parsed: DataFrame, table: str, load_start: datetime | None = None) -> DataFrame:
    """The error log: one row per rejected field.

    ``line_number`` is that of :func:`numbered` rows, else NULL: files are read in splits, which know no line numbers.
    """
    start = F.lit(load_start.isoformat(sep=" ") if load_start else None).cast("timestamp_ntz")
    number = F.col("line_number") if "line_number" in parsed.columns else F.lit(None)
    rejected = parsed.filter(F.size(ERRORS) > 0).select(
        F.explode(ERRORS).alias("e"), RAW_LINE, FILE, number.cast("bigint").alias("line_number")
    )
    return rejected.select(
        F.lit(table).alias("table"),
        "e.err_reason",
        start.alias("starttime"),
        F.col(FILE).alias("filename"),
        "line_number",
        "e.colname",
        "e.type",
        "e.col_length",
        "e.raw_field_value",
        F.col(RAW_LINE).alias("raw_line"),
        "e.field_count",
    )


def errors_for_table(
    errors: DataFrame, tables: DataFrame, name: str, since: datetime | None = None, file: str | None = None
) -> DataFrame:
    """Log entries of one table since a moment, by way of the registry ``tables(id, name)``.

    ``errors`` carries the registry id as ``tbl``. ``file`` narrows to one file, blanks aside.
    """
    ids = tables.filter(F.col("name") == name).select(F.col("id").alias("tbl"))
    return load_window(semi_join_keys(errors, ids, "tbl").withColumn("table", F.lit(name)), since, file)


def load_window(errors: DataFrame, since: datetime | None = None, file: str | None = None) -> DataFrame:
    """Log entries since a moment and, optionally, of one file. The caller supplies the moment."""
    if since is not None:
        errors = errors.filter(F.col("starttime") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    if file is not None:
        errors = errors.filter(F.trim("filename") == file)
    return errors


def error_summary(errors: DataFrame) -> DataFrame:
    """Reason and column with the number of errors; reasons are cut before the value they quote."""
    reason = F.trim(F.regexp_extract("err_reason", r"^([^,]*)", 1))
    return errors.groupBy(reason.alias("err_reason"), F.trim("colname").alias("colname")).agg(
        F.count("*").alias("error_count")
    )


def check_max_error(errors: DataFrame, max_error: int) -> None:
    """Refuse a load whose errors reach the limit; 0 and 1 both refuse the first one."""
    limit = min(max(max_error, 1), 2**31 - 1)
    # Counting stops at the limit, whatever the log holds.
    if errors.limit(limit).count() >= limit:
        raise LoadError(f"the load has reached {limit} error(s)")
