"""Target schemas: inference, translation, checks against data, and repair after load errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.casting import FALSE_WORDS, TRUE_WORDS, cast_text, is_text
from lakesync.functions.names import column_name
from lakesync.functions.text import NUMBER_TEXT, type_base_name

MAX_VARCHAR = 65535

# Target types that accept a generated type. A varying string accepts everything.
ACCEPTED_TYPES = {
    "TIMESTAMP": ("timestamp", "timestamptz", "timestamp without time zone"),
    "DATE": ("date",),
    "INTERVAL": ("interval",),
    "INTEGER": ("smallint", "integer", "int", "bigint", "int2", "int4", "int8"),
    "BIGINT": ("bigint", "int8"),
    "FLOAT": ("double precision", "float", "float8", "numeric", "decimal", "real", "float4"),
    "BOOLEAN": ("boolean", "bool"),
    "VARCHAR": ("varchar", "character varying", "nvarchar", "text", "character", "nchar", "bpchar"),
    "NULL": ("null",),
}
ACCEPTS_ANYTHING = ("varchar", "character varying")

# Source catalog types that the target knows; all others become wide strings.
KNOWN_TYPES = (
    "int2", "int", "int4", "bigint", "int8", "decimal", "numeric", "real", "float4",
    "double precision", "float8", "float", "boolean", "bool", "char", "character", "nchar",
    "bpchar", "varchar", "character varying", "nvarchar", "text", "date", "timestamp",
    "timestamp with time zone", "timestamp without time zone",
)


def family_of(kind: T.DataType) -> str:
    """The generated type for a Spark type; nested and binary values are stored as text."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(kind, T.DateType):
        return "DATE"
    if isinstance(kind, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "INTERVAL"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INTEGER"
    if isinstance(kind, T.LongType):
        return "BIGINT"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "FLOAT"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    return "VARCHAR"


def accepts(kind: T.DataType, target_type: str) -> bool:
    """Whether a target column, ``varchar(40)`` say, takes values of a Spark type."""
    base = target_type.split("(", 1)[0].strip().lower()
    return base in ACCEPTS_ANYTHING or base in ACCEPTED_TYPES[family_of(kind)]


def warehouse_type(kind: T.DataType, max_length: int | None = None) -> str:
    """Column type text. Decimals keep precision and scale; strings get their measured width."""
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision}, {kind.scale})"
    family = family_of(kind)
    if family != "VARCHAR":
        return family
    if is_text(kind) and max_length and max_length <= MAX_VARCHAR:
        return f"VARCHAR({max_length})"
    return "VARCHAR(MAX)"


def max_length_profile(df: DataFrame) -> DataFrame:
    """``column_name, max_length`` in characters; NULL for columns that hold no text. One pass."""
    lengths = [
        F.max(F.char_length(F.col(f"`{f.name}`"))) if is_text(f.dataType) else F.lit(None) for f in df.schema.fields
    ]
    row = df.agg(F.array(*[v.cast("int") for v in lengths]).alias("lengths"))
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.get("lengths", F.lit(i)).alias("max_length"))
        for i, name in enumerate(df.columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def measured_lengths(df: DataFrame) -> dict[str, int | None]:
    """The profile on the driver: one small row per column."""
    return {r["column_name"]: r["max_length"] for r in max_length_profile(df).collect()}


def generate_ddl(
    schema: T.StructType,
    table: str,
    lengths: Mapping[str, int | None] | None = None,
    primary_key: str | None = None,
    distkey: str | None = None,
    sortkey: str | None = None,
    all_varchar: bool = False,
) -> str:
    """CREATE TABLE text for a frame's schema, with cleaned column names."""
    parts = []
    for f in schema.fields:
        kind = "VARCHAR" if all_varchar else warehouse_type(f.dataType, (lengths or {}).get(f.name))
        marks = (" DISTKEY" if f.name == distkey else "") + (" SORTKEY" if f.name == sortkey else "")
        parts.append(f"{column_name(f.name)} {kind}{marks}")
    if primary_key:
        parts.append(f"PRIMARY KEY ({primary_key})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(parts)})"


def translated_type(name: Column, max_length: Column, precision: Column, scale: Column) -> Column:
    """Target type of one source catalog column."""
    wide = F.lit(f"varchar({MAX_VARCHAR})")
    varchar = F.when(max_length.isNull() | (max_length == 255), "text").otherwise(
        F.concat(F.lit("varchar("), max_length.cast("string"), F.lit(")"))
    )
    numeric = F.when(precision.isNull(), "numeric").otherwise(
        F.concat(
            F.lit("numeric("),
            precision.cast("string"),
            F.lit(", "),
            F.coalesce(scale.cast("string"), F.lit("")),
            F.lit(")"),
        )
    )
    return (
        F.when(name == "varchar", varchar).when(name == "numeric", numeric).when(name.isin(*KNOWN_TYPES), name)
    ).otherwise(wide)


def translate_schema(catalog: DataFrame) -> DataFrame:
    """Adds ``target_type`` to rows shaped like an information schema's column list."""
    parts = ("udt_name", "character_maximum_length", "numeric_precision", "numeric_scale")
    return catalog.withColumn("target_type", translated_type(*[F.col(p) for p in parts]))


def with_base_type(catalog: DataFrame, column: str = "type") -> DataFrame:
    return catalog.withColumn("base_type", type_base_name(F.col(column)))


def check_structure(df: DataFrame, target: T.StructType) -> DataFrame:
    """Whether delimited text fits a table: one row per position, never an exception.

    Columns ``pos, source, target, target_type, bad_values, ok``. A position is fine when both sides
    have a column and every non-blank text has a value in the target type; a string takes any.
    One aggregate over the text measures all columns.
    """
    width = max(len(df.columns), len(target.fields))
    bad = []
    for i in range(width):
        if i < len(df.columns) and i < len(target.fields) and not is_text(target.fields[i].dataType):
            c = F.col(f"`{df.columns[i]}`")
            bad.append(F.count_if((F.trim(c) != "") & cast_text(c, target.fields[i].dataType).isNull()))
        else:
            bad.append(F.lit(0).cast("bigint"))
    entries = []
    for i in range(width):
        source = df.columns[i] if i < len(df.columns) else None
        field = target.fields[i] if i < len(target.fields) else None
        count = F.get("bad", F.lit(i))
        entries.append(
            F.struct(
                F.lit(i + 1).alias("pos"),
                F.lit(source).cast("string").alias("source"),
                F.lit(field.name if field else None).cast("string").alias("target"),
                F.lit(field.dataType.simpleString() if field else None).cast("string").alias("target_type"),
                count.alias("bad_values"),
                ((count == 0) & F.lit(source is not None and field is not None)).alias("ok"),
            )
        )
    return df.agg(F.array(*bad).alias("bad")).select(F.inline(F.array(*entries)))


# ---- repair -------------------------------------------------------------------------------------

# Reasons a load error can have.
INVALID_DIGIT = "Invalid digit"
INVALID_DATE = "Invalid timestamp format or value"
UNKNOWN_BOOLEAN = "Unknown boolean format"
EXTRA_COLUMN = "Extra column(s) found"
TOO_LONG = "String length exceeds DDL length"
BLANK_LINE = "File contains a blank line"
MISSING_FIELDS = "Delimiter not found"
INVALID_CHARACTERS = "String contains invalid or unsupported UTF8 codepoints"

# Names of the first added columns.
NUMBER_WORDS = ("one", "two", "three", "four", "five")


class RepairError(ValueError):
    """A load error that no schema change can cure."""


@dataclass(frozen=True)
class SchemaChange:
    column: str
    old_type: str | None
    new_type: str


# A text that is written the one way a number is: no plus sign, no zeros in front, no exponent.
_PLAIN_NUMBER = r"^\s*-?(0|[1-9][0-9]*)([.][0-9]+)?\s*$"
_PLAIN_WHOLE = r"^\s*-?(0|[1-9][0-9]*)\s*$"
_BARE_NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?$"
# Decimal digits that a double always gives back, and that the widest decimal has.
_DOUBLE_DIGITS, _DECIMAL_DIGITS = 15, 38


def _whole_digits(text: Column) -> Column:
    return F.length(F.regexp_extract(text, r"^\s*[+-]?0*([0-9]*)", 1))


def _fraction_digits(text: Column) -> Column:
    return F.length(F.regexp_extract(text, r"[.]([0-9]*)", 1))


def fits_double(text: Column) -> Column:
    """Whether a number's text has no more digits than a double gives back."""
    digits = F.regexp_replace(F.regexp_replace(text, r"[eE].*", ""), r"[^0-9]", "")
    return F.length(F.ltrim(digits, F.lit("0"))) <= _DOUBLE_DIGITS


def error_profile(errors: DataFrame, digits: bool = False) -> DataFrame:
    """What all bad values of a column have in common: one row per reason kind and column.

    This is all the repair sees, so its size is the schema's and not the data's. ``digits`` adds how many the
    numbers have, from which a type is chosen that keeps them all.
    """
    value = F.col("raw_field_value")
    kind = F.regexp_extract("err_reason", r"^([^,]*)", 1)
    counts = [
        F.coalesce(F.bool_and(fits_double(value)), F.lit(False)).alias("double_safe"),
        F.coalesce(F.bool_and(~value.rlike("[eE]")), F.lit(False)).alias("no_exponent"),
        F.max(_whole_digits(value)).alias("whole_digits"),
        F.max(_fraction_digits(value)).alias("fraction_digits"),
    ]
    return errors.groupBy(kind.alias("reason"), "colname").agg(
        F.count("*").alias("error_count"),
        F.bool_and(cast_text(value, T.LongType()).isNotNull()).alias("all_integer"),
        F.bool_and(cast_text(value, T.DoubleType()).isNotNull()).alias("all_number"),
        F.bool_and(cast_text(value, T.TimestampNTZType()).isNotNull()).alias("all_timestamp"),
        F.max("field_count").alias("field_count"),
        *(counts if digits else []),
    )


def _wide_decimal(whole: int, fraction: int) -> T.DataType:
    """The decimal that has so many digits on each side, or text where none has."""
    return T.DecimalType(_DECIMAL_DIGITS, fraction) if whole + fraction <= _DECIMAL_DIGITS else T.StringType()


def widened(kind: T.DataType, profile: Mapping[str, object]) -> T.DataType:
    """The next wider type that holds the old values and all the bad ones, every digit of them."""
    if isinstance(kind, T.DateType) and profile["all_timestamp"]:
        return T.TimestampNTZType()
    if not profile["all_number"]:
        return T.StringType()
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    exact = (int(profile["whole_digits"]), int(profile["fraction_digits"])) if profile["no_exponent"] else None
    if isinstance(kind, T.IntegralType):
        if profile["all_integer"] and not isinstance(kind, T.LongType):
            return T.LongType()
        # A double holds every int, but not every bigint.
        if profile["double_safe"] and not isinstance(kind, T.LongType):
            return T.DoubleType()
        if exact:
            return _wide_decimal(max(exact[0], _WHOLE_DIGITS[type(kind)]), exact[1])
    elif isinstance(kind, T.DecimalType) and exact:
        return _wide_decimal(max(exact[0], kind.precision - kind.scale), max(exact[1], kind.scale))
    return T.StringType()


def added_name(number: int) -> str:
    """``new_column_one`` to ``new_column_five``, then ``new_column_6`` and on."""
    word = NUMBER_WORDS[number - 1] if number <= len(NUMBER_WORDS) else str(number)
    return f"new_column_{word}"


def evolve_schema(
    schema: T.StructType,
    profiles: Sequence[Mapping[str, object]],
    add_columns: bool = True,
    change_types: bool = True,
) -> tuple[T.StructType, list[SchemaChange]]:
    """The schema that the failed rows would load into, and what was changed to get there."""
    wanted: dict[str, T.DataType] = {}
    width = len(schema.fields)
    for profile in profiles:
        reason, column = str(profile["reason"]), profile["colname"]
        if reason.startswith(EXTRA_COLUMN) and add_columns:
            width = max(width, int(profile["field_count"]))
        elif reason.startswith((INVALID_DIGIT, INVALID_DATE)) and change_types:
            kind = widened(schema[column].dataType, profile)
            wanted[column] = T.StringType() if isinstance(wanted.get(column), T.StringType) else kind
        elif reason.startswith((UNKNOWN_BOOLEAN, TOO_LONG)) and change_types:
            wanted[column] = T.StringType()
        else:
            raise RepairError(f"{reason} ({column or 'whole line'}) cannot be repaired")
    fields, changes = [], []
    for f in schema.fields:
        kind = wanted.get(f.name, f.dataType)
        if kind != f.dataType:
            changes.append(SchemaChange(f.name, f.dataType.simpleString(), kind.simpleString()))
        fields.append(T.StructField(f.name, kind))
    taken = set(schema.names)
    number = 1
    while len(fields) < width:
        if (name := added_name(number)) not in taken:
            changes.append(SchemaChange(name, None, "string"))
            fields.append(T.StructField(name, T.StringType()))
        number += 1
    return T.StructType(fields), changes


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Existing rows in an evolved schema: changed columns cast, added ones NULL."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(_plain(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def holds_all_of(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` has its exact like in ``wide``."""
    if wide.simpleString() == narrow.simpleString() or (isinstance(wide, T.StringType) and is_text(narrow)):
        return True
    digits = _WHOLE_DIGITS.get(type(narrow))
    if digits:
        if isinstance(wide, T.DecimalType):
            return wide.precision - wide.scale >= digits
        return _WHOLE_DIGITS.get(type(wide), 15 if isinstance(wide, T.DoubleType) else 0) >= digits
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        more = wide.scale - narrow.scale
        return more >= 0 and wide.precision - narrow.precision >= more
    pairs = ((T.FloatType, T.DoubleType), (T.DateType, T.TimestampNTZType))
    return isinstance(narrow, T.NullType) or (type(narrow), type(wide)) in pairs


def conformed(df: DataFrame, schema: T.StructType, allow_new: bool = False) -> DataFrame:
    """Rows in the columns and types of ``schema``, by name; a type is cast up where that loses nothing.

    Columns on one side only are an error, as is a type that would lose values. With ``allow_new`` absent
    columns are NULL, and new ones stand at the end.
    """
    other = sorted(set(schema.names) ^ set(df.columns))
    if other and not allow_new:
        raise ValueError(f"columns differ: {', '.join(other)}")
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        mine = df.schema[f.name].dataType
        if not holds_all_of(f.dataType, mine):
            raise TypeError(f"column {f.name} is {mine.simpleString()}, which {f.dataType.simpleString()} cannot hold")
        column = F.col(f"`{f.name}`")
        same = f.dataType.simpleString() == mine.simpleString()
        out.append(column if same else column.cast(f.dataType).alias(f.name))
    return df.select(*out, *[F.col(f"`{c}`") for c in df.columns if c not in schema.names])


def _plain(kind: T.DataType) -> T.DataType:
    return T.StringType() if is_text(kind) else kind


# What a text can be, each a bit: a column's kinds are the bits of all its texts together.
_SHORT, _LONG, _LONGER, _FRACTION, _LONG_FRACTION, _NUMBER, _LONG_NUMBER, _CODE, _TRUTH, _MOMENT, _TEXT = (1 << i for i in range(11))


def _digits_and_kind(text: Column, t: Column, bare: Column) -> Column:
    """[kind, digits before the point, digits behind it] of a text, the digits of plain numbers only; NULL for a blank one.

    ``t`` is the text without blanks around it, ``bare`` whether that is a plain number. The tests stand in the order of what they
    cost: a plain number, which most are, is told by one pattern and its length.
    """
    size = F.length(t) - F.startswith(t, F.lit("-")).cast("int")
    point = F.instr(t, ".")
    zero = F.ltrim(t, F.lit("-")).startswith("0").cast("int")

    def found(kind: Column, whole: Column | None = None, fraction: Column | None = None) -> Column:
        none = F.lit(None).cast("int")
        return F.array(kind, none if whole is None else whole, none if fraction is None else fraction)

    def safe(yes: int, no: int) -> Column:
        # A text this short cannot have too many digits.
        return F.when((F.length(t) <= _DOUBLE_DIGITS) | fits_double(text), F.lit(yes)).otherwise(F.lit(no))

    whole = F.when(size <= _DOUBLE_DIGITS, _SHORT).when((size <= 18) | t.try_cast("bigint").isNotNull(), _LONG).otherwise(_LONGER)
    before = size - (F.length(t) - point) - 1 - zero
    date_like = (F.length(t) >= 8) & cast_text(text, T.TimestampNTZType()).isNotNull()
    return (
        F.when(t == "", None)
        .when(bare & (point == 0), found(whole, size - zero, F.lit(0)))
        .when(bare, found(safe(_FRACTION, _LONG_FRACTION), before, F.length(t) - point))
        .when(
            text.rlike(_PLAIN_NUMBER),  # other white space around it
            found(
                F.when(~text.rlike(_PLAIN_WHOLE), safe(_FRACTION, _LONG_FRACTION))
                .when(cast_text(text, T.LongType()).isNull(), _LONGER)
                .otherwise(safe(_SHORT, _LONG)),
                _whole_digits(text),
                _fraction_digits(text),
            ),
        )
        .when(text.rlike(r"^\s*(?:[+]|-?0[0-9])") & text.rlike(NUMBER_TEXT), found(F.lit(_CODE)))
        .when(text.rlike(NUMBER_TEXT), found(safe(_NUMBER, _LONG_NUMBER)))
        .when(F.lower(t).isin(*TRUE_WORDS, *FALSE_WORDS), found(F.lit(_TRUTH)))
        .when(date_like, found(F.lit(_MOMENT)))
        .when(text.isNotNull(), found(F.lit(_TEXT)))
    )


def infer_schema(df: DataFrame) -> T.StructType:
    """Types for columns of text, from all their values, such that no value loses a digit.

    Whole numbers are bigint, or decimal where they are longer; fractions are double, or decimal where a double
    has too few digits. A column with a plus sign or zeros in front of a number, which codes have, stays text, as does
    one with values of several kinds. Then come boolean and timestamp. Every value is classified once, in one aggregate; a row per column
    reaches the driver. Blank texts count as no value.
    """
    # Columns are laid under one another, so that the plan is as small for a hundred of them as for one.
    texts = df.select(F.posexplode(F.array(*[F.col(f"`{name}`").cast("string") for name in df.columns])).alias("at", "text"))
    # Columns of their own, so that each is worked out once.
    trimmed = texts.filter("text IS NOT NULL").withColumn("t", F.trim("text"))
    ready = trimmed.withColumn("bare", F.col("t").rlike(_BARE_NUMBER))
    told = ready.select("at", _digits_and_kind(F.col("text"), F.col("t"), F.col("bare")).alias("told"))
    kinds, digits, fraction = (F.get("told", F.lit(i)) for i in range(3))
    measured = told.groupBy("at").agg(
        F.bit_or(kinds).alias("kinds"), F.max(digits).alias("digits"), F.max(fraction).alias("fraction")
    )
    found = {r["at"]: r for r in measured.collect()}
    nothing = {"kinds": None, "digits": None, "fraction": None}
    return T.StructType([T.StructField(name, _type_of(found.get(i, nothing))) for i, name in enumerate(df.columns)])


def _type_of(found: Mapping[str, object]) -> T.DataType:
    kinds = found["kinds"] or _TEXT

    def only(*some: int) -> bool:
        return kinds & ~sum(some) == 0

    if only(_SHORT, _LONG):
        return T.LongType()
    if only(_SHORT, _LONG, _LONGER):
        return _wide_decimal(found["digits"], 0)
    if only(_SHORT, _FRACTION, _NUMBER):
        return T.DoubleType()
    if only(_SHORT, _LONG, _LONGER, _FRACTION, _LONG_FRACTION):
        return _wide_decimal(found["digits"], found["fraction"])
    if only(_TRUTH):
        return T.BooleanType()
    return T.TimestampNTZType() if only(_MOMENT) else T.StringType()


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of text in the types of a schema, by name; what does not fit is NULL."""
    return df.select(*[cast_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def store_as_text(df: DataFrame) -> DataFrame:
    """Nested values as JSON text and binary ones as base64, for targets with flat columns only."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            c = F.to_json(c).alias(f.name)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.base64(c).alias(f.name)
        out.append(c)
    return df.select(*out)
