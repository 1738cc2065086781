"""Row and column shape: conforming, projecting, unwrapping and flattening nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.names import undotted_name


def conform_columns(df: DataFrame, target: Sequence[str] | T.StructType) -> DataFrame:
    """Exactly the target columns, in order: missing ones are NULL, extra ones go.

    A schema as target gives missing columns their type; a list of names makes them strings.
    """
    if isinstance(target, T.StructType):
        wanted = [(f.name, f.dataType) for f in target.fields]
    else:
        wanted = [(name, T.StringType()) for name in target]
    have = set(df.columns)
    return df.select([F.col(f"`{n}`") if n in have else F.lit(None).cast(kind).alias(n) for n, kind in wanted])


def project_fixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A declared column list, in order; a missing column is an error."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return df.select(*columns)


def select_fields(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """A chosen subset of at least two fields; no choice keeps all."""
    if not fields:
        return df
    if len(fields) < 2:
        raise ValueError("the number of fields must be at least 2")
    return project_fixed(df, fields)


def drop_all_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove rows in which every (given) column is NULL."""
    return df.dropna(how="all", subset=list(columns) if columns else None)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema. The optimizer replaces the input by an empty relation."""
    return df.filter(F.lit(False))


def unwrap_pages(df: DataFrame, data_key: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of the page array ``data_key``; struct records become columns.

    ``keep`` names page columns to carry along.
    """
    rows = df.select(*keep, F.explode(F.col(data_key)).alias("record"))
    if isinstance(rows.schema["record"].dataType, T.StructType):
        return rows.select(*keep, "record.*")
    return rows


def flatten_nested_array(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Children of an array within an array of records, such as the stages of every funnel."""
    children = df.select(F.explode(F.col(outer)).alias("parent")).select(F.explode(F.col(f"parent.{inner}")).alias("record"))
    if isinstance(children.schema["record"].dataType, T.StructType):
        return children.select("record.*")
    return children


def _has_path(kind: T.DataType, path: Sequence[str]) -> bool:
    for step in path:
        if isinstance(kind, T.StructType) and step in kind.names:
            kind = kind[step].dataType
        elif isinstance(kind, T.MapType):
            kind = kind.valueType
        else:
            return False
    return True


def flatten_paths(df: DataFrame, paths: Sequence[str], missing_parent: str | None = None) -> DataFrame:
    """Dotted paths as flat columns, dots turned into underscores.

    A missing leaf or parent is NULL. ``missing_parent`` puts a text where the parent record itself
    is missing, which makes that column a string.
    """
    out = []
    for path in paths:
        steps = path.split(".")
        parent = ".".join(steps[:-1])
        name = undotted_name(path)
        value = F.col(path) if _has_path(df.schema, steps) else F.lit(None).cast("string")
        if parent and missing_parent is not None:
            gone = F.col(parent).isNull() if _has_path(df.schema, steps[:-1]) else F.lit(True)
            value = F.when(gone, F.lit(missing_parent)).otherwise(value.cast("string"))
        out.append(value.alias(name))
    return df.select(*out)


class ReportError(ValueError):
    """The report cannot be turned into rows."""


def report_names(columns: Sequence[str], labels: Mapping[str, str] | None = None) -> list[str]:
    """The names of a report's detail columns, those of their display labels if given."""
    if not columns:
        raise ReportError("the report has no columns")
    return [undotted_name(labels[c] if labels else c) for c in columns]


def flatten_report(
    df: DataFrame,
    columns: Sequence[str],
    fact_map: str = "factMap",
    labels: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per detail row of a grouped report, cells by position under the detail column names.

    ``fact_map`` is a map from group key to a record with ``rows``, each holding ``dataCells`` with a
    ``label``. ``labels`` renames columns to their display label. The group key stays, as ``group_key``.
    """
    names = report_names(columns, labels)
    groups = df.select(*keep, F.explode(F.col(fact_map)).alias("group_key", "fact"))
    rows = groups.select(*keep, "group_key", F.explode("fact.rows").alias("row"))
    cell_labels = rows.select(*keep, "group_key", F.transform("row.dataCells", lambda cell: cell["label"]).alias("cells"))
    return cell_labels.select(*keep, "group_key", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def report_status(df: DataFrame, fact_map: str = "factMap", keep: Sequence[str] = ()) -> DataFrame:
    """Per report: detail rows present, all data delivered, and the number of detail rows."""
    counts = F.transform(F.map_values(F.col(fact_map)), lambda g: F.coalesce(F.size(g["rows"]).cast("bigint"), F.lit(0)))
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + F.greatest(b, F.lit(0).cast("bigint")))
    return df.select(
        *keep,
        F.col("hasDetailRows").alias("has_details"),
        F.col("allData").alias("all_data"),
        total.alias("detail_rows"),
    )


def report_lines(df: DataFrame, width: int, fact_map: str = "factMap") -> DataFrame:
    """Status and cells of reports in one, to be stored: a row per detail row, with ``detail_rows`` 1, and one with 0 for each empty group or report.

    The cells are ``c0`` to the ``width``-th, as :func:`flatten_report` finds them.
    """
    status = (F.col("hasDetailRows").alias("has_details"), F.col("allData").alias("all_data"))
    groups = df.select(*status, F.explode_outer(F.col(fact_map)).alias("group_key", "fact"))
    rows = groups.select("has_details", "all_data", F.posexplode_outer("fact.rows").alias("at", "row"))
    labels = F.transform("row.dataCells", lambda cell: cell["label"]).alias("cells")
    cells = rows.select("has_details", "all_data", F.col("at").isNotNull().cast("bigint").alias("detail_rows"), labels)
    return cells.select("has_details", "all_data", "detail_rows", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(width)])


def assert_report(df: DataFrame, fact_map: str = "factMap") -> None:
    """Refuse reports without details, without all data, or without a single row."""
    assert_status(report_status(df, fact_map))


def assert_status(status: DataFrame) -> None:
    """As :func:`assert_report`, for the result of :func:`report_status` or of :func:`report_lines`."""
    bad = status.agg(
        F.count_if(~F.coalesce("has_details", F.lit(False))).alias("no_details"),
        F.count_if(~F.coalesce("all_data", F.lit(False))).alias("partial"),
        F.sum("detail_rows").alias("rows"),
    ).first()
    if bad["no_details"]:
        raise ReportError("the report does not include details, so its records cannot be read")
    if bad["partial"]:
        raise ReportError("the report does not deliver all its data")
    if not bad["rows"]:
        raise ReportError("the report has no rows")


def report_grand_total(fact_map: Column | str) -> Column:
    """The pre-computed total of a report: first aggregate of the grand-total group."""
    facts = F.col(fact_map) if isinstance(fact_map, str) else fact_map
    total = F.try_element_at(facts, F.lit("T!T"))
    return F.get(total["aggregates"], F.lit(0))["value"]


# What a child record looks like when presence of a field matters: values stay JSON text.
CHILD_RECORDS = "array<map<string,string>>"


def child_records(c: Column) -> Column:
    """JSON text of an array of objects, as an array of maps, so that an absent field differs from null."""
    return F.from_json(c, CHILD_RECORDS)


def first_child_with(children: Column, field: str, value: str | None = None) -> Column:
    """The first child that has ``field``; gives its ``value`` field (``field`` itself by default)."""
    having = F.filter(children, lambda child: F.map_contains_key(child, field))
    return F.get(having, F.lit(0))[value or field]


def concat_children(children: Column, field: str) -> Column:
    """The texts of ``field`` over all children that have it, joined; '' when none has."""
    having = F.filter(children, lambda child: F.map_contains_key(child, field))
    return F.array_join(F.transform(having, lambda child: child[field]), "")
