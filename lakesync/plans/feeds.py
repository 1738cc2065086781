"""Record feeds of a support desk, a survey tool and a sales system, as tables.

Input is pages of JSON text (``body``), as the paged source lands them. Records get a declared schema,
so a page is parsed once, in place, and only wanted fields are kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.names import question_names
from lakesync.functions.text import fill_empty, int_or_null, iso_to_space, strip_commas_slashes, strip_quotes
from lakesync.operators.checks import Report
from lakesync.operators.merge import dedupe_latest, distinct_rows
from lakesync.operators.schema import cast_columns, check_structure, infer_schema
from lakesync.operators.shape import (
    assert_status,
    child_records,
    concat_children,
    drop_all_null_rows,
    first_child_with,
    flatten_paths,
    project_fixed,
    report_lines,
    report_names,
    select_fields,
)
from lakesync.plans.distinct import append_distinct
from lakesync.plans.publish import SnapshotStore
from lakesync.session import shared_dir
from lakesync.sources.paged import discovered_records, page_records

# The columns of each feed.
TICKET_COLUMNS = (
    "agent_wait_time_in_minutes",
    "agent_wait_time_in_minutes_within_business_hours",
    "assigned_at",
    "assigned_stations",
    "assignee_external_id",
    "assignee_id",
    "assignee_name",
    "assignee_stations",
    "brand_name",
    "created_at",
    "current_tags",
    "domain",
    "due_date",
    "first_reply_time_in_minutes",
    "first_reply_time_in_minutes_within_business_hours",
    "first_resolution_time_in_minutes",
    "first_resolution_time_in_minutes_within_business_hours",
    "full_resolution_time_in_minutes",
    "full_resolution_time_in_minutes_within_business_hours",
    "generated_timestamp",
    "group_id",
    "group_name",
    "group_stations",
    "id",
    "initially_assigned_at",
    "on_hold_time_in_minutes",
    "on_hold_time_in_minutes_within_business_hours",
    "organization_name",
    "priority",
    "reopens",
    "replies",
    "req_email",
    "req_external_id",
    "req_id",
    "req_name",
    "requester_wait_time_in_minutes",
    "requester_wait_time_in_minutes_within_business_hours",
    "resolution_time",
    "satisfaction_score",
    "solved_at",
    "status",
    "subject",
    "submitter_name",
    "ticket_type",
    "updated_at",
    "url",
    "via",
)
# Ticket columns read as whole numbers.
TICKET_NUMBERS = (
    "agent_wait_time_in_minutes",
    "agent_wait_time_in_minutes_within_business_hours",
    "assigned_at",
    "assigned_stations",
    "first_reply_time_in_minutes",
    "first_reply_time_in_minutes_within_business_hours",
    "first_resolution_time_in_minutes",
    "first_resolution_time_in_minutes_within_business_hours",
    "full_resolution_time_in_minutes",
    "full_resolution_time_in_minutes_within_business_hours",
    "group_stations",
    "on_hold_time_in_minutes",
    "on_hold_time_in_minutes_within_business_hours",
    "reopens",
    "replies",
    "req_id",
    "requester_wait_time_in_minutes",
    "resolution_time",
)
# The columns of users.
USER_COLUMNS = (
    "active",
    "alias",
    "chat_only",
    "created_at",
    "custom_role_id",
    "details",
    "email",
    "external_id",
    "id",
    "last_login_at",
    "locale",
    "locale_id",
    "moderator",
    "name",
    "notes",
    "only_private_comments",
    "organization_id",
    "phone",
    "photo",
    "restricted_agent",
    "role",
    "shared",
    "shared_agent",
    "signature",
    "suspended",
    "tags",
    "ticket_restriction",
    "time_zone",
    "two_factor_auth_enabled",
    "updated_at",
    "url",
    "user_fields",
    "verified",
)
# The columns of organisations.
ORGANIZATION_COLUMNS = (
    "created_at",
    "deleted_at",
    "details",
    "domain_names",
    "external_id",
    "group_id",
    "id",
    "name",
    "notes",
    "organization_fields",
    "shared_comments",
    "shared_tickets",
    "tags",
    "updated_at",
    "url",
)
# The columns of ticket events.
EVENT_COLUMNS = (
    "child_events",
    "created_at",
    "id",
    "merged_ticket_ids",
    "system",
    "ticket_id",
    "timestamp",
    "updater_id",
    "via",
    "tags",
    "removed_tags",
    "added_tags",
    "priority",
    "status",
    "comment_public",
)


def text_record(columns: Sequence[str], typed: Sequence[str] = ()) -> T.StructType:
    """A record of text fields; numbers, lists and objects arrive as their JSON text.

    ``typed`` fields are variants, which remember whether a value was a number, a text or a truth value.
    """
    return T.StructType([T.StructField(c, T.VariantType() if c in typed else T.StringType()) for c in columns])


def clean_tickets(records: DataFrame) -> DataFrame:
    """Whole numbers where a ticket has them, no quotes in any text, the declared columns in order."""
    numbers = {c: int_or_null(F.col(c), records.schema[c].dataType) for c in TICKET_NUMBERS if c in records.columns}
    texts = [f.name for f in records.schema.fields if f.name not in numbers and isinstance(f.dataType, T.StringType)]
    return project_fixed(records.withColumns({**numbers, **{c: strip_quotes(F.col(c)) for c in texts}}), TICKET_COLUMNS)


def clean_organizations(records: DataFrame) -> DataFrame:
    """Absent values as '', details without commas and double slashes, timestamps in plain form."""
    times = {c: iso_to_space(F.col(c)) for c in ("created_at", "deleted_at", "updated_at")}
    return fill_empty(records).withColumns({"details": strip_commas_slashes(F.col("details")), **times})


def clean_ticket_events(records: DataFrame) -> DataFrame:
    """What happened, taken out of each event's children."""
    children = F.col("children")
    found = records.withColumn("children", child_records(F.col("child_events")))
    return project_fixed(
        found.withColumns(
            {
                "tags": first_child_with(children, "tags"),
                "removed_tags": first_child_with(children, "tags", "removed_tags"),
                "added_tags": first_child_with(children, "tags", "added_tags"),
                "priority": first_child_with(children, "priority"),
                "status": first_child_with(children, "status"),
                "comment_public": concat_children(children, "comment_public"),
                "created_at": iso_to_space(F.col("created_at")),
            }
        ),
        EVENT_COLUMNS,
    )


def _landed(df: DataFrame, feed: str) -> DataFrame:
    """Clean records written to shared storage: the pages' JSON is parsed once however often they are read."""
    folder = shared_dir(df.sparkSession, feed)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def tickets(pages: DataFrame) -> DataFrame:
    """All tickets, newest version of each."""
    records = page_records(pages, "results", text_record(TICKET_COLUMNS, TICKET_NUMBERS))
    return dedupe_latest(_landed(clean_tickets(records), "tickets"), "id", "updated_at")


def users(pages: DataFrame) -> DataFrame:
    """All users, newest version of each."""
    records = page_records(pages, "users", text_record(USER_COLUMNS))
    return dedupe_latest(_landed(records, "users"), "id", "updated_at")


def organizations(pages: DataFrame) -> DataFrame:
    """All organisations, newest version of each. Those without an id are no versions of one another."""
    records = page_records(pages, "organizations", text_record(ORGANIZATION_COLUMNS))
    return clean_organizations(dedupe_latest(_landed(records, "organizations"), "id", "updated_at"))


def organizations_with_all_fields(pages: DataFrame) -> DataFrame:
    """All organisations, newest version of each, with every field that any of them has in the type its values need.

    Texts are cleaned as in :func:`organizations`; absent values are NULL.
    """
    records = discovered_records(pages, "organizations")
    times = [c for c in ("created_at", "deleted_at", "updated_at") if c in records.columns]
    cleaned = records.withColumns({c: iso_to_space(F.col(c)) for c in times})
    if "details" in records.columns:
        cleaned = cleaned.withColumn("details", strip_commas_slashes(F.col("details")))
    if "id" not in records.columns:
        return cleaned
    newest = "updated_at" if "updated_at" in records.columns else "id"
    return dedupe_latest(_landed(cleaned, "organizations"), "id", newest)


def ticket_events(pages: DataFrame) -> DataFrame:
    """All ticket events, each once."""
    records = page_records(pages, "ticket_events", text_record(EVENT_COLUMNS[:9]))
    return dedupe_latest(_landed(clean_ticket_events(records), "ticket-events"), "id", "created_at")


def survey_answers(
    pages: DataFrame, questions: Mapping[str, str], field_ids: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """One row per answered response, one column per question, named by the question's text.

    ``questions`` maps id to text: a form's definition, not data. An answer to none of them ends the job;
    with ``strict=False`` it is left out.
    """
    answers = page_records(pages, "responses", "struct<answers:map<string,string>>").select("answers")
    if strict:
        unknown = F.array_except(F.map_keys("answers"), F.array(*[F.lit(q) for q in questions]))
        told = F.raise_error(F.concat(F.lit("answers to unknown questions: "), F.array_join(unknown, ", ")))
        known = F.when(F.size(unknown) > 0, told.cast("map<string,string>")).otherwise(F.col("answers"))
        answers = answers.select(known.alias("answers"))
    flat = answers.select(*[F.try_element_at("answers", F.lit(q)).alias(q) for q in questions])
    chosen = select_fields(drop_all_null_rows(flat), field_ids)
    return distinct_rows(question_names(chosen, dict(questions)))


def query_records(pages: DataFrame, record: T.StructType, paths: Sequence[str], missing_parent: str | None = None) -> DataFrame:
    """Object query results, nested parents flattened to ``Owner_Name`` style columns."""
    return distinct_rows(flatten_paths(page_records(pages, "records", record), paths, missing_parent))


REPORT_TYPE = (
    "hasDetailRows boolean, allData boolean, factMap map<string, struct<"
    "rows: array<struct<dataCells: array<struct<label: string, value: string>>>>,"
    "aggregates: array<struct<label: string, value: string>>>>"
)


def report_rows(pages: DataFrame, columns: Sequence[str], labels: Mapping[str, str] | None = None) -> DataFrame:
    """Detail rows of grouped reports; refuses a report without details, data or rows."""
    names = report_names(columns, labels)
    reports = pages.select(F.from_json("body", REPORT_TYPE).alias("report")).select("report.*")
    lines = _landed(report_lines(reports, len(names)), "report")
    assert_status(lines)
    return distinct_rows(lines.filter("detail_rows > 0").drop("has_details", "all_data", "detail_rows").toDF(*names))


def sheet_to_table(store: SnapshotStore, table: str, sheet: DataFrame) -> Report:
    """A sheet of text as a typed table: types from all its values, checked, made distinct, published.

    Nothing is published when the check fails.
    """
    schema = infer_schema(sheet)
    structure = check_structure(sheet, schema)
    bad = [r.asDict() for r in structure.filter(~F.col("ok")).collect()]
    report = Report().add("structure", not bad, bad)
    report.assert_ok()
    store.replace(table, distinct_rows(cast_columns(sheet, schema)))
    return report


def extract_to_table(store: SnapshotStore, table: str, rows: DataFrame) -> None:
    """Rows of a SQL extract that a table does not hold are added to it. The target is not rewritten."""
    append_distinct(store, table, rows)
