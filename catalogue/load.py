"""Delimited text, the error log, schemas."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.base import MESSY_SQL, messy, query, table
from lakesync.functions.casting import DATE_LAYOUTS
from lakesync.operators import schema as sc
from lakesync.plans.publish import SnapshotStore
from lakesync.plans.repair import copy_into, load_and_validate, load_with_repair, staged_load
from lakesync.session import shared_dir
from lakesync.sources import delimited as dl

# Six fields per event, and lines that are blank, too short or too long.
FIELDS_SQL = f"""
    SELECT event_id, event_type, user_id, value, ts,
           CAST(event_id AS STRING) AS f1,
           coalesce({MESSY_SQL}, '') AS f2,
           CASE WHEN event_type = 'purchase' AND value < 50 THEN 'free'
                ELSE CAST(CAST(value AS DECIMAL(10, 2)) AS STRING) END AS f3,
           CASE event_type WHEN 'view' THEN 't' WHEN 'click' THEN 'False' WHEN 'error' THEN 'maybe' ELSE '' END AS f4,
           CASE WHEN event_type = 'signup' AND value < 20 THEN 'yesterday'
                ELSE CAST(date_trunc('second', ts) AS STRING) END AS f5,
           event_type AS f6
    FROM events"""
LINES_SQL = f"""
    SELECT *, CASE WHEN event_type = 'view' AND user_id > 140 THEN ''
                   WHEN event_type = 'error' AND user_id > 140 THEN f1 || '|short'
                   WHEN event_type = 'click' AND user_id > 140
                   THEN f1 || '|' || f2 || '|' || f3 || '|' || f4 || '|' || f5 || '|' || f6 || '|more'
                   ELSE f1 || '|' || f2 || '|' || f3 || '|' || f4 || '|' || f5 || '|' || f6 END AS line
    FROM ({FIELDS_SQL}) f"""

TARGET = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("number", T.IntegerType())
    .add("price", T.DoubleType())
    .add("flag", T.BooleanType())
    .add("at", T.TimestampNTZType())
    .add("word", T.VarcharType(6))
)


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FIELDS_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(LINES_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    return lines.select("line")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.parse_lines(_lines(spark, sf_dir), TARGET, dl.LoadOptions("|"))


@query(f"""
    SELECT event_id, CASE event_type WHEN 'view' THEN CAST(user_id AS INTEGER) END AS number,
           CAST(f3 AS DOUBLE) AS price, CASE event_type WHEN 'view' THEN TRUE END AS flag,
           date_trunc('second', ts) AS at, event_type AS word
    FROM ({LINES_SQL}) l
    WHERE (event_type = 'view' AND user_id <= 140) OR (event_type = 'signup' AND value >= 20)""")
def load_delimited_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.good_rows(_parsed(spark, sf_dir))


@query(f"""
    SELECT event_id, CASE event_type WHEN 'view' THEN CAST(user_id AS INTEGER)
                                     WHEN 'purchase' THEN CAST(-event_id AS INTEGER) END AS number,
           CAST(f3 AS DOUBLE) AS price, CASE event_type WHEN 'view' THEN TRUE END AS flag,
           CASE WHEN f5 <> 'yesterday' THEN date_trunc('second', ts) END AS at, substr(event_type, 1, 6) AS word
    FROM ({LINES_SQL}) l
    WHERE (event_type = 'view' AND user_id <= 140) OR event_type = 'signup'
       OR (event_type = 'purchase' AND f3 <> 'free')""")
def load_delimited_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown dates become NULL, long words are cut."""
    return dl.good_rows(dl.parse_lines(_lines(spark, sf_dir), TARGET, dl.LoadOptions.tolerant("|")))


ERRORS_SQL = f"""
    SELECT * FROM (
        SELECT 'File contains a blank line' AS err_reason, '' AS colname, '' AS type, '' AS raw_field_value, line
        FROM ({LINES_SQL}) l WHERE line = ''
        UNION ALL
        SELECT 'Delimiter not found', '', '', '', line FROM ({LINES_SQL}) l WHERE line LIKE '%|short'
        UNION ALL
        SELECT 'Extra column(s) found', '', '', 'more', line FROM ({LINES_SQL}) l WHERE line LIKE '%|more'
        UNION ALL
        SELECT 'Invalid digit, Value ''' || f2 || ''', Type: int', 'number', 'int', f2, line
        FROM ({LINES_SQL}) l WHERE event_type IN ('click', 'error') AND user_id <= 140
        UNION ALL
        SELECT 'Invalid digit, Value ''' || f3 || ''', Type: double', 'price', 'double', f3, line
        FROM ({LINES_SQL}) l WHERE f3 = 'free'
        UNION ALL
        SELECT 'Unknown boolean format', 'flag', 'boolean', f4, line
        FROM ({LINES_SQL}) l WHERE f4 = 'maybe' AND user_id <= 140
        UNION ALL
        SELECT 'Invalid timestamp format or value', 'at', 'timestamp_ntz', f5, line
        FROM ({LINES_SQL}) l WHERE f5 = 'yesterday'
        UNION ALL
        SELECT 'String length exceeds DDL length', 'word', 'varchar(6)', f6, line
        FROM ({LINES_SQL}) l WHERE f6 = 'purchase') e"""

LOAD_START = datetime(2024, 2, 1, 12, 0, 0)


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.load_errors(_parsed(spark, sf_dir), "events_copy", LOAD_START)


@query(f"""
    SELECT 'events_copy' AS "table", err_reason, TIMESTAMP '2024-02-01 12:00:00' AS starttime, colname, type,
           CASE colname WHEN 'word' THEN '6' END AS col_length, raw_field_value, line AS raw_line
    FROM ({ERRORS_SQL}) x""")
def load_delimited_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir).drop("filename", "line_number", "field_count")


# Lines per file follow the key, so that every file's numbers can be told in SQL as well.
@query(f"""
    WITH placed AS (
        SELECT *, event_id % 3 AS part, 1 + ROW_NUMBER() OVER (PARTITION BY event_id % 3 ORDER BY event_id) AS line_number
        FROM ({LINES_SQL}) l)
    SELECT part::BIGINT AS part, line_number,
           CASE WHEN line = '' THEN 'File contains a blank line' WHEN line LIKE '%|short' THEN 'Delimiter not found'
                ELSE 'Extra column(s) found' END AS err_reason, line AS raw_line
    FROM placed WHERE line = '' OR line LIKE '%|short' OR line LIKE '%|more'""")
def load_errors_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files with headers and blank lines, each read in many splits: what is wrong stands under the line it stands in."""
    lines = spark.sql(LINES_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    folder = shared_dir(spark, "numbered-lines")
    for part in range(3):
        mine = lines.filter(F.pmod("event_id", F.lit(3)) == part)
        texts = mine.select("event_id", "line").unionByName(spark.createDataFrame([(-1, "a|b|c|d|e|f")], "event_id long, line string"))
        texts.orderBy("event_id").coalesce(1).select("line").write.text(f"{folder}/part={part}")
    files = [f"{folder}/part={part}" for part in range(3)]
    # Small splits, as large files have on a cluster.
    usual = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        errors = staged_load(spark, files, TARGET, "events_copy", dl.LoadOptions("|", header=True)).errors
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    part = F.regexp_extract("filename", r"part=(\d)/[^/]*$", 1).cast("bigint")
    return errors.filter(F.col("colname") == "").select(part.alias("part"), "line_number", "err_reason", "raw_line")


@query(f"""
    SELECT regexp_extract(err_reason, '^([^,]*)', 1) AS err_reason, colname, COUNT(*) AS error_count
    FROM ({ERRORS_SQL}) x GROUP BY 1, 2""")
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.error_summary(_errors(spark, sf_dir))


@query(f"""
    SELECT regexp_extract(err_reason, '^([^,]*)', 1) AS reason, colname, COUNT(*) AS error_count,
           bool_and(regexp_full_match(raw_field_value, '[+-]?[0-9]+')) AS all_integer,
           bool_and(regexp_full_match(raw_field_value, '[+-]?[0-9]+([.][0-9]+)?')) AS all_number,
           FALSE AS all_timestamp,
           max(CASE WHEN line = '' THEN 1 WHEN line LIKE '%|short' THEN 2 WHEN line LIKE '%|more' THEN 7
                    ELSE 6 END)::BIGINT AS field_count
    FROM ({ERRORS_SQL}) x GROUP BY 1, 2""")
def error_profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a schema repair decides from."""
    return sc.error_profile(_errors(spark, sf_dir))


@query(f"""
    SELECT colname, raw_field_value FROM ({ERRORS_SQL}) x WHERE colname IN ('number', 'price')""")
def errors_for_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads in one log; the entries of one table since a moment, by the table registry."""
    registry = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    log = _errors(spark, sf_dir).drop("table")
    ours = F.col("colname").isin("number", "price")
    log = log.withColumn("tbl", F.when(ours, 7).otherwise(8))
    return dl.errors_for_table(log, registry, "NATION_7", LOAD_START).select("colname", "raw_field_value")


@query("SELECT * FROM lineitem")
def load_roundtrip_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged as gzipped text, loaded back typed."""
    lineitem = table(spark, sf_dir, "lineitem")
    folder = shared_dir(spark, "lineitem-text")
    dl.write_delimited(lineitem, folder)
    return dl.good_rows(dl.load_delimited(spark, folder, lineitem.schema, dl.LoadOptions("|")))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def load_multiline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks and quotes, in files with a header."""
    documents = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "documents-text")
    dl.write_delimited(documents, folder, ",", header=True)
    options = dl.LoadOptions(header=True, multiline=True)
    return dl.good_rows(dl.load_delimited(spark, folder, documents.schema, options))


@query("SELECT DISTINCT * FROM customer")
def copy_into_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file loaded twice: rows stay distinct."""
    customer = table(spark, sf_dir, "customer")
    folder = shared_dir(spark, "customer-text")
    dl.write_delimited(customer, folder, ",", header=True)
    store = SnapshotStore(spark, shared_dir(spark, "copy-into"))
    for _ in range(2):
        copy_into(store, "customer", folder, customer.schema, dl.LoadOptions.tolerant(header=True))
    return store.read("customer")


@query(f"""
    SELECT DISTINCT * FROM (
        SELECT event_id, CAST(user_id AS STRING) AS number, CAST(value AS STRING) AS price,
               CAST(value > 100 AS STRING) AS flag, CAST(NULL AS STRING) AS new_column_one FROM events
        UNION ALL
        SELECT event_id, f2, f3, f4, CASE event_type WHEN 'click' THEN 'extra' END FROM ({FIELDS_SQL}) f
        WHERE event_type = 'click'
        UNION ALL
        SELECT event_id, f2, f3, f4, '' FROM ({FIELDS_SQL}) f WHERE event_type <> 'click') t""")
def load_with_repair_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that fits its table nowhere: three types widen and a column is added."""
    schema = T.StructType.fromDDL("event_id bigint, number int, price double, flag boolean")
    events = table(spark, sf_dir, "events")
    store = SnapshotStore(spark, shared_dir(spark, "repair"))
    number, flag = F.col("user_id").cast("int").alias("number"), (F.col("value") > 100).alias("flag")
    store.replace("copy", events.select("event_id", number, F.col("value").alias("price"), flag))
    last = F.when(F.col("event_type") == "click", "extra").otherwise("")
    folder = shared_dir(spark, "repair-text")
    dl.write_delimited(_fields(spark, sf_dir).select("f1", "f2", "f3", "f4", last), folder)
    load_with_repair(store, "copy", folder, schema, dl.LoadOptions("|"))
    return store.read("copy")


@query("""
    SELECT 'c_custkey' AS column_name, CAST(NULL AS INTEGER) AS max_length
    UNION ALL SELECT 'c_name', max(length(c_name))::INTEGER FROM customer
    UNION ALL SELECT 'c_nationkey', NULL UNION ALL SELECT 'c_acctbal', NULL
    UNION ALL SELECT 'c_mktsegment', max(length(c_mktsegment))::INTEGER FROM customer""")
def max_length_profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.max_length_profile(table(spark, sf_dir, "customer"))


@query("""
    SELECT 'doc_id' AS column_name, CAST(NULL AS INTEGER) AS max_length
    UNION ALL SELECT 'text', max(length(text))::INTEGER FROM documents
    UNION ALL SELECT 'lang', max(length(lang))::INTEGER FROM documents
    UNION ALL SELECT 'source', max(length(source))::INTEGER FROM documents
    UNION ALL SELECT 'n_chars', NULL""")
def max_length_profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.max_length_profile(table(spark, sf_dir, "documents"))


@query("""
    SELECT 'doc_id' AS column_name, 'BIGINT' AS warehouse_type
    UNION ALL SELECT 'text', CASE WHEN max(length(text)) <= 65535 THEN 'VARCHAR(' || max(length(text)) || ')'
                                  ELSE 'VARCHAR(MAX)' END FROM documents
    UNION ALL SELECT 'lang', 'VARCHAR(' || max(length(lang)) || ')' FROM documents
    UNION ALL SELECT 'source', 'VARCHAR(' || max(length(source)) || ')' FROM documents
    UNION ALL SELECT 'n_chars', 'BIGINT'""")
def warehouse_types_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lengths = sc.measured_lengths(documents)
    rows = [(f.name, sc.warehouse_type(f.dataType, lengths[f.name])) for f in documents.schema.fields]
    return spark.createDataFrame(rows, "column_name string, warehouse_type string")


CATALOG_SQL = """
    SELECT p_name || p_partkey AS column_name,
           CASE p_type WHEN 'STANDARD' THEN 'varchar' WHEN 'PROMO' THEN 'numeric' WHEN 'MEDIUM' THEN 'timestamptz'
                       WHEN 'ECONOMY' THEN 'int4' WHEN 'LARGE' THEN 'jsonb' ELSE 'timestamp' END AS udt_name,
           CASE WHEN p_type = 'STANDARD' AND p_size BETWEEN 10 AND 24 THEN 255
                WHEN p_type = 'STANDARD' AND p_size >= 25 THEN p_size END AS character_maximum_length,
           CASE WHEN p_type = 'PROMO' AND p_size > 20 THEN p_size WHEN p_type = 'ECONOMY' THEN 32 END AS numeric_precision,
           CASE WHEN p_type = 'PROMO' AND p_size > 20 THEN 2 WHEN p_type = 'ECONOMY' THEN 0 END AS numeric_scale
    FROM part"""


@query(f"""
    SELECT *, CASE WHEN udt_name = 'varchar' AND coalesce(character_maximum_length, 255) = 255 THEN 'text'
                   WHEN udt_name = 'varchar' THEN 'varchar(' || character_maximum_length || ')'
                   WHEN udt_name = 'numeric' AND numeric_precision IS NULL THEN 'numeric'
                   WHEN udt_name = 'numeric' THEN 'numeric(' || numeric_precision || ', ' || numeric_scale || ')'
                   WHEN udt_name IN ('int4', 'timestamp') THEN udt_name ELSE 'varchar(65535)' END AS target_type
    FROM ({CATALOG_SQL}) c""")
def translate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source catalog with one column per part."""
    catalog = spark.sql(CATALOG_SQL.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    return sc.translate_schema(catalog)


@query(f"""
    SELECT * FROM (
        SELECT 1 AS pos, 'f1' AS source, 'event_id' AS target, 'bigint' AS target_type, CAST(0 AS BIGINT) AS bad_values,
               TRUE AS ok
        UNION ALL SELECT 2, 'f2', 'number', 'int', COUNT(*) FILTER (event_type IN ('click', 'error')),
               COUNT(*) FILTER (event_type IN ('click', 'error')) = 0 FROM ({FIELDS_SQL}) f
        UNION ALL SELECT 3, 'f3', 'price', 'double', COUNT(*) FILTER (f3 = 'free'),
               COUNT(*) FILTER (f3 = 'free') = 0 FROM ({FIELDS_SQL}) f
        UNION ALL SELECT 4, 'f4', 'flag', 'boolean', COUNT(*) FILTER (f4 = 'maybe'),
               COUNT(*) FILTER (f4 = 'maybe') = 0 FROM ({FIELDS_SQL}) f
        UNION ALL SELECT 5, 'f5', 'at', 'timestamp_ntz', COUNT(*) FILTER (f5 = 'yesterday'),
               COUNT(*) FILTER (f5 = 'yesterday') = 0 FROM ({FIELDS_SQL}) f
        UNION ALL SELECT 6, 'f6', 'word', 'varchar(6)', 0, TRUE
        UNION ALL SELECT 7, NULL, 'missing', 'int', 0, FALSE) t""")
def check_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType([*TARGET.fields, T.StructField("missing", T.IntegerType())])
    return sc.check_structure(_fields(spark, sf_dir).select("f1", "f2", "f3", "f4", "f5", "f6"), target)


@query(f"""
    SELECT 'event' AS column_name,
           CASE WHEN bool_and(regexp_full_match(f1, '-?[0-9]+')) THEN 'bigint' ELSE 'string' END AS type
    FROM ({FIELDS_SQL}) f
    UNION ALL SELECT 'raw', CASE WHEN bool_and(regexp_full_match(f2, '-?[0-9]+')) THEN 'bigint' ELSE 'string' END
    FROM ({FIELDS_SQL}) f
    UNION ALL SELECT 'cents', CASE WHEN bool_and(regexp_full_match(CAST(CAST(value AS DECIMAL(10, 2)) AS STRING),
                                   '[0-9]+[.][0-9]+')) THEN 'double' ELSE 'string' END FROM events
    UNION ALL SELECT 'at', 'timestamp_ntz' UNION ALL SELECT 'big', 'boolean'""")
def infer_schema_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cents = F.col("value").cast("decimal(10,2)").cast("string").alias("cents")
    text = events.select(
        F.col("event_id").cast("string").alias("event"),
        messy().alias("raw"),
        cents,
        F.col("ts").cast("string").alias("at"),
        (F.col("value") > 100).cast("string").alias("big"),
    )
    rows = [(f.name, f.dataType.simpleString()) for f in sc.infer_schema(text).fields]
    return spark.createDataFrame(rows, "column_name string, type string")


@query("""
    SELECT (9007199254740992 + event_id) || '.0' AS wide, 'kept' AS origin FROM events
    UNION ALL SELECT CASE WHEN event_type = 'click' THEN user_id || '.5' ELSE (9007199254740992 + event_id) || '.0' END,
                     'e' || event_id FROM events""")
def repair_wide_keys_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions arrive in a column of ids that doubles cannot tell apart: every id stays itself."""
    events, wide = table(spark, sf_dir, "events"), F.lit(1 << 53) + F.col("event_id")
    store, folder = SnapshotStore(spark, shared_dir(spark, "wide")), shared_dir(spark, "wide-text")
    store.replace("ids", events.select(wide.alias("wide"), F.lit("kept").alias("origin")))
    text = F.when(F.col("event_type") == "click", F.concat("user_id", F.lit(".5"))).otherwise(wide.cast("string"))
    dl.write_delimited(events.select(text.alias("wide"), F.concat(F.lit("e"), "event_id").alias("origin")), folder)
    load_with_repair(store, "ids", folder, T.StructType.fromDDL("wide bigint, origin string"), dl.LoadOptions("|"))
    return store.read("ids").select(F.col("wide").cast("string").alias("wide"), "origin")


@query("""
    SELECT 'code' AS column_name, 'string' AS type UNION ALL SELECT 'long_id', 'decimal(38,0)'
    UNION ALL SELECT 'key', 'bigint' UNION ALL SELECT 'price', 'double'
    UNION ALL SELECT 'mixed', 'decimal(38,1)'""")
def infer_leading_zeros_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes padded with zeros stay text, and long numbers keep their digits."""
    key = F.col("p_partkey")
    sheet = table(spark, sf_dir, "part").select(
        F.lpad(key.cast("string"), 12, "0").alias("code"),
        F.concat(F.lit("98765432109876543"), F.lpad(key.cast("string"), 8, "0")).alias("long_id"),
        key.cast("string").alias("key"),
        F.concat("p_size", F.lit(".25")).alias("price"),
        F.when(F.pmod(key, F.lit(2)) == 0, F.concat(key, F.lit(".5"))).otherwise((F.lit(1 << 60) + key).cast("string")).alias("mixed"),
    )
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in sc.infer_schema(sheet).fields], "column_name string, type string")


@query("""
    SELECT 'customer' AS "table", load_id, COUNT(*) AS row_count, 0::BIGINT AS error_count, TIMESTAMP '2024-02-01 12:00:00' AS starttime,
           TRUE AS ok, (SELECT COUNT(*) FROM customer) AS table_rows
    FROM (SELECT 'customers of ' || c_mktsegment AS load_id FROM customer) GROUP BY load_id""")
def load_audit_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per market segment, one of them sent twice and one refused for its errors: what the audit tells of them, and what readers see."""
    store, customer = SnapshotStore(spark, shared_dir(spark, "audit")), table(spark, sf_dir, "customer")
    folder = shared_dir(spark, "segments")
    segments = sorted(r[0] for r in customer.select("c_mktsegment").distinct().collect())
    reports = {}
    for segment in [*segments, segments[0]]:
        path = f"{folder}/{segment}-{len(reports)}"
        dl.write_delimited(customer.filter(F.col("c_mktsegment") == segment), path, "|")
        _, report = load_and_validate(
            store, "customer", path, customer.schema, dl.LoadOptions("|"), load_start=LOAD_START, load_id=f"customers of {segment}"
        )
        reports[segment] = report.ok
    broken = customer.withColumn("c_custkey", F.concat(F.lit("x"), "c_custkey"))
    dl.write_delimited(broken, f"{folder}/broken", "|")
    _, refused = load_and_validate(store, "customer", f"{folder}/broken", customer.schema, dl.LoadOptions("|"), load_id="refused")
    audit = store.load_audit("customer").drop("seq", "files")
    ok = all(reports.values()) and not refused.ok
    return audit.withColumns({"ok": F.lit(ok), "table_rows": F.lit(store.read("customer").count()).cast("bigint")})


# A word with blanks around it, only blanks, nothing, or a word; and what a broken encoding leaves of one.
BLANKS_SQL = """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN '  ' || event_type || '  ' WHEN 1 THEN '   ' WHEN 2 THEN ''
                                       ELSE event_type || chr(65533) || user_id END AS word FROM events"""
BLANK_OPTIONS = {
    "none": ({}, "word"),
    "trim_blanks": ({"trim_blanks": True}, "rtrim(word)"),
    "blanks_as_null": ({"blanks_as_null": True}, "CASE WHEN trim(word) <> '' OR word = '' THEN word END"),
    "empty_as_null": ({"empty_as_null": True}, "NULLIF(word, '')"),
    "blanks_and_empty_as_null": ({"blanks_as_null": True, "empty_as_null": True}, "CASE WHEN trim(word) <> '' THEN word END"),
    "all": ({"trim_blanks": True, "blanks_as_null": True, "empty_as_null": True}, "CASE WHEN trim(word) <> '' THEN rtrim(word) END"),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS option, event_id, {value} AS word FROM ({BLANKS_SQL}) b WHERE event_id % 4 <> 3"
    for name, (_, value) in BLANK_OPTIONS.items()
))
def load_blank_options_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines under each option for blanks and empty fields; broken characters are refused by all of these."""
    lines = _blank_lines(spark, sf_dir)
    schema = T.StructType.fromDDL("event_id bigint, word string")
    loaded = [
        dl.good_rows(dl.parse_lines(lines, schema, dl.LoadOptions("|", **options))).select(F.lit(name).alias("option"), "event_id", "word")
        for name, (options, _) in BLANK_OPTIONS.items()
    ]
    return reduce(DataFrame.unionByName, loaded)


def _blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.pmod("event_id", F.lit(4))
    broken = F.concat("event_type", F.lit("\ufffd"), F.col("user_id").cast("string"))
    padded = F.concat(F.lit("  "), "event_type", F.lit("  "))
    word = F.when(kind == 0, padded).when(kind == 1, "   ").when(kind == 2, "").otherwise(broken)
    return events.select(F.concat(F.col("event_id").cast("string"), F.lit("|"), word).alias("line"))


@query(f"""
    SELECT 'replaced' AS side, event_id, replace(word, chr(65533), '?') AS word FROM ({BLANKS_SQL}) b
    UNION ALL SELECT 'refused', event_id, word FROM ({BLANKS_SQL}) b WHERE event_id % 4 = 3""")
def load_invalid_characters_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken characters replaced, and refused with the line they stand in."""
    lines = _blank_lines(spark, sf_dir)
    schema = T.StructType.fromDDL("event_id bigint, word string")
    replaced = dl.good_rows(dl.parse_lines(lines, schema, dl.LoadOptions("|", replace_invalid=True)))
    errors = dl.load_errors(dl.parse_lines(lines, schema, dl.LoadOptions("|")), "events_copy")
    key, word = (F.split_part("raw_line", F.lit("|"), F.lit(i)) for i in (1, 2))
    refused = errors.filter(F.col("err_reason") == sc.INVALID_CHARACTERS).select(key.cast("bigint").alias("event_id"), word.alias("word"))
    return replaced.select(F.lit("replaced").alias("side"), "*").unionByName(refused.select(F.lit("refused").alias("side"), "*"))


LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", *DATE_LAYOUTS)


@query("""
    SELECT event_id, CASE WHEN event_id % 9 IN (0, 1, 7, 8) THEN date_trunc('second', ts) ELSE date_trunc('day', ts)::TIMESTAMP END AS at,
           CAST(ts AS DATE) = CAST(ts AS DATE) AS same_day
    FROM events""")
def load_date_layouts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments in nine layouts in one column, and their days in a second one, each told by its shape."""
    events = table(spark, sf_dir, "events")
    written = [F.when(F.pmod("event_id", F.lit(len(LAYOUTS))) == i, F.date_format("ts", f)) for i, f in enumerate(LAYOUTS)]
    at = F.coalesce(*written)
    lines = events.select(F.concat_ws("|", F.col("event_id").cast("string"), at, at).alias("line"))
    parsed = dl.parse_lines(lines, T.StructType.fromDDL("event_id bigint, at timestamp_ntz, day date"), dl.LoadOptions("|"))
    return dl.good_rows(parsed).select("event_id", "at", (F.col("day") == F.to_date("at")).alias("same_day"))


@query(f"""
    WITH good AS (SELECT event_id, CAST(f2 AS INTEGER) AS number FROM ({FIELDS_SQL}) f WHERE regexp_full_match(trim(f2), '[+-]?[0-9]+')),
         bad AS (SELECT event_id FROM ({FIELDS_SQL}) f WHERE trim(f2) <> '' AND NOT regexp_full_match(trim(f2), '[+-]?[0-9]+'))
    SELECT event_id, CAST(user_id AS INTEGER) AS number, (SELECT COUNT(*) > 0 FROM bad) AS refused FROM events
    UNION ALL SELECT event_id, number, TRUE FROM good
    UNION ALL SELECT event_id, NULL, TRUE FROM ({FIELDS_SQL}) f WHERE trim(f2) = ''""")
def load_max_error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with more errors than it may have leaves the table alone; one that may have them adds its good rows."""
    schema = T.StructType.fromDDL("event_id bigint, number int")
    events = table(spark, sf_dir, "events")
    store = SnapshotStore(spark, shared_dir(spark, "max-error"))
    store.replace("copy", events.select("event_id", F.col("user_id").cast("int").alias("number")))
    folder = shared_dir(spark, "max-error-text")
    dl.write_delimited(_fields(spark, sf_dir).select("event_id", "f2"), folder)
    refused = False
    try:
        copy_into(store, "copy", folder, schema, dl.LoadOptions("|", max_error=5), dedupe=False)
    except dl.LoadError:
        refused = True
    copy_into(store, "copy", folder, schema, dl.LoadOptions("|", max_error=1 << 40), dedupe=False)
    return store.read("copy").withColumn("refused", F.lit(refused))
