"""Column expressions and name rules."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.base import MESSY_SQL, messy, query, table
from lakesync.functions import names, text

INTEGER_GUARD = r"'\s*[+-]?[0-9]+\s*'"
NUMBER_GUARD = r"'\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*'"


@query(f"""
    SELECT event_id, raw, CASE WHEN regexp_full_match(raw, {INTEGER_GUARD})
                               THEN TRY_CAST(trim(raw) AS BIGINT) END AS number
    FROM (SELECT event_id, {MESSY_SQL} AS raw FROM events) t""")
def clean_int_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", messy().alias("raw"))
    return raw.withColumn("number", text.int_or_null(F.col("raw")))


@query("""
    SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole_price,
           CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS finished
    FROM orders""")
def clean_int_or_null_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    return orders.select(
        "o_orderkey",
        text.int_or_null(F.col("o_totalprice"), T.DoubleType()).alias("whole_price"),
        text.int_or_null(finished, T.BooleanType()).alias("finished"),
    )


@query("""SELECT doc_id, replace(replace(text, '"', ''), '''', '') AS text FROM documents""")
def clean_strip_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_quotes(F.col("text")).alias("text"))


@query("""SELECT page_id, replace(replace(html, '"', ''), '''', '') AS html FROM pages""")
def clean_strip_quotes_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.strip_quotes(F.col("html")).alias("html"))


@query("SELECT page_id, replace(replace(html, ',', ''), '//', '') AS html FROM pages")
def clean_strip_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.strip_commas_slashes(F.col("html")).alias("html"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def clean_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "events").select("event_id", text.iso_to_space(iso).alias("at"))


@query("SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text FROM documents")
def clean_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.ascii_only(F.col("text")).alias("text"))


@query(f"SELECT event_id, user_id, coalesce({MESSY_SQL}, '') AS raw FROM events")
def clean_fill_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.fill_empty(table(spark, sf_dir, "events").select("event_id", "user_id", messy().alias("raw")))


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events")
def to_epoch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", text.to_epoch(F.col("ts")).alias("epoch"))


@query("""
    SELECT event_id, ts - INTERVAL 25 HOUR AS earlier, date_trunc('second', ts) AS at_second,
           strftime(ts + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS later
    FROM events""")
def shift_format_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.date_shift(ts, hours=-25).alias("earlier"),
        text.to_second(ts).alias("at_second"),
        text.format_seconds(text.date_shift(ts, days=2)).alias("later"),
    )


@query("SELECT p_partkey, p_name, contains(p_name, 'ed wid') AS found FROM part")
def like_contains_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", text.like_contains(F.col("p_name"), "ed wid").alias("found")
    )


@query("""
    SELECT p_partkey, trim(lower(split_part(p_type || ' (' || p_size || ')', '(', 1))) AS base_type FROM part""")
def type_base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.col("p_type"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", text.type_base_name(written).alias("base_type"))


@query(f"""
    SELECT event_id, raw,
           CASE WHEN raw IS NULL THEN NULL
                WHEN regexp_full_match(raw, {INTEGER_GUARD}) THEN 'INTEGER'
                WHEN regexp_full_match(raw, {NUMBER_GUARD}) THEN 'FLOAT'
                WHEN raw LIKE '2024-%' THEN 'TIMESTAMP' ELSE 'VARCHAR' END AS kind
    FROM (SELECT event_id, CASE WHEN event_type = 'error' AND user_id < 75
                                THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE {MESSY_SQL} END AS raw FROM events) t""")
def classify_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    some_moments = F.when((F.col("event_type") == "error") & (F.col("user_id") < 75), moment).otherwise(messy())
    raw = table(spark, sf_dir, "events").select("event_id", some_moments.alias("raw"))
    return raw.withColumn("kind", text.classify_value(F.col("raw")))


@query("""
    SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS record,
           '["' || event_type || '","' || user_id || '"]' AS list
    FROM events""")
def stringify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.stringify(F.struct("user_id", "event_type")).alias("record"),
        text.stringify(F.array("event_type", F.col("user_id").cast("string"))).alias("list"),
    )


@query("SELECT event_id, props ->> '$.k' AS k, CAST(props ->> '$.k' AS BIGINT) AS k_number FROM events")
def json_path_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = text.json_path(F.col("props"), "k")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), text.int_or_null(k).alias("k_number"))


@query("""
    SELECT page_id, CASE WHEN contains(html, '<title>')
        THEN split_part(split_part(html, '<title>', 2), '</title>', 1) END AS title,
        CASE WHEN contains(html, '<h2>')
        THEN split_part(split_part(html, '<h2>', 2), '</h2>', 1) END AS heading
    FROM pages""")
def xml_tag_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.xml_tag(html, "title").alias("title"), text.xml_tag(html, "h2").alias("heading")
    )


@query("""
    SELECT page_id, unnest(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)) AS paragraph FROM pages""")
def xml_tags_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.xml_tags(F.col("html"), "p")).alias("paragraph"))


@query(f"SELECT event_id, trim({MESSY_SQL}) AS trimmed FROM events")
def trim_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", text.trim_text(messy()).alias("trimmed"))


@query("SELECT event_id, event_type || user_id AS joined FROM events")
def concat_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.array("event_type", F.lit(None), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", text.concat_all(values).alias("joined"))


@query("""
    SELECT c_custkey AS customer_key, c_name AS full_name, c_nationkey AS nation_key, c_acctbal AS account_balance_usd,
           c_mktsegment AS segment FROM customer""")
def normalize_names_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = table(spark, sf_dir, "customer").toDF(
        " Customer Key", "Full Name ", "NATION_KEY", "Account Balance/USD", "segment"
    )
    return names.normalize_names(exported)


@query("""
    SELECT p_partkey AS "Part_Key", p_name AS "Part_Name_Long", p_size AS "Size" FROM part""")
def undotted_names_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return names.normalize_names(exported.toDF("Part.Key", "Part.Name.Long", "Size"), names.undotted_name)


@query(r"""
    SELECT conv_id, turn,
           regexp_replace(translate(replace(lower(text), ' ', '_'), '?:''")(!./\', ''), '[^\x00-\x7F]', '', 'g') AS name
    FROM conversations""")
def question_text_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", names.question_text(F.col("text")).alias("name")
    )
