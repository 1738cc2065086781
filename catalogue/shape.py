"""Conforming, projecting, filtering, unwrapping and flattening."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.base import CATALOGUE, MESSY_SQL, Query, messy, query, table
from lakesync.operators import shape
from lakesync.operators.filters import filter_spec, report_to_query
from lakesync.operators.layout import clustered_layout
from lakesync.sources.paged import page_records
from lakesync.sources.sheets import header_promote


@query("""
    SELECT c_name, c_custkey, CAST(NULL AS TIMESTAMP) AS closed_at, c_acctbal, CAST(NULL AS VARCHAR) AS note
    FROM customer""")
def conform_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType.fromDDL("c_name string, c_custkey bigint, closed_at timestamp_ntz, c_acctbal double, note string")
    return shape.conform_columns(table(spark, sf_dir, "customer"), target)


@query("SELECT o_orderdate, o_orderkey, o_totalprice FROM orders")
def project_fixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.project_fixed(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey", "o_totalprice"])


@query("SELECT url, page_id FROM pages")
def select_fields_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.select_fields(table(spark, sf_dir, "pages"), ["url", "page_id"])


SPARSE_SQL = """
    SELECT CASE WHEN event_type = 'click' THEN user_id END AS clicked_by,
           CASE WHEN event_type = 'purchase' THEN value END AS paid,
           CASE WHEN event_type = 'signup' THEN ts END AS joined FROM events"""


@query(f"SELECT * FROM ({SPARSE_SQL}) t WHERE clicked_by IS NOT NULL OR paid IS NOT NULL OR joined IS NOT NULL")
def drop_all_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return shape.drop_all_null_rows(
        table(spark, sf_dir, "events").select(
            F.when(kind == "click", F.col("user_id")).alias("clicked_by"),
            F.when(kind == "purchase", F.col("value")).alias("paid"),
            F.when(kind == "signup", F.col("ts")).alias("joined"),
        )
    )


@query("SELECT * FROM orders WHERE FALSE")
def empty_like_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.empty_like(table(spark, sf_dir, "orders"))


# name: (filter list, table, the same condition in SQL)
FILTERS = {
    "equals": ([("equals", "o_orderstatus", "O")], "orders", "o_orderstatus = 'O'"),
    "not_equals": ([("not equals", "o_orderstatus", "O")], "orders", "o_orderstatus <> 'O'"),
    "less_than": ([("less than", "o_totalprice", "5000.5")], "orders", "o_totalprice < 5000.5"),
    "less_or_equal": ([("less or equal", "o_orderdate", "1996-03-01")], "orders", "o_orderdate <= TIMESTAMP '1996-03-01'"),
    "greater_than": ([("greater than", "orders.o_totalprice", "400000")], "orders", "o_totalprice > 400000"),
    "greater_or_equal": ([("greater or equal", "o_custkey", "700")], "orders", "o_custkey >= 700"),
    "like": ([("like", "c_mktsegment", "%UR%")], "customer", "c_mktsegment LIKE '%UR%'"),
    "in": ([("in", "c_mktsegment", "BUILDING,MACHINERY")], "customer", "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
    "not_in": ([("not in", "c_mktsegment", ["BUILDING", "MACHINERY"])], "customer",
               "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"),
    "many": ([("Equals ", "o_orderpriority", "2-HIGH"), ("greater than", "o_totalprice", "100000")], "orders",
             "o_orderpriority = '2-HIGH' AND o_totalprice > 100000"),
    "none": ([], "customer", "TRUE"),
}


def _filter_query(entries: list, source: str):
    spec = [{"operator": o, "column": c, "value": v} for o, c, v in entries]
    return lambda spark, sf_dir: table(spark, sf_dir, source).filter(filter_spec(spec))


for _name, (_entries, _source, _condition) in FILTERS.items():
    CATALOGUE[f"filter_spec_{_name}"] = Query(
        _filter_query(_entries, _source), f"SELECT * FROM {_source} WHERE {_condition}"
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
def report_to_query_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [
        {"column": "Orders.o_orderstatus", "operator": "equals", "value": "F"},
        {"column": "Orders.o_orderpriority", "operator": "not equals", "value": "5-LOW"},
    ]
    return report_to_query(table(spark, sf_dir, "orders"), ["Orders.o_orderkey", "Orders.o_totalprice"], filters)


# ---- nested records: each given row becomes a page or a record, nothing is collected ---------------


@query("""
    SELECT doc_id, lang, line, length(line)::INTEGER AS size
    FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents) t""")
def unwrap_pages_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per document, a record per line."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.char_length(x).alias("size")))
    pages = table(spark, sf_dir, "documents").select("doc_id", "lang", lines.alias("results"))
    return shape.unwrap_pages(pages, "results", keep=["doc_id", "lang"])


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS id, unnest(string_split(text, chr(10))) AS line FROM documents""")
def page_records_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages as JSON text."""
    records = F.transform(F.split("text", "\n"), lambda x: F.struct(F.col("doc_id").alias("id"), x.alias("line")))
    pages = table(spark, sf_dir, "documents").select(F.to_json(F.struct(records.alias("data"))).alias("body"))
    return page_records(pages, "data", "struct<id:string,line:string>")


@query("""
    SELECT doc_id, unnest(string_split(line, ' ')) AS word
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) t""")
def flatten_nested_array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words within lines within documents."""
    words = lambda line: F.transform(F.split(line, " "), lambda w: F.struct(F.col("doc_id"), w.alias("word")))
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(words(line).alias("words")))
    return shape.flatten_nested_array(table(spark, sf_dir, "documents").select(lines.alias("lines")), "lines", "words")


@query("""
    SELECT o_orderkey AS "Id", CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS "Owner_Name",
           CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS "Owner_Manager_Id", CAST(NULL AS VARCHAR) AS "Owner_Phone"
    FROM orders""")
def flatten_paths_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents missing at one level or the other, and a leaf no record has."""
    manager = F.when(F.col("o_orderstatus") == "F", F.struct(F.col("o_custkey").alias("Id")))
    owner = F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_orderpriority").alias("Name"), manager.alias("Manager")))
    records = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Id"), owner.alias("Owner"))
    return shape.flatten_paths(records, ["Id", "Owner.Name", "Owner.Manager.Id", "Owner.Phone"])


@query("""
    SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS "Owner_Name",
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS "Owner_Manager_Id"
    FROM orders""")
def flatten_paths_missing_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    manager = F.when(F.col("o_orderstatus") == "F", F.struct(F.col("o_custkey").alias("Id")))
    owner = F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_orderpriority").alias("Name"), manager.alias("Manager")))
    records = table(spark, sf_dir, "orders").select(owner.alias("Owner"))
    return shape.flatten_paths(records, ["Owner.Name", "Owner.Manager.Id"], missing_parent="")


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per line item: detail rows in a group of its own, the total in the grand-total group."""
    cell = lambda c: F.struct(F.col(c).cast("string").alias("label"), F.col(c).cast("string").alias("value"))
    row = F.struct(F.array(cell("l_partkey"), cell("l_suppkey"), cell("l_shipmode")).alias("dataCells"))
    total = F.struct(F.col("l_quantity").cast("bigint").cast("string").alias("value"))
    detail = F.struct(F.array(row, row).alias("rows"), F.array(total).alias("aggregates"))
    no_rows = F.filter(F.array(row), lambda _: F.lit(False))
    grand = F.struct(no_rows.alias("rows"), F.array(total).alias("aggregates"))
    facts = F.create_map(F.concat(F.col("l_returnflag"), F.lit("!T")), detail, F.lit("T!T"), grand)
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_shipmode", F.concat("l_returnflag", "l_linestatus"))
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.lit(True).alias("hasDetailRows"),
        (F.col("l_linestatus") == "F").alias("allData"),
        facts.alias("factMap"),
    )


@query("""
    SELECT l_returnflag || '!T' AS group_key, CAST(l_partkey AS VARCHAR) AS "Part_Key",
           CAST(l_suppkey AS VARCHAR) AS "Supplier", l_returnflag || l_linestatus AS "Mode"
    FROM lineitem CROSS JOIN (VALUES (1), (2)) twice(n)""")
def flatten_report_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = {"part": "Part.Key", "supplier": "Supplier", "mode": "Mode"}
    return shape.flatten_report(_reports(spark, sf_dir), list(labels), labels=labels)


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS total FROM lineitem")
def report_grand_total_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir).select("l_orderkey", "l_linenumber", shape.report_grand_total("factMap").alias("total"))


@query("""
    SELECT l_orderkey, l_linenumber, TRUE AS has_details, l_linestatus = 'F' AS all_data,
           CAST(2 AS BIGINT) AS detail_rows FROM lineitem""")
def report_status_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.report_status(_reports(spark, sf_dir), keep=["l_orderkey", "l_linenumber"])


def child_events() -> Column:
    """JSON children of an event: a status, then tags for some, then two comments for others."""
    status = F.concat(F.lit('{"status":"'), F.col("event_type"), F.lit('"}'))
    tags = F.concat(F.lit('{"tags":["u'), F.col("user_id").cast("string"), F.lit('"],"added_tags":["new"],"priority":null}'))
    public = F.concat(F.lit('{"comment_public":'), (F.col("value") > 100).cast("string"), F.lit("}"))
    tagged = F.col("event_type").isin("view", "click")
    commented = F.col("event_type").isin("purchase", "click")
    parts = F.array(
        F.when(F.col("event_type") != "error", status),
        F.when(tagged, tags),
        F.when(commented, public),
        F.when(commented, F.lit('{"comment_public":false}')),
    )
    return F.concat(F.lit("["), F.array_join(F.array_compact(parts), ","), F.lit("]"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS status,
           CASE WHEN event_type IN ('view', 'click') THEN '["u' || user_id || '"]' END AS tags,
           CASE WHEN event_type IN ('view', 'click') THEN '["new"]' END AS added_tags,
           CAST(NULL AS VARCHAR) AS removed_tags
    FROM events""")
def first_child_with_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", shape.child_records(child_events()).alias("children"))
    children = F.col("children")
    return events.select(
        "event_id",
        shape.first_child_with(children, "status").alias("status"),
        shape.first_child_with(children, "tags").alias("tags"),
        shape.first_child_with(children, "tags", "added_tags").alias("added_tags"),
        shape.first_child_with(children, "tags", "removed_tags").alias("removed_tags"),
    )


@query("""
    SELECT event_id, CASE WHEN event_type IN ('purchase', 'click')
                          THEN CAST(value > 100 AS VARCHAR) || 'false' ELSE '' END AS comment_public
    FROM events""")
def concat_children_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", shape.child_records(child_events()).alias("children"))
    return events.select("event_id", shape.concat_children(F.col("children"), "comment_public").alias("comment_public"))


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event, raw AS raw_value
    FROM (SELECT event_id, {MESSY_SQL} AS raw FROM events) t""")
def header_promote_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet whose header comes back in its middle."""
    events = table(spark, sf_dir, "events")
    body = events.select(F.col("event_id").alias("n"), F.col("event_id").cast("string").alias("a"), messy().alias("b"))
    header = spark.range(1).select(F.lit(" Event").alias("a"), F.lit("Raw/Value").alias("b"))
    sheet = body.unionByName(header.withColumn("n", F.lit(-1))).unionByName(header.withColumn("n", F.lit(500)))
    return header_promote(sheet, "n")


@query("SELECT * FROM orders")
def clustered_layout_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered_layout(table(spark, sf_dir, "orders"), "o_custkey", "o_custkey,o_orderdate")
