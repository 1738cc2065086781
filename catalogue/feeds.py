"""Record feeds: every given row becomes a page of API records, in Spark."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.base import query, table
from catalogue.shape import child_events
from lakesync.plans import feeds
from lakesync.plans.publish import SnapshotStore
from lakesync.session import shared_dir


def _page(df: DataFrame, key: str, *records: Column) -> DataFrame:
    return df.select(F.to_json(F.struct(F.array(*records).alias(key))).alias("body"))


def _nulls(columns: tuple[str, ...], given: dict[str, str]) -> str:
    return ", ".join(f'{given.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in columns)


TICKET_SQL = {c: "CAST(NULL AS BIGINT)" for c in feeds.TICKET_NUMBERS} | {
    "id": "CAST(o_orderkey AS VARCHAR)",
    "req_id": "o_custkey",
    "replies": "CAST(NULL AS BIGINT)",
    "status": "o_orderstatus",
    "subject": "'its a ' || o_orderpriority || ' order'",
    "updated_at": "strftime(o_orderdate, '%Y-%m-%d')",
}


@query(f"SELECT {_nulls(feeds.TICKET_COLUMNS, TICKET_SQL)} FROM orders")
def feed_tickets_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page holds two versions of a ticket, the older one with another status."""
    day = F.col("o_orderdate")

    def ticket(status: Column, at: Column) -> Column:
        return F.struct(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("req_id"),
            F.lit("3.7").alias("replies"),
            status.alias("status"),
            F.concat(F.lit("it's a \""), F.col("o_orderpriority"), F.lit('" order')).alias("subject"),
            F.date_format(at, "yyyy-MM-dd").alias("updated_at"),
        )

    newer = ticket(F.col("o_orderstatus"), day)
    older = ticket(F.lit("new"), day - F.make_dt_interval(days=F.lit(3)))
    return feeds.tickets(_page(table(spark, sf_dir, "orders"), "results", older, newer))


USER_SQL = {
    "id": "CAST(c_custkey AS VARCHAR)",
    "name": "c_name",
    "active": "CAST(c_acctbal > 0 AS VARCHAR)",
    "tags": """'["' || c_mktsegment || '"]'""",
}


@query(f"SELECT {_nulls(feeds.USER_COLUMNS, USER_SQL)} FROM customer")
def feed_users_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.array("c_mktsegment").alias("tags"),
        F.lit("x").alias("not_wanted"),
    )
    return feeds.users(_page(table(spark, sf_dir, "customer"), "users", user))


ORGANIZATION_SQL = {c: "''" for c in feeds.ORGANIZATION_COLUMNS} | {
    "id": "CAST(s_suppkey AS VARCHAR)",
    "name": "s_name",
    "details": "'a b' || s_nationkey",
    "created_at": "'2024-01-02 03:04:05'",
}


@query(f"SELECT {_nulls(feeds.ORGANIZATION_COLUMNS, ORGANIZATION_SQL)} FROM supplier")
def feed_organizations_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    organization = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("a, //b"), F.col("s_nationkey").cast("string")).alias("details"),
        F.lit("2024-01-02T03:04:05Z").alias("created_at"),
    )
    pages = _page(table(spark, sf_dir, "supplier"), "organizations", organization)
    return feeds.organizations(pages)


@query("""
    SELECT s_suppkey AS id, s_name AS name, 'a b' || s_nationkey AS details, '2024-01-02 03:04:05' AS created_at,
           CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 2 = 0 END AS shared,
           CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal END AS balance,
           CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'n' || s_nationkey END AS mixed,
           '["x",' || s_nationkey || ']' AS tags
    FROM supplier""")
def feed_organizations_discovered_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that only some have, one with numbers and texts, and lists: all are found, typed by all their values."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    text = F.concat_ws(
        "",
        F.lit('{"id":'), key.cast("string"), F.lit(',"name":"'), F.col("s_name"), F.lit('","details":"a, //b'), nation,
        F.lit('","created_at":"2024-01-02T03:04:05Z"'),
        F.when(key % 3 == 0, F.concat(F.lit(',"shared":'), (key % 2 == 0).cast("string"))),
        F.when(key % 5 == 0, F.concat(F.lit(',"balance":'), F.format_string("%.2fe0", "s_acctbal"))),
        F.concat(F.lit(',"mixed":'), F.when(key % 2 == 0, nation).otherwise(F.concat(F.lit('"n'), nation, F.lit('"')))),
        F.concat(F.lit(',"tags":["x",'), nation, F.lit("]}")),
    )
    listed = table(spark, sf_dir, "supplier").groupBy(F.pmod(key, F.lit(7)).alias("page")).agg(F.concat_ws(",", F.collect_list(text)).alias("all"))
    pages = listed.select(F.concat(F.lit('{"organizations":['), "all", F.lit("]}")).alias("body"))
    return feeds.organizations_with_all_fields(pages)


EVENT_SQL = {
    "child_events": "child_events",
    "id": "CAST(event_id AS VARCHAR)",
    "ticket_id": "CAST(user_id AS VARCHAR)",
    "created_at": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "status": "CASE WHEN event_type <> 'error' THEN event_type END",
    "tags": """CASE WHEN event_type IN ('view', 'click') THEN '["u' || user_id || '"]' END""",
    "added_tags": """CASE WHEN event_type IN ('view', 'click') THEN '["new"]' END""",
    "comment_public": """CASE WHEN event_type IN ('purchase', 'click')
                              THEN CAST(value > 100 AS VARCHAR) || 'false' ELSE '' END""",
}

CHILDREN_SQL = """
    '[' || concat_ws(',',
        CASE WHEN event_type <> 'error' THEN '{"status":"' || event_type || '"}' END,
        CASE WHEN event_type IN ('view', 'click')
             THEN '{"tags":["u' || user_id || '"],"added_tags":["new"],"priority":null}' END,
        CASE WHEN event_type IN ('purchase', 'click') THEN '{"comment_public":' || (value > 100) || '}' END,
        CASE WHEN event_type IN ('purchase', 'click') THEN '{"comment_public":false}' END) || ']'"""


@query(f"""
    SELECT {_nulls(feeds.EVENT_COLUMNS, EVENT_SQL)}
    FROM (SELECT *, {CHILDREN_SQL} AS child_events FROM events) e""")
def feed_ticket_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(
        F.lit('{"ticket_events":[{"id":'),
        F.col("event_id").cast("string"),
        F.lit(',"ticket_id":'),
        F.col("user_id").cast("string"),
        F.date_format("ts", "',\"created_at\":\"'yyyy-MM-dd'T'HH:mm:ss'Z\"'"),
        F.lit(',"child_events":'),
        child_events(),
        F.lit("}]}"),
    )
    return feeds.ticket_events(table(spark, sf_dir, "events").select(body.alias("body")))


@query("""
    SELECT DISTINCT CASE WHEN role <> 'system' THEN text END AS whats_said,
           CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) END AS which_turn
    FROM conversations WHERE role <> 'system'""")
def feed_survey_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers keyed by question id; whoever answered nothing is left out."""
    answers = F.create_map(
        F.lit("q1"),
        F.when(F.col("role") != "system", F.col("text")),
        F.lit("q2"),
        F.when(F.col("role") == "user", F.col("turn").cast("string")),
    )
    pages = _page(table(spark, sf_dir, "conversations"), "responses", F.struct(answers.alias("answers")))
    return feeds.survey_answers(pages, {"q1": "What's said?", "q2": "Which (turn)"}, ["q1", "q2"])


@query("""
    SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS "Id", s_name AS "Name",
           CASE WHEN s_acctbal > 0 THEN 'N' || s_nationkey END AS "Owner_Name" FROM supplier""")
def feed_query_records_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = F.when(
        F.col("s_acctbal") > 0,
        F.struct(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("Name")),
    )
    record = F.struct(F.col("s_suppkey").cast("string").alias("Id"), F.col("s_name").alias("Name"), owner.alias("Owner"))
    kind = T.StructType.fromDDL("Id string, Name string, Owner struct<Name:string>")
    pages = _page(table(spark, sf_dir, "supplier"), "records", record)
    return feeds.query_records(pages, kind, ["Id", "Name", "Owner.Name"])


@query("""
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS "Order_Key", CAST(l_partkey AS VARCHAR) AS "Part" FROM lineitem""")
def feed_report_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.array(*[F.struct(F.col(c).cast("string").alias("label")) for c in ("l_orderkey", "l_partkey")])
    rows = F.struct(F.array(F.struct(cells.alias("dataCells"))).alias("rows"))
    fact = F.create_map(F.concat("l_returnflag", F.lit("!T")), rows)
    report = F.struct(F.lit(True).alias("hasDetailRows"), F.lit(True).alias("allData"), fact.alias("factMap"))
    pages = table(spark, sf_dir, "lineitem").select(F.to_json(report).alias("body"))
    return feeds.report_rows(pages, ["Order.Key", "Part"])


@query("""
    SELECT DISTINCT p_partkey, p_name, p_size::BIGINT AS part_size,
           CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS DOUBLE) AS price FROM part""")
def sheet_to_table_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string"),
        "p_name",
        F.col("p_size").cast("string").alias("part_size"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price"),
    )
    store = SnapshotStore(spark, shared_dir(spark, "sheet"))
    feeds.sheet_to_table(store, "part", sheet)
    return store.read("part")


@query("SELECT DISTINCT * FROM (SELECT o_custkey, o_orderstatus FROM orders) t")
def extract_to_table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same extract twice."""
    store = SnapshotStore(spark, shared_dir(spark, "extract"))
    for _ in range(2):
        feeds.extract_to_table(store, "orders", table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"))
    return store.read("orders")
