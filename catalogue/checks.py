"""Replica, load and page checks."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import CHANGED_ORDERS_SQL, changed_orders, query, table
from lakesync.operators import checks

NOW = datetime(2001, 8, 1, 12, 0, 0)


def _replica(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A replica that lacks the orders of the highest value."""
    orders = table(spark, sf_dir, "orders")
    return orders, orders.filter("o_totalprice < 490000")


@query("""
    SELECT s.n AS source_count, t.n AS target_count, s.n >= t.n AND s.n <= t.n * 1.05 AS ok
    FROM (SELECT COUNT(*) AS n FROM orders) s, (SELECT COUNT(*) AS n FROM orders WHERE o_totalprice < 490000) t""")
def count_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_parity(*_replica(spark, sf_dir))


@query("""
    SELECT s.a AS source_avg, t.a AS target_avg, s.a >= t.a AND s.a <= t.a * 1.05 AS ok
    FROM (SELECT AVG(o_orderkey) AS a FROM orders) s,
         (SELECT AVG(o_orderkey) AS a FROM orders WHERE o_totalprice < 490000) t""")
def avg_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.avg_parity(*_replica(spark, sf_dir), "o_orderkey")


@query("""
    SELECT MAX(o_orderdate) AS newest, MAX(o_orderdate) > TIMESTAMP '2001-07-31 12:00:00' AS ok FROM orders""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.freshness(table(spark, sf_dir, "orders"), "o_orderdate", NOW)


@query("""
    SELECT *, count_ok AND avg_ok AND fresh_ok AS ok FROM (
        SELECT s.n AS source_count, t.n AS target_count, s.a AS source_avg, t.a AS target_avg, t.m AS target_newest,
               s.n >= t.n AND s.n <= t.n * 1.05 AS count_ok, s.a >= t.a AND s.a <= t.a * 1.05 AS avg_ok,
               t.m > TIMESTAMP '2001-07-30 12:00:00' AS fresh_ok
        FROM (SELECT COUNT(*) AS n, AVG(o_orderkey) AS a FROM orders) s,
             (SELECT COUNT(*) AS n, AVG(o_orderkey) AS a, MAX(o_orderdate) AS m FROM orders
              WHERE o_totalprice < 490000) t) r""")
def validate_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validate_replica(
        *_replica(spark, sf_dir), "o_orderkey", "o_orderdate", NOW, max_age=timedelta(days=2)
    )


@query("""
    SELECT 'o_orderkey' AS candidate, COUNT(*)::BIGINT AS row_count, COUNT(DISTINCT o_orderkey) AS distinct_keys,
           CAST(0 AS BIGINT) AS null_keys, COUNT(*) = COUNT(DISTINCT o_orderkey) AS is_key FROM orders
    UNION ALL
    SELECT 'o_custkey,o_orderdate', COUNT(*), COUNT(DISTINCT (o_custkey, o_orderdate)), 0,
           COUNT(*) = COUNT(DISTINCT (o_custkey, o_orderdate)) FROM orders
    UNION ALL
    SELECT 'o_custkey', COUNT(*), COUNT(DISTINCT o_custkey), 0, COUNT(*) = COUNT(DISTINCT o_custkey) FROM orders""")
def infer_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = ["o_orderkey", "o_custkey,o_orderdate", "o_custkey"]
    return checks.infer_key(table(spark, sf_dir, "orders"), candidates)


@query(f"""
    WITH c AS ({CHANGED_ORDERS_SQL})
    SELECT 'o_orderdate' AS candidate, COUNT(*)::BIGINT AS row_count, COUNT(DISTINCT o_orderdate) AS distinct_keys,
           COUNT(*) FILTER (o_orderdate IS NULL) AS null_keys, FALSE AS is_key FROM c
    UNION ALL
    SELECT 'o_orderkey', COUNT(*), COUNT(DISTINCT o_orderkey), 0, COUNT(*) = COUNT(DISTINCT o_orderkey) FROM c""")
def infer_key_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.infer_key(changed_orders(table(spark, sf_dir, "orders")), ["o_orderdate", "o_orderkey"])


@query("""
    WITH commits AS (SELECT event_id AS query, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS status FROM events),
         queries AS (SELECT event_id AS query, user_id * 1000 + floor(value)::BIGINT AS xid,
                            'COPY public.' || event_type || 's FROM ...' AS querytxt, ts AS starttime FROM events),
         utility AS (SELECT user_id * 1000 + floor(value)::BIGINT AS xid,
                            CASE WHEN event_type = 'click' THEN 'ROLLBACK' ELSE 'COMMIT  ' END AS text FROM events)
    SELECT status, status = 1 AS success, COUNT(*) AS load_count
    FROM commits JOIN queries q USING (query)
    WHERE contains(querytxt, 'public.') AND starttime >= TIMESTAMP '2024-01-10 06:00:00'
      AND EXISTS (SELECT 1 FROM utility u WHERE u.xid = q.xid AND rtrim(u.text) = 'COMMIT')
    GROUP BY status""")
def committed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a load audit: transactions shared by several loads, some rolled back."""
    events = table(spark, sf_dir, "events")
    failed, rolled_back = F.col("event_type") == "error", F.col("event_type") == "click"
    xid = (F.col("user_id") * 1000 + F.floor("value")).alias("xid")
    copied = F.concat(F.lit("COPY public."), F.col("event_type"), F.lit("s FROM ..."))
    return checks.committed_loads(
        events.select(F.col("event_id").alias("query"), F.when(failed, 0).otherwise(1).alias("status")),
        events.select(F.col("event_id").alias("query"), xid, copied.alias("querytxt"), F.col("ts").alias("starttime")),
        events.select(xid, F.when(rolled_back, "ROLLBACK").otherwise("COMMIT  ").alias("text")),
        "public.",
        datetime(2024, 1, 10, 6, 0, 0),
    )


@query("""
    SELECT conv_id, COUNT(*) AS page_count, SUM(length(text))::BIGINT AS received, MAX(turn) * 100 AS declared,
           SUM(length(text)) >= MAX(turn) * 100 AS complete
    FROM conversations GROUP BY conv_id""")
def page_completeness_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages, their characters as the records received."""
    pages = table(spark, sf_dir, "conversations")
    return checks.page_completeness(pages, ["conv_id"], F.char_length("text"), F.col("turn") * 100)


@query("""
    SELECT event_id, event_type IN ('view', 'click') AS good FROM events""")
def envelope_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "object").otherwise("list")
    error = F.when(F.col("event_type") == "error", F.struct(F.lit("exceeded_rate").alias("name")))
    mark = F.when(F.col("event_type") != "purchase", kind)
    body = F.to_json(F.struct(mark.alias("object"), error.alias("error"), "user_id"))
    return table(spark, sf_dir, "events").select("event_id", checks.envelope_ok(body, {"object": "list"}).alias("good"))
