"""Merging by key and high-water marks."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import CHANGED_ORDERS_SQL, changed_orders, query, table
from lakesync.operators.merge import (
    dedupe_latest,
    delete_using,
    distinct_rows,
    distinct_values,
    duplicate_keys,
    keep_latest,
    reconcile_latest,
    semi_join_keys,
    union_all,
    union_pages,
    upsert,
)
from lakesync.operators.watermark import high_water_mark, read_high_water_mark, since_high_water
from lakesync.spec import HighWaterMark

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

RECONCILED_SQL = f"""
    WITH delta AS ({CHANGED_ORDERS_SQL}),
         merged AS (SELECT {ORDERS}, 0 AS d FROM orders UNION ALL SELECT {ORDERS}, 1 AS d FROM delta),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey
                                ORDER BY o_orderdate DESC NULLS LAST, d DESC) AS rn FROM merged)
    SELECT {ORDERS} FROM ranked WHERE rn = 1"""

UPSERTED_SQL = f"""
    WITH delta AS ({CHANGED_ORDERS_SQL})
    SELECT {ORDERS} FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = b.o_orderkey)
    UNION ALL SELECT {ORDERS} FROM delta"""


@query(RECONCILED_SQL)
def reconcile_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return reconcile_latest(orders, changed_orders(orders), "o_orderkey", "o_orderdate")


@query(f"""
    WITH merged AS (SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c),
         ranked AS (SELECT *, RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST) AS rk
                    FROM merged)
    SELECT {ORDERS} FROM ranked WHERE rk = 1""")
def reconcile_ties_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest orders of each customer, all of them at a tie."""
    orders = table(spark, sf_dir, "orders")
    return reconcile_latest(orders, changed_orders(orders), "o_custkey", "o_orderdate", ties="all")


KEYLESS = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END"


def _some_keyless(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")))


@query(f"""
    WITH keyed AS (SELECT o_orderkey, {KEYLESS} AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                          o_orderpriority FROM orders),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
                                ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
                    FROM keyed WHERE o_custkey IS NOT NULL)
    SELECT {ORDERS} FROM ranked WHERE rn = 1
    UNION ALL SELECT {ORDERS} FROM keyed WHERE o_custkey IS NULL""")
def null_keys_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(_some_keyless(table(spark, sf_dir, "orders")), "o_custkey", "o_orderdate", ["o_orderkey"])


@query(f"""
    WITH keyed AS (SELECT o_orderkey, {KEYLESS} AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                          o_orderpriority FROM orders),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
                                ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
                    FROM keyed WHERE o_custkey IS NOT NULL)
    SELECT {ORDERS} FROM ranked WHERE rn = 1""")
def null_keys_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _some_keyless(table(spark, sf_dir, "orders"))
    return keep_latest(orders, "o_custkey", "o_orderdate", ["o_orderkey"], null_keys="drop")


@query(UPSERTED_SQL)
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return upsert(orders, changed_orders(orders), "o_orderkey")


@query(f"""
    WITH delta AS ({CHANGED_ORDERS_SQL}),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                      o_orderkey DESC, o_totalprice DESC, o_orderpriority DESC) AS rn FROM delta)
    SELECT {ORDERS} FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_custkey = b.o_custkey)
    UNION ALL SELECT {ORDERS} FROM ranked WHERE rn = 1""")
def upsert_latest_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: the delta holds many versions of a key and is reduced first."""
    orders = table(spark, sf_dir, "orders")
    return upsert(orders, changed_orders(orders), "o_custkey", latest_by="o_orderdate")


LINEITEM = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, l_shipdate"""


@query(f"""
    WITH delta AS (SELECT CASE WHEN l_returnflag = 'A' THEN l_orderkey ELSE -l_orderkey - 1 END AS l_orderkey,
                          l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                          l_returnflag, 'X' AS l_linestatus, l_shipdate FROM lineitem)
    SELECT {LINEITEM} FROM lineitem b
    WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.l_orderkey = b.l_orderkey AND d.l_linenumber = b.l_linenumber)
    UNION ALL SELECT {LINEITEM} FROM delta""")
def upsert_composite_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-column key that is not unique: duplicates without a change stay."""
    lineitem = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    delta = lineitem.withColumns(
        {
            "l_orderkey": F.when(F.col("l_returnflag") == "A", key).otherwise(-key - 1),
            "l_linestatus": F.lit("X"),
        }
    )
    return upsert(lineitem, delta, "l_orderkey,l_linenumber")


@query(f"""
    SELECT {ORDERS} FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def delete_using_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers in debt are deleted."""
    in_debt = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return delete_using(table(spark, sf_dir, "orders"), in_debt.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")


@query(f"""
    SELECT {LINEITEM} FROM lineitem l
    WHERE EXISTS (SELECT 1 FROM (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem
                                 GROUP BY 1, 2 HAVING COUNT(*) > 1) d
                  WHERE d.k = l.l_orderkey AND d.n = l.l_linenumber)""")
def semi_join_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return semi_join_keys(lineitem, duplicate_keys(lineitem, keys), keys)


@query(f"""
    WITH ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem)
    SELECT {LINEITEM} FROM ranked WHERE rn = 1""")
def dedupe_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(table(spark, sf_dir, "lineitem"), "l_orderkey,l_linenumber", "l_shipdate")


@query(f"""
    WITH hot AS (SELECT CASE WHEN l_returnflag = 'A' THEN -1 ELSE l_orderkey END AS hot_key, * FROM lineitem),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY hot_key
        ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC, l_partkey DESC, l_suppkey DESC,
                 l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                 l_returnflag DESC, l_linestatus DESC) AS rn FROM hot)
    SELECT hot_key, {LINEITEM} FROM ranked WHERE rn = 1""")
def dedupe_latest_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows share one key."""
    hot = F.when(F.col("l_returnflag") == "A", F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey"))
    return dedupe_latest(table(spark, sf_dir, "lineitem").withColumn("hot_key", hot), "hot_key", "l_shipdate")


@query("""
    SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def duplicate_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey,l_linenumber")


@query("SELECT DISTINCT * FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer) t")
def distinct_rows_customer_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return distinct_rows(customer.unionByName(customer))


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_values_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@query(f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c")
def union_all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return union_all(orders, changed_orders(orders).select(*reversed(orders.columns)))


@query("""
    SELECT event_id, ts, user_id, value, NULL AS props FROM events WHERE event_type IN ('purchase', 'view')
    UNION ALL
    SELECT event_id, ts, NULL, NULL, props FROM events WHERE event_type NOT IN ('purchase', 'view')""")
def union_pages_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    paid = F.col("event_type").isin("purchase", "view")
    return union_pages(
        [
            events.filter(paid).select("event_id", "ts", "user_id", "value"),
            events.filter(~paid).select("event_id", "ts", "props"),
        ]
    )


@query("""
    SELECT date_trunc('second', MAX(ts)) AS high_water,
           CAST(epoch(date_trunc('second', MAX(ts))) AS BIGINT) AS epoch FROM events""")
def hwm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "events"), HighWaterMark("ts"))


@query("""
    SELECT date_trunc('second', MAX(ts)) - INTERVAL 25 HOUR AS high_water,
           CAST(epoch(date_trunc('second', MAX(ts)) - INTERVAL 25 HOUR) AS BIGINT) AS epoch FROM events""")
def hwm_lookback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "events"), HighWaterMark.reread("ts", extra_days=1))


@query("""
    SELECT date_trunc('second', MAX(ts)) AS high_water,
           CAST(epoch(date_trunc('second', MAX(ts))) AS BIGINT) AS epoch
    FROM events WHERE event_type <> 'error'""")
def hwm_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps kept as text, some of which are none."""
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    return high_water_mark(table(spark, sf_dir, "events").select(text.alias("ts")), HighWaterMark("ts"))


def _mark_of_signups(events: DataFrame, mark: HighWaterMark) -> object:
    return read_high_water_mark(events.filter("event_type = 'signup'"), mark)


@query("""
    SELECT * FROM events WHERE ts >= (SELECT date_trunc('second', MAX(ts)) FROM events
                                      WHERE event_type = 'signup')""")
def since_hwm_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica holds the signups; everything since its newest row."""
    events = table(spark, sf_dir, "events")
    mark = HighWaterMark("ts")
    return since_high_water(events, mark, _mark_of_signups(events, mark))


@query("""
    SELECT * FROM events WHERE ts > (SELECT date_trunc('second', MAX(ts)) - INTERVAL 241 HOUR FROM events
                                     WHERE event_type = 'signup')""")
def since_hwm_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    mark = HighWaterMark("ts", timedelta(hours=241), inclusive=False)
    return since_high_water(events, mark, _mark_of_signups(events, mark))
