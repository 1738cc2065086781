"""Publishing, replication and streaming, each over freshly written tables."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import CHANGED_ORDERS_SQL, changed_orders, query, table
from catalogue.merge import LINEITEM, ORDERS, RECONCILED_SQL, UPSERTED_SQL
from lakesync.operators.merge import reconcile_latest
from lakesync.plans.changed import ChangedTable
from lakesync.plans.distinct import append_distinct
from lakesync.plans.publish import SnapshotStore, promote_tables, publish_swap, side_by_side
from lakesync.plans.replicate import (
    changed_table,
    frame_extract,
    full_import,
    incremental_import,
    incremental_reconcile,
    replicate,
)
from lakesync.plans.touched import upsert_touched
from lakesync.session import shared_dir
from lakesync.spec import HighWaterMark, TableSpec
from lakesync.streaming.upsert import stream_upsert


def _store(spark: SparkSession, label: str) -> SnapshotStore:
    return SnapshotStore(spark, shared_dir(spark, label))


@query(f"SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c")
def publish_swap_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables switch together, then once more; the newer version is current."""
    store, orders = _store(spark, "swap"), table(spark, sf_dir, "orders")
    publish_swap(store, {"orders": orders, "customer": table(spark, sf_dir, "customer")})
    publish_swap(store, {"orders": changed_orders(orders)}, {"orders": ["o_orderkey"]})
    return store.read("orders")


@query("SELECT * FROM orders")
def backup_version_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, orders = _store(spark, "backup"), table(spark, sf_dir, "orders")
    store.replace("orders", orders)
    store.replace("orders", changed_orders(orders))
    return store.read_previous("orders")


@query(f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c")
def append_table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, orders = _store(spark, "append"), table(spark, sf_dir, "orders")
    store.append("orders", orders)
    store.append("orders", changed_orders(orders))
    return store.read("orders")


@query(f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c")
def append_side_by_side_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table exists; its changes come in eight appends at the same time, from stores that do not know of one another."""
    root, orders = shared_dir(spark, "append-side-by-side"), table(spark, sf_dir, "orders")
    SnapshotStore(spark, root).replace("orders", orders)
    parts = [changed_orders(orders).filter(F.pmod("o_custkey", F.lit(8)) == i) for i in range(8)]
    side_by_side(spark, lambda part: SnapshotStore(spark, root).append("orders", part), parts, workers=8)
    return SnapshotStore(spark, root).read("orders")


@query(f"SELECT {ORDERS} FROM orders")
def compact_after_new_copy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """While changes are folded in, a fresh copy of the table is published: it stays."""
    store, orders = _store(spark, "compact-late"), table(spark, sf_dir, "orders")
    store.replace("orders", changed_orders(orders))
    changed = ChangedTable(store, "orders", "o_orderkey")
    changed.merge_batch(changed_orders(orders).withColumn("o_orderstatus", F.lit("Y")), 0)
    stage = store.stage

    def late(*given) -> str:
        path = stage(*given)
        SnapshotStore(spark, store.root).replace("orders", orders)
        return path

    store.stage = late
    changed.compact()
    return changed.current()


@query(UPSERTED_SQL)
def rollback_with_changes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to the first version, then a second one with changes of its own: going back brings the first with its changes only."""
    store, orders = _store(spark, "rollback"), table(spark, sf_dir, "orders")
    changed = ChangedTable(store, "orders", "o_orderkey")
    store.replace("orders", orders)
    changed.merge_batch(changed_orders(orders), 0)
    store.replace("orders", orders.withColumn("o_orderstatus", F.lit("failed")))
    changed.merge_batch(orders.withColumn("o_orderstatus", F.lit("of the failed one")), 1)
    store.rollback("orders")
    return changed.current()


@query(f"""
    SELECT {ORDERS}, 'current' AS side FROM ({CHANGED_ORDERS_SQL}) c
    UNION ALL SELECT {ORDERS}, 'previous' FROM orders""")
def release_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty publications and an unpublished folder; all that is not current or previous is released, and both are still read."""
    store, orders = _store(spark, "release"), table(spark, sf_dir, "orders")
    for _ in range(9):
        store.append("customer", table(spark, sf_dir, "customer"))
        store.replace("nation", table(spark, sf_dir, "nation"))
    store.stage("orders", orders)
    store.replace("orders", changed_orders(orders))
    store.replace("orders", orders)
    store.replace("orders", changed_orders(orders))
    store.release(datetime(9999, 1, 1))
    again = SnapshotStore(spark, store.root)
    sides = {"current": again.read("orders"), "previous": again.read_previous("orders")}
    return sides["current"].withColumn("side", F.lit("current")).unionByName(sides["previous"].withColumn("side", F.lit("previous")))


# Single lines of a part of the orders get new versions, and their key ranges new lines.
TOUCHING_SQL = f"""
    SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_linenumber + 10 ELSE l_linenumber END AS l_linenumber, 'X' AS l_linestatus)
    FROM (SELECT {LINEITEM} FROM lineitem WHERE l_orderkey < (SELECT MAX(o_orderkey) // 10 FROM orders))"""


@query(f"""
    WITH delta AS ({TOUCHING_SQL})
    SELECT {LINEITEM} FROM lineitem b
    WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.l_orderkey = b.l_orderkey AND d.l_linenumber = b.l_linenumber)
    UNION ALL SELECT {LINEITEM} FROM delta""")
def upsert_touched_files_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many files laid out by key: the changes rewrite those they fall into, twice over, and the others stay."""
    store, lineitem = _store(spark, "touched"), table(spark, sf_dir, "lineitem")
    path = store.stage("lineitem", lineitem.repartitionByRange(16, "l_orderkey"))
    store.switch({"lineitem": path}, {"lineitem": lineitem.schema})
    keys = ["l_orderkey", "l_linenumber"]
    bound = table(spark, sf_dir, "orders").agg(F.expr("max(o_orderkey) div 10").alias("bound"))
    part = lineitem.join(F.broadcast(bound), F.col("l_orderkey") < F.col("bound")).drop("bound")
    number = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") + 10).otherwise(F.col("l_linenumber"))
    delta = part.withColumns({"l_linenumber": number, "l_linestatus": F.lit("X")})
    upsert_touched(store, "lineitem", delta.withColumn("l_linestatus", F.lit("Y")), keys)
    done = upsert_touched(store, "lineitem", delta, keys)
    if done.carried < 12:
        raise RuntimeError(f"files were rewritten without need: {done}")
    return store.read("lineitem")


@query(f"SELECT {ORDERS} FROM orders UNION SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c")
def append_distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, then their changes twice with half of the orders among them: each row is there once, and only new ones are written."""
    store, orders = _store(spark, "append-distinct"), table(spark, sf_dir, "orders")
    changed = changed_orders(orders)
    append_distinct(store, "orders", orders.unionByName(orders))
    append_distinct(store, "orders", changed.filter("o_custkey % 2 = 0").unionByName(orders.filter("o_orderkey % 2 = 0")))
    append_distinct(store, "orders", changed)
    return store.read("orders")


@query("SELECT * FROM lineitem")
def promote_tables_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table is promoted although another one is missing."""
    working, public = _store(spark, "working"), _store(spark, "public")
    working.replace("lineitem", table(spark, sf_dir, "lineitem"))
    promote_tables(working, public, {"absent": ["id"], "lineitem": ["l_orderkey", "l_linenumber"]})
    return public.read("lineitem")


def _spec(orders: DataFrame, mark: HighWaterMark, first: list[DataFrame]) -> TableSpec:
    """A source that holds ``first`` at the first extract and ``orders`` at the next."""
    frames = [*first, orders]

    def read(_: SparkSession) -> DataFrame:
        return frames.pop(0)

    return TableSpec("orders", "o_orderkey", mark, frame_extract(read, mark))


@query("SELECT * FROM customer")
def full_import_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "full")
    read = frame_extract(lambda s: table(s, sf_dir, "customer"))
    full_import(store, [TableSpec("customer", "c_custkey", extract=read)])
    return store.read("customer")


# What the source adds since the replica's newest row, one day and one hour of it read again.
SINCE_SQL = f"""
    SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c
    WHERE o_orderdate > (SELECT MAX(o_orderdate) - INTERVAL 25 HOUR FROM orders)"""


@query(f"""
    WITH delta AS ({SINCE_SQL})
    SELECT {ORDERS} FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = b.o_orderkey)
    UNION ALL SELECT {ORDERS} FROM delta""")
def incremental_import_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run loads everything, the second upserts what came since."""
    store, orders = _store(spark, "incremental"), table(spark, sf_dir, "orders")
    spec = _spec(changed_orders(orders), HighWaterMark.reread("o_orderdate", extra_days=1), [orders])
    for _ in range(2):
        incremental_import(store, [spec])
    return store.read("orders")


@query(f"""
    WITH delta AS ({SINCE_SQL})
    SELECT {ORDERS} FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = b.o_orderkey)
    UNION ALL SELECT {ORDERS} FROM delta""")
def incremental_changes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with only the changes written, folded into the base afterwards."""
    store, orders = _store(spark, "changes"), table(spark, sf_dir, "orders")
    spec = _spec(changed_orders(orders), HighWaterMark.reread("o_orderdate", extra_days=1), [orders])
    for _ in range(2):
        incremental_import(store, [spec], rewrite=False)
    merged = changed_table(store, spec)
    merged.compact()
    return merged.current()


@query(f"""
    WITH delta AS (SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c
                   WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders)),
         merged AS (SELECT {ORDERS}, 0 AS d FROM orders UNION ALL SELECT {ORDERS}, 1 FROM delta),
         ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey
                                ORDER BY o_orderdate DESC NULLS LAST, d DESC) AS rn FROM merged)
    SELECT {ORDERS} FROM ranked WHERE rn = 1""")
def incremental_reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, orders = _store(spark, "reconcile"), table(spark, sf_dir, "orders")
    spec = _spec(changed_orders(orders), HighWaterMark("o_orderdate"), [orders])
    for _ in range(2):
        incremental_reconcile(store, [spec])
    return store.read("orders")


@query("""
    SELECT 'orders' AS tbl, COUNT(*) AS row_count, TRUE AS ok FROM orders
    UNION ALL SELECT 'nation', COUNT(*), TRUE FROM nation""")
def replicate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table upserted, promoted and validated, another copied; what readers then count."""
    working, public = _store(spark, "replicate-working"), _store(spark, "replicate-public")
    mark = HighWaterMark("o_orderdate")
    orders = TableSpec("orders", "o_orderkey", mark, frame_extract(lambda s: table(s, sf_dir, "orders"), mark))
    nation = TableSpec("nation", "n_nationkey", extract=frame_extract(lambda s: table(s, sf_dir, "nation")))
    source = {"orders": table(spark, sf_dir, "orders")}
    done = replicate(working, public, [nation], [orders], source, now=datetime(2001, 8, 1, 6))
    counts = [public.read(t).select(F.lit(t).alias("tbl")).groupBy("tbl").count() for t in ("orders", "nation")]
    return counts[0].unionByName(counts[1]).select("tbl", F.col("count").alias("row_count"), F.lit(done.ok).alias("ok"))


@query(UPSERTED_SQL)
def stream_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes arrive as a stream of files; one batch is replayed, then all are folded in."""
    store, orders = _store(spark, "stream"), table(spark, sf_dir, "orders")
    store.replace("orders", orders)
    landing = shared_dir(spark, "landing")
    changed_orders(orders).repartition(4, "o_orderkey").write.parquet(landing)
    streamed = ChangedTable(store, "orders", "o_orderkey", "o_orderdate")
    changes = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    stream_upsert(changes, streamed, shared_dir(spark, "stream-checkpoint")).awaitTermination()
    return streamed.current()


@query(RECONCILED_SQL)
def reconcile_published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and delta as written tables, the result published over the base it reads."""
    store, orders = _store(spark, "published"), table(spark, sf_dir, "orders")
    publish_swap(store, {"orders": orders, "delta": changed_orders(orders)})
    merged = reconcile_latest(store.read("orders"), store.read("delta"), "o_orderkey", "o_orderdate")
    store.replace("orders", merged, ["o_orderkey"])
    return store.read("orders")


@query(UPSERTED_SQL)
def stream_restart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream starts from a new checkpoint, counting from zero again, after the first one's changes were folded in."""
    store, orders = _store(spark, "restart"), table(spark, sf_dir, "orders")
    store.replace("orders", orders)
    streamed, changed = ChangedTable(store, "orders", "o_orderkey", "o_orderdate"), changed_orders(orders)
    for number, part in enumerate((F.col("o_orderkey") < 0, F.col("o_orderkey") >= 0)):
        landing = shared_dir(spark, "landing")
        changed.filter(part).write.parquet(landing)
        changes = spark.readStream.schema(orders.schema).parquet(landing)
        stream_upsert(changes, streamed, shared_dir(spark, "stream-checkpoint")).awaitTermination()
        if number == 0:
            streamed.compact()
    return streamed.current()


@query(f"SELECT {ORDERS} FROM orders")
def stream_after_full_import_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh copy of the table is published after the stream's changes: they are no longer applied."""
    store, orders = _store(spark, "recopied"), table(spark, sf_dir, "orders")
    store.replace("orders", orders)
    streamed, landing = ChangedTable(store, "orders", "o_orderkey", "o_orderdate"), shared_dir(spark, "landing")
    changed_orders(orders).write.parquet(landing)
    changes = spark.readStream.schema(orders.schema).parquet(landing)
    stream_upsert(changes, streamed, shared_dir(spark, "stream-checkpoint")).awaitTermination()
    full_import(store, [TableSpec("orders", "o_orderkey", extract=frame_extract(lambda s: table(s, sf_dir, "orders")))])
    return streamed.current()


@query(f"""
    WITH delta AS ({CHANGED_ORDERS_SQL})
    SELECT {ORDERS}, NULL AS o_note FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = b.o_orderkey)
    UNION ALL SELECT {ORDERS}, LOWER(o_orderpriority) FROM delta""")
def changes_with_new_column_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes bring a column that the base has not."""
    store, orders = _store(spark, "new-column"), table(spark, sf_dir, "orders")
    store.replace("orders", orders)
    changed = ChangedTable(store, "orders", "o_orderkey", "o_orderdate", allow_new=True)
    delta = changed_orders(orders)
    changed.merge_batch(delta.filter("o_orderkey < 0").withColumn("o_note", F.lower("o_orderpriority")), 0)
    changed.merge_batch(delta.filter("o_orderkey >= 0").withColumn("o_note", F.lower("o_orderpriority")), 1)
    return changed.current()


@query(f"""
    WITH delta AS (SELECT {ORDERS} FROM ({CHANGED_ORDERS_SQL}) c WHERE o_orderdate IS NOT NULL)
    SELECT {ORDERS} FROM orders b WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = b.o_orderkey)
    UNION ALL SELECT {ORDERS} FROM delta
    UNION ALL SELECT {ORDERS} FROM (SELECT * REPLACE ('Y' AS o_orderstatus) FROM delta)""")
def incremental_changes_many_versions_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract with two versions of every key: written as changes, it leaves what a rewrite leaves."""
    store, orders = _store(spark, "versions"), table(spark, sf_dir, "orders")
    changed = changed_orders(orders)
    both = changed.unionByName(changed.withColumn("o_orderstatus", F.lit("Y")))
    spec = _spec(both, HighWaterMark("o_orderdate", lookback=timedelta(days=10000)), [orders])
    for _ in range(2):
        incremental_import(store, [spec], rewrite=False)
    return changed_table(store, spec).current()
