"""Registration, and the inputs that several queries derive from the given tables.

The given tables are clean: keys are unique, nothing is NULL. Changes, gaps, duplicates and dirty texts
are therefore derived from their columns, over all rows, in Spark and in SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if run.__name__ in CATALOGUE:
            raise ValueError(f"query {run.__name__} is registered twice")
        CATALOGUE[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Every order changed: some at the same moment, some newer, some older, some without a date; those in
# progress become new orders.
CHANGED_ORDERS_SQL = """
    SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
           o_custkey, 'X' AS o_orderstatus, o_totalprice,
           CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate
                                WHEN '2-HIGH' THEN o_orderdate + INTERVAL 1 DAY
                                WHEN '3-MEDIUM' THEN o_orderdate - INTERVAL 1 DAY
                                WHEN '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL 2 DAY END AS o_orderdate,
           o_orderpriority
    FROM orders"""


def changed_orders(orders: DataFrame) -> DataFrame:
    key, date, priority = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority")
    day = F.make_dt_interval(days=F.lit(1))
    return orders.select(
        F.when(F.col("o_orderstatus") == "P", -key - 1).otherwise(key).alias("o_orderkey"),
        "o_custkey",
        F.lit("X").alias("o_orderstatus"),
        "o_totalprice",
        F.when(priority == "1-URGENT", date)
        .when(priority == "2-HIGH", date + day)
        .when(priority == "3-MEDIUM", date - day)
        .when(priority == "4-NOT SPECIFIED", date + day + day)
        .alias("o_orderdate"),
        "o_orderpriority",
    )


# Texts as a careless export has them: padded and negative numbers, fractions, words, blanks, NULL.
MESSY_SQL = """
    CASE event_type WHEN 'view' THEN '  ' || user_id || ' '
                    WHEN 'click' THEN user_id || '.7'
                    WHEN 'error' THEN 'e' || user_id
                    WHEN 'purchase' THEN '-' || event_id
                    ELSE CASE WHEN user_id < 50 THEN NULL WHEN user_id < 100 THEN '' ELSE '   ' END END"""


def messy() -> Column:
    return F.expr(MESSY_SQL)
