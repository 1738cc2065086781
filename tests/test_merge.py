from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesync.operators import merge
from lakesync.operators.watermark import high_water_mark, read_high_water_mark, since_high_water
from lakesync.spec import HighWaterMark, TableSpec, key_list

SCHEMA = "id int, ts int, v string"
BASE = [(1, 10, "a"), (2, 10, "b"), (3, 10, "c"), (None, 10, "n"), (5, None, "q")]
DELTA = [(2, 20, "B"), (3, 10, "C"), (4, 20, "D"), (4, 15, "d"), (None, 20, "N")]
RECONCILED = [(None, 10, "n"), (None, 20, "N"), (1, 10, "a"), (2, 20, "B"), (3, 10, "C"), (4, 20, "D"), (5, None, "q")]


@pytest.fixture
def base(spark):
    return spark.createDataFrame(BASE, SCHEMA)


@pytest.fixture
def delta(spark):
    return spark.createDataFrame(DELTA, SCHEMA)


def same(df, expected):
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, expected))


def test_reconcile_one(base, delta):
    same(merge.reconcile_latest(base, delta, "id", "ts"), RECONCILED)


def test_reconcile_all_ties(base, delta):
    same(merge.reconcile_latest(base, delta, "id", "ts", ties="all"), [*RECONCILED, (3, 10, "c")])


def test_reconcile_drops_null_keys(base, delta):
    expected = [r for r in RECONCILED if r[0] is not None]
    same(merge.reconcile_latest(base, delta, "id", "ts", null_keys="drop"), expected)


def test_reconcile_ties_all_with_only_null_timestamps(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, None, "c"), (2, 1, "d")], SCHEMA)
    same(merge.keep_latest(df, "id", "ts", ties="all"), [(1, None, "a"), (1, None, "b"), (2, 1, "d")])


UPSERTED = [(1, 10, "a"), (2, 20, "B"), (3, 10, "C"), (4, 20, "D"), (4, 15, "d"), (5, None, "q"), (None, 10, "n"), (None, 20, "N")]


@pytest.mark.parametrize("hot", [None, []])
def test_upsert(base, delta, hot):
    same(merge.upsert(base, delta, "id", hot=hot), UPSERTED)


def test_upsert_latest(base, delta):
    same(merge.upsert(base, delta, "id", latest_by="ts"), [r for r in UPSERTED if r != (4, 15, "d")])


def test_upsert_matches_columns_by_name(base, delta):
    same(merge.upsert(base, delta.select("v", "ts", "id"), "id"), UPSERTED)
    with pytest.raises(ValueError, match="extra"):
        merge.upsert(base, delta.withColumn("extra", F.lit(1)), "id")
    assert merge.upsert(base, delta.drop("v"), "id", allow_missing=True).columns == ["id", "ts", "v"]


def test_hot_keys_are_found_and_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 3000
        df = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id").repartition(6)
        hot = merge.hot_keys(df, "k")
        assert len(hot) == 1
        gone = spark.createDataFrame([(-1,), (1,), (None,)], "k bigint")
        assert merge.delete_using(df, gone, "k").count() == n - n // 3 - 1
        assert merge.semi_join_keys(df, gone, "k").count() == n // 3 + 1
        kept = merge.delete_using(df, spark.createDataFrame([(1,)], "k bigint"), "k")
        assert kept.count() == n - 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_row_is_reduced_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("ts"))
    plan = merge.dedupe_latest(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_keys_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    wide = spark.createDataFrame([(1,), (2**40,)], "k bigint")
    assert rows(merge.delete_using(df, wide, "k")) == [(2,)]
    assert rows(merge.semi_join_keys(wide, df, "k")) == [(1,)]
    with pytest.raises(TypeError):
        merge.delete_using(df, spark.createDataFrame([("1",)], "k string"), "k")


def test_distinct_rows_with_maps(spark):
    df = spark.sql("SELECT map('a', 1) AS m, 1 AS x UNION ALL SELECT map('a', 1), 1 UNION ALL SELECT map('b', 1), 1")
    assert rows(merge.distinct_rows(df)) == [('{"a":1}', 1), ('{"b":1}', 1)]


def test_union_pages(spark):
    pages = [spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2.0, 3)], "c double, a int")]
    assert rows(merge.union_pages(pages)) == [(1, "x", None), (3, None, 2.0)]


def test_key_list():
    assert key_list("a, b") == ["a", "b"]
    assert TableSpec("t", ["a"]).key_columns == ["a"]
    with pytest.raises(ValueError):
        key_list("a,,b")


def test_high_water_mark(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:15.75' AS ts UNION ALL SELECT NULL")
    assert high_water_mark(df, HighWaterMark("ts")).first()["high_water"] == datetime(2024, 3, 10, 2, 30, 15)
    assert read_high_water_mark(df, HighWaterMark.reread("ts", 1)) == datetime(2024, 3, 9, 1, 30, 15)
    empty = df.filter("ts IS NULL")
    assert read_high_water_mark(empty, HighWaterMark("ts")) is None
    assert read_high_water_mark(empty, HighWaterMark("ts", default=datetime(2020, 1, 1))) == datetime(2020, 1, 1)


def test_high_water_mark_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:15.75' AS ts")
        row = high_water_mark(df, HighWaterMark("ts")).first()
        assert row["high_water"] == datetime(2024, 3, 10, 2, 30, 15) and row["epoch"] == 1710037815
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_since(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-03', INTERVAL 1 DAY)) AS ts")
    at = datetime(2024, 1, 2)
    assert since_high_water(df, HighWaterMark("ts"), at).count() == 2
    assert since_high_water(df, HighWaterMark("ts", timedelta(0), inclusive=False), at).count() == 1
    assert since_high_water(df, HighWaterMark("ts"), None).count() == 3


small = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("xyz")),
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=small, second=small)
def test_properties(spark, first, second):
    b, d = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)
    latest = [tuple(r) for r in merge.dedupe_latest(b, "id", "ts").collect()]
    keyed = [r for r in latest if r[0] is not None]
    assert len({r[0] for r in keyed}) == len(keyed)
    for k, ts, v in keyed:
        of_key = [r for r in first if r[0] == k]
        assert (k, ts, v) in of_key
        assert all(r[1] is None or (ts is not None and r[1] <= ts) for r in of_key)
    assert sorted(map(str, (r for r in latest if r[0] is None))) == sorted(map(str, (r for r in first if r[0] is None)))
    once = merge.upsert(b, d.filter("id IS NOT NULL"), "id", latest_by="ts")
    twice = merge.upsert(once, d.filter("id IS NOT NULL"), "id", latest_by="ts")
    same(twice, [tuple(r) for r in once.collect()])
