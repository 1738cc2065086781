from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesync.plans import distinct
from lakesync.plans.distinct import append_distinct
from lakesync.plans.publish import SnapshotStore

SCHEMA = "id int, d double, s string, a array<int>"


def odd(spark, n, start=0):
    values = [(i if i % 7 else None, [0.5, -0.0, 0.0, float("nan"), None][i % 5], f"s{i % 3}", [i, None]) for i in range(start, start + n)]
    return spark.createDataFrame(values, SCHEMA)


def text(df):
    return sorted(map(str, df.collect()))


def test_equals_the_full_distinct(spark, store):
    parts = [odd(spark, 60), odd(spark, 80, 30), odd(spark, 10), odd(spark, 200, 90).unionByName(odd(spark, 20, 100))]
    seen, held = None, 0
    for i, part in enumerate(parts):
        seen = part if seen is None else seen.unionByName(part)
        wanted = seen.distinct().count()
        assert append_distinct(store, "t", part) == wanted - held
        held = wanted
        assert store.read("t").count() == held
    assert text(store.read("t").withColumn("d", F.col("d") + 0.0)) == text(seen.withColumn("d", F.col("d") + 0.0).distinct())
    # The third part brought nothing, so the table consists of what the other three wrote.
    assert len(store.current_paths("t")) == 3


def test_false_positives_lose_nothing(spark, store, monkeypatch):
    monkeypatch.setattr(distinct, "ROWS_PER_WORD", 10**9)
    append_distinct(store, "t", spark.range(1000))
    before = store.current_paths("t")
    assert append_distinct(store, "t", spark.range(500, 2000)) == 1000
    facts = store.table_state("t").current.facts
    assert facts[before[0]]["words"] == 1 and store.current_paths("t")[:1] == before
    # With all rows in one word every row is a possible repeat.
    maybe = distinct.possible_repeats(store, distinct._hashed(spark.range(5000, 5100)), facts)
    assert maybe.select("__hash").distinct().count() == 100
    assert rows(store.read("t").distinct()) == rows(spark.range(2000)) and store.read("t").count() == 2000


def test_filters_rule_most_rows_out(spark, store):
    append_distinct(store, "t", spark.range(20_000))
    append_distinct(store, "t", spark.range(1))
    facts = store.table_state("t").current.facts
    asked = distinct._hashed(spark.range(50_000, 90_000))
    assert distinct.possible_repeats(store, asked, facts).count() < 40_000 * 0.02
    assert distinct.possible_repeats(store, distinct._hashed(spark.range(20_000)), facts).count() == 20_000


def test_target_rows_are_not_exchanged(spark, store):
    append_distinct(store, "t", spark.range(300_000).selectExpr("id", "uuid() AS a", "uuid() AS b"))
    held, delta = store.read("t"), store.stage("x", store.read("t").filter("id % 10000 = 3"))
    hashed = distinct._hashed(spark.read.parquet(delta))
    found = distinct._repeats(hashed, hashed.select("__hash"), held)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)  # the target's, on the left
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    joined = next(i for i, line in enumerate(above) if "Join" in line)
    assert "BroadcastHashJoin" in above[joined] and not any("Exchange" in line for line in above[:joined])
    assert found.count() == 30


def test_tables_not_known_to_be_distinct_are_made_so(spark, store):
    store.replace("t", spark.range(3).unionByName(spark.range(3)))
    assert append_distinct(store, "t", spark.range(2, 5)) == -1
    store.append("t", spark.range(1))
    assert append_distinct(store, "t", spark.range(9, 10)) == 0
    assert rows(store.read("t")) == [(i,) for i in (0, 1, 2, 3, 4, 9)]
    with pytest.raises(ValueError):
        append_distinct(store, "t", spark.createDataFrame([(1,)], "other int"))


def test_side_by_side(spark, store):
    append_distinct(store, "t", spark.range(10))
    append_distinct(store, "t", spark.range(11))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: append_distinct(SnapshotStore(spark, store.root), "t", spark.range(5 * i, 30)), range(4)))
    assert sorted(r.id for r in store.read("t").collect()) == list(range(30))


def test_maps_become_text(spark, store):
    maps = spark.sql("SELECT map('a', id) AS m FROM range(3)")
    assert append_distinct(store, "t", maps) == 3
    assert append_distinct(store, "t", maps.unionByName(spark.sql("SELECT map('b', 1L) AS m"))) == 1
    assert text(store.read("t")) == text(spark.createDataFrame([(f'{{"a":{i}}}',) for i in range(3)] + [('{"b":1}',)], "m string"))
