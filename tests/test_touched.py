from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesync.operators.merge import upsert
from lakesync.plans import replicate, touched
from lakesync.plans.changed import ChangedTable
from lakesync.plans.publish import SnapshotStore
from lakesync.plans.touched import touched_files, upsert_touched
from lakesync.spec import HighWaterMark, TableSpec


def laid_out(spark, store, n=1000, files=10, key="id"):
    df = spark.range(n).select(F.col("id").cast("int"), F.format_string("k%05d", "id").alias("name"), F.lit("old").alias("v"))
    path = store.stage("t", df.repartitionByRange(files, key))
    store.switch({"t": path}, {"t": df.schema})
    return df


@pytest.mark.parametrize("key", ["id", "name"])
def test_only_touched_files_are_written(spark, store, key):
    base = laid_out(spark, store, key=key)
    delta = base.filter("id IN (5, 7, 512)").withColumn("v", F.lit("new")).unionByName(
        spark.createDataFrame([(5000, "k05000", "added"), (None, None, "without key")], "id int, name string, v string")
    )
    wanted = rows(upsert(base, delta, key))
    done = upsert_touched(store, "t", delta, key)
    assert (done.rewritten, done.carried) == (2, 8) and rows(store.read("t")) == wanted
    assert rows(store.read_previous("t")) == rows(base)
    # The second time the statistics are those of the manifest, and files of the first merge count like any other.
    again = delta.withColumn("v", F.lit("newer")).filter("id = 512")
    done = upsert_touched(store, "t", again, key)
    assert done.carried >= 8 and rows(store.read("t")) == rows(upsert(upsert(base, delta, key), again, key))


def test_statistics_are_read_once(spark, store, monkeypatch):
    base = laid_out(spark, store)
    upsert_touched(store, "t", base.filter("id = 3"), "id")
    asked = []
    whole = touched.file_facts
    monkeypatch.setattr(touched, "file_facts", lambda s, folder, *more: (asked.append(folder), whole(s, folder, *more))[1])
    upsert_touched(store, "t", base.filter("id = 4"), "id")
    assert len(asked) == 1


def test_empty_delta_and_empty_table(spark, store):
    base = laid_out(spark, store)
    done = upsert_touched(store, "t", base.limit(0), "id")
    assert (done.rewritten, done.carried) == (0, 10) and store.read("t").count() == 1000
    store.replace("t", base.limit(0))
    upsert_touched(store, "t", base.limit(0), "id")
    assert store.read("t").count() == 0 and store.read("t").columns == base.columns
    upsert_touched(store, "t", base.filter("id < 2"), "id")
    assert store.read("t").count() == 2
    with pytest.raises(TypeError, match="double"):
        store.replace("d", spark.sql("SELECT 1.5D AS k"))
        upsert_touched(store, "d", spark.sql("SELECT 1.5D AS k"), "k")


def test_ranges(spark):
    facts = {"a": {"lo": 1, "hi": 5}, "b": {"lo": 4, "hi": 9}, "c": {"lo": None, "hi": None}, "d": {"lo": 20, "hi": 20}}
    for keys, wanted in (([5], "ab"), ([10, 19, 21], ""), ([None], ""), ([0, 20], "d"), ([6, 1], "ab")):
        frame = spark.createDataFrame([(k,) for k in keys], "k long")
        assert sorted(touched_files(frame, "k", facts)) == list(wanted)
    moments = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.000001' AS k")
    assert touched_files(moments, "k", {"x": {"lo": 1704067200000001, "hi": 1704067200000001}}) == ["x"]


def test_a_version_published_meanwhile_is_merged_into(spark, store, monkeypatch):
    base = laid_out(spark, store)
    stage = store.stage

    def late(*given):
        monkeypatch.undo()
        SnapshotStore(spark, store.root).append("t", spark.createDataFrame([(3, "k", "appended"), (2000, "k", "appended")], "id int, name string, v string"))
        return stage(*given)

    monkeypatch.setattr(store, "stage", late)
    upsert_touched(store, "t", base.filter("id = 3").withColumn("v", F.lit("new")), "id")
    found = {r.id: r.v for r in store.read("t").filter("v <> 'old'").collect()}
    assert found == {3: "new", 2000: "appended"} and store.read("t").count() == 1001


def test_release_takes_the_files_that_no_version_holds(spark, store):
    base = laid_out(spark, store)
    for i in range(3):
        upsert_touched(store, "t", base.filter("id = 3").withColumn("v", F.lit(f"v{i}")), "id")
    wanted, previous = rows(store.read("t")), rows(store.read_previous("t"))
    gone = store.release(datetime(9999, 1, 1))
    assert len([p for p in gone if "/part-" in p]) == 1 and len(gone) == 2
    assert rows(store.read("t")) == wanted and rows(store.read_previous("t")) == previous


def test_changes_still_win(spark, store):
    base = laid_out(spark, store, 20, 2)
    table = ChangedTable(store, "t", "id")
    table.merge_batch(base.filter("id = 3").withColumn("v", F.lit("change")), 0)
    upsert_touched(store, "t", base.filter("id IN (3, 4)").withColumn("v", F.lit("merged")), "id")
    assert {r.id: r.v for r in table.current().filter("v <> 'old'").collect()} == {3: "change", 4: "merged"}


@pytest.mark.parametrize("run", [replicate.incremental_import, replicate.incremental_reconcile])
def test_imports_that_write_touched_files(spark, store, tmp_path, run):
    plain = SnapshotStore(spark, str(tmp_path / "plain"))
    frames = {
        "first": spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id AS int)) AS ts", "'a' AS v"),
        "second": spark.sql("SELECT 7L AS id, timestamp_ntz'2024-09-01' AS ts, 'b' AS v UNION ALL SELECT 200L, timestamp_ntz'2024-09-02', 'b'"),
    }
    for where, rewrite in ((store, "touched"), (plain, True)):
        pending = [frames["first"], frames["second"]]
        mark = HighWaterMark("ts")
        spec = TableSpec("t", "id", mark, replicate.frame_extract(lambda s, p=pending: p.pop(0), mark))
        assert [run(where, [spec], rewrite=rewrite)[0].action for _ in range(2)] == ["bootstrap", "merged"]
    assert rows(store.read("t")) == rows(plain.read("t"))
