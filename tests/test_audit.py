from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesync.plans import manifest
from lakesync.plans.manifest import Manifest
from lakesync.plans.repair import copy_into, load_and_validate, load_with_repair
from lakesync.sources.delimited import LoadError, LoadOptions
from test_load import ddl

AT = datetime(2024, 1, 2, 3)


def audited(store):
    return rows(store.load_audit().select("table", "load_id", "row_count", "error_count"))


def test_a_load_and_its_audit_row_are_one_publication(spark, store, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("1,a\n2,b\n2,b\n")
    bad.write_text("3,c\nx,d\n")
    schema = ddl("n int, s string")
    copy_into(store, "t", str(good), schema, load_start=AT, load_id="one")
    row = store.load_audit("t").first()
    assert (row.seq, row.files, row.row_count, row.starttime) == (store.current_seq("t"), str(good), 3, AT)
    with pytest.raises(LoadError):
        copy_into(store, "t", str(bad), schema, load_id="two")
    # The same load again changes nothing, whatever the files hold by now.
    good.write_text("9,z\n")
    copy_into(store, "t", str(good), schema, load_id="one")
    assert audited(store) == [("t", "one", 3, 0)] and rows(store.read("t")) == [(1, "a"), (2, "b")]
    copy_into(store, "t", str(good), schema, dedupe=False, load_id="three", post_load=lambda df: df.withColumn("s", F.upper("s")))
    load_with_repair(store, "t", str(bad), schema, load_id="four")
    assert audited(store) == [("t", "four", 2, 0), ("t", "one", 3, 0), ("t", "three", 1, 0)]
    assert rows(store.read("t")) == [("1", "a"), ("2", "b"), ("3", "c"), ("9", "Z"), ("x", "d")]


def test_load_check_publish(spark, store, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("1,a\nx,b\n")
    schema = ddl("n int, s string")
    result, report = load_and_validate(store, "t", str(path), schema, load_id="one")
    assert report.outcomes == {"load_errors": False, "committed": False} and not store.exists("t")
    assert result.errors.first()["line_number"] == 2
    _, report = load_and_validate(store, "t", str(path), schema, LoadOptions(), max_error=1, load_id="one")
    assert report.ok and rows(store.read("t")) == [(1, "a")] and audited(store) == [("t", "one", 1, 1)]
    _, report = load_and_validate(
        store, "t", str(path), schema, max_error=1, load_id="two", post_load=lambda df: df.withColumn("n", F.col("n").cast("string"))
    )
    assert not report.outcomes["structure"] and not report.outcomes["committed"] and len(audited(store)) == 1


def test_audit_rows_survive_written_states(spark, tmp_path):
    log = Manifest(spark, str(tmp_path))
    for i in range(2 * manifest.EVERY + 2):
        log.publish(lambda state, i=i: [{"kind": "load", "table": "t", "load_id": f"l{i}"}])
    log.write_state()
    log.prune(1 << 60)
    again = Manifest(spark, str(tmp_path))
    assert [r["load_id"] for r in again.loads()] == [f"l{i}" for i in range(2 * manifest.EVERY + 2)]
    assert [r["seq"] for r in again.loads()] == list(range(1, 2 * manifest.EVERY + 3))
