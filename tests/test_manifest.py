import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from test_jobs import content, frame

from lakesync.plans import manifest
from lakesync.plans.changed import ChangedTable
from lakesync.plans.manifest import Conflict, Manifest, State, TableState, version_entry
from lakesync.plans.publish import SnapshotStore

OLD, NEW = [(1, 1, "old"), (2, 1, "old")], [(1, 5, "fresh"), (2, 5, "fresh"), (3, 5, "fresh")]


def side_by_side(work, n):
    with ThreadPoolExecutor(n) as pool:
        return [f.result() for f in [pool.submit(work, i) for i in range(n)]]


@pytest.mark.parametrize("there", [True, False])
def test_appends_side_by_side_all_count(spark, store, there):
    if there:
        store.replace("t", frame(spark, [(0, 1, "base")]))
    stores = [store, SnapshotStore(spark, store.root)]
    side_by_side(lambda i: stores[i % 2].append("t", frame(spark, [(i, 1, f"row {k}") for k in range(10)])), 6)
    assert store.read("t").count() == 60 + there and len(stores[1].current_paths("t")) == 6 + there


def test_append_to_other_columns_is_a_conflict(spark, store, monkeypatch):
    store.replace("t", frame(spark, OLD))
    stage = store.stage

    def late(*given):
        SnapshotStore(spark, store.root).replace("t", spark.range(3))
        return stage(*given)

    monkeypatch.setattr(store, "stage", late)
    with pytest.raises(Conflict):
        store.append("t", frame(spark, NEW))
    assert store.read("t").count() == 3
    assert len([n for n in os.listdir(f"{store.root}/t") if n.startswith("v=")]) == 2


def test_replace_of_what_is_no_longer_current(spark, store):
    store.replace("t", frame(spark, OLD))
    seen = store.current_seq("t")
    store.append("t", frame(spark, NEW))
    with pytest.raises(Conflict):
        store.replace("t", frame(spark, OLD), built_on=seen)
    assert store.read("t").count() == 5
    store.replace("t", frame(spark, OLD), built_on=store.current_seq("t"))
    assert content(store.read("t")) == OLD
    with pytest.raises(Conflict):
        store.replace("new", frame(spark, OLD), built_on=7)
    store.replace("new", frame(spark, OLD), built_on=0)


def test_compact_leaves_a_newer_copy(spark, store, monkeypatch):
    store.replace("t", frame(spark, OLD))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(2, 3, "changed")]), 0)
    stage = store.stage

    def late(*given):
        path = stage(*given)
        store.replace("t", frame(spark, NEW))
        return path

    with monkeypatch.context() as patched:
        patched.setattr(store, "stage", lambda *given: (patched.undo(), late(*given))[1])
        assert table.compact() is False
    assert content(table.current()) == NEW and content(store.read("t")) == NEW
    assert table.compact() is True


def test_rollback_leaves_changes_with_their_version(spark, store):
    store.replace("t", frame(spark, OLD))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(2, 3, "of v1")]), 0)
    store.replace("t", frame(spark, NEW))
    table.merge_batch(frame(spark, [(1, 9, "of v2")]), 1)
    assert content(table.current()) == [(1, 9, "of v2"), *NEW[1:]]
    store.rollback("t")
    assert content(table.current()) == [OLD[0], (2, 3, "of v1")]
    store.rollback("t")
    assert content(table.current()) == [(1, 9, "of v2"), *NEW[1:]]


def test_rollback_of_a_compaction_keeps_its_changes(spark, store):
    store.replace("t", frame(spark, OLD))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(2, 3, "one")]), 0)
    table.compact()
    table.merge_batch(frame(spark, [(3, 3, "two")]), 1)
    store.rollback("t")
    assert content(store.read("t")) == OLD
    assert content(table.current()) == [OLD[0], (2, 3, "one"), (3, 3, "two")]


def test_a_batch_entered_twice_at_the_same_time_counts_once(spark, store):
    store.replace("t", frame(spark, OLD))
    side_by_side(lambda i: ChangedTable(SnapshotStore(spark, store.root), "t", "id").merge_batch(frame(spark, [(7, 1, "x")]), 3, "s"), 4)
    assert content(ChangedTable(store, "t", "id").current()) == [*OLD, (7, 1, "x")]


def test_a_later_batch_wins_whatever_its_time(spark, store):
    store.replace("t", frame(spark, OLD))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(1, 9, "newer")]), 0)
    table.merge_batch(frame(spark, [(1, 2, "later")]), 1)
    assert content(table.current()) == [(1, 2, "later"), OLD[1]]


def test_batches_are_kept_as_ranges():
    state = TableState()
    for batch in (0, 1, 5, 3, 2, 9, 4):
        state._enter_batch("s", batch)
    assert state.batches == {"s": [[0, 5], [9, 9]]}
    assert state.has_batch("s", 4) and not state.has_batch("s", 6) and not state.has_batch("other", 4)


def test_reading_costs_the_written_state_and_its_tail(spark, tmp_path, monkeypatch):
    log = Manifest(spark, str(tmp_path))
    for i in range(2 * manifest.EVERY + 3):
        log.publish(lambda state, i=i: [version_entry(f"t{i % 3}", [f"p{i}"])])
    late = Manifest(spark, str(tmp_path))
    read = []
    monkeypatch.setattr(late.files, "read", lambda path, get=late.files.read: (read.append(path), get(path))[1])
    state = late.state()
    assert len(read) == 4 and state.seq == 2 * manifest.EVERY + 3
    assert State.from_json(state.to_json()).tables == state.tables == log.state().tables
    assert late.state() is state and len(read) == 4
    # What written states stand for goes; the rest reads as before.
    assert log.prune(1 << 60) == manifest.EVERY
    assert Manifest(spark, str(tmp_path)).state().tables == state.tables


def test_release(spark, store):
    table = ChangedTable(store, "t", "id", "ts")
    store.replace("t", frame(spark, OLD))
    table.merge_batch(frame(spark, [(2, 3, "one")]), 0)
    table.compact()
    table.merge_batch(frame(spark, [(3, 3, "two")]), 1)
    staged = store.stage("t", frame(spark, NEW))
    assert store.release(datetime(2000, 1, 1)) == []
    # The first change is in the previous version's line: a rollback would need it.
    assert store.release(datetime(9999, 1, 1)) == [staged]
    assert content(table.current()) == [OLD[0], (2, 3, "one"), (3, 3, "two")]
    store.rollback("t")
    assert content(table.current()) == [OLD[0], (2, 3, "one"), (3, 3, "two")]
    store.replace("t", frame(spark, NEW))
    store.replace("t", frame(spark, OLD))
    gone = store.release(datetime(9999, 1, 1))
    assert len(gone) == 4 and len([p for p in gone if "/changes/" in p]) == 2
    assert content(store.read("t")) == OLD and content(store.read_previous("t")) == NEW
    table.merge_batch(frame(spark, [(3, 3, "again")]), 1)
    assert content(table.current()) == OLD


def test_discard_keeps_what_is_published(spark, store):
    path = store.replace("t", frame(spark, OLD))
    with pytest.raises(ValueError):
        store.discard(path)
    assert content(store.read("t")) == OLD
