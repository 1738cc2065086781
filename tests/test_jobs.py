from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakesync.operators import checks
from lakesync.plans import feeds, publish, replicate
from lakesync.plans.changed import ChangedTable
from lakesync.sources import paged
from lakesync.spec import HighWaterMark, TableSpec
from lakesync.streaming.upsert import stream_upsert

SCHEMA = "id int, ts timestamp_ntz, v string"


def at(day):
    return datetime(2024, 1, day)


def frame(spark, data):
    return spark.createDataFrame([(k, at(d), v) for k, d, v in data], SCHEMA)


def content(df):
    return sorted(((r["id"], r["ts"].day, r["v"]) for r in df.collect()), key=str)


# ---- publish ------------------------------------------------------------------------------------


def test_swap_keeps_the_previous_version(spark, store):
    one, two = frame(spark, [(1, 1, "a")]), frame(spark, [(1, 2, "b")])
    publish.publish_swap(store, {"t": one, "u": one})
    publish.publish_swap(store, {"t": two})
    assert content(store.read("t")) == [(1, 2, "b")] and content(store.read_previous("t")) == [(1, 1, "a")]
    assert content(store.read("u")) == [(1, 1, "a")]
    with pytest.raises(LookupError):
        store.read_previous("u")
    store.rollback("t")
    assert content(store.read("t")) == [(1, 1, "a")]


def test_failed_write_switches_nothing(spark, store):
    store.replace("t", frame(spark, [(1, 1, "a")]))
    broken = frame(spark, [(2, 1, "b")]).withColumn("id", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish.publish_swap(store, {"t": broken})
    assert content(store.read("t")) == [(1, 1, "a")]


def test_append_writes_only_new_rows(spark, store):
    store.append("t", frame(spark, [(1, 1, "a")]))
    first = store.current_paths("t")
    store.append("t", frame(spark, [(2, 1, "b")]).select("v", "id", "ts"))
    assert store.current_paths("t")[:1] == first or first[0] in store.current_paths("t")
    assert content(store.read("t")) == [(1, 1, "a"), (2, 1, "b")]
    with pytest.raises(ValueError):
        store.append("t", spark.createDataFrame([(1,)], "x int"))


def test_replace_reads_itself(spark, store):
    store.replace("t", frame(spark, [(1, 1, "a")]))
    store.replace("t", store.read("t").unionByName(store.read("t")))
    assert store.read("t").count() == 2


def test_views(spark, store):
    spark.sql("CREATE DATABASE IF NOT EXISTS live")
    spark.sql("CREATE DATABASE IF NOT EXISTS backup")
    store.replace("t", frame(spark, [(1, 1, "a")]))
    store.append("t", frame(spark, [(2, 1, "b")]))
    store.create_views("live", ["t"], "backup")
    assert spark.table("live.t").count() == 2 and spark.table("backup.t").count() == 1


def test_catalog_tables(spark):
    publish.replace_table(frame(spark, [(1, 1, "a")]), "copied", ["id"])
    publish.append_table(frame(spark, [(2, 1, "b")]).select("v", "ts", "id"), "copied")
    assert content(spark.table("copied")) == [(1, 1, "a"), (2, 1, "b")]
    with pytest.raises(ValueError):
        publish.append_table(spark.range(1), "copied")


def test_promotion_goes_on_after_a_failure(spark, store, tmp_path):
    public = publish.SnapshotStore(spark, str(tmp_path / "public"))
    store.replace("t", frame(spark, [(1, 1, "a")]))
    results = publish.promote_tables(store, public, {"absent": ["id"], "t": ["id"]})
    assert [r.error is None for r in results] == [False, True]
    assert content(public.read("t")) == [(1, 1, "a")]


def test_tables_staged_side_by_side_switch_together_or_not_at_all(spark, store):
    tables = {f"t{i}": frame(spark, [(i, 1, "a")]) for i in range(5)}
    publish.publish_swap(store, tables, workers=3)
    assert [content(store.read(t)) for t in tables] == [[(i, 1, "a")] for i in range(5)]
    broken = frame(spark, [(9, 9, "z")]).withColumn("v", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        publish.publish_swap(store, {"t0": frame(spark, [(8, 8, "y")]), "t1": broken})
    assert content(store.read("t0")) == [(0, 1, "a")]
    publish.publish_swap(store, {})


# ---- replicate ----------------------------------------------------------------------------------


def source(spark, *versions, mark=None):
    pending = list(versions)
    return replicate.frame_extract(lambda s: frame(spark, pending.pop(0) if len(pending) > 1 else pending[0]), mark)


FIRST = [(1, 1, "a"), (2, 2, "b")]
SECOND = [(1, 1, "a"), (2, 3, "B"), (3, 4, "c"), (4, 1, "late")]


@pytest.mark.parametrize("rewrite", [True, False])
def test_incremental_import(spark, store, rewrite):
    mark = HighWaterMark.reread("ts")
    spec = TableSpec("t", "id", mark, source(spark, FIRST, SECOND, SECOND[:1], mark=mark))
    actions = [replicate.incremental_import(store, [spec], rewrite)[0].action for _ in range(3)]
    assert actions == ["bootstrap", "merged", "unchanged"]
    table = store.read("t") if rewrite else replicate.changed_table(store, spec).current()
    assert content(table) == [(1, 1, "a"), (2, 3, "B"), (3, 4, "c")]


def test_incremental_reconcile(spark, store):
    mark = HighWaterMark("ts")
    spec = TableSpec("t", "id", mark, source(spark, FIRST, [(2, 2, "again"), (1, 5, "new")], mark=mark))
    results = [replicate.incremental_reconcile(store, [spec])[0] for _ in range(2)]
    assert results[1].since == at(2)
    assert content(store.read("t")) == [(1, 5, "new"), (2, 2, "again")]


def test_post_load_and_empty_source(spark, store):
    spec = TableSpec("t", "id", extract=source(spark, FIRST, []), post_load=lambda df: df.filter("id > 1"))
    replicate.full_import(store, [spec])
    assert content(store.read("t")) == [(2, 2, "b")]
    assert replicate.full_import(store, [spec], on_empty="skip")[0].action == "unchanged"
    assert store.read("t").count() == 1
    replicate.full_import(store, [spec])
    assert store.read("t").count() == 0


@pytest.mark.parametrize("rewrite", [True, False])
def test_replicate(spark, store, tmp_path, rewrite):
    public = publish.SnapshotStore(spark, str(tmp_path / "public"))
    mark = HighWaterMark("ts")
    spec = TableSpec("t", "id", mark, source(spark, FIRST, SECOND, mark=mark))
    whole = TableSpec("w", "id", extract=source(spark, FIRST))
    for versions in (FIRST, SECOND):
        sources = {"t": frame(spark, versions)}
        result = replicate.replicate(store, public, [whole], [spec], sources, at(5), rewrite=rewrite)
    assert content(public.read("t")) == [(1, 1, "a"), (2, 3, "B"), (3, 4, "c")]
    # The late row is older than the mark, so the source has one row more than the tolerance allows.
    assert not result.ok and not result.reports["t"].outcomes["count_ok"]
    with pytest.raises(checks.CheckFailed):
        result.reports["t"].assert_ok()


# ---- stream -------------------------------------------------------------------------------------


def test_stream_upsert(spark, store, tmp_path):
    store.replace("t", frame(spark, FIRST))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    table = ChangedTable(store, "t", "id", "ts")
    assert content(table.current()) == FIRST

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        stream_upsert(stream, table, checkpoint).awaitTermination()

    frame(spark, [(2, 3, "B"), (2, 2, "x"), (3, 1, "c")]).write.parquet(landing)
    run()
    after = [(1, 1, "a"), (2, 3, "B"), (3, 1, "c")]
    assert content(table.current()) == after
    frame(spark, [(3, 1, "C")]).write.mode("append").parquet(landing)
    run()
    after[2] = (3, 1, "C")
    assert content(table.current()) == after
    table.merge_batch(frame(spark, [(3, 1, "C")]), 1)
    assert content(table.current()) == after
    table.compact()
    assert content(store.read("t")) == after and content(table.current()) == after
    assert table.changes().count() == 0
    frame(spark, [(1, 9, "A")]).write.mode("append").parquet(landing)
    run()
    after[0] = (1, 9, "A")
    assert content(table.current()) == after


def test_changes_belong_to_source_and_base(spark, store):
    store.replace("t", frame(spark, FIRST))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(3, 3, "c")]), 0, "one")
    table.compact()
    table.merge_batch(frame(spark, [(4, 4, "d")]), 0, "two")
    table.merge_batch(frame(spark, [(5, 5, "repeated")]), 0, "one")
    assert content(table.current()) == [*FIRST, (3, 3, "c"), (4, 4, "d")]
    store.append("t", frame(spark, [(6, 6, "f")]))
    assert content(table.current()) == [*FIRST, (3, 3, "c"), (4, 4, "d"), (6, 6, "f")]
    store.replace("t", frame(spark, FIRST))
    assert content(table.current()) == FIRST


def test_changes_that_arrive_while_folding_are_kept(spark, store, monkeypatch):
    store.replace("t", frame(spark, FIRST))
    table = ChangedTable(store, "t", "id", "ts")
    table.merge_batch(frame(spark, [(3, 3, "c")]), 0)
    stage = store.stage

    def slow(*given):
        monkeypatch.setattr(store, "stage", stage)
        table.merge_batch(frame(spark, [(4, 4, "d")]), 1)
        return stage(*given)

    monkeypatch.setattr(store, "stage", slow)
    table.compact()
    assert content(store.read("t")) == [*FIRST, (3, 3, "c")]
    assert content(table.current()) == [*FIRST, (3, 3, "c"), (4, 4, "d")]


def test_changes_with_other_columns(spark, store):
    store.replace("t", frame(spark, FIRST))
    more = frame(spark, [(2, 3, "B")]).selectExpr("*", "7 AS more")
    with pytest.raises(ValueError, match="more"):
        ChangedTable(store, "t", "id", "ts").merge_batch(more, 0)
    with pytest.raises(TypeError, match="id"):
        ChangedTable(store, "t", "id").merge_batch(frame(spark, FIRST).selectExpr("'x' AS id", "ts", "v"), 0)
    table = ChangedTable(store, "t", "id", "ts", allow_new=True)
    table.merge_batch(more, 0)
    table.merge_batch(frame(spark, [(3, 1, "c")]), 1)
    assert {(r.id, r.v, r.more) for r in table.current().collect()} == {(1, "a", None), (2, "B", 7), (3, "c", None)}


@pytest.mark.parametrize("latest", [False, True])
def test_both_forms_of_import_agree(spark, tmp_path, latest):
    found = []
    for rewrite in (True, False):
        store = publish.SnapshotStore(spark, str(tmp_path / str(rewrite)))
        spec = TableSpec("t", "id", HighWaterMark("ts"), source(spark, FIRST, [(2, 3, "B"), (2, 4, "C")]))
        for _ in range(2):
            replicate.incremental_import(store, [spec], rewrite, latest)
        found.append(content(store.read("t") if rewrite else replicate.changed_table(store, spec).current()))
    assert found[0] == found[1] == [(1, 1, "a"), *([] if latest else [(2, 3, "B")]), (2, 4, "C")]
    with pytest.raises(replicate.ImportFailed, match="post_load"):
        post = TableSpec("t", "id", HighWaterMark("ts"), source(spark, FIRST), post_load=lambda df: df)
        replicate.incremental_import(store, [post], rewrite=False)


def test_one_failing_table_of_three(spark, store):
    def broken(*_):
        raise OSError("unreachable")

    specs = [TableSpec(n, "id", extract=broken if n == "b" else source(spark, FIRST)) for n in "abc"]
    with pytest.raises(replicate.ImportFailed, match="b: OSError: unreachable") as failed:
        replicate.incremental_import(store, specs)
    assert [r.action for r in failed.value.results] == ["bootstrap", "failed", "bootstrap"]
    assert content(store.read("a")) == content(store.read("c")) == FIRST


def test_failing_full_copies_are_reported_beside_the_upserts(spark, store, tmp_path):
    def broken(*_):
        raise OSError("unreachable")

    mark = HighWaterMark("ts")
    good = TableSpec("t", "id", mark, source(spark, FIRST, mark=mark))
    full = [TableSpec("w", "id", extract=source(spark, FIRST)), TableSpec("b", "id", extract=broken)]
    public = publish.SnapshotStore(spark, str(tmp_path / "public"))
    done = replicate.replicate(store, public, full, [good], {"t": frame(spark, FIRST)}, at(2))
    assert [(t.table, t.action) for t in done.tables] == [("t", "bootstrap"), ("w", "failed"), ("b", "failed")]
    assert not done.ok and content(public.read("t")) == FIRST and not public.exists("w")


def test_an_empty_source_is_asked_once(spark, store):
    asked = []

    def extract(*_):
        asked.append(1)
        return frame(spark, [])

    store.replace("t", frame(spark, FIRST))
    assert replicate.full_import(store, [TableSpec("t", "id", extract=extract)], "skip")[0].action == "unchanged"
    assert asked == [1] and content(store.read("t")) == FIRST


def test_without_sources_nothing_is_validated(spark, store, tmp_path):
    spec = TableSpec("t", "id", HighWaterMark("ts"), source(spark, FIRST, mark=HighWaterMark("ts")))
    done = replicate.replicate(store, publish.SnapshotStore(spark, str(tmp_path / "public")), [], [spec])
    assert done.ok is None and done.unvalidated == ["t"]


def test_append_keeps_types(spark, store):
    store.append("t", spark.range(2))
    store.append("t", spark.createDataFrame([(5,)], "id int"))
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 5]
    with pytest.raises(TypeError):
        store.append("t", spark.createDataFrame([("x",)], "id string"))
    assert store.read("t").count() == 3


# ---- checks -------------------------------------------------------------------------------------


@pytest.mark.parametrize("n, ok", [(100, True), (105, True), (106, False), (99, False)])
def test_count_band(spark, n, ok):
    assert checks.count_parity(spark.range(n), spark.range(100)).first()["ok"] == ok


def test_freshness(spark):
    df = frame(spark, FIRST)
    assert checks.freshness(df, "ts", at(2) + timedelta(hours=12)).first()["ok"]
    assert not checks.freshness(df, "ts", at(4)).first()["ok"]
    assert not checks.freshness(df.limit(0), "ts", at(4)).first()["ok"]


def test_validate_replica(spark):
    df = frame(spark, FIRST)
    assert checks.validate_replica(df, df, "id", "ts", at(2)).first()["ok"]
    assert not checks.validate_replica(df, df, "id", "ts", at(9)).first()["ok"]


def test_validate_load(spark):
    errors = spark.range(2)
    assert checks.validate_load(errors, max_error=2).ok
    audit = spark.createDataFrame([("a",), ("b",), ("b",)], "load_id string")
    assert checks.validate_load(errors, max_error=2, audit=audit, load_id="a").ok
    assert [checks.validate_load(audit=audit, load_id=i).ok for i in "bc"] == [False, False]
    structure = spark.createDataFrame([(1, True), (2, False)], "pos int, ok boolean")
    with pytest.raises(checks.CheckFailed, match="structure"):
        checks.validate_load(errors.limit(0), structure).assert_ok()


def test_committed_loads(spark):
    commits = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0)], "query long, status int")
    queries = spark.createDataFrame(
        [(1, 10, "copy s.t", at(2)), (2, 20, "copy s.t", at(2)), (3, 10, "copy s.t", at(2)), (4, 10, "copy sxt", at(2))],
        "query long, xid long, querytxt string, starttime timestamp_ntz",
    )
    utility = spark.createDataFrame([(10, "COMMIT  "), (10, "COMMIT"), (20, "ROLLBACK")], "xid long, text string")
    out = checks.committed_loads(commits, queries, utility, "s.t", at(1))
    assert rows(out) == [(0, False, 1), (1, True, 2)]


# ---- feeds --------------------------------------------------------------------------------------


def test_feed_columns():
    counts = (feeds.TICKET_COLUMNS, feeds.TICKET_NUMBERS, feeds.USER_COLUMNS, feeds.ORGANIZATION_COLUMNS, feeds.EVENT_COLUMNS)
    assert [len(c) for c in counts] == [47, 18, 33, 15, 15]
    assert set(feeds.TICKET_NUMBERS) <= set(feeds.TICKET_COLUMNS)


def test_ticket_numbers(spark):
    body = """{"results":[{"id":1,"updated_at":"2024-01-02","reopens":3.7,"replies":"3.7","req_id":" 12 ",
               "assigned_stations":true,"group_stations":"x","status":"it's \\"open\\""},
               {"id":1,"updated_at":"2024-01-01"},{"updated_at":"2024-01-01"}]}"""
    out = feeds.tickets(spark.createDataFrame([(body,)], "body string"))
    chosen = out.select("id", "reopens", "replies", "req_id", "assigned_stations", "group_stations", "status")
    assert rows(chosen) == [(None,) * 7, ("1", 3, None, 12, 1, None, "its open")]


def test_survey_over_pages(spark):
    bodies = [
        '{"responses":[{"answers":{"a":"1","b":"x"}},{"answers":{}}]}',
        '{"responses":[{"answers":{"b":"y","zzz":"unknown"}}]}',
    ]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    with pytest.raises(Exception, match="unknown questions: zzz"):
        feeds.survey_answers(pages, {"a": "How many?", "b": "Why/not"}).collect()
    out = feeds.survey_answers(pages, {"a": "How many?", "b": "Why/not"}, strict=False)
    assert out.columns == ["how_many", "whynot"]
    assert rows(out) == [(None, "y"), ("1", "x")]


def test_organizations_without_id_stay_apart(spark):
    body = '{"organizations":[{"name":"a"},{"name":"b"},{"id":1,"name":"c","updated_at":"2024-01-02T00:00:00Z"},{"id":1,"name":"old"}]}'
    out = feeds.organizations(spark.createDataFrame([(body,)], "body string"))
    assert sorted((r["id"], r["name"]) for r in out.collect()) == [("", "a"), ("", "b"), ("1", "c")]


def test_fields_are_discovered(spark):
    bodies = [
        '{"organizations":[{"id":1,"a b":"x","n":1,"d":1.5e3,"w":12345678901234567890.5,"none":null,"o":{"k":[1]}},{"n":2.25,"m":1}]}',
        '{"organizations":[{"id":2,"m":"t","d":7,"w":1e300,"q\\"":true},{"id":1,"n":3}]}',
    ]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = paged.discovered_records(pages, "organizations")
    kinds = dict(found.dtypes)
    assert kinds["id"] == "bigint" and kinds["d"] == "double" and kinds["q\""] == "boolean"
    assert kinds["a b"] == kinds["m"] == kinds["none"] == kinds["o"] == kinds["w"] == "string" and kinds["n"].startswith("decimal")
    got = found.select("id", "m", "o", F.col("n").cast("double"), "w").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        map(str, [(1, None, '{"k":[1]}', 1.0, "12345678901234567890.5"), (None, "1", None, 2.25, None), (2, "t", None, None, "1.0E300"), (1, None, None, 3.0, None)])
    )
    assert feeds.organizations_with_all_fields(pages).count() == 3
    nothing = spark.createDataFrame([('{"organizations":[]}',)], "body string")
    assert feeds.organizations_with_all_fields(nothing).count() == 0


def test_sheet_is_refused_without_publishing(spark, store):
    sheet = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b")], "n string, s string")
    feeds.sheet_to_table(store, "sheet", sheet).assert_ok()
    assert rows(store.read("sheet")) == [(1, "a"), (2, "b")]
