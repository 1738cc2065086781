from datetime import datetime, timedelta

import fake_api
import pytest
from pyspark.sql import functions as F
from conftest import rows

from lakesync.sources import jdbc, paged, sheets
from lakesync.spec import HighWaterMark


@pytest.mark.parametrize(
    "fetch, mode, key, options",
    [
        ("offsets", "offset", "responses", {"total": 25, "page_size": 10}),
        ("numbered", "count", "segments", {"pages": 3}),
        ("numbered", "number", "segments", {"page_size": 10, "data_key": "segments"}),
        ("linked", "link", "data", {}),
        ("cursor", "cursor", "results", {"start": 0}),
    ],
)
def test_pages(spark, fetch, mode, key, options):
    pages = paged.paged_source(spark, f"fake_api:{fetch}", mode, resource="r", **options)
    assert pages.count() == 3
    assert rows(paged.page_records(pages, key, "struct<n:int>")) == sorted(((i,) for i in range(25)), key=str)


def test_offset_pages_are_read_in_parallel(spark):
    pages = paged.paged_source(spark, "fake_api:offsets", total=25, page_size=10)
    assert pages.rdd.getNumPartitions() == 3


def test_cursor_keeps_the_last_page_and_starts_anywhere(spark):
    pages = paged.cursor_source(spark, "fake_api:cursor", 5)
    assert paged.page_records(pages, "results", "struct<n:int>").count() == 20


def test_cursor_stream(spark, tmp_path):
    stream = paged.cursor_stream(spark, "fake_api:cursor", 0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = stream.writeStream.format("json").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query.start(out).awaitTermination()

    run()
    run()
    pages = spark.read.schema(paged.PAGE_SCHEMA).json(out)
    assert paged.page_records(pages, "results", "struct<n:int>").count() == 25


def test_unknown_mode(spark):
    with pytest.raises(Exception, match="unknown paging mode"):
        paged.paged_source(spark, "fake_api:offsets", "sideways").count()


def test_id_fanout(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "stage int")
    out = paged.id_fanout(ids, "stage", "fake_api:by_id", "slots", tasks=2)
    assert rows(paged.page_records(out, "slots", "struct<at:string>")) == [("slots-1",), ("slots-2",)]


def test_jdbc_options():
    source = jdbc.JdbcSource("jdbc:x:y", {"user": "u"})
    slices = jdbc.Slices("id", "0", "1000", 8)
    assert jdbc.table_options(source, "t", slices) == {
        "url": "jdbc:x:y", "dbtable": "t", "user": "u", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "1000", "numPartitions": "8",
    }
    assert jdbc.query_options(source, "SELECT 1") == {"url": "jdbc:x:y", "query": "SELECT 1", "user": "u"}


def test_jdbc_filter_is_the_databases():
    at = datetime(2024, 1, 2, 3, 4, 5, 600000)
    mark = HighWaterMark("updated_at")
    expected = "(SELECT * FROM t WHERE updated_at >= TIMESTAMP '2024-01-02 03:04:05') sub"
    assert jdbc.since_subquery("t", mark, at) == expected
    strict = HighWaterMark("updated_at", timedelta(hours=1), inclusive=False)
    assert " > TIMESTAMP" in jdbc.since_subquery("t", strict, at)
    assert jdbc.since_subquery("t", mark, None) == "t"


def test_sheet_rows(spark):
    data = [[" Store Name/ID ", "City"], ["1", "a"], [" Store Name/ID ", "City"], ["2", ""]]
    df = sheets.sheet_rows(spark, data)
    assert df.columns == ["store_name_id", "city"] and rows(df) == [("1", "a"), ("2", "")]


def test_header_promote(spark):
    df = spark.createDataFrame([(0, "A b", "C"), (1, "1", None), (2, "A b", "C")], "n int, x string, y string")
    out = sheets.header_promote(df, "n")
    assert out.columns == ["a_b", "c"] and rows(out) == [("1", None)]
    with pytest.raises(ValueError):
        sheets.header_promote(df.filter("n < 0"), "n")


def test_read_sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('Store Name,Note\n1,"two\nlines"\nStore Name,Note\n02,\n')
    out = sheets.read_sheet(spark, str(path))
    assert out.columns == ["store_name", "note"] and rows(out) == [("02", ""), ("1", "two\nlines")]


def test_required_paging_options(spark):
    for mode, given in (("offset", {}), ("count", {}), ("number", {"data_key": "segments"}), ("number", {"page_size": 10})):
        with pytest.raises(Exception, match="needs"):
            paged.paged_source(spark, "fake_api:offsets", mode, **given).count()
    assert paged.paged_source(spark, "fake_api:offsets", "count", pages=0).count() == 0


@pytest.mark.parametrize("body", ['{"data":[{"n":1},{"n"', '{"error":"too many requests"}', "", None])
def test_bad_pages_are_not_passed_over(spark, body):
    pages = spark.createDataFrame([("1", '{"data":[{"n":1}]}'), ("2", body), ("3", '{"data":[]}')], "position string, body string")
    with pytest.raises(Exception, match="position 2"):
        paged.page_records(pages, "data", "struct<n:int>").collect()
    assert paged.page_records(pages, "data", "struct<n:int>", strict=False).count() == 1
    assert [r.position for r in paged.bad_pages(pages, "data").collect()] == ["2"]


def records(pages):
    return {(r["id"], r["at"]) for r in paged.page_records(pages, "results", "struct<id:int,at:int>").collect()}


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_ranges_give_the_records_of_the_chain(spark, ranges):
    chain = paged.cursor_source(spark, "fake_api:bursts", 0, page_size=10, data_key="results")
    pages = paged.cursor_ranges(spark, "fake_api:bursts", 0, 95_000, "results", "at", ranges, page_size=10)
    assert records(pages) == records(chain) == {(i, t) for i, t in enumerate(fake_api.BURSTS)}
    assert pages.rdd.getNumPartitions() == ranges
    # No record comes from two ranges: only pages of one range share what stands at their ends.
    by_range = pages.withColumn("part", F.spark_partition_id()).select("part", F.from_json("body", "results array<struct<id:int>>").alias("r"))
    parts = by_range.select("part", F.explode("r.results.id").alias("id")).distinct().groupBy("id").count()
    assert parts.filter("count > 1").count() == 0


def test_ranges_are_finer_where_records_are_dense(spark):
    read = paged.PageReader({"fetch": "fake_api:bursts", "mode": "ranges", "until": "95000", "data_key": "results", "time_key": "at", "page_size": "10", "ranges": "24"})
    begins = [a for a, _ in read._ranges()]
    assert sum(900 <= a <= 1100 for a in begins) >= 2 and read._ranges()[-1][1] is None
    late = paged.cursor_ranges(spark, "fake_api:bursts", 94_000, 10, "results", "at", 4, page_size=10)
    assert len(records(late)) == 10
    with pytest.raises(ValueError, match="time_key"):
        paged.PageReader({"fetch": "x:y", "mode": "ranges", "until": "1", "data_key": "d"})


def test_chains_that_would_end_in_silence(spark):
    with pytest.raises(Exception, match="next_key"):
        paged.paged_source(spark, "fake_api:without_link", "link").collect()
    for options in ({}, {"data_key": "results", "page_size": 10}):
        with pytest.raises(Exception, match="cursor"):
            paged.cursor_source(spark, "fake_api:stuck", 5, **options).collect()
    assert paged.cursor_source(spark, "fake_api:stuck", 5, data_key="results", page_size=11).count() == 1


def test_times_of_records():
    assert paged._seconds("2024-01-01T00:00:00Z") == paged._seconds("2024-01-01 00:00:00") == paged._seconds("1704067200") == 1704067200
    with pytest.raises(ValueError):
        paged._seconds(None)
