import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.operators import shape
from lakesync.operators.filters import filter_spec, report_to_query
from lakesync.operators.layout import choose_layout_key, clustered_layout
from lakesync.plans import feeds


def test_conform_example(spark):
    df = spark.createDataFrame(
        [(None, "", 1, 7, 8), (None, "", 2, 5, 6)], "one string, two string, four int, five int, three int"
    )
    target = ["one", "two", "three", "four", "five", "six"]
    out = shape.conform_columns(df, target)
    assert out.columns == target
    assert rows(out) == [(None, "", 6, 2, 5, None), (None, "", 8, 1, 7, None)]
    assert rows(shape.conform_columns(out, target)) == rows(out)


def test_conform_other_names_and_fewer(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(shape.conform_columns(df, ["a", "c"])) == [(1, None)]
    assert rows(shape.conform_columns(df, ["b"])) == [(2,)]


def test_select_fields(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.select_fields(df, None).columns == ["a", "b", "c"]
    assert shape.select_fields(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError):
        shape.select_fields(df, ["a"])
    with pytest.raises(ValueError, match="x"):
        shape.project_fixed(df, ["x"])


def test_filter_spec(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "n int, s string")
    assert df.filter(filter_spec([])).count() == 3
    assert df.filter(filter_spec([{"column": "t.s", "operator": " LIKE", "value": "%y%"}])).count() == 1
    assert df.filter(filter_spec([{"column": "n", "operator": "not in", "value": ["1"]}])).count() == 1
    with pytest.raises(ValueError):
        filter_spec([{"column": "n", "operator": "between", "value": "1"}])
    with pytest.raises(ValueError):
        report_to_query(df, ["a.n", "b.s"])


def test_flatten_paths(spark):
    df = spark.createDataFrame(
        [("1", ("ann", ("a@b",))), ("2", None), ("3", ("bob", None))],
        "Id string, Owner struct<Name:string,Manager:struct<Email:string>>",
    )
    paths = ["Id", "Owner.Name", "Owner.Manager.Email", "Owner.Missing"]
    out = shape.flatten_paths(df, paths)
    assert out.columns == ["Id", "Owner_Name", "Owner_Manager_Email", "Owner_Missing"]
    assert rows(out) == [("1", "ann", "a@b", None), ("2", None, None, None), ("3", "bob", None, None)]
    filled = shape.flatten_paths(df, paths[:3], missing_parent="")
    assert rows(filled) == [("1", "ann", "a@b"), ("2", "", ""), ("3", "bob", "")]


REPORT = """SELECT {details} AS hasDetailRows, {every} AS allData,
    from_json('{facts}', 'map<string,struct<rows:array<struct<dataCells:array<struct<label:string,value:string>>>>,
    aggregates:array<struct<value:string>>>>') AS factMap"""
FACTS = '{"0!T":{"rows":[{"dataCells":[{"label":"a","value":"1"},{"label":"b","value":"2"}]}]},"T!T":{"rows":[],"aggregates":[{"value":"9"}]}}'


def test_report(spark):
    df = spark.sql(REPORT.format(details="true", every="true", facts=FACTS))
    shape.assert_report(df)
    assert rows(shape.flatten_report(df, ["x.y", "z"])) == [("0!T", "a", "b")]
    assert df.select(shape.report_grand_total("factMap")).first()[0] == "9"


@pytest.mark.parametrize("details, every, facts", [("false", "true", FACTS), ("true", "false", FACTS), ("true", "true", "{}")])
def test_report_refused(spark, details, every, facts):
    with pytest.raises(shape.ReportError):
        shape.assert_report(spark.sql(REPORT.format(details=details, every=every, facts=facts)))


BODY = '{{"hasDetailRows":{},"allData":{},"factMap":{}}}'
ROWS = '{"1!T":{"rows":[{"dataCells":[{"label":"a"},{"label":"b"}]},null,{"dataCells":[{"label":"c"}]}]},"T!T":{"rows":[]},"2!T":{}}'


def test_report_pages_are_parsed_once(spark):
    """Rows without cells stay, empty groups and reports give none, and no page is made twice."""
    seen = spark.sparkContext.accumulator(0)

    def told(body):
        seen.add(1)
        return body

    bodies = [BODY.format("true", "true", facts) for facts in (ROWS, "{}", ROWS.replace('"a"', '"d"'))]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    pages = pages.select(F.udf(told, "string")("body").alias("body"))
    found = feeds.report_rows(pages, ["x.y", "z"])
    assert found.columns == ["x_y", "z"]
    assert rows(found) == [(None, None), ("a", "b"), ("c", None), ("d", "b")]
    assert seen.value == 3


@pytest.mark.parametrize("details, every, facts", [("false", "true", ROWS), ("true", "null", ROWS), ("true", "true", '{"T!T":{"rows":[]}}')])
def test_report_rows_refused(spark, details, every, facts):
    good = BODY.format("true", "true", ROWS) if facts == ROWS else BODY.format("true", "true", "null")
    pages = spark.createDataFrame([(good,), (BODY.format(details, every, facts),)], "body string")
    with pytest.raises(shape.ReportError):
        feeds.report_rows(pages, ["x.y", "z"])


def test_child_events(spark):
    children = """[{"status":"open"},{"tags":["a"],"added_tags":["a"],"removed_tags":[]},
                   {"comment_public":true},{"comment_public":false},{"status":"late"}]"""
    c = shape.child_records(F.lit(children))
    row = spark.range(1).select(
        shape.first_child_with(c, "status").alias("status"),
        shape.first_child_with(c, "priority").alias("priority"),
        shape.first_child_with(c, "tags").alias("tags"),
        shape.first_child_with(c, "tags", "removed_tags").alias("removed"),
        shape.concat_children(c, "comment_public").alias("public"),
        shape.concat_children(c, "nothing").alias("none"),
    ).first()
    assert tuple(row) == ("open", None, '["a"]', "[]", "truefalse", "")


def test_presence_differs_from_null(spark):
    c = shape.child_records(F.lit('[{"priority":null,"x":"1"},{"priority":"high","x":"2"}]'))
    assert spark.range(1).select(shape.first_child_with(c, "priority", "x")).first()[0] == "1"


def test_drop_all_null_and_empty(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert shape.drop_all_null_rows(df).count() == 1
    empty = shape.empty_like(df)
    assert empty.count() == 0 and empty.schema == df.schema


def test_layout(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    assert clustered_layout(df, "k", "k,id").count() == 100
    assert choose_layout_key(["a", "b"]) == "a" and choose_layout_key(["a", "b"], ["b"]) == "b"


def test_unwrap_keeps_scalars(spark):
    df = spark.createDataFrame([([1, 2],), (None,)], T.StructType().add("data", T.ArrayType(T.IntegerType())))
    assert rows(shape.unwrap_pages(df, "data")) == [(1,), (2,)]
