import pytest
from conftest import rows
from pyspark.sql import types as T

from lakesync.operators import schema as sc


def kind(ddl):
    return T.StructType.fromDDL(f"x {ddl}")["x"].dataType


@pytest.mark.parametrize(
    "ddl, expected",
    [
        ("timestamp", "TIMESTAMP"), ("timestamp_ntz", "TIMESTAMP"), ("date", "DATE"), ("interval day to second", "INTERVAL"),
        ("smallint", "INTEGER"), ("bigint", "BIGINT"), ("decimal(10,2)", "NUMERIC(10, 2)"), ("float", "FLOAT"),
        ("boolean", "BOOLEAN"), ("string", "VARCHAR(MAX)"), ("array<int>", "VARCHAR(MAX)"), ("binary", "VARCHAR(MAX)"),
    ],
)
def test_warehouse_type(spark, ddl, expected):
    assert sc.warehouse_type(kind(ddl)) == expected


def test_lengths(spark):
    assert sc.warehouse_type(T.StringType(), 12) == "VARCHAR(12)"
    assert sc.warehouse_type(T.StringType(), 65536) == "VARCHAR(MAX)"
    df = spark.createDataFrame([("abé", 1), (None, 2)], "s string, n int")
    assert rows(sc.max_length_profile(df)) == [("n", None), ("s", 3)]


@pytest.mark.parametrize(
    "ddl, target, ok",
    [
        ("int", "smallint", True), ("bigint", "integer", False), ("bigint", "int8", True), ("double", "numeric(10,2)", True),
        ("date", "timestamp", False), ("date", "varchar(9)", True), ("string", "text", True), ("string", "int", False),
        ("timestamp", "timestamptz", True),
    ],
)
def test_accepts(spark, ddl, target, ok):
    assert sc.accepts(kind(ddl), target) == ok


def test_translate(spark):
    catalog = spark.createDataFrame(
        [
            ("a", "varchar", 255, None, None), ("b", "varchar", 40, None, None), ("c", "numeric", None, None, None),
            ("d", "numeric", None, 10, 2), ("e", "int4", None, 32, 0), ("f", "timestamp", None, None, None),
            ("g", "timestamptz", None, None, None), ("h", "jsonb", None, None, None), ("i", "varchar", None, None, None),
        ],
        "column_name string, udt_name string, character_maximum_length int, numeric_precision int, numeric_scale int",
    )
    assert rows(sc.translate_schema(catalog).select("column_name", "target_type")) == [
        ("a", "text"), ("b", "varchar(40)"), ("c", "numeric"), ("d", "numeric(10, 2)"), ("e", "int4"),
        ("f", "timestamp"), ("g", "varchar(65535)"), ("h", "varchar(65535)"), ("i", "text"),
    ]


def test_ddl(spark):
    schema = T.StructType.fromDDL("`Store Id` bigint, name string")
    text = sc.generate_ddl(schema, "s.t", {"name": 7}, "store_id", "Store Id", "Store Id")
    assert text == (
        "CREATE TABLE IF NOT EXISTS s.t (store_id BIGINT DISTKEY SORTKEY, name VARCHAR(7), PRIMARY KEY (store_id))"
    )
    assert "name VARCHAR)" in sc.generate_ddl(schema, "t", all_varchar=True)


def test_check_structure(spark):
    df = spark.createDataFrame([("1", "x", "z"), ("b", " ", "z"), (None, "2", "z")], "a string, b string, c string")
    report = sc.check_structure(df, T.StructType.fromDDL("n int, m int"))
    assert rows(report.select("pos", "bad_values", "ok")) == [(1, 1, False), (2, 1, False), (3, 0, False)]
    fine = sc.check_structure(df, T.StructType.fromDDL("a string, b string, c string"))
    assert fine.filter("NOT ok").count() == 0


def test_infer_schema(spark):
    df = spark.createDataFrame(
        [("1", "1", "t", "2024-01-01", "", "1", "1"), ("2", "2.5", "false", None, "  ", "x", "t")],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    expected = "struct<a:bigint,b:double,c:boolean,d:timestamp_ntz,e:string,f:string,g:string>"
    schema = sc.infer_schema(df)
    assert schema.simpleString() == expected
    assert sc.cast_columns(df, schema).schema.simpleString() == expected


@pytest.mark.parametrize(
    "values, expected",
    [
        (["123", "00123"], "string"), (["+1"], "string"), (["0", "-7", " 5 "], "bigint"), (["007.5"], "string"),
        (["12345678901234567890", "1"], "decimal(38,0)"), (["1" * 39], "string"), (["0.5", "9007199254740993"], "decimal(38,1)"),
        (["1e5", "2"], "double"), (["0.1234567890123456789"], "decimal(38,19)"), (["1", "yes"], "string"),
        (["9223372036854775807", "-9223372036854775808"], "bigint"), (["9223372036854775808"], "decimal(38,0)"),
        (["\t5", "-0.5"], "double"), (["\t9007199254740993.5 "], "decimal(38,1)"), (["-0." + "1" * 38], "decimal(38,38)"),
        (["1." + "1" * 38], "string"), (["NaN", "1.5"], "string"), (["1."], "double"), ([".5", "12"], "double"),
        (["2024-01-01", "20240101"], "string"), (["yes", "no", None], "boolean"), ([None, " "], "string"), (["1" * 30 + "." + "1" * 9], "string"),
    ],
)
def test_inference_keeps_every_digit(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert sc.infer_schema(df)["v"].dataType.simpleString() == expected


def test_store_as_text(spark):
    df = spark.sql("SELECT array(1, 2) AS a, named_struct('x', 1) AS s, CAST('hi' AS BINARY) AS b, 5 AS n")
    assert rows(sc.store_as_text(df)) == [("[1,2]", '{"x":1}', "aGk=", 5)]


def test_added_names():
    assert [sc.added_name(i) for i in (1, 5, 6)] == ["new_column_one", "new_column_five", "new_column_6"]
