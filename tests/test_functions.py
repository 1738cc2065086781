import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions import casting, names, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [("12", 12), (" 12 ", 12), ("", None), ("3.7", None), ("1e3", None), ("abc", None), (None, None), ("-4", -4)],
)
def test_int_or_null(spark, value, expected):
    assert one(spark, text.int_or_null(F.lit(value).cast("string"))) == expected


def test_int_or_null_of_numbers(spark):
    assert one(spark, text.int_or_null(F.lit(3.7), T.DoubleType())) == 3
    assert one(spark, text.int_or_null(F.lit(True), T.BooleanType())) == 1
    assert one(spark, text.int_or_null(F.lit(1e300), T.DoubleType())) is None


@pytest.mark.parametrize(
    "value, kind",
    [
        ("12", "INTEGER"), ("-5", "INTEGER"), ("2.5", "FLOAT"), (".5", "FLOAT"), ("1e3", "FLOAT"), ("1.2.3", "VARCHAR"),
        ("99999999999999999999", "FLOAT"), ("2024-01-02 03:04:05", "TIMESTAMP"), ("", "VARCHAR"), ("1d", "VARCHAR"),
    ],
)
def test_classify_value(spark, value, kind):
    assert one(spark, text.classify_value(F.lit(value))) == kind


@pytest.mark.parametrize(
    "value, kind, ok",
    [
        ("1.5", "double", True), ("1d", "double", False), ("NaN", "double", False), ("0x1p3", "double", False),
        (" 7\t", "double", True), ("t", "boolean", True), ("maybe", "boolean", False), ("2024", "date", False),
        ("2024-02-30", "date", False), ("20240229", "date", True), ("03/14/2024", "date", True),
        ("14-Mar-2024", "date", True), ("2024/03/14 10:11:12", "timestamp_ntz", True), ("Mar 14, 2024", "date", True),
        ("13/14/2024", "date", False), ("99999999999", "int", False), ("1.239", "decimal(5,2)", True),
        ("2024-01-02T03:04:05", "timestamp_ntz", True),
    ],
)
def test_cast_text(spark, value, kind, ok):
    target = T.StructType.fromDDL(f"x {kind}")["x"].dataType
    assert (one(spark, casting.cast_text(F.lit(value), target)) is not None) == ok


def test_iso_and_quotes(spark):
    assert one(spark, text.iso_to_space(F.lit("2024-01-02T03:04:05Z"))) == "2024-01-02 03:04:05"
    assert one(spark, text.strip_quotes(F.lit("it's \"so\""))) == "its so"
    assert one(spark, text.strip_commas_slashes(F.lit("a,b//c/,/d"))) == "abc" + "d"
    assert one(spark, text.ascii_only(F.lit("ab–cé"))) == "abc"


def test_epoch_before_1970(spark):
    assert one(spark, text.to_epoch(F.expr("TIMESTAMP_NTZ'1969-12-31 23:59:58.5'"))) == -1


def test_xml(spark):
    xml = F.lit("<a><result>1</result><result>2</result><open>x")
    assert one(spark, text.xml_tag(xml, "result")) == "1"
    assert one(spark, text.xml_tag(xml, "open")) == "x"
    assert one(spark, text.xml_tag(xml, "none")) is None
    assert one(spark, text.xml_tags(xml, "result")) == ["1", "2"]


@pytest.mark.parametrize(
    "given, rule, expected",
    [
        (" Store Name/ID ", names.sheet_name, "store_name_id"),
        ("Store Name", names.column_name, "store_name"),
        ("What's your name? (é)", names.question_name, "whats_your_name_"),
        ("Account.Owner.Name", names.undotted_name, "Account_Owner_Name"),
    ],
)
def test_names(spark, given, rule, expected):
    assert rule(given) == expected
    if rule is names.question_name:
        assert one(spark, names.question_text(F.lit(given))) == expected


def test_name_collision(spark):
    with pytest.raises(ValueError, match="a_b"):
        names.normalize_names(spark.range(1).toDF("x").selectExpr("x AS `A b`", "x AS `a/b`"))


def test_type_base_name(spark):
    df = spark.createDataFrame([("VARCHAR(40)",), ("numeric (10, 2)",), ("int",)], "t string")
    assert rows(df.select(text.type_base_name(F.col("t")))) == [("int",), ("numeric",), ("varchar",)]
