import gzip
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import types as T

from lakesync.operators import schema as sc
from lakesync.plans.repair import copy_into, load_with_repair, staged_load
from lakesync.sources import delimited as dl


def ddl(text):
    return T.StructType.fromDDL(text)


def parse(spark, lines, schema, **options):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return dl.parse_lines(df, schema, dl.LoadOptions(**options))


def failures(parsed):
    return rows(dl.load_errors(parsed, "t").select("err_reason", "colname", "raw_field_value", "raw_line"))


def test_every_line_is_good_or_rejected(spark):
    lines = ["1,a", "x,a", "", "2", "3,b,c", '4,"a,b"', "5,", ' 6 ,""', '7,"open', "   "]
    parsed = parse(spark, lines, ddl("id int, s string"))
    assert rows(dl.good_rows(parsed)) == [(1, "a"), (4, "a,b"), (5, ""), (6, "")]
    errors = dl.load_errors(parsed, "t", datetime(2024, 1, 1))
    assert errors.select("raw_line").distinct().count() + 4 == len(lines)
    assert {(e["err_reason"], e["field_count"]) for e in errors.collect()} == {
        ("Invalid digit, Value 'x', Type: int", 2),
        (sc.BLANK_LINE, 1),
        (sc.MISSING_FIELDS, 1),
        (sc.MISSING_FIELDS, -1),
        (sc.EXTRA_COLUMN, 3),
    }


def test_far_too_many_fields(spark):
    parsed = parse(spark, [",".join("123456789")], ddl("a int"))
    assert dl.load_errors(parsed, "t").first()["field_count"] == 9


def test_several_errors_in_a_line(spark):
    parsed = parse(spark, ["x,maybe,never"], ddl("n int, b boolean, d date"))
    assert failures(parsed) == [
        ("Invalid digit, Value 'x', Type: int", "n", "x", "x,maybe,never"),
        (sc.INVALID_DATE, "d", "never", "x,maybe,never"),
        (sc.UNKNOWN_BOOLEAN, "b", "maybe", "x,maybe,never"),
    ]


def test_options_for_blanks(spark):
    schema, lines = ddl("a string, n int"), ["x  , 1", "   ,", ",2"]

    def texts(**options):
        return [r["a"] for r in dl.good_rows(parse(spark, lines, schema, **options)).collect()]

    assert texts() == ["x  ", "   ", ""]
    assert texts(trim_blanks=True) == ["x", "", ""]
    assert texts(blanks_as_null=True) == ["x  ", None, ""]
    assert texts(empty_as_null=True) == ["x  ", "   ", None]
    assert texts(trim_blanks=True, blanks_as_null=True, empty_as_null=True) == ["x", None, None]


def test_widths(spark):
    schema = T.StructType([T.StructField("s", T.VarcharType(3))])
    assert failures(parse(spark, ["abcd"], schema)) == [(sc.TOO_LONG, "s", "abcd", "abcd")]
    assert rows(dl.good_rows(parse(spark, ["abcd"], schema, truncate_columns=True))) == [("abc",)]


def test_invalid_characters(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_bytes(b"1,a\xffb\n2,ok\n")
    schema = ddl("id int, s string")
    strict = dl.load_delimited(spark, str(path), schema)
    assert [e[0] for e in failures(strict)] == [sc.INVALID_CHARACTERS]
    assert rows(dl.good_rows(dl.load_delimited(spark, str(path), schema, dl.LoadOptions(replace_invalid=True)))) == [
        (1, "a?b"),
        (2, "ok"),
    ]


def test_dates(spark):
    schema = ddl("d date, t timestamp_ntz")
    lines = ["2024-01-02,2024-01-02 03:04:05", "01/02/2024,20240102", "soon,later"]
    good = [(datetime(2024, 1, 2).date(), datetime(2024, 1, 2)), (datetime(2024, 1, 2).date(), datetime(2024, 1, 2, 3, 4, 5))]
    assert rows(dl.good_rows(parse(spark, lines, schema))) == good
    assert rows(dl.good_rows(parse(spark, lines, schema, accept_any_date=True))) == [(None, None), *good]


def test_header_gzip_and_file_name(spark, tmp_path):
    for i in range(2):
        with gzip.open(tmp_path / f"part{i}.csv.gz", "wt") as out:
            out.write(f"id,s\n{i},a\nbad,b\n")
    parsed = dl.load_delimited(spark, str(tmp_path), ddl("id int, s string"), dl.LoadOptions(header=True))
    assert rows(dl.good_rows(parsed)) == [(0, "a"), (1, "a")]
    names = {e["filename"].rsplit("/", 1)[1] for e in dl.load_errors(parsed, "t").collect()}
    assert names == {"part0.csv.gz", "part1.csv.gz"}


def test_header_is_the_first_line_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"q"\nid,v\n\n2," b "\n')
    (tmp_path / "b.csv").write_text("ID,V\n3,x\u0001y\n4\n")
    parsed = dl.load_delimited(spark, str(tmp_path), ddl("id string, v string"), dl.LoadOptions(header=True))
    assert rows(dl.good_rows(parsed)) == [("1", "q"), ("2", " b "), ("3", "x\u0001y"), ("id", "v")]
    assert sorted(e[0] for e in failures(parsed)) == sorted([sc.BLANK_LINE, sc.MISSING_FIELDS])


def test_every_field_is_counted(spark):
    lines = [",".join(["x"] * 22), '1,"a,b",2,"c""d",5', '1,2,3,"open', '5" pipe,6" pipe,7']
    found = {e.raw_line: e.field_count for e in dl.load_errors(parse(spark, lines, ddl("a string, b string")), "t").collect()}
    assert (found[lines[0]], found[lines[1]], found[lines[3]]) == (22, 5, 3)


def test_microseconds_come_back(spark, tmp_path):
    data = [(datetime(2024, 1, 2, 3, 4, 5, 678901),), (datetime(1969, 12, 31, 23, 59, 59, 1),)]
    dl.write_delimited(spark.createDataFrame(data, "t timestamp_ntz"), str(tmp_path / "out"))
    parsed = dl.load_delimited(spark, str(tmp_path / "out"), ddl("t timestamp_ntz"), dl.LoadOptions("|"))
    assert sorted(tuple(r) for r in dl.good_rows(parsed).collect()) == sorted(data)


def test_multiline(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('id,s\n1,"two\nlines ""quoted"""\nx,a\n2\n3,b,c\n')
    options = dl.LoadOptions(header=True, multiline=True)
    parsed = dl.load_delimited(spark, str(path), ddl("id int, s string"), options)
    assert rows(dl.good_rows(parsed)) == [(1, 'two\nlines "quoted"')]
    assert sorted(e[0] for e in failures(parsed)) == sorted(
        ["Invalid digit, Value 'x', Type: int", sc.MISSING_FIELDS, sc.EXTRA_COLUMN]
    )


def test_write_and_load_back(spark, tmp_path):
    schema = ddl("id int, s string, d double, t timestamp_ntz, b boolean")
    data = [(1, ' "a|b" ', 1e-7, datetime(2024, 1, 2, 3, 4, 5, 678000), True), (2, "", None, None, None)]
    dl.write_delimited(spark.createDataFrame(data, schema), str(tmp_path / "out"))
    parsed = dl.load_delimited(spark, str(tmp_path / "out"), schema, dl.LoadOptions("|"))
    assert rows(dl.good_rows(parsed)) == data


def test_load_window(spark):
    parsed = parse(spark, ["x", "y"], ddl("n int"))
    errors = dl.load_errors(parsed, "t", datetime(2024, 1, 1, 12))
    assert dl.load_window(errors, datetime(2024, 1, 1, 12)).count() == 2
    assert dl.load_window(errors, datetime(2024, 1, 1, 13)).count() == 0
    assert rows(dl.error_summary(errors)) == [("Invalid digit", "n", 2)]
    tables = spark.createDataFrame([(1, "t"), (2, "u")], "id int, name string")
    from pyspark.sql import functions as F

    log = errors.drop("table").withColumn("tbl", F.lit(1))
    assert dl.errors_for_table(log, tables, "t").count() == 2
    assert dl.errors_for_table(log, tables, "u").count() == 0


def test_max_error(spark, store, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("1\nx\ny\n")
    schema = ddl("n int")
    for limit in (0, 1, 2):
        with pytest.raises(dl.LoadError):
            copy_into(store, "t", str(path), schema, dl.LoadOptions(max_error=limit))
    assert not store.exists("t")
    result = copy_into(store, "t", str(path), schema, dl.LoadOptions(max_error=3))
    assert rows(store.read("t")) == [(1,)] and result.errors.count() == 2
    copy_into(store, "t", str(path), schema, dl.LoadOptions(max_error=3), dedupe=False)
    assert store.read("t").count() == 2


# ---- repair -------------------------------------------------------------------------------------


def test_repair_example(spark, store, tmp_path):
    path = tmp_path / "test.csv"
    path.write_text("1,2\ntwo,2\n3,4\n5,6\nab,test\n")
    schema = ddl("id int, col string")
    store.replace("test", spark.createDataFrame([(1, "2"), (2, "two")], schema))
    first = staged_load(spark, str(path), schema, "test")
    assert [e[1:3] for e in failures_of(first)] == [("id", "ab"), ("id", "two")]
    result = load_with_repair(store, "test", str(path), schema)
    assert result.schema.simpleString() == "struct<id:string,col:string>"
    assert [(c.column, c.old_type, c.new_type) for c in result.changes] == [("id", "int", "string")]
    assert rows(store.read("test")) == [
        ("1", "2"), ("2", "two"), ("3", "4"), ("5", "6"), ("ab", "test"), ("two", "2"),
    ]
    assert rows(store.read_previous("test")) == [(1, "2"), (2, "two")]


def failures_of(result):
    return rows(result.errors.select("err_reason", "colname", "raw_field_value"))


@pytest.mark.parametrize(
    "lines, before, after",
    [
        (["1", "2.5"], "n int", "n double"),
        (["-5"], "n int", "n int"),
        (["99999999999"], "n int", "n bigint"),
        (["1.2.3"], "n int", "n string"),
        (["2.5", "99999999999"], "n int", "n double"),
        (["2.5", "9007199254740993"], "n bigint", "n decimal(38,1)"),
        (["12345678901234567890", "1"], "n bigint", "n decimal(38,0)"),
        (["2.5", "12345678901234567890"], "n int", "n decimal(38,1)"),
        (["1e40", "9007199254740993"], "n bigint", "n string"),
        (["123456789.25"], "n decimal(5,1)", "n decimal(38,2)"),
        (["maybe"], "n boolean", "n string"),
        (["2024-01-01 10:00:00x"], "n date", "n string"),
        (["7,8,9"], "n int", "n int, new_column_one string, new_column_two string"),
        (["x,8", "3"], "n int", None),
        (["1", "", "2"], "n int", None),
    ],
)
def test_repair_cases(spark, store, tmp_path, lines, before, after):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    if after is None:
        with pytest.raises(sc.RepairError):
            load_with_repair(store, "t", str(path), ddl(before))
        assert not store.exists("t")
        return
    result = load_with_repair(store, "t", str(path), ddl(before))
    assert result.schema.simpleString() == ddl(after).simpleString()
    assert store.read("t").count() == len(lines)


def test_repair_of_widths_and_many_columns(spark, store, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("abcd,2,3,4,5,6,7,8,9\n")
    schema = T.StructType([T.StructField("s", T.VarcharType(3))])
    result = load_with_repair(store, "t", str(path), schema)
    assert result.schema.names[1:] == [f"new_column_{w}" for w in ("one", "two", "three", "four", "five", "6", "7", "8")]
    assert result.schema["s"].dataType == T.StringType()


@pytest.mark.parametrize(
    "lines, after, passes",
    [
        (["1,2024-01-01", "3,2024-01-02"], "n int, d date", 1),
        (["1,2024-01-01,", "x,2024-01-02,more"], "n string, d date, new_column_one string", 2),
        (["1,2024-01-01,a,b", "2.5,2024-01-02 10:00:00,,"], "n double, d date, new_column_one string, new_column_two string", 2),
        (["9007199254740993,2024-01-01,", "0.5,soon,e"], "n decimal(38,1), d string, new_column_one string", 2),
        (['"1,2",2024-01-01,a', '7,"2024-01-01, noon",e'], "n string, d string, new_column_one string", 2),
        (["h1,h2", "1,2024-01-01,a", "x,soon,e"], "n string, d string, new_column_one string", 2),
        (["h1,h2,h3", "1,2024-01-01", "2,2024-01-01"], "n int, d date", 1),
        (["1,2024-01-01", "x,2024-01-02,more"], None, None),
    ],
)
@pytest.mark.parametrize("multiline", [False, True])
def test_repair_sees_all_that_fails_at_once(spark, store, tmp_path, lines, after, passes, multiline):
    path, header = tmp_path / "in.csv", lines[0].startswith("h")
    path.write_text("\n".join(lines) + "\n")
    options = dl.LoadOptions(header=header, multiline=multiline)
    if after is None:
        with pytest.raises(sc.RepairError):
            load_with_repair(store, "t", str(path), ddl("n int, d date"), options)
        return
    result = load_with_repair(store, "t", str(path), ddl("n int, d date"), options)
    assert (result.schema.simpleString(), result.passes) == (ddl(after).simpleString(), passes)
    assert result.rows.columns == result.schema.names and result.errors.count() == 0
    assert store.read("t").count() == len(lines) - header


def test_repair_keeps_every_text(spark, store, tmp_path):
    """Whatever the fields of lines with more of them than the table hold: two passes, and each number reads as it was written."""
    import decimal
    import random

    rng = random.Random(11)
    kinds = [
        lambda: str(rng.randint(-99, 99)),
        lambda: str(rng.randint(1 << 40, 1 << 62)),
        lambda: f"{rng.randint(0, 999)}.{rng.randint(1, 99):02d}",
        lambda: f"{rng.randint(1 << 60, 1 << 62)}.5",
        lambda: rng.choice(["x", "3e5", "007", "1.2.3"]),
    ]
    for case in range(4):
        some = [rng.choice(kinds[: rng.randint(2, 5)]) for _ in range(3)]
        lines = [[rng.choice(some)() for _ in range(3)] for _ in range(12)]
        path = tmp_path / f"{case}.csv"
        path.write_text("".join(",".join(line) + "\n" for line in lines))
        result = load_with_repair(store, f"t{case}", str(path), ddl("a int, b bigint"))
        assert result.passes <= 2
        for i, kind in enumerate([f.dataType for f in result.schema.fields][:2]):
            texts = sorted(line[i] for line in lines)
            got = sorted(str(r[i]) for r in result.rows.collect())
            if not isinstance(kind, T.StringType):
                texts, got = (sorted(map(decimal.Decimal, x)) for x in (texts, got))
            assert got == texts, (case, kind)


def test_repair_can_be_limited(spark, store, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("x\n")
    with pytest.raises(sc.RepairError):
        load_with_repair(store, "t", str(path), ddl("n int"), change_types=False)
    path.write_text("1,2\n")
    with pytest.raises(sc.RepairError):
        load_with_repair(store, "t", str(path), ddl("n int"), add_columns=False)


def test_line_numbers_over_many_splits(spark, tmp_path):
    for name, n, start in (("a", 400, 0), ("b", 3, 1000), ("empty", 0, 0)):
        lines = ["head,er"] * (n > 0) + [("" if i % 7 == 3 else f"x{i},s" if i % 5 == 2 else f"{start + i},s") for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("".join(f"{x}\n" for x in lines))
    usual = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        done = staged_load(spark, str(tmp_path), ddl("n int, s string"), "t", dl.LoadOptions(header=True))
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    found = {(e.filename.rsplit("/", 1)[1], e.line_number, e.raw_line) for e in done.errors.collect()}
    wanted = {("a.csv", i + 2, "" if i % 7 == 3 else f"x{i},s") for i in range(400) if i % 7 == 3 or i % 5 == 2}
    assert found == wanted | {("b.csv", 4, "x2,s")}
    assert done.rows.count() == sum(i % 7 != 3 and i % 5 != 2 for i in range(400)) + 2
    plan = done.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_many_small_splits_share_tasks(spark, tmp_path):
    """Some 300 splits of one file are parsed by no more tasks than the cores are worth, and lines keep their numbers."""
    (tmp_path / "a.csv").write_text("n,s\n" + "".join(f"{'x' if i % 50 == 0 else i},{'y' * 20}\n" for i in range(6000)))
    usual = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 250
        done = staged_load(spark, str(tmp_path), ddl("n int, s string"), "t", dl.LoadOptions(header=True))
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert len(done.rows.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism
    assert done.rows.count() == 6000 - 120
    assert sorted(r[0] for r in done.errors.select("line_number").collect()) == [i + 2 for i in range(0, 6000, 50)]


def test_line_numbers_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\nx\n\n4\ny")
    done = staged_load(spark, str(tmp_path), ddl("n int"), "t")
    assert rows(done.errors.select("line_number", "raw_line")) == [(2, "x"), (3, ""), (5, "y")]
    spans = staged_load(spark, str(tmp_path), ddl("n int"), "t", dl.LoadOptions(multiline=True))
    assert {r[0] for r in spans.errors.select("line_number").collect()} == {None}


def test_numbers_that_are_none_come_back(spark, tmp_path):
    values = [float("nan"), float("inf"), float("-inf"), 1.5]
    df = spark.createDataFrame([(x, x) for x in values], "d double, f float")
    dl.write_delimited(df, str(tmp_path / "out"))
    parsed = dl.load_delimited(spark, str(tmp_path / "out"), df.schema, dl.LoadOptions("|"))
    assert str(rows(dl.good_rows(parsed))) == str(rows(df)) and dl.load_errors(parsed, "t").count() == 0
    other = dl.parse_lines(spark.createDataFrame([("nan",), ("inf",), ("1d",)], "line string"), ddl("d double"))
    assert dl.good_rows(other).count() == 0


def test_rejected_lines_hold_no_end_mark(spark):
    parsed = parse(spark, ["a", "a,b,c", "a,b"], ddl("k string, v string"))
    assert rows(parsed.select("k", "v")) == [(None, None), (None, None), ("a", "b")]
