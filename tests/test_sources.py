"""Reading delimited text and writing results."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.profile import profile_file
from ledgerlens.sources import delimited, sinks, tables


def write(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_default_na_tokens_are_exact(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'v,w\nN/A,1\n n/a,2\nnull,3\nNone,4\nunknown,5\n"",6\n')
    got = {r["w"]: r["v"] for r in delimited.read_delimited(spark, path).collect()}
    assert got == {"1": None, "2": " n/a", "3": None, "4": None, "5": "unknown", "6": None}


def test_header_repair(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,A,a,,a.1,\n1,2,3,4,5,6\n")
    assert delimited.read_delimited(spark, path).toDF(*"abcdef").first().asDict() == dict(zip("abcdef", "123456"))
    assert delimited.repair_header(["a", "A", "a", None, "b", None]) == ["a", "A", "a.1", "Unnamed: 3", "b", "Unnamed: 5"]
    assert delimited.repair_header(["a", "a", "a.1", "a"]) == ["a", "a.2", "a.1", "a.3"]
    assert delimited.duplicate_names(["a", "b", "a", "a", None]) == ["a"]


def test_quotes_and_line_breaks_inside_fields(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,text\n1,"say ""hi"", ok"\n2,"two\nlines"\n3, padded \n')
    assert delimited.lines_with_open_quotes(spark, path) == 2
    assert {r["id"]: r["text"] for r in delimited.read_delimited(spark, path, multi_line=True).collect()} == {
        "1": 'say "hi", ok', "2": "two\nlines", "3": " padded "}


def test_surplus_fields_are_an_error_and_short_records_are_filled(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        delimited.read_delimited(spark, path).select("a").collect()
    short = write(tmp_path, "b.csv", "a,b\n1\n2,3\n")
    assert sorted(map(tuple, delimited.read_delimited(spark, short).collect())) == [("1", None), ("2", "3")]


def test_a_stray_quote_does_not_change_how_the_file_is_read(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'k,v\n1,5" pipe\n2,x\n')
    assert delimited.lines_with_open_quotes(spark, path) == 1
    assert delimited.read_delimited(spark, path).count() == 2


def test_names_that_differ_by_case_can_be_profiled(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,A,b,b\n" + "".join(f"{i},x,{i % 3},q\n" for i in range(40)))
    p = profile_file(spark, path, "2026-08-09")
    assert [r["name"] for r in p.columns.orderBy("position").collect()] == ["a", "A", "b", "b.1"]
    assert p.dataset.first()["duplicate_column_names"] == ["b"]


def test_tab_separated_files(spark, tmp_path):
    for name in ("a.tsv", "a.txt"):
        path = write(tmp_path, name, "x\ty\n1,5\t2\n")
        assert tuple(delimited.read_delimited(spark, path).first()) == ("1,5", "2")


def test_input_validation(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        delimited.read_delimited(spark, str(tmp_path / "a.xlsx"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        delimited.read_delimited(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="no rows"):
        delimited.read_delimited(spark, write(tmp_path, "only_header.csv", "a,b\n"))


def test_typed_tables(spark, tmp_path):
    path = write(tmp_path, "sales.csv", "order_number,date,warehouse,client_type,product_line,quantity,unit_price,total,"
                 "payment,payment_fee\nN1,2021-06-01,North,Retail,Engine,2,1.50,3.00,Cash,0.03\n")
    row = tables.load_sales(spark, path).first()
    assert str(row["total"]) == "3.00" and row["date"].isoformat() == "2021-06-01"
    assert spark.sql("SELECT count(*) FROM sales").first()[0] == 1
    students = write(tmp_path, "students.csv", ",".join(tables.STUDENTS.fieldNames()) + "\nInter" + "," * 16 + "\n")
    assert tables.load_students(spark, students).first()["inter_dom"] == "Inter"


def test_a_review_is_published_as_a_whole(spark, tmp_path):
    one, two = spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([(2,)], "n int")
    folder = str(tmp_path / "reviews")

    def held(source):
        return {name: [tuple(r) for r in df.collect()] for name, df in sinks.read_review(spark, folder, source).items()}

    sinks.write_review({"t": one, "u": one}, "a", folder)
    sinks.write_review({"t": two}, "b", folder)
    assert held("a") == {"t": [(1, "a")], "u": [(1, "a")]} and held("b") == {"t": [(2, "b")]} and held("c") == {}
    broken = two.select(F.raise_error(F.lit("lost")).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_review({"t": two, "u": broken}, "a", folder)
    assert held("a") == {"t": [(1, "a")], "u": [(1, "a")]}
    sinks.write_review({"t": two, "u": one}, "a", folder)
    assert held("a") == {"t": [(2, "a")], "u": [(1, "a")]} and held("b") == {"t": [(2, "b")]}


def test_result_sink(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1)], "k string, n int")
    path = sinks.write_result(df, str(tmp_path / "out"))
    assert tuple(spark.read.csv(path, header=True).first()) == ("a,b", "1")
    with pytest.raises(ValueError):
        sinks.write_result(df, str(tmp_path / "out"), "xlsx")
