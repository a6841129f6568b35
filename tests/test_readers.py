"""A1-A5: untyped extract scan, header strip, empty-row drop, required columns, presence-based pick."""

import os

import pytest
from pyspark.sql import functions as F

from vigil.operators.loaders import load
from vigil.sources.readers import MissingColumnsError, pick_column, read_extract, require_columns


def test_read_extract_and_load(spark, scratch):
    path = os.path.join(scratch, "inspections.csv")
    with open(path, "w") as fh:
        fh.write(" Inspection ID ,FEI Number,Legal Name,City,State,Zip,Country,Inspection End Date,Fiscal Year,"
                 "Posted Citations,Classification,Project Area,Product Type,Additional Details,FMD 145 Date\n")
        fh.write("12,3012457996.0,Acme, Springfield ,-,02139.0,United States,2024-01-05,2024,Yes,"
                 "Official Action Indicated (OAI),Drugs,Drugs,x,\n")
        fh.write(",,,,,,,,,,,,,,\n")
        fh.write("13,007,Beta,,CA,,United States,bad,20x4,maybe,Pending,,Devices,,N/A\n")
    raw = read_extract(spark, path)
    assert "Inspection ID" in raw.columns and raw.count() == 2  # header stripped, empty row dropped
    rows = {r["inspection_id"]: r for r in load(raw, "inspections").collect()}
    a = rows[12]
    assert (a["fei_number"], a["state"], a["zip_code"], a["city"]) == ("3012457996", None, "02139", "Springfield")
    assert a["classification_code"] == "OAI" and a["posted_citations"] is True and a["errors"] == []
    b = rows[13]
    assert b["fei_number"] == "007" and b["classification_code"] is None
    assert b["errors"] == [
        "Inspection End Date is not a date: 'bad'",
        "Fiscal Year is not a whole number: '20x4'",
        "Posted Citations is neither yes nor no: 'maybe'",
        "Project Area has no value",
    ]


def test_require_columns_reports_all_missing(spark):
    df = spark.createDataFrame([("1",)], "`Inspection ID` string")
    with pytest.raises(MissingColumnsError) as e:
        require_columns(df, {"inspection_id": ("Inspection ID",), "fei": ("FEI Number",), "zip": ("Zip Code", "Zip")}, "f.csv")
    assert "fei" in str(e.value) and "zip" in str(e.value) and "inspection_id" not in str(e.value)


def test_pick_column_by_presence(spark):
    df = spark.createDataFrame([(None, "b")], "`Zip Code` string, Zip string")
    assert df.select(pick_column(df, "Zip Code", "Zip")).first()[0] is None  # present wins even when NULL
    assert df.select(pick_column(df, "Nope", "Zip")).first()[0] == "b"
    assert df.select(pick_column(df, "Nope")).first()[0] is None


def _write(scratch, name, text):
    path = os.path.join(scratch, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_a_large_csv_is_read_in_splits(spark, scratch):
    rows = 60_000
    path = _write(scratch, "big.csv", "id, name ,note\n" + "".join(f'{i},"n, ""{i}""",{"x" * 40}\n' for i in range(rows)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        df = read_extract(spark, path)
        assert df.rdd.getNumPartitions() >= 5 and df.count() == rows and df.select("name").distinct().count() == rows
        assert read_extract(spark, path, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert df.where("id = 7").first()["name"] == 'n, "7"'


@pytest.mark.parametrize("cell", ['1,"two\nlines",x\n', '1,a,"two\nlines"\n', '"two\nlines",a,b\n'])
def test_a_line_break_within_quotes_is_an_error_or_a_cell(spark, scratch, cell):
    path = _write(scratch, "broken.csv", "id,name,note\n0,a,b\n" + cell + "2,c,d\n")
    with pytest.raises(Exception, match="multi_line=True"):
        read_extract(spark, path).collect()
    with pytest.raises(Exception, match="multi_line=True"):
        read_extract(spark, path).select("id").collect()
    rows = read_extract(spark, path, multi_line=True).collect()
    assert len(rows) == 3 and any("two\nlines" in tuple(r) for r in rows)


def test_short_rows_end_in_nulls(spark, scratch):
    path = _write(scratch, "short.csv", "id,name,note\n0,a\n1,b,c\n")
    assert [tuple(r) for r in read_extract(spark, path).collect()] == [("0", "a", None), ("1", "b", "c")]
    named = read_extract(spark, path, header_names=["k", "n", "o"])
    assert named.columns == ["k", "n", "o"] and named.count() == 2
