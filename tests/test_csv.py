import os

import pytest
from support import rows

from changevault.functions.records import align, job_status, spill_overflow, stringify, valid_record_ids
from changevault.model import ColumnDef
from changevault.sources.extract import read_extract
from changevault.sources.restore_csv import write_restore_csv


def page(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)
    return str(folder)


def written(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.endswith(".csv"):
            with open(os.path.join(path, name), newline="") as f:
                out.append(f.read())
    return out


def test_two_rows_stay_text(spark, tmp_path):
    path = page(tmp_path / "x", "1.csv", "Id,Name,Amount\n001,Acme,100.0\n002,Globex,200.0\n")
    df = read_extract(spark, path)
    assert df.columns == ["Id", "Name", "Amount"]
    assert rows(df) == [("001", "Acme", "100.0"), ("002", "Globex", "200.0")]


@pytest.mark.parametrize("text", ["", "Id,Name\n"])
def test_no_rows(spark, tmp_path, text):
    df = read_extract(spark, page(tmp_path / "x", "1.csv", text), ["Id", "Name"])
    assert df.columns == ["Id", "Name"] and rows(df) == []


def test_quotes_commas_newlines(spark, tmp_path):
    path = page(
        tmp_path / "x", "1.csv",
        'Id,Description\n001,"has, comma"\n002,"has\nnewline"\n003,"has ""quotes"""\n004,"cr\r\nlf"\n005,  blanks \n',
    )
    assert rows(read_extract(spark, path)) == [
        ("001", "has, comma"), ("002", "has\nnewline"), ("003", 'has "quotes"'), ("004", "cr\nlf"), ("005", "  blanks "),
    ]


def test_empty_cells_are_empty_text(spark, tmp_path):
    path = page(tmp_path / "x", "1.csv", 'Id,A,B\n001,,""\n')
    assert rows(read_extract(spark, path, ["Id", "A", "B", "Absent"])) == [("001", "", "", None)]


def test_ragged_row_fails(spark, tmp_path):
    path = page(tmp_path / "x", "1.csv", "Id,Name\n001,a\n002\n")
    with pytest.raises(Exception):
        read_extract(spark, path, ["Id"]).collect()


def test_pages(spark, tmp_path):
    page(tmp_path / "x", "1.csv", "Id,Name\n001,a\n")
    page(tmp_path / "x", "2.csv", "Id,Name\n002,b\n")
    page(tmp_path / "x", "3.csv", "")
    assert rows(read_extract(spark, str(tmp_path / "x"))) == [("001", "a"), ("002", "b")]


def test_mixed_headers(spark, tmp_path):
    page(tmp_path / "x", "1.csv", "Id,Name\n001,a\n")
    page(tmp_path / "x", "2.csv", "Name,Id\nb,002\n")
    page(tmp_path / "x", "3.csv", "Id,Name,Extra\n003,c,x\n")
    path = str(tmp_path / "x")
    with pytest.raises(Exception):
        read_extract(spark, path, ["Id", "Name"]).collect()
    got = read_extract(spark, path, ["Id", "Name", "Extra"], mixed_headers=True)
    assert rows(got) == [("001", "a", None), ("002", "b", None), ("003", "c", "x")]


def test_restore_csv(spark, tmp_path):
    df = spark.createDataFrame([("001", "Acme", "500"), ("002", "Globex", None)], "Id string, Name string, Amount string")
    write_restore_csv(df.coalesce(1), str(tmp_path / "out"))
    assert written(tmp_path / "out") == ["Amount,Id,Name\n500,001,Acme\n,002,Globex\n"]


def test_restore_csv_round_trip_and_pages(spark, tmp_path):
    data = [("1", 'has "quotes"'), ("2", "has, comma"), ("3", "new\nline"), ("4", " blank "), ("5", "back\\slash\\"), ("6", '"')]
    df = spark.createDataFrame(data, "Id string, Note string").coalesce(1)
    write_restore_csv(df, str(tmp_path / "out"), bulk_size=4)
    assert len(written(tmp_path / "out")) == 2
    assert rows(read_extract(spark, str(tmp_path / "out"))) == data


def test_stringify_and_align(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS n, true AS b, timestamp'2024-01-02 03:04:05' AS t, date'2024-01-02' AS d")
    assert rows(stringify(df)) == [("1", "", "true", "2024-01-02T03:04:05.000000Z", "2024-01-02")]
    got = align(df, [ColumnDef("b", "boolean"), ColumnDef("x", "date"), ColumnDef("id", "int")])
    assert got.dtypes == [("b", "boolean"), ("x", "date"), ("id", "int")] and rows(got) == [(True, None, 1)]


def test_spill_overflow(spark):
    df = spark.createDataFrame(
        [("1", "z", 'q"', "a"), ("2", None, None, None), ("3", "", None, None)], "Id string, Zed string, Beta string, Ab string"
    )
    assert rows(spill_overflow(df, ["Id"])) == [
        ("1", '{"Ab":"a","Beta":"q\\"","Zed":"z"}'), ("2", None), ("3", '{"Zed":""}'),
    ]
    assert rows(spill_overflow(df.select("Id"), ["Id", "Name"])) == [("1", None), ("2", None), ("3", None)]


def test_record_ids(spark):
    ids = ["001C000000XyzABC", "7503S000003XXXXX", "not-an-id", "has spaces in it!", "dropit;SELECT 1", "", "abc\n", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [r.is_valid for r in valid_record_ids(df, "id").collect()] == [True, True] + [False] * 6


def test_job_status(spark):
    jobs = spark.createDataFrame(
        [("a", "Failed", 5, 2, "invalid field"), ("b", "JobComplete", 10, 0, ""), ("c", "Failed", 1, 1, None)],
        "id string, state string, processed int, failed int, error_message string",
    )
    assert rows(job_status(jobs)) == [
        ("a", "Failed", 5, ["2 record(s) failed", "invalid field"]),
        ("b", "JobComplete", 10, []),
        ("c", "Failed", 1, ["1 record(s) failed"]),
    ]
