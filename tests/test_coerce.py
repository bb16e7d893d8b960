from datetime import date, datetime

import pytest
from support import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from changevault.functions.coerce import coerce, coerced, coercion_rejects, is_rejected, required_violations
from changevault.functions.records import stringify
from changevault.model import ColumnDef

CASES = {
    "string": ([("x", "x"), ("", ""), (" 5 ", " 5 ")], []),
    "long": (
        [("5", 5), ("+5", 5), ("-5", -5), ("9223372036854775807", 2**63 - 1)],
        ["1.0", " 5 ", "9223372036854775808", "abc", "5\n", "0x1", "1_000", "٣"],
    ),
    "int": ([("2147483647", 2**31 - 1), ("-2147483648", -(2**31))], ["2147483648", "1.5"]),
    "double": (
        [("1", 1.0), ("1.5e3", 1500.0), (".5", 0.5), ("5.", 5.0), ("inf", float("inf")),
         ("-Infinity", float("-inf")), ("+INF", float("inf")), ("1e-999", 0.0)],
        ["1.0d", "1e999", "x", " 1", "1\n", "+nan", "-NaN", "."],
    ),
    "float": ([("1.5", 1.5), ("-2", -2.0)], ["1.0f", "x"]),
    "boolean": (
        [(t, True) for t in "1 t T TRUE true True".split()]
        + [(t, False) for t in "0 f F FALSE false False".split()],
        ["yes", "tRue", "Y", "true\n", "2"],
    ),
    "date": ([("2024-02-29", date(2024, 2, 29))], ["2024", "2024-1-2", "2023-02-29", "2024-01-01\n", "2024-13-01"]),
    "timestamp": (
        [("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
         ("2024-01-01T00:00:00.123456+01:00", datetime(2023, 12, 31, 23, 0, 0, 123456)),
         ("2024-01-01T00:00:00.123456789Z", datetime(2024, 1, 1, 0, 0, 0, 123456)),
         ("2024-01-01T00:00:00.250+0000", datetime(2024, 1, 1, 0, 0, 0, 250000)),
         ("2024-06-01T12:00:00-05:30", datetime(2024, 6, 1, 17, 30))],
        ["2024-01-01", "12:00", "2024-01-01T00:00:00+0000", "2024-01-01T00:00:00.000+0100",
         "2024-01-01 00:00:00Z", "2024-02-30T00:00:00Z", "2024-01-01T25:00:00Z", "2024-01-01T00:00:00"],
    ),
    "binary": ([("aGk=", bytearray(b"aGk=")), ("ü", bytearray("ü".encode()))], []),
}


@pytest.mark.parametrize("type_name", CASES)
def test_accepted_and_rejected(spark, type_name):
    good, bad = CASES[type_name]
    texts = [t for t, _ in good] + bad + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    value = coerced("v", type_name)
    if type_name == "timestamp":
        value = value.cast("timestamp_ntz")
    got = {r.i: r for r in df.select("i", value.alias("x"), is_rejected("v", type_name).alias("bad")).collect()}
    for i, (text, want) in enumerate(good):
        assert got[i].x == want and not got[i].bad, text
    for i in range(len(good), len(good) + len(bad)):
        assert got[i].x is None and got[i].bad, texts[i]
    assert got[len(texts) - 1].x is None and not got[len(texts) - 1].bad


def test_nan(spark):
    got = spark.sql("SELECT 'NaN' AS v").select(coerced("v", "double").alias("x"), is_rejected("v", "double")).first()
    assert got.x != got.x and not got[1]


@pytest.mark.parametrize("type_name", [t for t in CASES if t != "string"])
def test_empty_text_is_null(spark, type_name):
    got = spark.sql("SELECT '' AS v").select(
        coerced("v", type_name).alias("x"), is_rejected("v", type_name).alias("bad")
    ).first()
    assert got.x is None and not got.bad


def test_fail_names_column_and_value(spark):
    df = spark.createDataFrame([("7",), ("seven",)], "n string")
    with pytest.raises(Exception, match="column n: cannot read 'seven' as long"):
        coerce(df, [ColumnDef("n", "long")]).collect()
    assert rows(coerce(df, [ColumnDef("n", "long")], on_error="null")) == [(7,), (None,)]
    with pytest.raises(ValueError):
        coerce(df, [], on_error="skip")


def test_rejects_and_required(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "x"), ("a", ""), (None, "2024-01-01")], "n string, d string")
    columns = [ColumnDef("n", "long", True), ColumnDef("d", "date", True)]
    assert rows(coercion_rejects(df, columns)) == [("d", "x", 2), ("n", "a", 2)]
    typed = coerce(df, columns, on_error="null")
    assert rows(required_violations(typed, columns)) == [("d", 3), ("n", 3)]
    assert rows(required_violations(typed, [ColumnDef("n", "long")])) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(-(2**63), 2**63 - 1), st.floats(allow_nan=False), st.booleans(),
    st.dates(date(1, 1, 1), date(9999, 12, 31)),
    st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)), st.text(max_size=8).filter(lambda s: "\x00" not in s),
), min_size=1, max_size=30))
def test_text_form_reads_back(spark, values):
    """Typed value -> text -> typed value is the identity."""
    df = spark.createDataFrame(
        values, "l long, f double, b boolean, d date, t timestamp_ntz, s string"
    ).withColumn("t", F.col("t").cast("timestamp"))
    types = ["long", "double", "boolean", "date", "timestamp", "string"]
    back = coerce(stringify(df), [ColumnDef(n, t) for n, t in zip(df.columns, types)])
    assert rows(back) == rows(df)
