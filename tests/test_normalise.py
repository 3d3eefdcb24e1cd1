"""Value rules on literal edge cases; expected values are written by hand from the rules."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import normalise as N


def one(spark, value, expr, dtype="string"):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", T._parse_datatype_string(dtype))]))
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def read_load(c):
    return N.load_value(N.read_value(c, T.StringType()))


@pytest.mark.parametrize("value,expected", [
    ("AB-12/3_4  ", "AB-12/3_4"),
    ("--- ", "--- "),
    ("\tX1 ", "X1"),
    ("X1\t", "X1\t"),
    ("a b  ", "a b  "),
    ("  ", "  "),
    ("Ünïcode9 ", "Ünïcode9"),
])
def test_pad_trim(spark, value, expected):
    assert one(spark, value, N.pad_trim) == expected


@pytest.mark.parametrize("value,expected", [
    (None, None),
    ("", ""),
    ("   ", "   "),
    ("NULL", None),
    ("<Null>", None),
    ("none", "none"),
    (" null", " null"),
    (" null ", None),
    ("TRUE", "1"),
    ("false", "0"),
    ("true ", "1"),
    (" true", " true"),
    ("yes", "yes"),
    ("2024-01-01 10:11:12.1234567 +00:00", "2024-01-01 10:11:12.123"),
    ("2024-01-01 10:11:12.123456\nnext line", "2024-01-01 10:11:12.123"),
    ("2024-01-01 10:11:12.12345", "2024-01-01 10:11:12.12345"),
    ("é", "é"),
])
def test_read_then_load(spark, value, expected):
    assert one(spark, value, read_load) == expected


def test_truncate_counts_code_points(spark):
    emoji = "\U0001F600" * 2001
    assert one(spark, emoji, N.load_value) == "\U0001F600" * 2000
    spaces = " " * 2001
    assert one(spark, spaces, N.load_value) == spaces
    text = "line1\r\nline2\n" + "x" * 3000
    out = one(spark, text, N.load_value)
    assert len(out) == 2000 and out.startswith("line1\r\nline2\n")


@pytest.mark.parametrize("value,expected", [
    ("", None), ("  ", None), ("NULL", None), ("yes", "1"), ("N", "0"), ("t", "1"), ("none", "none"),
    ("1", "1"), (" yes", " yes"), ("2024-01-01 10:11:12.123456", "2024-01-01 10:11:12.123"),
])
def test_check_rules(spark, value, expected):
    assert one(spark, value, N.check_value) == expected


def test_datetime_and_binary(spark):
    assert one(spark, dt.date(2024, 1, 1), N.datetime_ms, "date") == "2024-01-01 00:00:00.000"
    assert one(spark, dt.date(2024, 1, 1), N.date_only, "date") == "2024-01-01"
    ts = dt.datetime(2024, 1, 1, 10, 11, 12, 999999)
    assert one(spark, ts, N.datetime_ms, "timestamp_ntz") == "2024-01-01 10:11:12.999"
    assert one(spark, bytearray(b"\x00\xff"), N.binary_hex, "binary") == "00ff"
    assert one(spark, bytearray(b""), N.binary_hex, "binary") == ""
    assert one(spark, bytearray(b"caf\xc3\xa9"), N.bytes_decode, "binary") == "café"
    assert one(spark, bytearray(b"caf\xe9"), N.bytes_decode, "binary") == "café"


def test_stringify(spark):
    assert one(spark, 1.0, N.stringify, "double") == "1.0"
    assert one(spark, True, N.stringify, "boolean") == "true"
    assert one(spark, True, lambda c: N.load_value(N.stringify(c)), "boolean") == "1"


def test_truncation_report(spark):
    df = spark.createDataFrame([("a\r\nb\n" + "x" * 2100,), ("short",), (" " * 3000,)], "t string")
    r = N.truncation_report(df).first()
    assert (r["truncated_rows"], r["multiline_truncated_rows"], r["max_original_chars"], r["max_line_count"]) == \
        (1, 1, 2105, 4)


def test_nfc_engines_agree(spark):
    for engine in ("jvm", "python"):
        assert one(spark, "e\u0301x", lambda c: N.nfc(c, engine)) == "\u00e9x"
        assert one(spark, "plain", lambda c: N.nfc(c, engine)) == "plain"


def test_load_rules_skip_types_they_cannot_change(spark):
    df = spark.createDataFrame([(1, 2.5, True, None)], "i int, d double, b boolean, s string")
    r = N.normalise(df, "load").first()
    assert (r["i"], r["d"], r["b"], r["s"]) == ("1", "2.5", "1", None)
