"""Scalar parser tables (literal input -> expected output)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def _run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s")).alias("o")).collect()]


def test_double0(spark):
    out = _run(spark, S.lenient_double, ["", " 12 ", "abc", "1e3", "1.5d", "+5", "1e400", None,
                                         " 7.25　", "-inf", "NaN", ".5", "5."])
    assert out[:6] == [0.0, 12.0, 0.0, 1000.0, 0.0, 5.0]
    assert out[6] == float("inf")
    assert out[7] == 0.0 and out[8] == 7.25 and out[9] == float("-inf")
    assert out[10] != out[10]  # NaN
    assert out[11:] == [0.5, 5.0]


def test_double_nullable(spark):
    out = _run(spark, lambda c: S.lenient_double(c, None), ["", "1e400", "x", "2.5", "Inf"])
    assert out == [None, None, None, 2.5, float("inf")]


def test_long(spark):
    out = _run(spark, S.lenient_long, ["1.5", "99999999999999999999", "-99999999999999999999",
                                       " 42 ", "+7", "", "x"])
    assert out == [0, 9223372036854775807, -9223372036854775808, 42, 7, 0, 0]
    out = _run(spark, lambda c: S.lenient_long(c, 0, on_overflow="default"), ["99999999999999999999", "3"])
    assert out == [0, 3]
    out = _run(spark, lambda c: S.lenient_long(c, None), ["", "12", "1.5"])
    assert out == [None, 12, None]


def test_bool(spark):
    assert _run(spark, S.lenient_bool, ["Y", "TRUE", "on", "", None, " t ", "1", "0"]) == [
        True, True, False, False, False, True, True, False]


def test_date(spark):
    out = _run(spark, S.lenient_date, ["2025-01-02", "2025-1-2", "2025-13-02", "2025-01-02T00:00:00Z",
                                       "2025-02-30", " 2025-03-04 "])
    assert out == [dt.date(2025, 1, 2), None, None, None, None, dt.date(2025, 3, 4)]


def test_date3(spark):
    out = _run(spark, S.lenient_date3, ["2025-01-02", "2025-01-02T23:30:00-05:00", "2025-01-02T10:00:00",
                                        "2025-01-02 10:00:00", "2025-01-02T25:00:00Z", "x"])
    assert out == [dt.date(2025, 1, 2), dt.date(2025, 1, 2), dt.date(2025, 1, 2), None, None, None]
    out = _run(spark, lambda c: S.lenient_date3(c, " "), ["2025-01-02 10:00:00", "2025-01-02T10:00:00"])
    assert out == [dt.date(2025, 1, 2), None]


def test_clock(spark):
    out = _run(spark, S.lenient_clock, ["9:05", "10:11:12", "10:11:12.345", "x", "24:00", "10:11:12,5",
                                        "10:11:12.123456"])
    assert out == ["09:05:00.000", "10:11:12.000", "10:11:12.345", None, None, "10:11:12.500", "10:11:12.123"]


def test_ts(spark):
    df = spark.createDataFrame([(v,) for v in [
        "2025-01-02T03:04:05+01:00", "2025-01-02 03:04:05", "2025-01-02 03:04:05.123", "2025",
        "2025-01-02", "2025-01-02T03:04:05.123456789Z", "2025-01-02 03:04:05Z", "2025-01-02T3:04:05"]],
        "s string")
    out = [r[0] for r in df.select(F.date_format(S.lenient_ts("s"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()]
    assert out == ["2025-01-02 02:04:05.000000", "2025-01-02 03:04:05.000000", "2025-01-02 03:04:05.123000",
                   None, None, "2025-01-02 03:04:05.123456", None, "2025-01-02 03:04:05.000000"]


def test_clean_and_branch(spark):
    assert _run(spark, S.clean_text, ["a��b", None]) == ["a?b", ""]
    assert _run(spark, S.global_branch, ["", None, " ", "b1"]) == ["ALL", "ALL", " ", "b1"]
    assert _run(spark, S.blank_to_null, ["", "x"]) == [None, "x"]


def test_double_special_forms(spark):
    vals = ["0x1p-2", "0X1.8P1", "Infinity", "+inf", "-Infinity", "nan", "+nan", "1e-400", "0x10"]
    d = _run(spark, S.lenient_double, vals)
    n = _run(spark, lambda c: S.lenient_double(c, None), vals)
    assert d[:5] == [0.25, 3.0, float("inf"), float("inf"), float("-inf")] and d[5] != d[5]
    assert d[6:] == [0.0, 0.0, 0.0] and n[6] is None and n[7] == 0.0 and n[8] is None
