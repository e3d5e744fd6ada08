"""Column functions: conversions and the cross-engine traps."""

import datetime

import pytest
from storelens import functions as sf


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_to_number_rejects_java_literals_and_specials(spark):
    got = one_col(spark, ["4.1", " 2 ", "-1", ".5", "1e3", "19d", "1f", "nan", "inf",
                          "1_000", "0x1A", "", None, "1.", "+3"], sf.to_number)
    assert got == [4.1, 2.0, -1.0, 0.5, 1000.0, None, None, None, None,
                   None, None, None, None, 1.0, 3.0]


def test_installs_cleaning(spark):
    txt = one_col(spark, ["10,000+", " 5 ", "Free", "0+", "1,000,000+", "12\n"], sf.installs_text)
    assert txt == ["10000", "5", "Free", "0", "1000000", "12"]
    ok = one_col(spark, txt, sf.is_digits)
    assert ok == [True, True, False, True, True, True]
    assert one_col(spark, ["10000", "99999999999999999999"], sf.installs_to_long) == [10000, 0]


def test_price(spark):
    assert one_col(spark, ["$4.99", "0", " $1 ", "Everyone", None, "$"], sf.price_to_number) == [
        4.99, 0.0, 1.0, 0.0, 0.0, 0.0]


def test_size_to_bytes(spark):
    got = one_col(spark, ["19M", "8.5k", "Varies with device", "9G", "xM", "1.5m", "2MM"],
                  sf.size_to_bytes)
    assert got == [19 * 1048576.0, 8704.0, None, None, None, None, 2 * 1048576.0]


def test_iso_date_is_a_cast_not_a_parse(spark):
    got = one_col(spark, ["2018-08-01", "2018", "2018-01", "January 7, 2018", "2018-13-01",
                          "2018/1/7", "2018-1-7", "Unknown"], sf.iso_date)
    assert got == [datetime.date(2018, 8, 1), None, None, None, None, None,
                   datetime.date(2018, 1, 7), None]


def test_parse_date_formats(spark):
    got = one_col(spark, ["January 7, 2018", "2018-08-01", "Unknown"], sf.parse_date)
    assert got == [datetime.date(2018, 1, 7), datetime.date(2018, 8, 1), None]


def test_md5_key_matches_known_hex_and_separator(spark):
    df = spark.createDataFrame([("Alpha", "1.0"), ("Beta", None), ("ab", "c"), ("a", "bc")],
                               "a string, b string")
    keys = [r[0] for r in df.select(sf.md5_key("a", "b")).collect()]
    assert keys[0] == "38f1a00679e61384257dc7001e70add6"
    assert keys[2] == keys[3]  # no separator: known collision
    sep = [r[0] for r in df.select(sf.md5_key("a", "b", sep="|")).collect()]
    assert sep[2] != sep[3]
    import hashlib
    assert keys[1] == hashlib.md5(b"Beta_").hexdigest()
    non_ascii = spark.createDataFrame([("é", "2")], "a string, b string")
    assert non_ascii.select(sf.md5_key("a", "b")).first()[0] == hashlib.md5("é2".encode()).hexdigest()


def test_text_score(spark):
    assert one_col(spark, ["0.5", "NULL", "0.1x", "-1", None], sf.text_score) == [
        0.5, None, None, -1.0, None]


def test_sentiment_score(spark):
    got = one_col(spark, ["Positive", "POSITIVE", "neutral", "Negative", "Mixed", None],
                  sf.sentiment_score)
    assert got == [1.0, 1.0, 0.5, 0.0, None, None]


def test_bytes_to_mb(spark):
    assert one_col(spark, [1048576.0, None, 8704.0, float("inf"), float("nan")],
                   sf.bytes_to_mb, "double") == [1.0, 0.0, 0.00830078125, 0.0, 0.0]


@pytest.mark.parametrize("n,text", [
    (0, "0"), (999, "999"), (1000, "1.0K"), (1049, "1.0K"), (1050, "1.1K"),
    (1250000, "1.3M"), (999950000, "1000.0M"), (1500000000, "1.5B"), (32005, "32.0K"),
])
def test_compact_number(spark, n, text):
    assert one_col(spark, [n], sf.compact_number, "bigint") == [text]


def test_thousands(spark):
    assert one_col(spark, [1234567, 0], sf.thousands, "bigint") == ["1,234,567", "0"]


def test_na_to_null(spark):
    from storelens.sources.schemas import NA_TOKENS
    got = one_col(spark, ["NaN", "nan", "NULL", "", "N/A", " NaN", "ok", None],
                  lambda c: sf.na_to_null(c, tokens=NA_TOKENS))
    assert got == [None, None, None, None, None, " NaN", "ok", None]


def test_nan_to_null(spark):
    assert one_col(spark, [float("nan"), 1.5, None], sf.nan_to_null, "double") == [None, 1.5, None]


def test_numbers_too_large_and_unicode_blanks(spark):
    from storelens.functions.numeric import installs_text_sql, size_to_bytes_sql, to_number_sql

    r = spark.createDataFrame([("1e999", "1\u00a0", "1e400M", "2M")], "a string, b string, c string, d string") \
        .selectExpr(to_number_sql("a"), installs_text_sql("b"), size_to_bytes_sql("c"), size_to_bytes_sql("d")).first()
    assert tuple(r) == (None, "1", None, 2.0 * 1024 * 1024)
