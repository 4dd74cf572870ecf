from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from firstpour.functions.charset import code_page, unrepaired
from firstpour.functions import all_string, force_encode, partition_values, stamp, with_fetch_partitions
from firstpour.functions.naming import bronze_name, bronze_name_column
from tests.conftest import DAY_1, rows

MIDNIGHT_EAST = datetime(2024, 2, 1, 0, 30, tzinfo=timezone(timedelta(hours=1)))


def misread(text, charset):
    return text.encode("utf-8").decode(charset)


def test_misread_text_is_repaired_and_clean_text_kept(spark):
    texts = [misread("café", "latin-1"), "plain", "café", "Ωmega", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, name string")
    repaired = [r["name"] for r in force_encode(df, "iso-8859-1").orderBy("id").collect()]
    assert repaired == ["café", "plain", "café", "Ωmega", None, ""]


@pytest.mark.parametrize("charset", ["UTF-8", "ISO-8859-1", "US-ASCII"])
def test_broken_bytes_become_replacement_characters(spark, charset):
    broken = spark.sql("SELECT CAST(X'8061' AS STRING) AS name UNION ALL SELECT CAST(X'61C3' AS STRING)")
    assert rows(force_encode(broken, charset)) == [("a\ufffd",), ("\ufffda",)]


def test_text_read_under_a_wide_charset_is_repaired(spark):
    df = spark.createDataFrame([("abcdé!!".encode("utf-8").decode("utf-16-be"),)], "name string")
    assert rows(force_encode(df, "UTF-16BE")) == [("abcdé!!",)]


def test_strict_conversion_fails_on_other_characters(spark):
    df = spark.createDataFrame([("Ω",)], "name string")
    with pytest.raises(Exception, match="MALFORMED"):
        force_encode(df, "ISO-8859-1", errors="raise").collect()


def test_unknown_charset_is_rejected_early(spark):
    with pytest.raises(ValueError, match="unsupported"):
        force_encode(spark.range(1), "EBCDIC")


def test_no_charset_changes_nothing(spark):
    df = spark.range(1)
    assert force_encode(df, None) is df


def test_only_text_columns_are_converted(spark):
    df = spark.createDataFrame([(1, b"\xff", "a")], "n int, raw binary, t string")
    assert force_encode(df, "US-ASCII").dtypes == df.dtypes
    assert rows(force_encode(df, "US-ASCII")) == [(1, b"\xff", "a")]


def test_all_string_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, b double, `c.d` boolean")
    assert rows(all_string(df)) == [("1", None, "true")]


def test_partition_values_are_utc():
    assert partition_values(MIDNIGHT_EAST)["fetch_day"] == "20240131"
    assert partition_values(datetime(2024, 1, 15))["fetch_day"] == "20240115"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_partition_columns_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = with_fetch_partitions(stamp(spark.range(1), MIDNIGHT_EAST)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["fetch_year"], row["fetch_month"], row["fetch_day"]) == ("2024", "202401", "20240131")


def test_stamp_is_one_constant(spark):
    stamped = stamp(spark.range(3), DAY_1)
    assert stamped.select(F.unix_seconds("fetch_date").alias("s")).distinct().first()["s"] == DAY_1.timestamp()


def test_name_column_agrees_with_name(spark):
    sources = [("DB", "ERP", "SALES", "ORDER LINES"), ("FILE", "EXCEL", "/in/a b.xlsx", "My Sheet"), ("DB", "A", "B", "C")]
    df = spark.createDataFrame(sources, "t string, n string, o string, b string")
    made = df.select(bronze_name_column(F.col("t"), F.col("n"), F.col("o"), F.col("b")).alias("name"))
    assert [r["name"] for r in made.collect()] == [bronze_name(*s) for s in sources]


PAGES = ("windows-1252", "ISO-8859-15", "cp850", "cp037", "koi8-r")


@pytest.mark.parametrize("charset", PAGES)
def test_code_pages_round_trip_like_the_codecs(spark, charset):
    page = code_page(charset)
    for b in range(256):
        try:
            assert page[b] == bytes([b]).decode(charset)
        except UnicodeDecodeError:
            assert page[b] == chr(b)
    texts = ["plain", "café – “x” € ñ", "日本語 😀", "".join(map(chr, range(1, 0x250))), "", "ß" * 300]
    df = spark.createDataFrame([(i, "".join(page[b] for b in t.encode())) for i, t in enumerate(texts)] + [(9, None)], "id int, t string")
    assert [r["t"] for r in force_encode(df, charset).orderBy("id").collect()] == [*texts, None]
    assert [r["t"] for r in force_encode(df, charset, errors="raise").orderBy("id").collect()] == [*texts, None]
    assert df.select(unrepaired(df, charset).alias("u")).where("size(u) > 0").count() == 0


def test_values_no_code_page_explains_stay_and_are_named(spark):
    df = spark.createDataFrame([(1, "Ω", "cafÃ©"), (2, "é", "ok"), (3, None, "日")], "id int, a string, b string")
    assert rows(force_encode(df, "windows-1252")) == [(1, "Ω", "café"), (2, "é", "ok"), (3, None, "日")]
    assert rows(df.select("id", unrepaired(df, "windows-1252").alias("u"))) == [(1, ["a"]), (2, ["a"]), (3, ["b"])]
    with pytest.raises(Exception, match="not text in WINDOWS-1252"):
        force_encode(df, "windows-1252", errors="raise").collect()


def test_charsets_of_several_bytes_are_no_code_pages():
    assert [code_page(c) for c in ("shift_jis", "gbk", "utf-7", "base64", "nowhere")] == [None] * 5
