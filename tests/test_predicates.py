from datetime import datetime

import pytest

from firstpour.operators.predicates import condition, constrain, select_rows, since
from tests.conftest import rows


@pytest.fixture
def numbered(spark):
    data = [("F", 1), ("F", 2), ("O", 2), ("O", 3), ("P", 3), ("F", None)]
    return spark.createDataFrame(data, "status string, n int")


@pytest.mark.parametrize("text", ["WHERE a = 1", " where  a = 1", "a = 1", "\nWhere\ta = 1 "])
def test_leading_where_is_removed(text):
    assert condition(text) == "a = 1"


def test_where_is_only_removed_as_a_word():
    assert condition("whereabouts = 1") == "whereabouts = 1"


@pytest.mark.parametrize("text", [None, "", "  "])
def test_no_constraint_keeps_all(numbered, text):
    assert constrain(numbered, text) is numbered


def test_equal_and_null_values_are_not_picked_up(numbered):
    assert rows(since(numbered, "n", "2")) == [("O", 3), ("P", 3)]


@pytest.mark.parametrize("column, value", [(None, "2"), ("n", None), (None, None)])
def test_watermark_needs_column_and_value(numbered, column, value):
    assert since(numbered, column, value) is numbered


def test_or_in_the_constraint_is_bracketed(numbered):
    found = select_rows(numbered, "WHERE status = 'F' OR status = 'O'", "n", "2")
    assert rows(found) == [("O", 3)]


def test_text_watermark_compares_as_text(spark):
    df = spark.createDataFrame([("9",), ("10",)], "n string")
    assert rows(since(df, "n", "1")) == [("10",), ("9",)]
    assert rows(since(df, "n", "5")) == [("9",)]


def test_zoned_text_compares_with_both_timestamp_kinds(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:01' AS a, TIMESTAMP '2024-01-01 00:00:01 UTC' AS b")
    for column in ("a", "b"):
        assert since(df, column, "2024-01-01 00:00:00+00:00").count() == 1
        assert since(df, column, "2024-01-01 00:00:01+00:00").count() == 0


def test_malformed_watermark_fails(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        since(df, "t", "soon").collect()


def test_criterion_may_be_an_expression_or_differ_in_case(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2, "b"), (3, 4, "c")], "a int, b int, `my id` string")
    assert rows(since(df, "coalesce(a, b)", "1").select("my id")) == [("b",), ("c",)]
    assert rows(since(df, "B", "2").select("my id")) == [("c",)]
    assert rows(since(df, "my id", "b").select("my id")) == [("c",)]
