from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType

from marquee.functions import columns as c


def one(spark, schema, value, expression):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expression(df).alias("x")).first()["x"]


@pytest.mark.parametrize("text, expected", [("\\N", None), (None, None), ("", ""), ("N", "N"), ("a\\N", "a\\N")])
def test_null_token(spark, text, expected):
    assert one(spark, "v string", text, lambda df: c.null_token(F.col("v"))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("", [""]),
        ("a", ["a"]),
        ("a,b", ["a", "b"]),
        ("  a ,  b,c  ", ["a", "b", "c"]),
        ("a,,b", ["a", "", "b"]),
    ],
)
def test_split_list(spark, text, expected):
    assert one(spark, "v string", text, lambda df: c.split_list(F.col("v"))) == expected


@pytest.mark.parametrize(
    "text, comma, json",
    [
        ("\\N", None, None),
        (None, None, None),
        ('["Self"]', ["Self"], ["Self"]),
        ('["A","B"]', ["A", "B"], ["A", "B"]),
        ('["Self","Host, The"]', ["Self", "Host", "The"], ["Self", "Host, The"]),
        ('["O\'Neil [old]"]', ["O'Neil old"], ["O'Neil [old]"]),
    ],
)
def test_parse_characters(spark, text, comma, json):
    assert one(spark, "v string", text, lambda df: c.parse_characters(F.col("v"))) == comma
    assert one(spark, "v string", text, lambda df: c.parse_characters(F.col("v"), "json")) == json


def test_parse_characters_rejects_other_ways():
    with pytest.raises(ValueError, match="xml"):
        c.parse_characters(None, "xml")


@pytest.mark.parametrize(
    "text, as_int, as_short",
    [
        ("1960", 1960, 1960),
        (" 7 ", 7, 7),
        ("\\N", None, None),
        ("", None, None),
        (None, None, None),
        ("1960.5", None, None),
        ("40000", 40000, None),
        ("x", None, None),
    ],
)
def test_number_from_text(spark, text, as_int, as_short):
    assert one(spark, "v string", text, lambda df: c.number(df, "v", IntegerType())) == as_int
    assert one(spark, "v string", text, lambda df: c.number(df, "v", ShortType())) == as_short


def test_number_from_int(spark):
    assert one(spark, "v int", 40000, lambda df: c.number(df, "v", ShortType())) is None
    assert one(spark, "v int", 7, lambda df: c.number(df, "v", IntegerType())) == 7


@pytest.mark.parametrize("value, expected", [(6.25, "6.3"), (6.35, "6.4"), (7.0, "7.0"), (10.0, "10.0")])
def test_rating_rounds_half_up(spark, value, expected):
    assert one(spark, "v double", value, lambda df: c.number(df, "v", DecimalType(10, 1))) == Decimal(expected)


@pytest.mark.parametrize("value, expected", [(1960, False), (1961, True), (2009, True), (2010, False), (None, None)])
def test_strictly_between(spark, value, expected):
    assert one(spark, "v int", value, lambda df: c.strictly_between(F.col("v"), (1960, 2010))) is expected


@pytest.mark.parametrize(
    "birth, death, expected",
    [(1970, None, True), (1970, 2015, False), (None, None, None), (None, 2015, None)],
)
def test_alive_flag(spark, birth, death, expected):
    df = spark.createDataFrame([(birth, death)], "b int, d int")
    assert df.select(c.alive_flag(F.col("b"), F.col("d"))).first()[0] is expected


@pytest.mark.parametrize("value, expected", [(0, False), (1, True), (5, True), (None, True)])
def test_adult_flag(spark, value, expected):
    assert one(spark, "v int", value, lambda df: c.adult_flag(F.col("v"))) is expected
