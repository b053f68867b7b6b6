from decimal import Decimal
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daylake.functions.typing import list_elements, typed


def one(spark, text, working):
    df = spark.createDataFrame([(text,)], "c string")
    return df.select(typed(F.col("c"), working).alias("v")).first()["v"]


def elements(spark, text):
    df = spark.createDataFrame([(text,)], "c string")
    return df.select(list_elements(F.col("c")).alias("v")).first()["v"]


@pytest.mark.parametrize("text,working,expected", [
    ("17298374650000000001", "HUGEINT", Decimal("17298374650000000001")),
    ("5.7", "INTEGER", 6),
    ("-2.5", "INTEGER", -3),
    ("-1.5", "BIGINT", -2),
    ("1e3", "INTEGER", 1000),
    (" 5 ", "INTEGER", 5),
    ("", "INTEGER", None),
    ("abc", "INTEGER", None),
    ("70000", "SMALLINT", None),
    ("1", "BOOLEAN", True),
    ("0", "BOOLEAN", False),
    ("yes", "BOOLEAN", True),
    ("5", "BOOLEAN", None),
    ("2026", "DATE", None),
    ("not-a-date", "DATE", None),
    ("2026-05-20", "DATE", dt.date(2026, 5, 20)),
    ("2026-05-20 12:34:56", "TIMESTAMP", dt.datetime(2026, 5, 20, 12, 34, 56)),
    ("2026", "TIMESTAMP", None),
    ("1.5", "DOUBLE", 1.5),
    ("", "VARCHAR", ""),
    (None, "VARCHAR", None),
])
def test_scalars(spark, text, working, expected):
    assert one(spark, text, working) == expected


@pytest.mark.parametrize("text,expected", [
    ("['a,b','c']", ["a,b", "c"]),
    ("[a,,b]", ["a", "", "b"]),
    ("['']", [""]),
    ("['NULL']", ["NULL"]),
    ("['it\\'s']", ["it's"]),
    ("[]x", None),
    ("[]", []),
    ("garbage", None),
    ("[a,]", ["a", ""]),
    ("[NULL, x]", [None, "x"]),
    ("[\\'a\\']", ["'a'"]),
])
def test_list_tokens(spark, text, expected):
    assert elements(spark, text) == expected


def test_typed_arrays(spark):
    assert one(spark, "[8273645,8273646]", "HUGEINT[]") == [Decimal(8273645), Decimal(8273646)]
    assert one(spark, "[]", "BIGINT[]") == []
    assert one(spark, "garbage", "BIGINT[]") is None
    assert one(spark, "[1,abc]", "BIGINT[]") == [1, None]
    assert one(spark, "[1,,2]", "BIGINT[]") == [1, None, 2]
    assert one(spark, "['2026-05-20 12:34:56',2026-05-21 00:00:00]", "TIMESTAMP[]") == [
        dt.datetime(2026, 5, 20, 12, 34, 56), dt.datetime(2026, 5, 21)]
    assert one(spark, "[1.5, 2]", "DOUBLE[]") == [1.5, 2.0]
