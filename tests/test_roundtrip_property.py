"""Property: value -> export text -> typed value gives the value back."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.functions.typing import typed
from daylake.sources.landing import cell_text

# Cells of the export never hold tab / line breaks (they would cut the row).
TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\t\n\r\x0b\x0c\x1c\x1d\x1e\x85  "),
               max_size=12)
STAMP = st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31))
CASES = [
    ("BIGINT", T.LongType(), st.integers(-2**63, 2**63 - 1)),
    ("INTEGER", T.IntegerType(), st.integers(-2**31, 2**31 - 1)),
    ("SMALLINT", T.ShortType(), st.integers(-2**15, 2**15 - 1)),
    ("HUGEINT", T.DecimalType(38, 0), st.integers(0, 2**64 - 1).map(Decimal)),
    ("DOUBLE", T.DoubleType(), st.floats(allow_nan=False, width=64)),
    ("BOOLEAN", T.BooleanType(), st.booleans()),
    ("DATE", T.DateType(), st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(9999, 12, 31))),
    ("TIMESTAMP", T.TimestampNTZType(), STAMP),
    ("VARCHAR", T.StringType(), TEXT),
    ("BIGINT[]", T.ArrayType(T.LongType()), st.lists(st.one_of(st.none(), st.integers(-2**63, 2**63 - 1)), max_size=5)),
    ("HUGEINT[]", T.ArrayType(T.DecimalType(38, 0)), st.lists(st.integers(0, 2**64 - 1).map(Decimal), max_size=5)),
    ("DOUBLE[]", T.ArrayType(T.DoubleType()), st.lists(st.floats(allow_nan=False, width=64), max_size=5)),
    ("TIMESTAMP[]", T.ArrayType(T.TimestampNTZType()), st.lists(STAMP, max_size=4)),
    ("VARCHAR[]", T.ArrayType(T.StringType()), st.lists(st.one_of(st.none(), TEXT), max_size=5)),
]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
    return a == b


def test_roundtrip_all_types(spark):
    for working, dtype, strategy in CASES:
        @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
        @given(st.lists(st.one_of(st.none(), strategy), min_size=1, max_size=40))
        def check(values):
            schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)])
            df = spark.createDataFrame(list(enumerate(values)), schema)
            text = df.select("i", cell_text(F.col("v"), dtype).alias("t"))
            back = {r["i"]: r["b"] for r in text.select("i", typed(F.col("t"), working).alias("b")).collect()}
            for i, v in enumerate(values):
                if v is None:
                    # NULL is written as '' : NULL again, except VARCHAR where '' is a value.
                    assert back[i] in (None, ""), (working, v, back[i])
                else:
                    assert same(back[i], v), (working, v, back[i])
        check()
