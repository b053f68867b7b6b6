"""Hard row check (E3): expected rows (from the raw text) against actual rows (re-read files).

The two counts come from independent paths: the text count never looks at
the parsed cells and the actual count reads the written Parquet back.  A
mismatch is an error for the day, never a warning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "load_date"


def check_frame(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per day: expected, actual (0 when nothing was written) and ``ok``.

    ``expected`` needs ``load_date, expected`` (and may carry more columns);
    ``actual`` needs ``load_date, actual``.
    """
    j = expected.join(actual, DAY, "left")
    act = F.coalesce(F.col("actual"), F.lit(0)).cast("long")
    ok = (F.col("expected") >= 0) & (act >= 0) & (F.col("expected") == act)
    return j.withColumn("actual", act).withColumn("ok", ok)
