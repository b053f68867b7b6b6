"""Day selection (K3, D4): which days of a range to (re)load.

A day is loaded when it lies in the hot window ``[anchor-(N-1), anchor]``
(the origin keeps completing recent days, K7) OR it is not confirmed by the
reconcile.  The window beats the skip; N=0 turns it off; N<0 is an error.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "load_date"
DEFAULT_HOT_WINDOW_DAYS = 3


def day_calendar(spark: SparkSession, d1: _dt.date, d2: _dt.date) -> DataFrame:
    if d1 > d2:
        raise ValueError(f"inverted range {d1} > {d2}")
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(d1), F.lit(d2), F.expr("INTERVAL 1 DAY"))).alias(DAY))


def select_days(spark: SparkSession, source: str, confirmed: DataFrame, d1: _dt.date,
                d2: _dt.date, *, hot_window_days: int = DEFAULT_HOT_WINDOW_DAYS,
                anchor: _dt.date) -> DataFrame:
    """Days to load, ascending; ``confirmed`` has (source, load_date) of loaded days."""
    if hot_window_days < 0:
        raise ValueError(f"hot window must be >= 0, got {hot_window_days}")
    cal = day_calendar(spark, d1, d2)
    loaded = (confirmed.where(F.col("source") == source).select(DAY).distinct()
              .withColumn("is_loaded", F.lit(True)))
    if hot_window_days > 0:
        start = anchor - _dt.timedelta(days=hot_window_days - 1)
        in_hot = F.col(DAY).between(F.lit(start), F.lit(anchor))
    else:
        in_hot = F.lit(False)
    # Broadcast bound: one row per confirmed day of one source.
    return (cal.join(F.broadcast(loaded), DAY, "left")
            .select(DAY, in_hot.alias("in_hot"), F.coalesce("is_loaded", F.lit(False)).alias("loaded"))
            .where(F.col("in_hot") | ~F.col("loaded"))
            .orderBy(DAY))
