"""Window figures that look back a few rows, for keys of any size.

A key's rows are cut into slices of the time axis, each ordered by its own task.  What a row must know
of the slices before its own (how many rows there were, which were the last few) comes from one small row per key
and slice.  Row numbers, ``lag`` and rolling aggregates are then read off without a window over the whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def looking_back(df: DataFrame, key: str, time: str, tie: list[str], columns: list[str], back: int, slice_unit: str = "day") -> DataFrame:
    """``df`` with ``running_no`` (1, 2, ... of the key in the order of ``time``, ``tie``) and ``previous``: the ``back`` rows
    before it (fewer at the begin), oldest first, as structs of ``columns``.

    A NULL time is a slice of its own, before all others, as NULLs are in the order; so is a NULL key a key.
    """
    rows = df.withColumn("_slice", F.date_trunc(slice_unit, time))
    inside = Window.partitionBy(key, "_slice").orderBy(time, *tie)
    one = F.struct(*[F.col(c).alias(c) for c in columns])
    rows = rows.withColumns({
        "_no": F.row_number().over(inside).cast("long"),
        "_near": F.collect_list(one).over(inside.rowsBetween(-back, -1)),
        "_after": F.lead(F.lit(1), back).over(inside),
    })
    # Of each slice its size and last rows: ``back`` of them at most.
    tails = rows.groupBy(key, "_slice").agg(
        F.max("_no").alias("_n"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_after").isNull(), F.struct("_no", one.alias("row"))))), lambda x: x["row"]).alias("_tail"))
    before = Window.partitionBy(key).orderBy("_slice")
    # A slice has a row at least, so the last ``back`` rows lie in the last ``back`` slices.
    carried = tails.select(
        F.col(key).alias("_key"), F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"),
        F.flatten(F.collect_list("_tail").over(before.rowsBetween(-back, -1))).alias("_carried"))
    joined = rows.join(carried, F.col(key).eqNullSafe(F.col("_key")) & F.col("_slice").eqNullSafe(F.col("_of")))
    known = F.concat("_carried", "_near")
    previous = F.slice(known, F.greatest(F.size(known) - back, F.lit(0)) + 1, F.lit(back))
    return joined.select(*df.columns, (F.col("_earlier") + F.col("_no")).alias("running_no"), previous.alias("previous"))
