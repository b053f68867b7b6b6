"""Sessions from timed events: gap-based cuts, running session numbers, ordered paths.

A session of a key ends where its next event is more than ``gap`` seconds later.  A key's events
are cut into slices of the time axis (days by default), each numbered by its own task; what
a slice must know of the ones before it (the last time, how many sessions have begun) comes from one
summary row per key and slice.  So a key with a third of all rows is as many tasks as it has slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_SECONDS = 30 * 60
SLICE = "day"


def _seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two times, with their fraction."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1_000_000)


def sessions(events: DataFrame, key: str, time: str, tie: list[str], gap: float = GAP_SECONDS, slice_unit: str = SLICE) -> DataFrame:
    """``events`` with ``session_no`` (1, 2, ... for each key, in the order of ``time``, ``tie``) and
    ``step`` (1, 2, ... in the session's slice) and ``slice_at``, the begin of the slice.

    Rows without key or time belong to no session and are left out.  A session over several slices keeps its
    number; its order is (``slice_at``, ``step``).
    """
    cut = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("slice_at", F.date_trunc(slice_unit, time))
    inside = Window.partitionBy(key, "slice_at").orderBy(time, *tie)
    since = _seconds(F.col(time), F.lag(time).over(inside))
    # The first event of a slice is judged against the slices before it.
    rows = cut.withColumn("_cut", F.coalesce(since > gap, F.lit(False)).cast("long"))
    rows = rows.withColumn("_begun", F.sum("_cut").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("step", F.row_number().over(inside))

    # One row per key and slice, made from partial aggregates.
    before = Window.partitionBy(key).orderBy("slice_at")
    firsts = cut.groupBy(key, "slice_at").agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    cuts = rows.groupBy(key, "slice_at").agg(F.sum("_cut").alias("_cuts"))
    carried = firsts.join(cuts, [key, "slice_at"])
    opens = F.coalesce(_seconds(F.col("_first"), F.lag("_last").over(before)) > gap, F.lit(True)).cast("long")
    carried = carried.withColumn("_opens", opens)
    earlier = F.coalesce(F.sum(F.col("_opens") + F.col("_cuts")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = carried.select(key, "slice_at", (earlier + F.col("_opens")).alias("_number"))
    return rows.join(carried, [key, "slice_at"]).withColumn("session_no", F.col("_number") + F.col("_begun")).drop("_cut", "_begun", "_number")


def session_paths(
    events: DataFrame, key: str, time: str, tie: list[str], step_col: str, gap: float = GAP_SECONDS, slice_unit: str = SLICE, separator: str = ">"
) -> DataFrame:
    """One row per session: ``key, session_no, started, ended, n_events, path`` (the steps in order, joined).

    Paths are joined slice by slice first, so a long session is merged from a few pieces.
    """
    cut = sessions(events, key, time, tie, gap, slice_unit)
    piece = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", F.col(step_col).alias("s")))), lambda x: F.coalesce(x["s"].cast("string"), F.lit(""))), separator)
    pieces = cut.groupBy(key, "session_no", "slice_at").agg(
        F.min(time).alias("started"), F.max(time).alias("ended"), F.count(F.lit(1)).alias("n_events"), piece.alias("piece")
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slice_at", "piece"))), lambda x: x["piece"]), separator)
    return pieces.groupBy(key, "session_no").agg(
        F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("n_events").alias("n_events"), whole.alias("path")
    )


def transitions(events: DataFrame, key: str, time: str, tie: list[str], step_col: str, gap: float = GAP_SECONDS, slice_unit: str = SLICE) -> DataFrame:
    """``step_from, step_to, n``: how often a step is followed by another in one session; a session's last step goes to NULL."""
    cut = sessions(events, key, time, tie, gap, slice_unit)
    inside = Window.partitionBy(key, "session_no", "slice_at").orderBy("step")
    steps = cut.select(key, "session_no", "slice_at", "step", F.col(step_col).alias("step_from"), F.lead(F.struct(F.col(step_col).alias("s"))).over(inside).alias("next"))
    # The last step of a slice goes on to the first of the session's next slice.
    edges = steps.groupBy(key, "session_no", "slice_at").agg(F.min_by(F.struct(F.col("step_from").alias("s")), "step").alias("first"))
    after = Window.partitionBy(key, "session_no").orderBy("slice_at")
    edges = edges.withColumn("onward", F.lead("first").over(after)).drop("first")
    linked = steps.where("next IS NOT NULL").select("step_from", F.col("next.s").alias("step_to")).unionByName(
        steps.where("next IS NULL").join(edges, [key, "session_no", "slice_at"]).select("step_from", F.col("onward.s").alias("step_to"))
    )
    return linked.groupBy("step_from", "step_to").agg(F.count(F.lit(1)).alias("n"))
