"""Relations between sources: array key <-> scalar key (D1), bounded per-key lists, and
parallel arrays read back as rows (I6).

D1 is an equi join after ``explode`` (hash / sort-merge join chosen by
Catalyst, skew split by AQE); ``array_contains`` would be a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

MAX_LIST = 500  # longest list one row may hold (the export contract's visit limit)
SPLIT_ROWS = 1_000_000  # keys with more rows are numbered by several tasks
KEY_SLOTS = 65_536  # slots that keys are counted by before the keys of the full ones are


def link_array_to_key(left: DataFrame, array_col: str, right: DataFrame, key: str,
                      how: str = "inner", keep: list[str] | None = None) -> DataFrame:
    """One row per (left row, array element) joined to ``right`` on ``key``.

    ``how='left'`` keeps left rows with an empty/NULL array (``explode_outer``).
    """
    cols = keep if keep is not None else [c for c in left.columns if c != array_col]
    ex = F.explode_outer if how == "left" else F.explode
    exploded = left.select(*cols, ex(array_col).alias(key))
    return exploded.join(right, key, how)


def write_linked(left: DataFrame, array_col: str, right: DataFrame, key: str, path: str, tables: tuple[str, str],
                 buckets: int, keep: list[str] | None = None) -> None:
    """Lay out a link that is asked again and again: both sides as tables bucketed and sorted by the key.

    One shuffle of each side now; after it :func:`read_linked` joins bucket to bucket with no shuffle.  ``left`` is exploded
    first.  ``tables`` are the names of the two tables, their files lie below ``path`` (a shared folder).
    """
    cols = keep if keep is not None else [c for c in left.columns if c != array_col]
    sides = (left.select(*cols, F.explode_outer(array_col).alias(key)), right)
    for side, table in zip(sides, tables):
        # One task a bucket writes one file; rows with a NULL key are kept, they meet nobody.
        (side.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", f"{path}/{table}")
         .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def read_linked(spark, tables: tuple[str, str], key: str, how: str = "left") -> DataFrame:
    """D1 over the tables of :func:`write_linked`: equal buckets meet, no row is shuffled."""
    left, right = (spark.table(t) for t in tables)
    # Both sides lie sorted in equal buckets: a merge needs neither a shuffle nor a broadcast.
    return left.hint("merge").join(right, key, how)


def hot_keys(df: DataFrame, keys: list[str], rows: int) -> DataFrame | None:
    """The keys with more than ``rows`` rows, None without any.  Keys are counted in a fixed number of slots first (no key is
    shuffled); only the keys of slots with more rows than that are counted one by one."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(KEY_SLOTS))
    counts = df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    full = [r[0] for r in counts.select("slot").collect()]
    if not full:
        return None
    found = df.where(slot.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*keys)
    return None if found.isEmpty() else found


def bounded_lists(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                  max_len: int = MAX_LIST, part_col: str = "list_part",
                  split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Per key, ordered lists of ``values`` (``<value>`` -> array column of the same name).

    The grain is (key, ``list_part``) whatever the size: part ``p`` holds the rows at the
    order positions ``p * max_len`` to ``(p + 1) * max_len - 1`` of its key, so the parts of a
    key, taken in order, are its one list.  Equal rows take positions of their own.

    Positions are row numbers inside ranges of the first order column.  A key with more than
    ``split_rows`` rows is cut into 32 such ranges (quantiles of that key), each numbered by
    its own task, and a range starts where the ranges before it end; other keys are one range.
    """
    fields = list(dict.fromkeys(order + values))
    hot = hot_keys(df, keys, split_rows)
    ranged = df.withColumn("_r", F.lit(0))
    split = hot is not None
    kind = df.schema[order[0]].dataType
    if split and isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        steps = [i / 32 for i in range(1, 32)]
        cuts = df.join(hot, keys, "left_semi").groupBy(*keys).agg(F.percentile_approx(order[0], steps).alias("_cuts"))
        above = F.filter(F.col("_cuts"), lambda c: c < F.col(order[0]))
        ranged = df.join(cuts, keys, "left").withColumn("_r", F.coalesce(F.array_size(above), F.lit(0))).drop("_cuts")
    inside = Window.partitionBy(*keys, "_r").orderBy(*[F.col(c) for c in fields])
    numbered = ranged.withColumn("_i", (F.row_number().over(inside) - 1).cast("long"))
    if split:
        before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
        starts = (ranged.join(hot, keys, "left_semi").groupBy(*keys, "_r").agg(F.count(F.lit(1)).alias("_c"))
                  .select(*keys, "_r", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start")))
        numbered = (numbered.join(starts, [*keys, "_r"], "left")
                    .withColumn("_i", F.col("_i") + F.coalesce("_start", F.lit(0))))
    numbered = numbered.withColumn(part_col, F.floor(F.col("_i") / max_len).cast("int"))
    grouped = (numbered.groupBy(*keys, part_col)
               .agg(F.array_sort(F.collect_list(F.struct("_i", *[F.col(c) for c in values]))).alias("_items")))
    return grouped.select(*keys, part_col, *[F.col("_items")[v].alias(v) for v in values])


def zipped_rows(df: DataFrame, keep: list[str], arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays of a row back to one row per position.

    ``arrays`` maps array column -> output name; positions beyond a shorter
    array give NULL (``arrays_zip``).
    """
    z = F.arrays_zip(*[F.col(a).alias(n) for a, n in arrays.items()])
    return df.select(*keep, F.inline(z))


def array_sum(c: Column, zero: Column) -> Column:
    """Sum of the elements (NULL elements count as zero); ``zero`` fixes the type."""
    return F.aggregate(c, zero, lambda acc, x: acc + F.coalesce(x, zero))
