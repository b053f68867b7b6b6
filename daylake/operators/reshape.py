"""Wide and long forms: pivot (M1) and unpivot (M2) with a stated or bounded list of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PIVOT_VALUES = 1_000


def pivot(df: DataFrame, on: str, using: Column, group_by: list[str], values: list | None = None,
          fill=None, max_values: int = MAX_PIVOT_VALUES) -> DataFrame:
    """One row per ``group_by``, one column per value of ``on`` holding the aggregate ``using``.

    Without ``values`` the distinct values are looked up; more than ``max_values`` raise, since each becomes
    a column.  NULL is no column.  ``fill`` replaces the NULL of an empty cell.
    """
    if values is None:
        found = df.select(on).where(F.col(on).isNotNull()).distinct().limit(max_values + 1).collect()
        if len(found) > max_values:
            raise ValueError(f"{on} has more than {max_values} values; state the ones to pivot")
        values = sorted(r[0] for r in found)
    wide = df.groupBy(*group_by).pivot(on, values).agg(using)
    cells = [F.col(f"`{v}`") for v in values]
    if fill is not None:
        cells = [F.coalesce(c, F.lit(fill)) for c in cells]
    return wide.select(*group_by, *[c.alias(str(v)) for c, v in zip(cells, values)])


def unpivot(df: DataFrame, columns: list[str], name: str, value: str, keep_null: bool = False) -> DataFrame:
    """One row per row and column of ``columns``: the other columns, the column's ``name`` and its ``value``.
    NULL cells give no row unless ``keep_null``."""
    others = [c for c in df.columns if c not in columns]
    out = df.unpivot(others, columns, name, value)
    return out if keep_null else out.where(F.col(value).isNotNull())
