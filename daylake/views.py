"""Typed reading layer: catalog-typed DataFrames and SQL views over the raw days.

A view is a lazy projection over the raw scan; Spark keeps the file listing
of a registered DataFrame, so every publish ends with ``register_views``
again (re-registration is cheap: no job runs).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.functions.dates import register_today
from daylake.functions.typing import typed_projection
from daylake.plans import journal
from daylake.sources.catalog import Catalog
from daylake.sources.raw import DAY, scan_raw


def typed_source(spark: SparkSession, lake: str, catalog: Catalog, source: str,
                 keep_day: bool = False) -> DataFrame:
    """B3/B4 over A6 (A7 when the source has no day: 0 rows, right types)."""
    raw = scan_raw(spark, lake, catalog, source)
    return typed_projection(raw, catalog, source, keep=(DAY,) if keep_day else ())


LOAD_STATE = "load_state"


def load_state(spark: SparkSession, lake: str) -> DataFrame:
    """The journal as an object: the current mark of each source and day."""
    return journal.current(spark, lake).select("source", DAY, "row_count", "loaded_at", "status")


def register_views(spark: SparkSession, lake: str, catalog: Catalog, sources=None,
                   prefix: str = "", keep_day: bool = False) -> dict[str, DataFrame]:
    """Build every view first, then register them all (no half-registered layer)."""
    frames = {f"{prefix}{s}": typed_source(spark, lake, catalog, s, keep_day)
              for s in (sources or catalog.sources())}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    load_state(spark, lake).createOrReplaceTempView(f"{prefix}{LOAD_STATE}")
    register_today(spark)
    return frames


def query(spark: SparkSession, text: str) -> DataFrame:
    """Run a read statement; ``SUMMARIZE <table or query>`` goes to the summarize operator
    (Spark SQL has no such statement), everything else to ``spark.sql``."""
    from daylake.operators.profile import summarize
    stripped = text.strip().rstrip(";").strip()
    head, _, rest = stripped.partition(" ")
    if head.upper() == "SUMMARIZE":
        rest = rest.strip()
        is_query = rest.split(" ", 1)[0].upper() in ("SELECT", "WITH", "FROM", "TABLE", "VALUES") \
            or rest.startswith("(")
        return summarize(spark.sql(rest) if is_query else spark.table(rest))
    return spark.sql(stripped)


def where_days(df: DataFrame, d1, d2, date_col: str = "date") -> DataFrame:
    """Day range filter that also prunes day folders.

    A filter on the typed ``date`` is not pushed into the scan (it is a cast of
    a string), so the same bounds are put on the partition column as well:
    one day partition holds one load day.
    """
    d1 = _dt.date.fromisoformat(str(d1))
    d2 = _dt.date.fromisoformat(str(d2))
    out = df.where(F.col(date_col).between(F.lit(d1), F.lit(d2)))
    if DAY in df.columns:
        out = out.where(F.col(DAY).between(F.lit(d1), F.lit(d2)))
    return out
