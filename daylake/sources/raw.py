"""Raw day store, read side: scan (A6), empty source (A7), day listing (A8), day facts.

Layout: ``<lake>/raw/<source>/load_date=YYYY-MM-DD/*.parquet``, every column a
string, named by the catalog.  Spark hides ``_``/``.`` names, so staging
folders and unfinished files never count as days.

A day that has been replaced lies in ``<lake>/versions/<source>/load_date=YYYY-MM-DD/v=<n>/``.  Which version is read
tells a marker file ``_current/load_date=YYYY-MM-DD@<n>`` beside these folders: the highest number counts.  The
marker is put last and in one step, so a reader finds the former day or the new one, never none and never both.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.sinks import fs
from daylake.sources.catalog import Catalog

DAY = "load_date"
log = logging.getLogger(__name__)
PARQUET_MAGIC = bytearray(b"PAR1")
# No footer of a file without rows is as long as this.
EMPTY_FILE_BYTES = 4 << 20
# Paths told to one scan of files without rows.
SUSPECTS = 5_000


def _in_groups(rows, size: int):
    group: list[str] = []
    for r in rows:
        group.append(r[0])
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def raw_dir(lake: str, source: str) -> str:
    return f"{lake.rstrip('/')}/raw/{source}"


def versions_dir(lake: str, source: str) -> str:
    return f"{lake.rstrip('/')}/versions/{source}"


def current_versions(spark: SparkSession, lake: str, source: str) -> dict[str, int]:
    """``load_date=YYYY-MM-DD`` -> the version read, for days that have been replaced (one listing)."""
    found: dict[str, int] = {}
    for name in fs.list_children(spark, f"{versions_dir(lake, source)}/_current"):
        day, _, n = name.rpartition("@")
        if day.startswith(f"{DAY}=") and n.isdigit():
            found[day] = max(found.get(day, 0), int(n))
    return found


def _base_days(spark: SparkSession, lake: str, source: str) -> list[str]:
    return sorted(n for n in fs.list_children(spark, raw_dir(lake, source)) if n.startswith(f"{DAY}="))


def has_days(spark: SparkSession, lake: str, source: str) -> bool:
    return bool(_base_days(spark, lake, source) or current_versions(spark, lake, source))


def _read_days(spark: SparkSession, lake: str, source: str, read: Callable[[DataFrameReader, list[str]], DataFrame],
               d1=None, d2=None) -> DataFrame | None:
    """``read(reader, paths)`` over the folders of the days as they stand; None without a day."""
    versions = current_versions(spark, lake, source)
    base = _base_days(spark, lake, source)
    plain = [n for n in base if n not in versions]
    parts = []
    if plain:
        root = raw_dir(lake, source)
        paths = [root] if len(plain) == len(base) else [f"{root}/{n}" for n in plain]
        parts.append(read(spark.read.option("basePath", root), paths))
    if versions:
        root = versions_dir(lake, source)
        parts.append(read(spark.read.option("basePath", root), [f"{root}/{n}/v={v}" for n, v in sorted(versions.items())]))
    if not parts:
        return None
    return _in_range(reduce(DataFrame.unionByName, parts), d1, d2)


def _raw_schema(catalog: Catalog, source: str) -> T.StructType:
    return T.StructType(catalog.raw_schema(source).fields + [T.StructField(DAY, T.DateType())])


def scan_raw(spark: SparkSession, lake: str, catalog: Catalog, source: str, file_col: str | None = None) -> DataFrame:
    """All days of a source, united by name; a column absent from a day is NULL.

    The explicit catalog schema makes the union by name free (no footer merge)
    and keeps ``load_date`` a partition column, so day filters prune folders.
    A7: with no day at all the frame is empty with the same schema.  ``file_col`` adds each row's file.
    """
    schema = _raw_schema(catalog, source)
    extra = [F.col("_metadata.file_path").alias(file_col)] if file_col else []
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    days = _read_days(spark, lake, source, lambda r, paths: r.schema(schema).parquet(*paths).select(*names, *extra))
    if days is None:
        if file_col:
            schema = T.StructType([*schema.fields, T.StructField(file_col, T.StringType())])
        return spark.createDataFrame([], schema)
    return days


def scan_files(spark: SparkSession, lake: str, catalog: Catalog, source: str, files: list[str],
               where: Column | None = None) -> DataFrame:
    """The raw rows of some day files (``where`` is applied to each scan)."""
    schema = _raw_schema(catalog, source)
    mark = f"/versions/{source}/{DAY}="
    parts = []
    for root, paths in ((raw_dir(lake, source), [f for f in files if mark not in f]), (versions_dir(lake, source), [f for f in files if mark in f])):
        if paths:
            part = spark.read.option("basePath", root).schema(schema).parquet(*sorted(paths)).select(*[F.col(f"`{f.name}`") for f in schema.fields])
            parts.append(part.where(where) if where is not None else part)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _in_range(df: DataFrame, d1, d2) -> DataFrame:
    if d1 is not None:
        df = df.where(F.col(DAY) >= F.lit(d1).cast("date"))
    if d2 is not None:
        df = df.where(F.col(DAY) <= F.lit(d2).cast("date"))
    return df


def list_day_files(spark: SparkSession, lake: str, source: str, d1=None, d2=None) -> DataFrame:
    """One row per ``*.parquet`` file of a day (0-row files included).

    Optional day bounds prune day folders before any file is opened.
    """
    found = _read_days(spark, lake, source, lambda r, paths: r.format("binaryFile").option("pathGlobFilter", "*.parquet")
                       .load(paths).select("path", "length", F.col(DAY).cast("date").alias(DAY)), d1, d2)
    return found if found is not None else spark.createDataFrame([], "path string, length long, load_date date")


def day_facts(spark: SparkSession, lake: str, catalog: Catalog, source: str,
              d1=None, d2=None) -> DataFrame:
    """Real row count of every listed day, NULL when a file of the day is unreadable.

    One job counts rows of all files (footers only, no column is read); short files that
    gave no row (empty or corrupt, few) are opened again to test the magic.
    """
    files = list_day_files(spark, lake, source, d1, d2)
    empty = spark.createDataFrame([], "source string, load_date date, fact long")
    if not has_days(spark, lake, source):
        return empty
    counts = _read_days(
        spark, lake, source, lambda r, paths: r.schema(_raw_schema(catalog, source)).option("ignoreCorruptFiles", True).parquet(*paths)
        .select(DAY, F.col("_metadata.file_path").alias("path")), d1, d2).groupBy("path").count()
    per_file = files.join(counts, "path", "left")
    # A file without rows is valid only if it ends as Parquet does.  Such a file is a footer and no more, so
    # a long one is corrupt; the short ones are opened, some thousand paths at a time.
    silent = per_file.where(F.col("count").isNull())
    small = silent.where(F.col("length") <= EMPTY_FILE_BYTES).select("path")
    magic = None
    for paths in _in_groups(small.toLocalIterator(), SUSPECTS):
        told = (spark.read.format("binaryFile").load(paths)
                .select("path", (F.substring("content", -4, 4) == F.lit(PARQUET_MAGIC)).alias("readable")))
        magic = told if magic is None else magic.unionByName(told)
    if magic is None:
        per_file = per_file.withColumn("readable", F.lit(False))
    else:
        per_file = per_file.join(magic, "path", "left")
    bad = [r.path for r in per_file.where(F.col("count").isNull() & ~F.coalesce("readable", F.lit(False))).select("path").limit(5).collect()]
    if bad:
        log.warning("%s: unreadable day files, their days count as not loaded: %s", source, bad)
    ok = F.col("count").isNotNull() | F.coalesce(F.col("readable"), F.lit(False))
    return (per_file.groupBy(DAY)
            .agg(F.bool_and(ok).alias("ok"), F.sum(F.coalesce("count", F.lit(0))).alias("n"))
            .select(F.lit(source).alias("source"), DAY,
                    F.when(F.col("ok"), F.col("n")).cast("long").alias("fact")))
