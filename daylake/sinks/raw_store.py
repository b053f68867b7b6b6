"""Raw day store, write side: rename (B1), staged write (J1), empty day (J2), value contract.

A load writes all selected days of a source in ONE job into a staging folder,
the row check (E3) reads the staged files back, and only verified days are
published: a new day by a folder move, a day that replaces another as a further version whose marker is put
last, so readers never miss a day, other days are never touched and a failed day keeps its former state.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.sinks import fs
from daylake.sources.catalog import Catalog
from daylake.sources.raw import DAY, current_versions, raw_dir, versions_dir

# Raw days are text only: zstd keeps them small at rest (reads are IO bound).
RAW_COMPRESSION = "zstd"
# Day folders moved side by side when a load is published.
PUBLISH_THREADS = 16


def storage_mapping(catalog: Catalog, source: str, header: list[str]) -> dict[str, int]:
    """B1: storage name -> cell position for one header; unknown or doubled names fail."""
    to_storage = catalog.native_to_storage(source)
    unknown = [h for h in header if h not in to_storage]
    if unknown:
        raise ValueError(f"{source}: columns not in the catalog: {unknown}")
    dup = sorted({h for h in header if header.count(h) > 1})
    if dup:
        raise ValueError(f"{source}: header names twice: {dup}")
    return {to_storage[h]: i for i, h in enumerate(header)}


def assert_all_strings(df: DataFrame) -> None:
    """Only text (or NULL) may enter the raw store."""
    bad = [f.name for f in df.schema.fields
           if f.name != DAY and not isinstance(f.dataType, T.StringType)]
    if bad:
        raise TypeError(f"raw store takes strings only; typed columns: {bad}")


def write_staged(df: DataFrame, stage: str, mode: str = "overwrite", lookup: tuple[str, ...] = ()) -> None:
    """One distributed write for all days; rows stay in their input splits (no shuffle).

    ``lookup`` names columns by whose values single rows are asked: they get Bloom filters, as large as a file's
    distinct values need (a multiple of candidates is filled and the smallest that fits is kept).
    """
    assert_all_strings(df)
    # The staging folder is new for every run: a plain (static) write, no
    # second staging level of dynamic partition overwrite.
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", RAW_COMPRESSION)
    for c in lookup:
        # Candidates from 512 bytes to a megabyte.
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.candidates.number#{c}", "12")
    if lookup:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.partitionBy(DAY).parquet(stage)


def write_empty_days(spark: SparkSession, catalog: Catalog, source: str, stage: str,
                     days: list[str]) -> None:
    """A day with 0 rows is one schema-only file (a partitioned write would skip it).

    One Spark job writes the schema-only file; each empty day gets a copy.
    """
    if not days:
        return
    template = f"{stage}/_empty"
    (spark.createDataFrame([], catalog.raw_schema(source)).coalesce(1)
     .write.mode("overwrite").option("compression", RAW_COMPRESSION).parquet(template))
    name = next(n for n in fs.list_children(spark, template) if n.endswith(".parquet"))
    for day in days:
        fs.copy(spark, f"{template}/{name}", f"{stage}/{DAY}={day}/part-00000-empty.parquet")


def staged_counts(spark: SparkSession, catalog: Catalog, source: str, stage: str) -> DataFrame:
    """Actual rows per staged day, read back from the files (independent of the text count)."""
    if not any(n.startswith(f"{DAY}=") for n in fs.list_children(spark, stage)):
        return spark.createDataFrame([], "load_date date, actual long")
    return (spark.read.schema(T.StructType(catalog.raw_schema(source).fields
                                           + [T.StructField(DAY, T.DateType())]))
            .parquet(stage).groupBy(DAY).agg(F.count(F.lit(1)).alias("actual")))


def publish_days(spark: SparkSession, lake: str, source: str, stage: str, days: list[str]) -> None:
    """Put each verified staged day in place (per-day replace).

    First load of a source (no raw folder yet, every staged day verified):
    the whole staging folder becomes the raw folder in one move.
    """
    if not days:
        return
    root = raw_dir(lake, source)
    wanted = {f"{DAY}={d}" for d in days}
    staged = {n for n in fs.list_children(spark, stage) if n.startswith(f"{DAY}=")}
    versions = current_versions(spark, lake, source)
    if not versions and not fs.exists(spark, root) and staged == wanted:
        fs.mkdirs(spark, root.rsplit("/", 1)[0])
        fs.rename(spark, stage, root)
        return
    existing = {*fs.list_children(spark, root), *versions}
    fs.mkdirs(spark, root)
    with ThreadPoolExecutor(max_workers=PUBLISH_THREADS) as pool:
        # Every day is tried; the first failure is raised when all are done.
        for done in [pool.submit(_publish_day, spark, lake, source, stage, n, n in existing) for n in sorted(wanted)]:
            done.result()


def _publish_day(spark: SparkSession, lake: str, source: str, stage: str, name: str, replaces: bool) -> None:
    """Put a staged day in place.  A new day is one move.  A day that replaces another is moved beside it as a further
    version, which no reader sees until its marker is there; the former one is dropped by the next load (:func:`sweep_days`)."""
    if not replaces:
        fs.rename(spark, f"{stage}/{name}", f"{raw_dir(lake, source)}/{name}")
        return
    root = versions_dir(lake, source)
    taken = [int(n[2:]) for n in fs.list_children(spark, f"{root}/{name}") if n.startswith("v=") and n[2:].isdigit()]
    n = max(taken, default=0) + 1
    fs.mkdirs(spark, f"{root}/{name}")
    fs.rename(spark, f"{stage}/{name}", f"{root}/{name}/v={n}")
    if not fs.create_new(spark, f"{root}/_current/{name}@{n}", uuid.uuid4().hex):
        raise IOError(f"{source} {name}: another writer has published version {n}")


def sweep_days(spark: SparkSession, lake: str, source: str) -> int:
    """Drop what no reader asks for any more: former days, their markers, and versions that a killed publish left
    without a marker.  Run when a load of the source begins; returns how many folders and markers went."""
    root, versions = raw_dir(lake, source), current_versions(spark, lake, source)
    gone = [f"{root}/{n}" for n in fs.list_children(spark, root) if n in versions]
    above = versions_dir(lake, source)
    for name in fs.list_children(spark, above):
        if name.startswith(f"{DAY}="):
            gone += [f"{above}/{name}/{v}" for v in fs.list_children(spark, f"{above}/{name}") if v != f"v={versions.get(name)}"]
    for mark in fs.list_children(spark, f"{above}/_current"):
        day, _, n = mark.rpartition("@")
        if day in versions and n != str(versions[day]):
            gone.append(f"{above}/_current/{mark}")
    for path in gone:
        fs.delete(spark, path)
    return len(gone)
