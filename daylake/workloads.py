"""Workloads over the given tables: the driver tables play the log sources.

* ``events``   -> hits-like source (one row per event, day of ``ts``);
* ``lineitem`` -> hits-like source with a UInt64-style id above 2^63;
* ``orders``   -> visits-like source: its lines as parallel arrays built by
  Spark from ``lineitem`` + ``part`` (array keys link to ``lineitem``).

Every lake lives in a fresh folder below the shared root
(``spark.checkpoint.dir``).  The base lake of a session is built once and
reused by the read queries; queries that change a lake build their own.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.operators.relations import bounded_lists
from daylake.plans.load import load_days
from daylake.session import new_work_dir, tune_for_day_folders
from daylake.sinks import fs
from daylake.sources.catalog import Catalog, load_catalog
from daylake.sources.landing import source_dir, write_landing
from daylake.functions.dates import register_today
from daylake.views import register_views, typed_source

DAY = "load_date"
# Fixed value: the offset that puts the test ids above 2^63, like real UInt64 ids.
ID_BASE = Decimal("17298374650000000000")
SOURCES = ("events", "lineitem", "orders")
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base_id() -> F.Column:
    return F.lit(ID_BASE).cast("decimal(38,0)")


def events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", F.to_date("ts").alias("date"), "user_id", "event_type",
                     "value", "props", F.to_date("ts").alias(DAY))


def _line_id(order: F.Column, number: F.Column) -> F.Column:
    return (_base_id() + order.cast("decimal(20,0)") * 10 + number).cast("decimal(38,0)")


def _gathered(df: DataFrame) -> DataFrame:
    """Rows of a day together (AQE splits a hot day), before what can be derived from them is added."""
    return df.hint("rebalance", DAY)


def lineitem_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    day = _gathered(li.withColumn(DAY, F.to_date("l_shipdate")))
    return day.select(_line_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_id"), *li.columns,
                      F.col(DAY).alias("date"), DAY)


def orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as parallel arrays, one row per (order, ``list_part``).

    Ids and labels of the lines are made from their numbers and names when all else is in place, so no shuffle moves them.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.concat("p_brand", F.lit(', "'), "p_type", F.lit('"')).alias("p_kind"))
    lines = li.join(part, li.l_partkey == part.p_partkey, "left").select("l_orderkey", *LINE_ORDER, "p_name", "p_kind")
    lists = bounded_lists(lines, ["l_orderkey"], LINE_ORDER,
                          ["l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "p_name", "p_kind"])
    o = table(spark, sf_dir, "orders")
    j = _gathered(o.join(lists, o.o_orderkey == lists.l_orderkey, "left").drop("l_orderkey")
                  .withColumn(DAY, F.to_date("o_orderdate")))
    empty = F.array()
    j = j.withColumns({"l_linenumber": F.coalesce("l_linenumber", empty.cast("array<int>")),
                       "p_name": F.coalesce("p_name", empty.cast("array<string>"))})
    label = F.zip_with("p_name", "p_kind", lambda name, kind: F.concat(name, F.lit("'s "), kind))
    return j.select(
        (_base_id() + F.col("o_orderkey")).cast("decimal(38,0)").alias("order_id"),
        "o_orderkey", F.coalesce("list_part", F.lit(0)).alias("list_part"),
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.col(DAY).alias("date"), "o_orderpriority",
        (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
        F.array_size("l_linenumber").cast("smallint").alias("n_lines"),
        F.transform("l_linenumber", lambda n: _line_id(F.col("o_orderkey"), n)).alias("line_ids"),
        F.col("l_linenumber").alias("line_numbers"),
        F.coalesce("l_quantity", empty.cast("array<double>")).alias("quantities"),
        F.coalesce("l_shipdate", empty.cast("array<timestamp_ntz>")).alias("ship_times"),
        F.coalesce("l_returnflag", empty.cast("array<string>")).alias("return_flags"),
        F.col("p_name").alias("part_names"),
        F.coalesce(label, empty.cast("array<string>")).alias("part_labels"), DAY)


FRAMES = {"events": events_frame, "lineitem": lineitem_frame, "orders": orders_frame}
PARTS_PER_DAY = {"events": 4, "lineitem": 1, "orders": 1}
GATHERED = ("lineitem", "orders")  # frames that bring the rows of a day together themselves


@dataclass
class Lake:
    root: str
    lake: str
    landing: str
    catalog: Catalog
    sf_dir: str

    def typed(self, spark: SparkSession, source: str, keep_day: bool = False) -> DataFrame:
        return typed_source(spark, self.lake, self.catalog, source, keep_day)

    def views(self, spark: SparkSession, sources=SOURCES, prefix: str = "") -> dict[str, DataFrame]:
        return register_views(spark, self.lake, self.catalog, sources, prefix)


def new_lake(spark: SparkSession, sf_dir: str, tag: str) -> Lake:
    tune_for_day_folders(spark)
    root = new_work_dir(spark, tag)
    return Lake(root, f"{root}/lake", f"{root}/landing", load_catalog(spark), sf_dir)


def landed_days(spark: SparkSession, lake: Lake, source: str) -> list[str]:
    return sorted(n.split("=", 1)[1] for n in fs.list_children(spark, source_dir(lake.landing, source))
                  if n.startswith(f"{DAY}="))


def land(spark: SparkSession, lake: Lake, source: str, frame: DataFrame | None = None,
         parts_per_day: int | None = None) -> None:
    gathered = frame is None and source in GATHERED and parts_per_day is None
    frame = frame if frame is not None else FRAMES[source](spark, lake.sf_dir)
    write_landing(frame, lake.landing, source, lake.catalog,
                  parts_per_day=parts_per_day or PARTS_PER_DAY[source], gathered=gathered)


def load_all(spark: SparkSession, lake: Lake, source: str) -> DataFrame:
    return load_days(spark, lake.lake, lake.landing, lake.catalog, source,
                     landed_days(spark, lake, source))


_lock = threading.RLock()
_memo: dict = {}


def memo(spark: SparkSession, key: tuple, build):
    """Build once per (session, key); lakes are folders, so they outlive nothing but the run."""
    k = (spark.sparkContext.applicationId,) + key
    with _lock:
        if k not in _memo:
            _memo[k] = build()
        return _memo[k]


def base_lake(spark: SparkSession, sf_dir: str, sources=SOURCES) -> Lake:
    """The shared lake of a session; each source is landed and loaded once, on first use."""
    lake = memo(spark, ("base", sf_dir), lambda: new_lake(spark, sf_dir, "base"))
    for s in sources:
        def build(s=s):
            land(spark, lake, s)
            return load_all(spark, lake, s)
        memo(spark, ("base", sf_dir, s), build)
    return lake


def base_views(spark: SparkSession, sf_dir: str, sources=SOURCES) -> dict[str, DataFrame]:
    """Typed views of the base lake.  The base lake does not change after its
    load, so each source's frame (and its file listing) is built once; the temp
    views are registered again on every call (no job, no listing)."""
    lake = base_lake(spark, sf_dir, sources)
    frames = {s: memo(spark, ("base-view", sf_dir, s), lambda s=s: lake.typed(spark, s))
              for s in sources}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    register_today(spark)
    return frames
