"""Load journal (K1) and its reconcile against the real partitions.

The journal is append-only Parquet ``(source, load_date, row_count, loaded_at,
status, seq)``; the current state of a day is the row with the highest
``seq`` (``max_by``), so an upsert is an append and a delete is a tombstone
row with status ``removed``.  No MERGE and no rewrite is needed.

Numbers come from the journal itself, not from a clock: a writer takes the first number above all there are
by putting a claim file that must not exist yet, and tries the next one if another writer was faster.
So marks rank in the order in which they were begun, however the writers' clocks differ.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.sinks import fs
from daylake.sources.catalog import Catalog
from daylake.sources.raw import DAY, day_facts

LOADING, LOADED, FAILED, REMOVED = "loading", "loaded", "failed", "removed"
JOURNAL_SCHEMA = ("source string, load_date date, row_count long, "
                  "loaded_at timestamp_ntz, status string, seq long")

def journal_dir(lake: str) -> str:
    return f"{lake.rstrip('/')}/journal"


def claims_dir(lake: str) -> str:
    return f"{lake.rstrip('/')}/journal_claims"


def _numbers(spark: SparkSession, lake: str) -> list[int]:
    root = journal_dir(lake)
    folders = [n.split("=", 1)[1] for n in fs.list_children(spark, root) if n.startswith("seq=")]
    return [int(n) for n in folders + [c for c in fs.list_children(spark, claims_dir(lake)) if c.isdigit()]]


def last_seq(spark: SparkSession, lake: str) -> int:
    """The highest number taken so far (0: none)."""
    return max(_numbers(spark, lake), default=0)


def claim_seq(spark: SparkSession, lake: str) -> int:
    """A number above all taken ones, for this writer alone."""
    n = last_seq(spark, lake) + 1
    while not fs.create_new(spark, f"{claims_dir(lake)}/{n}", uuid.uuid4().hex):
        n += 1
    return n


def append_marks(spark: SparkSession, lake: str, marks: DataFrame) -> None:
    """Append marks ``(source, load_date, row_count, status)`` as one small file.

    Every batch of marks goes to its own folder ``journal/seq=<seq>``: writers
    never share a commit area (concurrent loads of different sources are
    safe) and ``seq`` comes back as a partition column.  ``loading`` /
    ``failed`` / ``removed`` carry no count and no time; ``loaded`` gets the
    time of the mark.
    """
    seq = claim_seq(spark, lake)
    done = F.col("status") == LOADED
    rows = marks.select(
        F.col("source").cast("string"), F.col(DAY).cast("date"),
        F.when(done, F.col("row_count")).cast("long").alias("row_count"),
        F.when(done, F.localtimestamp()).alias("loaded_at"),
        F.col("status").cast("string"))
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{journal_dir(lake)}/seq={seq}")


def mark(spark: SparkSession, lake: str, source: str, days: list[str], status: str,
         counts: dict[str, int] | None = None) -> None:
    if not days:
        return
    if status not in (LOADING, LOADED, FAILED, REMOVED):
        raise ValueError(f"unknown journal status {status!r}")
    if status == LOADED:
        bad = [d for d in days if (counts or {}).get(d) is None or (counts or {})[d] < 0]
        if bad:
            raise ValueError(f"'loaded' needs a row count >= 0; missing or negative for {bad[:5]}")
    data = [(source, d, (counts or {}).get(d), status) for d in days]
    df = spark.createDataFrame(data, "source string, load_date string, row_count long, status string")
    append_marks(spark, lake, df)


def history(spark: SparkSession, lake: str) -> DataFrame:
    if not fs.exists(spark, journal_dir(lake)):
        return spark.createDataFrame([], JOURNAL_SCHEMA)
    return spark.read.schema(JOURNAL_SCHEMA).parquet(journal_dir(lake))


def current(spark: SparkSession, lake: str) -> DataFrame:
    """K1: latest mark per (source, day); tombstoned days are absent."""
    return _latest(history(spark, lake))


def _latest(marks: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("row_count", "loaded_at", "status", "seq"), F.col("seq"))
    return (marks.groupBy("source", DAY).agg(last.alias("m"))
            .select("source", DAY, "m.row_count", "m.loaded_at", "m.status", "m.seq")
            .where(F.col("status") != REMOVED))


def compact_in_place(spark: SparkSession, lake: str) -> int:
    """Replace the listed mark folders by one that holds their state; returns the number of folders removed.

    Only the folders listed at the start are read, and the snapshot goes into the newest of them,
    so it ranks as that mark does: a mark appended meanwhile has a higher ``seq`` and stays the
    current one.  Then the older listed folders are dropped (a tombstoned day has no row in the
    snapshot; its tombstone goes with its old rows, or stays in the newest folder).
    """
    root = journal_dir(lake)
    old = sorted((n for n in fs.list_children(spark, root) if n.startswith("seq=")),
                 key=lambda n: int(n.split("=", 1)[1]))
    if len(old) <= 1:
        return 0
    listed = (spark.read.schema(JOURNAL_SCHEMA).option("basePath", root)
              .parquet(*[f"{root}/{n}" for n in old]))
    newest = int(old[-1].split("=", 1)[1])
    snapshot = _latest(listed).where(F.col("seq") < newest).drop("seq")
    snapshot.coalesce(1).write.mode("append").parquet(f"{root}/{old[-1]}")
    for n in old[:-1]:
        fs.delete(spark, f"{root}/{n}")
    # Claims below the newest folder are taken for good; its number keeps them so.
    for c in fs.list_children(spark, claims_dir(lake)):
        if c.isdigit() and int(c) < newest:
            fs.delete(spark, f"{claims_dir(lake)}/{c}")
    return len(old) - 1


def maybe_compact(spark: SparkSession, lake: str, max_folders: int = 500) -> None:
    """Compact once the journal holds more than ``max_folders`` mark folders."""
    if len(fs.list_children(spark, journal_dir(lake))) > max_folders:
        compact_in_place(spark, lake)


def reconcile_frame(spark: SparkSession, lake: str, catalog: Catalog, sources,
                    d1=None, d2=None) -> DataFrame:
    """K2 truth table as a frame over journal ∪ files (full outer join on the day key).

    Optional day bounds restrict both sides (a range load only needs its days).
    """
    facts = None
    for s in sources:
        f = day_facts(spark, lake, catalog, s, d1, d2)
        facts = f if facts is None else facts.unionByName(f)
    cur = current(spark, lake).where(F.col("source").isin(list(sources)))
    if d1 is not None:
        cur = cur.where(F.col(DAY) >= F.lit(d1).cast("date"))
    if d2 is not None:
        cur = cur.where(F.col(DAY) <= F.lit(d2).cast("date"))
    j = cur.join(facts, ["source", DAY], "full_outer")
    confirmed = (F.col("fact").isNotNull() & (F.col("status") == LOADED)
                 & (F.col("row_count") == F.col("fact")))
    return j.select("source", DAY, F.col("status").alias("journal_status"),
                    F.col("row_count").alias("journal_rows"), "fact",
                    F.coalesce(confirmed, F.lit(False)).alias("confirmed"),
                    (F.col("status").isNotNull() & ~F.coalesce(confirmed, F.lit(False)))
                    .alias("removed"))


def reconcile(spark: SparkSession, lake: str, catalog: Catalog, sources, d1=None, d2=None,
              path: str | None = None) -> DataFrame:
    """K2: check every known day (or the days of a range), drop journal rows that
    disagree with the facts.  Returns the report, materialised before the
    tombstones are appended; ``confirmed`` days are the loaded set.  The report is a table
    at ``path`` (default: a new folder of the lake's staging area); who names it may remove it after use.
    """
    maybe_compact(spark, lake)
    # Written as a small table (one row per day) to the lake's run folder: the
    # report must not change when the tombstones are appended, and no cached
    # plan over day files may outlive the next publish.
    path = path or f"{lake.rstrip('/')}/staging/reconcile-{uuid.uuid4().hex[:12]}"
    reconcile_frame(spark, lake, catalog, sources, d1, d2).write.parquet(path)
    report = spark.read.parquet(path)
    stale = report.where("removed").select("source", DAY, F.lit(None).cast("long").alias("row_count"),
                                           F.lit(REMOVED).alias("status"))
    if stale.take(1):
        append_marks(spark, lake, stale)
    return report
