"""Load pipelines: days of one source (K4), a date range (K5), all sources (K6), totals.

``load_days`` handles all selected days of a source with a fixed number of
jobs, whatever the number of days:

1. text scan + hash aggregate -> one row per part file (header, line count,
   width check); no data row is shuffled;
2. the text again, without the lines equal to their day's header (a day's parts share one header), cells renamed
   by the catalog (B1), ONE staged write for all days; a part in which its header's text comes again as a row
   gets those rows back by a small second write.  Nothing ties the splits of the two passes together;
3. staged files counted back per day (footers only) and compared with the
   text count (E3);
4. verified days published by a folder move per day; journal marks per batch.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daylake.functions.dates import clamp_range
from daylake.operators.rowcheck import check_frame
from daylake.plans import file_stats, journal
from daylake.plans.select import DEFAULT_HOT_WINDOW_DAYS, select_days
from daylake.sinks import fs
from daylake.sinks.raw_store import (publish_days, staged_counts, storage_mapping,
                                     sweep_days, write_empty_days, write_staged)
from daylake.sources.catalog import Catalog
from daylake.sources.landing import (cells, day_expectations, day_in, header_texts, lines_of,
                                     open_parts, part_stats, parts_per_day, source_dir, tab_count)

DAY = "load_date"
BATCH_FILES_MAX = 100_000      # part files per load batch (bounds driver lists and staging)

REPORT_SCHEMA = ("source string, load_date date, n_parts long, expected long, actual long, "
                 "status string, error string")


def _report(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def day_batches(per_day: dict[str, int], days: list[str], max_files: int) -> list[list[str]]:
    """Split days (ascending) into batches of at most ``max_files`` part files
    (a day is never split; a day above the bound is a batch of its own)."""
    batches, cur, n = [], [], 0
    for d in days:
        k = per_day.get(d, 0)
        if cur and n + k > max_files:
            batches.append(cur)
            cur, n = [], 0
        cur.append(d)
        n += k
    if cur:
        batches.append(cur)
    return batches


def load_days(spark: SparkSession, lake: str, landing: str, catalog: Catalog, source: str,
              days, *, run_id: str | None = None, max_files: int = BATCH_FILES_MAX,
              rebalance: bool = False, lookup: tuple[str, ...] = ()) -> DataFrame:
    """K4 for many days at once; returns the per-day report (one row per requested day).

    Days whose part files exceed ``max_files`` are loaded in several batches,
    each a complete load; the plan needs only a per-day file count.

    An error that stops a batch marks its days failed (days it had published stay); the other batches
    are still tried, then the first error is raised, with the report of all days as its ``report``.  This does
    not depend on how many batches there are.

    ``rebalance=True`` shuffles rows by day before the write (AQE sizes the
    files): one shuffle more, for sources whose exports come as many tiny parts.
    By default the write is map-only and files follow the input splits.
    ``lookup``: columns that get Bloom filters (see ``file_stats.lookup``).
    """
    days = sorted({str(d) for d in days})
    if not days:
        return _report(spark, [])
    catalog.fields_for(source)
    batches: list[tuple[list[str], DataFrame | None]] = [(days, None)]
    parts = open_parts(spark, landing, source, days)
    if parts is not None:
        # The one listing plans the batches; a single batch reads it, too.
        per_day = parts_per_day(parts)
        if sum(per_day.get(d, 0) for d in days) <= max_files:
            batches = [(days, parts)]
        else:
            batches = [(b, None) for b in day_batches(per_day, days, max_files)]
    sweep_days(spark, lake, source)
    reports = []
    errors = []
    for i, (b, opened) in enumerate(batches):
        try:
            reports.append(_load_batch(spark, lake, landing, catalog, source, b, parts=opened,
                                       run_id=f"{run_id}-{i}" if run_id else None, rebalance=rebalance, lookup=lookup))
        except Exception as exc:  # noqa: BLE001 - raised again below
            errors.append(exc)
            reports.append(_report(spark, [(source, _dt.date.fromisoformat(d), 0, None, None, "failed",
                                            f"{type(exc).__name__}: {exc}"[:500]) for d in b]))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    if errors:
        errors[0].report = out
        raise errors[0]
    return out


def _load_batch(spark: SparkSession, lake: str, landing: str, catalog: Catalog, source: str,
                days: list[str], *, parts: DataFrame | None = None,
                run_id: str | None = None, rebalance: bool = False, lookup: tuple[str, ...] = ()) -> DataFrame:
    """One batch: loading marks -> checks -> staged write -> row check -> publish -> marks.

    Any error marks every day of the batch ``failed`` and is raised again (days
    of earlier batches stay committed); the run's staging folder is removed.
    """
    catalog.fields_for(source)
    run_id = run_id or uuid.uuid4().hex[:12]
    run_dir = f"{lake.rstrip('/')}/staging/{run_id}"
    journal.mark(spark, lake, source, days, journal.LOADING)
    try:
        return _run_batch(spark, lake, landing, catalog, source, days, parts, run_dir, rebalance, lookup)
    except Exception:
        journal.mark(spark, lake, source, days, journal.FAILED)
        raise
    finally:
        fs.delete(spark, run_dir)


def _run_batch(spark: SparkSession, lake: str, landing: str, catalog: Catalog, source: str,
               days: list[str], parts: DataFrame | None, run_dir: str,
               rebalance: bool = False, lookup: tuple[str, ...] = ()) -> DataFrame:
    stage = f"{run_dir}/{source}"

    parts = parts if parts is not None else open_parts(spark, landing, source, days)
    if parts is None:
        rows = [(source, _dt.date.fromisoformat(d), 0, None, None, "failed", "no landed parts")
                for d in days]
        journal.mark(spark, lake, source, days, journal.FAILED)
        return _report(spark, rows)

    # Pass 1: one row per part file.
    # Written once to the run's folder (shared storage): later steps read the
    # small table instead of scanning the text again, and lineage is cut.
    parts_path = f"{run_dir}/_parts/{source}"
    part_stats(lines_of(parts)).write.mode("overwrite").parquet(parts_path)
    stats = spark.read.parquet(parts_path)
    per_day = {str(r[DAY]): r for r in day_expectations(stats).collect()}
    # One part for each header that a whole day shares (mostly one in all).
    samples = {r["header_key"]: r["sample"] for r in per_day.values() if r["n_headers"] == 1}
    texts = header_texts(spark, landing, source, samples)
    # A landed day without a single line (all its parts are empty) is a day of 0 rows.
    blank: list[str] = []

    result: dict[str, dict] = {}
    headers: list[str] = []
    mappings: list[dict[str, int]] = []
    good: list[str] = []
    for d in days:
        r = per_day.get(d)
        res = {"n_parts": 0, "expected": None, "actual": None, "status": "failed", "error": None}
        result[d] = res
        if r is None:
            folder = f"{source_dir(landing, source)}/{DAY}={d}"
            names = [n for n in fs.list_children(spark, folder) if not n.startswith(("_", "."))]
            if names:
                res["n_parts"], res["expected"] = len(names), 0
                blank.append(d)
            else:
                res["error"] = "no landed parts"
            continue
        res["n_parts"], res["expected"] = r["n_parts"], r["expected"]
        if r["n_headers"] > 1:
            res["error"] = "parts of the day have different headers"
            continue
        if not r["text_ok"]:
            res["error"] = "the text is not UTF-8"
            continue
        if not r["width_ok"]:
            res["error"] = "a row is not as wide as its header"
            continue
        header = texts[r["header_key"]]
        if header not in headers:
            try:
                mappings.append(storage_mapping(catalog, source, header.split("\t")))
            except ValueError as exc:
                res["error"] = str(exc)
                continue
            headers.append(header)
        good.append(d)

    wide = [d for d in days if result[d]["error"] == "a row is not as wide as its header"]
    if wide:
        # Rare path: one small job names an example row per failed day.
        shown = [h for h in {texts[per_day[d]["header_key"]] for d in wide}]
        of_day = spark.createDataFrame([(d, shown.index(texts[per_day[d]["header_key"]])) for d in wide], "load_date string, hid int")
        of_day = of_day.select(F.col(DAY).cast("date").alias(DAY), "hid")
        width = F.element_at(F.array(*[F.lit(h.count("\t")) for h in shown]), F.col("hid") + 1)
        examples = (lines_of(parts, ordered=False).where(day_in(wide))
                    .join(F.broadcast(of_day), DAY).where(tab_count(F.col("line")) != width)
                    .groupBy(DAY).agg(F.min("line").alias("example")).collect())
        for r in examples:
            result[str(r[DAY])]["error"] += f"; e.g. {r['example'][:200]!r}"

    if good:
        # Pass 2.  All parts of a good day share one header: only (day, header id) is broadcast, a row per day of the batch.
        day_hid = spark.createDataFrame(
            [(d, headers.index(texts[per_day[d]["header_key"]])) for d in good], "load_date string, hid int"
        ).select(F.col(DAY).cast("date").alias(DAY), "hid")
        header_text = F.element_at(F.array(*[F.lit(h) for h in headers]), F.col("hid") + 1)
        is_header = F.col("line") == header_text
        lines = lines_of(parts, ordered=False).where(day_in(good)).join(F.broadcast(day_hid), DAY)
        dropped = Observation()
        rows = lines.observe(dropped, F.count_if(is_header).alias("headers")).where(~is_header)

        def stored(lines: DataFrame) -> DataFrame:
            split = lines.select(DAY, "hid", cells(F.col("line")).alias("cells"))
            out = []
            for f in catalog.fields_for(source):
                expr = None
                for i, m in enumerate(mappings):
                    if f.storage_name in m:
                        val = F.get(F.col("cells"), m[f.storage_name])
                        expr = (F.when(F.col("hid") == i, val) if expr is None
                                else expr.when(F.col("hid") == i, val))
                out.append((expr if expr is not None else F.lit(None)).cast("string").alias(f.storage_name))
            return split.select(*out, DAY)

        staged = stored(rows)
        if rebalance:
            staged = staged.hint("rebalance", DAY)
        write_staged(staged, stage, lookup=lookup)
        n_files = sum(per_day[d]["n_parts"] for d in good)
        if dropped.get["headers"] < n_files:
            raise RuntimeError(f"{source}: the second pass did not find the headers of the first")
        if dropped.get["headers"] > n_files:
            # Rare path: some part holds its header's text again.  All but the first of each part are rows like others.
            again = (lines.where(is_header).groupBy(DAY, "hid", "file").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select(DAY, "hid", header_text.alias("line"), F.explode(F.sequence(F.lit(2).cast("long"), F.col("n")))))
            write_staged(stored(again), stage, mode="append", lookup=lookup)

    if good or blank:
        write_empty_days(spark, catalog, source, stage,
                         blank + [d for d in good if per_day[d]["expected"] == 0])
        expected = spark.createDataFrame([(d, result[d]["expected"]) for d in good + blank],
                                         "load_date string, expected long").withColumn(
            DAY, F.col(DAY).cast("date"))
        checked = check_frame(expected, staged_counts(spark, catalog, source, stage)).collect()
        for c in checked:
            res = result[str(c[DAY])]
            res["actual"] = c["actual"]
            if c["ok"]:
                res["status"] = "loaded"
            else:
                res["error"] = f"row check: expected {c['expected']}, written {c['actual']}"

    ok_days = [d for d in days if result[d]["status"] == "loaded"]
    publish_days(spark, lake, source, stage, ok_days)
    journal.mark(spark, lake, source, ok_days, journal.LOADED,
                 {d: result[d]["actual"] for d in ok_days})
    journal.mark(spark, lake, source, [d for d in days if result[d]["status"] != "loaded"],
                 journal.FAILED)
    return _report(spark, [(source, _dt.date.fromisoformat(d), result[d]["n_parts"],
                            result[d]["expected"], result[d]["actual"], result[d]["status"],
                            result[d]["error"]) for d in days])


@dataclass
class RangeResult:
    source: str
    loaded_days: list[str]
    skipped_days: list[str]
    failed_days: list[str]
    total_rows: int
    report: DataFrame


def ingest_range(spark: SparkSession, lake: str, landing: str, catalog: Catalog, source: str,
                 date1, date2, *, hot_window_days: int = DEFAULT_HOT_WINDOW_DAYS,
                 today: _dt.date | None = None, stats: bool = False) -> RangeResult:
    """K5: validate -> clamp -> reconcile -> select -> load; a rerun resumes.

    ``stats=True`` also writes the statistics of the range's new day files (one more scan of them), so that profiles,
    range filters and lookups find them.
    """
    from daylake.functions.dates import parse_date
    d1 = parse_date(date1) if isinstance(date1, str) else date1
    d2 = parse_date(date2) if isinstance(date2, str) else date2
    if hot_window_days < 0:
        raise ValueError(f"hot window must be >= 0, got {hot_window_days}")
    catalog.fields_for(source)
    d1, d2 = clamp_range(d1, d2, today)
    if today is not None:
        anchor = today - _dt.timedelta(days=1)
    else:
        from daylake.functions.dates import business_yesterday
        anchor = business_yesterday()
    rec_path = f"{lake.rstrip('/')}/staging/reconcile-{source}-{uuid.uuid4().hex[:12]}"
    rec = journal.reconcile(spark, lake, catalog, [source], d1, d2, path=rec_path)
    confirmed = rec.where("confirmed").select("source", DAY)
    chosen = [str(r[DAY]) for r in select_days(spark, source, confirmed, d1, d2,
                                               hot_window_days=hot_window_days,
                                               anchor=anchor).collect()]
    fs.delete(spark, rec_path)
    all_days = [str(d1 + _dt.timedelta(days=i)) for i in range((d2 - d1).days + 1)]
    report = load_days(spark, lake, landing, catalog, source, chosen)
    st = {str(r[DAY]): (r["status"], r["actual"]) for r in report.select(DAY, "status", "actual").collect()}
    loaded = [d for d in chosen if st[d][0] == "loaded"]
    if stats:
        file_stats.refresh(spark, lake, catalog, source, d1, d2)
    # A registered view keeps its file listing: re-register after publishing.
    from daylake.views import register_views
    register_views(spark, lake, catalog, [source])
    return RangeResult(source, loaded, [d for d in all_days if d not in chosen],
                       [d for d in chosen if st[d][0] != "loaded"],
                       sum(st[d][1] or 0 for d in loaded), report)


def update_all(spark: SparkSession, lake: str, landing: str, catalog: Catalog, sources,
               date1, date2, *, parallel_sources: int = 1, **kw) -> DataFrame:
    """K6 + E10: every source is tried even when another fails; one summary row each.

    ``parallel_sources`` > 1 submits the sources' jobs from that many threads
    (one SparkSession, independent day folders and journal files), so small
    sources do not leave a large cluster idle.
    """
    def one(s):
        start = journal.last_seq(spark, lake)
        try:
            r = ingest_range(spark, lake, landing, catalog, s, date1, date2, **kw)
            return (s, len(r.loaded_days), len(r.skipped_days), len(r.failed_days), r.total_rows, None)
        except Exception as exc:  # noqa: BLE001 - one source must not stop the others
            # What had been published before the error is loaded: the journal tells.
            done = journal.current(spark, lake).where(
                (F.col("source") == s) & (F.col("status") == journal.LOADED) & (F.col("seq") > start)
            ).agg(F.count(F.lit(1)), F.sum("row_count")).first()
            return (s, done[0], 0, 0, done[1] or 0, f"{type(exc).__name__}: {exc}")

    sources = list(sources)
    if parallel_sources > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel_sources) as pool:
            rows = list(pool.map(one, sources))
    else:
        rows = [one(s) for s in sources]
    return spark.createDataFrame(rows, "source string, loaded_days long, skipped_days long, "
                                       "failed_days long, total_rows long, error string")
