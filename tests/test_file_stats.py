"""Statistics of day files: merged profiles, and filters that choose files by typed bounds."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import write_part
from daylake.operators import profile as prof
from daylake.plans import file_stats
from daylake.plans.load import load_days
from daylake.views import typed_source

HV = "v:visitID\tv:clientID\tv:watchIDs\tv:date\tv:pageViews\tv:dateTime"
DAYS = [f"2026-05-{d:02d}" for d in range(1, 9)]


def visits(landing, days=DAYS, seed=1, shift=0):
    """Ids rise from day to day; some cells can't be typed."""
    rnd = random.Random(seed)
    for n, d in enumerate(days):
        lines = []
        for k in range(30):
            views = rnd.choice([str(rnd.randint(0, 500)), "many", ""])
            lines.append(f"{(n + shift) * 1000 + k}\t{rnd.randint(1, 40)}\t[1,2]\t{d}\t{views}\t{d} 10:00:{k:02d}")
        write_part(landing, "visits", d, "a.tsv", "\n".join([HV, *lines]) + "\n")


def loaded(spark, catalog, lake_dirs, **kw):
    lake, landing = lake_dirs
    visits(landing, **kw)
    assert {r.status for r in load_days(spark, lake, landing, catalog, "visits", kw.get("days", DAYS)).collect()} == {"loaded"}
    return lake


def test_summarize_merged_equals_summarize(spark, mini_catalog, lake_dirs):
    lake = loaded(spark, mini_catalog, lake_dirs)
    view = typed_source(spark, lake, mini_catalog, "visits")
    exact = {r.column_name: r for r in prof.summarize(view).collect()}
    got = {r.column_name: r for r in file_stats.summarize_merged(spark, lake, mini_catalog, "visits").collect()}
    assert list(got) == list(exact)
    for name, r in got.items():
        e = exact[name]
        assert (r.column_type, r.min, r.max, r["count"], r.null_percentage) == (e.column_type, e.min, e.max, e["count"], e.null_percentage), name
        assert (r.avg is None) == (e.avg is None) and (r.avg is None or r.avg == pytest.approx(e.avg, abs=1e-4)), name  # the exact one is rounded to 4 places for HUGEINT
        assert (r.std is None) == (e.std is None) and (r.std is None or r.std == pytest.approx(e.std)), name
    views = sorted(x.page_views for x in view.where("page_views IS NOT NULL").collect())
    assert got["page_views"].q50 in (views[len(views) // 2 - 1], views[len(views) // 2], statistics.median(views))
    assert got["client_id"].approx_unique == view.select("client_id").distinct().count()
    assert got["watch_ids"].approx_unique is None


def test_statistics_are_written_once_and_follow_a_reload(spark, mini_catalog, lake_dirs):
    lake = loaded(spark, mini_catalog, lake_dirs)
    files = file_stats.file_stats(spark, lake, mini_catalog, "visits")
    n = files.count()
    assert files.where("n IS NULL").count() == n > 0
    assert file_stats.refresh(spark, lake, mini_catalog, "visits") == n
    assert file_stats.refresh(spark, lake, mini_catalog, "visits") == 0
    # One day comes again with other ids: only its files are read for new statistics, and the old ones count no more.
    visits(lake_dirs[1], days=DAYS[:1], shift=50)
    load_days(spark, lake, lake_dirs[1], mini_catalog, "visits", DAYS[:1])
    assert 0 < file_stats.refresh(spark, lake, mini_catalog, "visits") < n
    told = {r.column_name: r for r in file_stats.summarize_merged(spark, lake, mini_catalog, "visits").collect()}
    assert (told["visit_id"].min, told["visit_id"].max, told["visit_id"]["count"]) == ("1000", "50029", 240)
    # A copy of the same statistics changes nothing.
    copy = spark.read.parquet(file_stats.stats_dir(lake, "visits")).collect()
    spark.createDataFrame(copy, file_stats._struct(mini_catalog, "visits")).write.mode("append").parquet(file_stats.stats_dir(lake, "visits"))
    again = {r.column_name: r for r in file_stats.summarize_merged(spark, lake, mini_catalog, "visits").collect()}
    assert again["visit_id"]["count"] == 240


def test_context_and_counts_from_statistics(spark, mini_catalog, lake_dirs):
    lake = loaded(spark, mini_catalog, lake_dirs)
    sources = ["visits", "hits"]  # hits has no day
    frames = {s: typed_source(spark, lake, mini_catalog, s) for s in sources}
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(file_stats.context_merged(spark, lake, mini_catalog, sources)) == key(prof.context_profile(frames))
    counts = file_stats.column_counts_merged(spark, lake, mini_catalog, sources)
    assert key(counts) == key(prof.column_counts(frames))
    empty = prof.drift_report(spark, frames, mini_catalog, counts).where("issue = 'no value in any row'")
    assert {r.table_name for r in empty.collect()} == {"hits"}
    assert prof.drift_report(spark, frames, mini_catalog, names_only=True).where("issue = 'no value in any row'").count() == 0
    merged = file_stats.summarize_merged(spark, lake, mini_catalog, "hits").collect()
    assert [(r["count"], r["min"], r.avg, r.q50) for r in merged] == [(0, None, None, None)] * len(merged)


def test_where_between_reads_only_files_that_can_match(spark, mini_catalog, lake_dirs):
    lake = loaded(spark, mini_catalog, lake_dirs)
    view = typed_source(spark, lake, mini_catalog, "visits")

    def check(column, low, high, **kw):
        got = file_stats.where_between(spark, lake, mini_catalog, "visits", column, low, high, **kw)
        cond = F.col(column).isNotNull()
        if low is not None:
            cond = cond & (F.col(column) >= F.lit(low))
        if high is not None:
            cond = cond & (F.col(column) <= F.lit(high))
        assert sorted(map(repr, got.frame.collect())) == sorted(map(repr, view.where(cond).collect()))
        return got

    # Without statistics every file is read.
    before = check("visit_id", 2010, 3005)
    assert before.files == before.all_files
    file_stats.refresh(spark, lake, mini_catalog, "visits")
    hit = check("visit_id", 2010, 3005)
    assert 0 < hit.files < hit.all_files
    # The scan's input files are those counted.
    assert len(hit.frame.inputFiles()) == hit.files
    assert check("visit_id", 900_000, None).files == 0
    assert check("visit_id", None, 500).files < hit.all_files
    assert check("page_views", 100, 120).files <= hit.all_files
    assert check("visit_id", 2010, 3005, max_files=1).files == hit.files
    with pytest.raises(ValueError, match="no order"):
        file_stats.where_between(spark, lake, mini_catalog, "visits", "watch_ids", 1, 2)


def test_a_range_load_writes_statistics(spark, mini_catalog, lake_dirs):
    import datetime as dt
    from daylake.plans.load import update_all
    lake, landing = lake_dirs
    visits(landing)
    rep = update_all(spark, lake, landing, mini_catalog, ["visits"], DAYS[0], DAYS[3], today=dt.date(2026, 5, 6), stats=True).first()
    assert (rep.loaded_days, rep.error) == (4, None)
    stats = file_stats.file_stats(spark, lake, mini_catalog, "visits")
    assert stats.where("n IS NULL").count() == 0 and stats.agg(F.sum("n")).first()[0] == 120
