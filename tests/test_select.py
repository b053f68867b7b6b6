"""Dates, range clamp, day selection and range loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daylake.functions.dates import (business_today, clamp_columns, clamp_range, parse_date,
                                     register_today, strict_date)
from daylake.plans.load import ingest_range, update_all
from daylake.plans.select import select_days
from tests.conftest import write_part

D = dt.date
HH = "h:watchID\th:goalsID\th:date"


def loaded(spark, days, source="hits"):
    return spark.createDataFrame([(source, d) for d in days], "source string, load_date date")


def picked(spark, loaded_days, d1, d2, n, anchor):
    return [r["load_date"] for r in select_days(spark, "hits", loaded(spark, loaded_days), d1, d2,
                                                hot_window_days=n, anchor=anchor).collect()]


def test_select_skips_loaded_outside_window(spark):
    got = picked(spark, [D(2026, 5, 2), D(2026, 5, 3)], D(2026, 5, 1), D(2026, 5, 4), 3, D(2026, 5, 20))
    assert got == [D(2026, 5, 1), D(2026, 5, 4)]


def test_window_beats_skip(spark):
    got = picked(spark, [D(2026, 4, 29), D(2026, 5, 2), D(2026, 5, 3), D(2026, 5, 4)],
                 D(2026, 4, 28), D(2026, 5, 4), 3, D(2026, 5, 4))
    assert got == [D(2026, 4, 28), D(2026, 4, 30), D(2026, 5, 1), D(2026, 5, 2), D(2026, 5, 3),
                   D(2026, 5, 4)]


def test_window_off_and_negative(spark):
    assert picked(spark, [D(2026, 5, 4)], D(2026, 5, 3), D(2026, 5, 4), 0, D(2026, 5, 4)) == [D(2026, 5, 3)]
    with pytest.raises(ValueError):
        picked(spark, [], D(2026, 5, 3), D(2026, 5, 4), -1, D(2026, 5, 4))
    with pytest.raises(ValueError):
        picked(spark, [], D(2026, 5, 5), D(2026, 5, 4), 1, D(2026, 5, 4))


def test_clamp_and_parse():
    assert clamp_range(D(2026, 5, 1), D(2026, 5, 30), today=D(2026, 5, 24)) == (D(2026, 5, 1), D(2026, 5, 23))
    assert clamp_range(D(2026, 5, 1), D(2026, 5, 23), today=D(2026, 5, 24)) == (D(2026, 5, 1), D(2026, 5, 23))
    with pytest.raises(ValueError):
        clamp_range(D(2026, 5, 24), D(2026, 5, 30), today=D(2026, 5, 24))
    assert parse_date(" 2026-05-24 ") == D(2026, 5, 24)
    for bad in ["20260524", "2026-W21-1", "2026-13-01", "2026-05-40", "0000-00-00", "2026-5-1"]:
        with pytest.raises(ValueError):
            parse_date(bad)
    assert business_today(dt.datetime(2026, 5, 23, 22, 0, tzinfo=dt.timezone.utc)) == D(2026, 5, 24)


def test_column_forms(spark):
    df = spark.createDataFrame([("2026-05-24",), ("20260524",), ("2026-13-01",), (" 2026-05-24 ",)], "s string")
    assert [r[0] for r in df.select(strict_date(F.col("s"))).collect()] == [
        D(2026, 5, 24), None, None, D(2026, 5, 24)]
    req = spark.createDataFrame([(D(2026, 5, 1), D(2026, 5, 30)), (D(2026, 5, 25), D(2026, 5, 30))],
                                "d1 date, d2 date")
    d1, d2, ok = clamp_columns(F.col("d1"), F.col("d2"), F.lit(D(2026, 5, 24)))
    assert [tuple(r) for r in req.select(d2, ok).collect()] == [(D(2026, 5, 23), True), (D(2026, 5, 23), False)]
    register_today(spark)
    assert spark.sql("SELECT today() - 30 < today()").first()[0] is True


def test_range_load_resumes(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    for d in ["2026-05-01", "2026-05-02", "2026-05-03", "2026-05-04"]:
        write_part(landing, "hits", d, "p.tsv", f"{HH}\n1\t[]\t{d}\n")
    r1 = ingest_range(spark, lake, landing, mini_catalog, "hits", "2026-05-01", "2026-05-10",
                      hot_window_days=2, today=D(2026, 5, 5))
    assert r1.loaded_days == ["2026-05-01", "2026-05-02", "2026-05-03", "2026-05-04"]
    assert r1.total_rows == 4 and r1.failed_days == []
    r2 = ingest_range(spark, lake, landing, mini_catalog, "hits", "2026-05-01", "2026-05-04",
                      hot_window_days=2, today=D(2026, 5, 5))
    assert r2.loaded_days == ["2026-05-03", "2026-05-04"]
    assert r2.skipped_days == ["2026-05-01", "2026-05-02"]
    summary = {r["source"]: r for r in update_all(
        spark, lake, landing, mini_catalog, ["hits", "visits"], "2026-05-01", "2026-05-04",
        hot_window_days=0, today=D(2026, 5, 5)).collect()}
    assert summary["hits"]["skipped_days"] == 4 and summary["hits"]["error"] is None
    assert summary["visits"]["failed_days"] == 4     # nothing landed for visits


def test_update_all_parallel_sources(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    VH = "v:visitID\tv:dateTime\tv:watchIDs"
    for d in ["2026-05-01", "2026-05-02"]:
        write_part(landing, "hits", d, "p.tsv", f"{HH}\n1\t[]\t{d}\n2\t[]\t{d}\n")
        write_part(landing, "visits", d, "p.tsv", f"{VH}\n7\t{d} 00:00:00\t[1,2]\n")
    out = {r["source"]: r for r in update_all(
        spark, lake, landing, mini_catalog, ["hits", "visits"], "2026-05-01", "2026-05-02",
        hot_window_days=0, today=D(2026, 5, 5), parallel_sources=2).collect()}
    assert (out["hits"]["loaded_days"], out["hits"]["total_rows"]) == (2, 4)
    assert (out["visits"]["loaded_days"], out["visits"]["total_rows"]) == (2, 2)
    assert out["hits"]["error"] is None and out["visits"]["error"] is None
