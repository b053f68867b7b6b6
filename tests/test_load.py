"""Landing parts -> checked, verified raw days -> typed views."""

import datetime as dt
from decimal import Decimal


from daylake.plans import journal
from daylake.plans.load import load_days
from daylake.sources.landing import day_expectations, part_stats, scan_lines
from daylake.sources.raw import day_facts, list_day_files, scan_raw
from daylake.views import register_views, typed_source
from tests.conftest import write_part

VH = "v:visitID\tv:dateTime\tv:watchIDs"
HH = "h:watchID\th:goalsID\th:date"


def counts(spark, landing, source="visits"):
    st = day_expectations(part_stats(scan_lines(spark, landing, source))).collect()
    return {str(r["load_date"]): r for r in st}


def test_part_counts(spark, lake_dirs):
    _, landing = lake_dirs
    write_part(landing, "visits", "2026-05-01", "a.tsv", f"{VH}\n1\tx\t[]\n2\tx\t[]\n")
    write_part(landing, "visits", "2026-05-02", "a.tsv", f"{VH}\n")
    write_part(landing, "visits", "2026-05-03", "a.tsv", "")
    write_part(landing, "visits", "2026-05-04", "a.tsv", f"{VH}\r\n1\tx\t[]\r\n\r\n2\tx\t[]\r\n")
    write_part(landing, "visits", "2026-05-05", "a.tsv", f"{VH}\n1\ta\vb c\x85d\t[]\n")
    write_part(landing, "visits", "2026-05-06", "a.tsv", f"{VH}\n1\tx\t[]\n2\tx\t[]\n")
    write_part(landing, "visits", "2026-05-06", "b.tsv", f"{VH}\n3\tx\t[]\n4\tx\t[]\n5\tx\t[]\n")
    c = counts(spark, landing)
    assert c["2026-05-01"]["expected"] == 2
    assert c["2026-05-02"]["expected"] == 0
    assert "2026-05-03" not in c          # an empty part has no line at all
    assert c["2026-05-04"]["expected"] == 2
    assert c["2026-05-05"]["expected"] == 1
    assert c["2026-05-06"]["expected"] == 5 and c["2026-05-06"]["n_parts"] == 2


def test_load_typed_roundtrip_and_bad_cells(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "visits", "2026-05-20", "p1.tsv",
               f"{VH}\tv:date\tv:pageViews\n"
               "17298374650000000001\t2026-05-20 12:34:56\t[8273645,8273646]\t2026-05-20\t7\n"
               "17298374650000000002\t2026-05-20 13:01:02\t[8273647]\tnot-a-date\tabc\n")
    write_part(landing, "visits", "2026-05-20", "p2.tsv",
               f"{VH}\tv:date\tv:pageViews\n3\tgarbage\tgarbage\t\t\n")
    rep = load_days(spark, lake, landing, mini_catalog, "visits", ["2026-05-20"]).first()
    assert (rep["expected"], rep["actual"], rep["status"], rep["n_parts"]) == (3, 3, "loaded", 2)
    v = {r["visit_id"]: r for r in typed_source(spark, lake, mini_catalog, "visits").collect()}
    a = v[Decimal("17298374650000000001")]
    assert a["watch_ids"] == [Decimal(8273645), Decimal(8273646)]
    assert a["date"] == dt.date(2026, 5, 20) and a["page_views"] == 7
    assert a["date_time"] == dt.datetime(2026, 5, 20, 12, 34, 56)
    b = v[Decimal("17298374650000000002")]
    assert b["date"] is None and b["page_views"] is None and b["watch_ids"] == [Decimal(8273647)]
    c = v[Decimal(3)]
    assert c["watch_ids"] is None and c["date_time"] is None and c["client_id"] is None


def test_raw_keeps_text_verbatim(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "p.tsv",
               f"{HH}\n1\t\t2026-05-20\n2\tsay \"hi\"\t[8273645,8273646]\n")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"])
    raw = {r["watch_id"]: r for r in scan_raw(spark, lake, mini_catalog, "hits").collect()}
    assert raw["1"]["goals_id"] == ""
    assert raw["2"]["goals_id"] == 'say "hi"' and raw["2"]["date"] == "[8273645,8273646]"


def test_reload_replaces_only_that_day(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "p.tsv", f"{HH}\n1\t[]\t2026-05-20\n")
    write_part(landing, "hits", "2026-05-21", "p.tsv", f"{HH}\n9\t[]\t2026-05-21\n")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20", "2026-05-21"])
    views = register_views(spark, lake, mini_catalog, ["hits"])
    assert views["hits"].count() == 2
    write_part(landing, "hits", "2026-05-20", "p.tsv",
               f"{HH}\n1\t[]\t2026-05-20\n2\t[]\t2026-05-20\n3\t[1001,1002]\t2026-05-20\n")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"])
    register_views(spark, lake, mini_catalog, ["hits"])
    per_day = dict(spark.sql("SELECT date, count(*) FROM hits GROUP BY date").collect())
    assert per_day == {dt.date(2026, 5, 20): 3, dt.date(2026, 5, 21): 1}
    assert spark.sql("SELECT size(goals_id) FROM hits WHERE watch_id = 3").first()[0] == 2


def test_schema_drift_and_empty_source(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "visits", "2026-05-20", "p.tsv", f"{VH}\n1\t2026-05-20 00:00:00\t[]\n")
    write_part(landing, "visits", "2026-05-21", "p.tsv",
               f"{VH}\tv:pageViews\n2\t2026-05-21 00:00:00\t[]\t42\n")
    rep = load_days(spark, lake, landing, mini_catalog, "visits", ["2026-05-20", "2026-05-21"])
    assert {r["status"] for r in rep.collect()} == {"loaded"}
    got = dict((int(r[0]), r[1]) for r in typed_source(spark, lake, mini_catalog, "visits")
               .select("visit_id", "page_views").collect())
    assert got == {1: None, 2: 42}
    empty = typed_source(spark, lake, mini_catalog, "hits")
    assert empty.count() == 0
    assert empty.schema == mini_catalog.typed_schema("hits")


def test_empty_day_is_a_loaded_day(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "p.tsv", f"{HH}\n")
    rep = load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"]).first()
    assert (rep["expected"], rep["actual"], rep["status"]) == (0, 0, "loaded")
    files = list_day_files(spark, lake, "hits").collect()
    assert len(files) == 1
    facts = day_facts(spark, lake, mini_catalog, "hits").collect()
    assert [(str(r["load_date"]), r["fact"]) for r in facts] == [("2026-05-20", 0)]
    cur = journal.current(spark, lake).collect()
    assert [(r["status"], r["row_count"]) for r in cur] == [("loaded", 0)]


def test_bad_days_fail_before_publish(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "a.tsv", f"{HH}\n1\t[]\t2026-05-20\n")
    write_part(landing, "hits", "2026-05-20", "b.tsv", "h:date\th:goalsID\th:watchID\n")
    write_part(landing, "hits", "2026-05-21", "a.tsv", f"{HH}\n1\t[]\n")
    write_part(landing, "hits", "2026-05-22", "a.tsv", "h:watchID\th:unknown\n1\t2\n")
    write_part(landing, "hits", "2026-05-23", "a.tsv", f"{HH}\n5\t[]\t2026-05-23\n")
    rep = {str(r["load_date"]): r for r in load_days(
        spark, lake, landing, mini_catalog, "hits",
        ["2026-05-20", "2026-05-21", "2026-05-22", "2026-05-23", "2026-05-24"]).collect()}
    assert rep["2026-05-20"]["status"] == "failed" and "headers" in rep["2026-05-20"]["error"]
    assert rep["2026-05-21"]["status"] == "failed" and "wide" in rep["2026-05-21"]["error"]
    assert "e.g. '1\\t[]'" in rep["2026-05-21"]["error"]
    assert rep["2026-05-22"]["status"] == "failed" and "not in the catalog" in rep["2026-05-22"]["error"]
    assert rep["2026-05-23"]["status"] == "loaded"
    assert rep["2026-05-24"]["status"] == "failed"
    days = {str(r["load_date"]) for r in scan_raw(spark, lake, mini_catalog, "hits")
            .select("load_date").distinct().collect()}
    assert days == {"2026-05-23"}
    st = {str(r["load_date"]): r["status"] for r in journal.current(spark, lake).collect()}
    assert st == {"2026-05-20": "failed", "2026-05-21": "failed", "2026-05-22": "failed",
                  "2026-05-23": "loaded", "2026-05-24": "failed"}


def test_part_landing_during_load_is_not_read(spark, mini_catalog, lake_dirs, monkeypatch):
    from daylake.plans import load as L
    lake, landing = lake_dirs
    for d in ("2026-05-20", "2026-05-21"):
        write_part(landing, "hits", d, "a.tsv", f"{HH}\n1\t[]\t{d}\n2\t[]\t{d}\n")
    real = L.open_parts

    def listed_then_more_lands(*a, **k):
        files = real(*a, **k)
        write_part(landing, "hits", "2026-05-20", "late.tsv", f"{HH}\n9\t[]\t2026-05-20\n" * 3)
        return files
    monkeypatch.setattr(L, "open_parts", listed_then_more_lands)
    rep = {str(r["load_date"]): r for r in load_days(
        spark, lake, landing, mini_catalog, "hits", ["2026-05-20", "2026-05-21"]).collect()}
    assert [(rep[d]["status"], rep[d]["actual"]) for d in sorted(rep)] == [("loaded", 2), ("loaded", 2)]


def test_large_loads_run_in_file_bounded_batches(spark, mini_catalog, lake_dirs):
    from daylake.plans.load import day_batches
    assert day_batches({"a": 2, "b": 1, "c": 5, "d": 1}, ["a", "b", "c", "d"], 3) == [["a", "b"], ["c"], ["d"]]
    lake, landing = lake_dirs
    days = ["2026-05-20", "2026-05-21", "2026-05-22"]
    for d in days:
        write_part(landing, "hits", d, "a.tsv", f"{HH}\n1\t[]\t{d}\n")
        write_part(landing, "hits", d, "b.tsv", f"{HH}\n2\t[]\t{d}\n3\t[]\t{d}\n")
    rep = load_days(spark, lake, landing, mini_catalog, "hits", days, max_files=3).collect()
    assert sorted((str(r["load_date"]), r["status"], r["actual"]) for r in rep) == [
        (d, "loaded", 3) for d in days]
    assert typed_source(spark, lake, mini_catalog, "hits").count() == 9


def test_gzip_parts(spark, mini_catalog, lake_dirs):
    import gzip
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "a.tsv.gz",
               gzip.compress(f"{HH}\n1\t[]\t2026-05-20\n2\t[5]\t2026-05-20\n".encode()), binary=True)
    write_part(landing, "hits", "2026-05-20", "b.tsv", f"{HH}\n3\t[]\t2026-05-20\n")
    rep = load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"]).first()
    assert (rep["n_parts"], rep["expected"], rep["actual"], rep["status"]) == (2, 3, 3, "loaded")
    ids = sorted(int(r[0]) for r in typed_source(spark, lake, mini_catalog, "hits").select("watch_id").collect())
    assert ids == [1, 2, 3]


def test_failure_marks_days_failed_and_cleans_staging(spark, mini_catalog, lake_dirs, monkeypatch):
    import pytest
    from daylake.plans import load as L
    from daylake.sinks import fs
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-20", "a.tsv", f"{HH}\n1\t[]\t2026-05-20\n")

    def broken(*a, **k):
        raise IOError("disk gone")
    monkeypatch.setattr(L, "publish_days", broken)
    with pytest.raises(IOError):
        load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"])
    st = [(str(r["load_date"]), r["status"]) for r in journal.current(spark, lake).collect()]
    assert st == [("2026-05-20", "failed")]
    assert fs.list_children(spark, f"{lake}/staging") == []


def test_passes_may_split_files_differently(spark, mini_catalog, lake_dirs, monkeypatch):
    """Headers are found again whatever the splits of the second pass; a header's text among the rows stays a row."""
    from daylake.plans import load as L
    lake, landing = lake_dirs
    for k in range(4):
        body = "".join(f"{k * 1000 + i}\t[]\t2026-05-20\n" for i in range(400))
        write_part(landing, "hits", "2026-05-20", f"p{k}.tsv", f"\n\r\n{HH}\n{body}" + (f"{HH}\n" * k) + "7\t[]\t2026-05-20\n")
    key = "spark.sql.files.maxPartitionBytes"
    former = spark.conf.get(key)
    real = L.header_texts

    def resplit(*args):
        # Called between the passes.
        texts = real(*args)
        spark.conf.set(key, "1000")
        return texts
    monkeypatch.setattr(L, "header_texts", resplit)
    try:
        rep = load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20"]).first()
    finally:
        spark.conf.set(key, former)
    want = 4 * 401 + 0 + 1 + 2 + 3
    assert (rep["n_parts"], rep["expected"], rep["actual"], rep["status"]) == (4, want, want, "loaded")
    raw = scan_raw(spark, lake, mini_catalog, "hits")
    assert raw.where("watch_id = 'h:watchID' AND date = 'h:date'").count() == 6
    assert raw.where("watch_id = '7'").count() == 5


def test_a_day_above_the_file_bound_is_read_by_its_folder(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    for k in range(5):
        write_part(landing, "hits", "2026-05-20", f"p{k}.tsv", f"{HH}\n{k}\t[]\t2026-05-20\n")
        write_part(landing, "hits", f"2026-05-2{k + 1}", "p.tsv", f"{HH}\n{k}\t[]\tx\n")
    rep = load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20", "2026-05-21"], max_files=2).collect()
    assert sorted((r["status"], r["n_parts"], r["actual"]) for r in rep) == [("loaded", 1, 1), ("loaded", 5, 5)]


def test_rebalanced_load_gives_same_days(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    for d in ("2026-05-20", "2026-05-21"):
        for k in range(3):
            write_part(landing, "hits", d, f"p{k}.tsv", f"{HH}\n{k}\t[]\t{d}\n{k + 10}\t[]\t{d}\n")
    rep = load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20", "2026-05-21"],
                    rebalance=True).collect()
    assert sorted((str(r["load_date"]), r["status"], r["actual"]) for r in rep) == [
        ("2026-05-20", "loaded", 6), ("2026-05-21", "loaded", 6)]
    assert typed_source(spark, lake, mini_catalog, "hits").count() == 12


def test_an_error_has_one_outcome_at_any_batch_size(spark, mini_catalog, tmp_path, monkeypatch):
    """The same error on one day: raised, that batch's days failed, the report beside it, whatever ``max_files``."""
    import pytest
    from daylake.plans import load as L
    real = L.write_staged
    days = ["2026-05-20", "2026-05-21", "2026-05-22"]
    for n, max_files in enumerate((100, 1)):
        lake, landing = str(tmp_path / f"lake{n}"), str(tmp_path / f"landing{n}")
        for d in days:
            write_part(landing, "hits", d, "a.tsv", f"{HH}\n1\t[]\t{d}\n")

        def broken(df, stage, **kw):
            if df.where("load_date = '2026-05-21'").count():
                raise OSError("disk gone")
            return real(df, stage, **kw)
        monkeypatch.setattr(L, "write_staged", broken)
        with pytest.raises(OSError, match="disk gone") as caught:
            load_days(spark, lake, landing, mini_catalog, "hits", days, max_files=max_files)
        report = {str(r["load_date"]): (r["status"], r["error"]) for r in caught.value.report.collect()}
        assert report["2026-05-21"] == ("failed", "OSError: disk gone")
        marks = {str(r["load_date"]): r["status"] for r in journal.current(spark, lake).collect()}
        assert marks == {d: s for d, (s, _) in report.items()}
        # Days of other batches are loaded.
        assert [marks[d] for d in days] == (["failed"] * 3 if max_files == 100 else ["loaded", "failed", "loaded"])
