"""Journal upserts and the reconcile truth table."""


from daylake.plans import journal
from daylake.plans.load import load_days
from daylake.sinks import fs
from daylake.sources.raw import day_facts, raw_dir
from tests.conftest import write_part

HH = "h:watchID\th:goalsID\th:date"


def test_current_is_latest_mark(spark, lake_dirs):
    lake, _ = lake_dirs
    journal.mark(spark, lake, "hits", ["2026-05-01", "2026-05-02"], journal.LOADING)
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 7})
    journal.mark(spark, lake, "hits", ["2026-05-02"], journal.FAILED)
    journal.mark(spark, lake, "hits", ["2026-05-02"], journal.REMOVED)
    cur = journal.current(spark, lake).collect()
    assert [(str(r["load_date"]), r["status"], r["row_count"]) for r in cur] == [
        ("2026-05-01", "loaded", 7)]
    assert cur[0]["loaded_at"] is not None


def test_reconcile_truth_table(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    days = ["2026-05-01", "2026-05-02", "2026-05-03", "2026-05-04", "2026-05-05", "2026-05-06"]
    for d in days:
        write_part(landing, "hits", d, "p.tsv", f"{HH}\n1\t[]\t{d}\n2\t[]\t{d}\n")
    load_days(spark, lake, landing, mini_catalog, "hits", days)
    root = raw_dir(lake, "hits")
    # 05-02: journal says 5 rows, file has 2.
    journal.mark(spark, lake, "hits", ["2026-05-02"], journal.LOADED, {"2026-05-02": 5})
    # 05-03: no file.
    fs.delete(spark, f"{root}/load_date=2026-05-03")
    # 05-04: a junk file beside the good one.
    fs.write_bytes(spark, f"{root}/load_date=2026-05-04/junk.parquet", b"junk")
    # 05-05: loading (even with equal counts).
    journal.mark(spark, lake, "hits", ["2026-05-05"], journal.LOADING)
    # 05-06: file without a journal row.
    journal.mark(spark, lake, "hits", ["2026-05-06"], journal.REMOVED)
    rep = {str(r["load_date"]): r for r in journal.reconcile(spark, lake, mini_catalog, ["hits"]).collect()}
    assert rep["2026-05-01"]["confirmed"] and not rep["2026-05-01"]["removed"]
    assert not rep["2026-05-02"]["confirmed"] and rep["2026-05-02"]["removed"]
    assert rep["2026-05-03"]["fact"] is None and rep["2026-05-03"]["removed"]
    assert rep["2026-05-04"]["fact"] is None and rep["2026-05-04"]["removed"]
    assert rep["2026-05-05"]["fact"] == 2 and rep["2026-05-05"]["removed"]
    assert not rep["2026-05-06"]["confirmed"] and not rep["2026-05-06"]["removed"]
    left = {str(r["load_date"]) for r in journal.current(spark, lake).collect()}
    assert left == {"2026-05-01"}


def test_day_fact_ignores_hidden_files(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-01", "p.tsv", f"{HH}\n1\t[]\tx\n")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-01"])
    root = raw_dir(lake, "hits")
    fs.write_bytes(spark, f"{root}/load_date=2026-05-01/_tmp.parquet", b"half written")
    fs.write_bytes(spark, f"{root}/load_date=2026-05-01/x.parquet.tmp", b"half written")
    facts = day_facts(spark, lake, mini_catalog, "hits").collect()
    assert [(str(r["load_date"]), r["fact"]) for r in facts] == [("2026-05-01", 1)]


def test_mark_appended_while_compacting_stays_current(spark, lake_dirs, monkeypatch):
    lake, _ = lake_dirs
    journal.mark(spark, lake, "hits", ["2026-05-01", "2026-05-02"], journal.LOADING)
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 3})
    listed = fs.list_children

    def then_mark(s, path):
        names = listed(s, path)
        monkeypatch.undo()
        journal.mark(s, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 9})
        return names

    monkeypatch.setattr(journal.fs, "list_children", then_mark)
    assert journal.compact_in_place(spark, lake) == 1
    state = sorted((str(r["load_date"]), r["status"], r["row_count"]) for r in journal.current(spark, lake).collect())
    assert state == [("2026-05-01", "loaded", 9), ("2026-05-02", "loading", None)]


def test_compact_in_place(spark, lake_dirs):
    lake, _ = lake_dirs
    journal.mark(spark, lake, "hits", ["2026-05-01", "2026-05-02", "2026-05-03"], journal.LOADING)
    journal.mark(spark, lake, "hits", ["2026-05-01", "2026-05-03"], journal.LOADED,
                 {"2026-05-01": 3, "2026-05-03": 4})
    journal.mark(spark, lake, "hits", ["2026-05-02"], journal.FAILED)
    journal.mark(spark, lake, "hits", ["2026-05-03"], journal.REMOVED)
    before = sorted((str(r["load_date"]), r["status"], r["row_count"]) for r in journal.current(spark, lake).collect())
    assert journal.compact_in_place(spark, lake) == 3
    after = sorted((str(r["load_date"]), r["status"], r["row_count"]) for r in journal.current(spark, lake).collect())
    assert before == after == [("2026-05-01", "loaded", 3), ("2026-05-02", "failed", None)]
    assert len(fs.list_children(spark, journal.journal_dir(lake))) == 1
    assert journal.history(spark, lake).count() == 3  # the state and the newest mark, a tombstone
    journal.mark(spark, lake, "hits", ["2026-05-02"], journal.LOADED, {"2026-05-02": 1})
    assert {str(r["load_date"]): r["status"] for r in journal.current(spark, lake).collect()} == {
        "2026-05-01": "loaded", "2026-05-02": "loaded"}


def test_day_folder_without_parquet_is_not_a_day(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "hits", "2026-05-01", "p.tsv", f"{HH}\n1\t[]\tx\n")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-01"])
    root = raw_dir(lake, "hits")
    fs.mkdirs(spark, f"{root}/load_date=2026-05-02")              # empty day folder
    fs.mkdirs(spark, f"{root}/load_date=2026-05-03/2026-05-03.parquet")  # only a folder inside
    journal.mark(spark, lake, "hits", ["2026-05-02", "2026-05-03"], journal.LOADED,
                 {"2026-05-02": 0, "2026-05-03": 0})
    facts = {str(r["load_date"]): r["fact"] for r in day_facts(spark, lake, mini_catalog, "hits").collect()}
    assert facts == {"2026-05-01": 1}
    rep = {str(r["load_date"]): r for r in journal.reconcile_frame(spark, lake, mini_catalog, ["hits"]).collect()}
    assert rep["2026-05-01"]["confirmed"]
    assert rep["2026-05-02"]["fact"] is None and rep["2026-05-02"]["removed"]
    assert rep["2026-05-03"]["fact"] is None and rep["2026-05-03"]["removed"]


def test_mark_validates_status_and_counts(spark, lake_dirs):
    import pytest
    lake, _ = lake_dirs
    with pytest.raises(ValueError):
        journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED)
    with pytest.raises(ValueError):
        journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": -1})
    with pytest.raises(ValueError):
        journal.mark(spark, lake, "hits", ["2026-05-01"], "done")
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 0})
    assert [r["row_count"] for r in journal.current(spark, lake).collect()] == [0]
