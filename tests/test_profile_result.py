"""Profile, schema, summarize, paging, sampling, export and row encodings."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from daylake.functions.encode import csv_row, json_row, md_row
from daylake.operators import profile as prof
from daylake.operators import result as res


@pytest.fixture()
def frames(spark):
    visits = spark.createDataFrame(
        [(1, dt.date(2026, 5, 20), "a"), (2, dt.date(2026, 5, 21), None)] * 3,
        "visit_id long, date date, name string")
    hits = spark.createDataFrame([], "watch_id long, date date")
    other = spark.createDataFrame([(1,), (2,)], "k long")
    return {"visits": visits, "hits": hits, "other": other}


def test_context_profile(spark, frames):
    rows = {r["object"]: r for r in prof.context_profile(frames).collect()}
    assert (rows["visits"]["row_count"], rows["visits"]["min_value"], rows["visits"]["max_value"]) == (
        6, "2026-05-20", "2026-05-21")
    assert rows["hits"]["row_count"] == 0 and rows["hits"]["min_value"] is None
    assert rows["other"]["date_column"] is None


def test_schema_semantics_and_drift(spark, mini_catalog):
    frames = {"hits": spark.createDataFrame([], mini_catalog.typed_schema("hits")),
              "extra": spark.createDataFrame([], "x long")}
    sem = {(r["table_name"], r["column_name"]): r for r in
           prof.schema_with_semantics(spark, frames, mini_catalog).collect()}
    assert sem[("hits", "watch_id")]["semantics"] == "Hit id"
    assert sem[("hits", "watch_id")]["data_type"] == "HUGEINT"
    assert sem[("hits", "goals_id")]["data_type"] == "BIGINT[]"
    assert sem[("hits", "date")]["semantics"] is None
    assert sem[("extra", "x")]["semantics"] is None
    with pytest.raises(KeyError, match="known"):
        prof.object_schema(spark, frames, mini_catalog, "nope")
    drift = [(r["table_name"], r["column_name"], r["issue"]) for r in
             prof.drift_report(spark, frames, mini_catalog).collect()]
    assert ("hits", "date", "column without description") in drift
    assert ("hits", "watch_id", "no value in any row") in drift     # the view has no row yet
    full = {"hits": spark.createDataFrame([(Decimal(1), [2], None)], mini_catalog.typed_schema("hits"))}
    drift = [(r["column_name"], r["issue"]) for r in prof.drift_report(spark, full, mini_catalog).collect()]
    assert drift == [("date", "column without description"), ("date", "no value in any row")]


def test_summarize(spark, frames):
    s = {r["column_name"]: r for r in prof.summarize(frames["visits"]).collect()}
    assert s["visit_id"]["min"] == "1" and s["visit_id"]["max"] == "2"
    assert s["visit_id"]["avg"] == 1.5 and s["visit_id"]["approx_unique"] == 2
    assert s["name"]["null_percentage"] == 50.0 and s["name"]["count"] == 6
    assert s["date"]["column_type"] == "DATE"


def test_limits_and_pages(spark):
    assert res.clamp_limit(0) == 100 and res.clamp_limit(-5) == 100 and res.clamp_limit(None) == 100
    assert res.clamp_limit(20000) == 10000 and res.clamp_limit(7) == 7
    assert res.sample_size(None) == 5 and res.sample_size("x") == 5
    assert res.sample_size(-1) == 5 and res.sample_size(0) == 1
    df = spark.range(300).orderBy("id")
    pg = res.page(df, 100)
    assert pg.total_rows == 300 and pg.has_more and pg.next_offset == 100
    assert [r[0] for r in pg.rows.collect()][:2] == [0, 1]
    last = res.page(df, 100, offset=200)
    assert not last.has_more and last.next_offset is None


def test_auto_export_threshold(spark, tmp_path):
    r = res.run_query(spark.range(501), str(tmp_path / "a.csv"))
    assert (r.mode, r.total_rows) == ("file", 501)
    assert spark.read.option("header", True).csv(str(tmp_path / "a.csv")).count() == 501
    r = res.run_query(spark.range(500), str(tmp_path / "b.csv"))
    assert (r.mode, r.total_rows) == ("inline", 500) and r.rows.count() == 100
    with pytest.raises(Exception):
        res.export(spark.range(3), str(tmp_path / "a.csv"))
    with pytest.raises(ValueError):
        res.export(spark.range(3), str(tmp_path / "a.txt"))
    assert res.export(spark.range(3), str(tmp_path / "c.json")) == 3
    assert res.export(spark.range(3), str(tmp_path / "c.parquet")) == 3


def test_encodings(spark):
    df = spark.createDataFrame(
        [(1, "a,b", 'say "hi"', float("nan"), dt.datetime(2026, 5, 20, 12, 0), "x" * 60),
         (2, None, "line\nbreak|pipe", 1.5, dt.datetime(2026, 5, 20, 12, 0, 0, 5), "Привет")],
        "id long, a string, b string, f double, t timestamp_ntz, long string")
    csv = [r[0] for r in df.select(csv_row(df)).orderBy("id").collect()]
    assert csv[0].startswith('1,"a,b","say ""hi"""')
    assert csv[1].startswith('2,,"line\nbreak|pipe"')
    js = [json.loads(r[0]) for r in df.select(json_row(df)).orderBy("id").collect()]
    assert js[0]["f"] is None and js[0]["t"] == "2026-05-20T12:00:00"
    assert js[1]["t"] == "2026-05-20T12:00:00.000005" and js[1]["a"] is None
    assert js[1]["long"] == "Привет"
    md = [r[0] for r in df.select(md_row(df)).orderBy("id").collect()]
    assert md[0].endswith("| " + "x" * 47 + "... |")
    assert "| NULL |" in md[1] and "line break\\|pipe" in md[1]


def test_render_formats(spark):
    df = spark.createDataFrame([(i, f"v{i}" if i % 2 else "a|b\nc", float("nan") if i == 0 else i / 2)
                                for i in range(5)], "id long, s string, f double").orderBy("id")
    doc = json.loads(res.render(df, 3, "json"))
    assert doc["columns"] == ["id", "s", "f"] and doc["total_rows"] == 5
    assert doc["has_more"] and doc["next_offset"] == 3 and len(doc["rows"]) == 3
    assert doc["rows"][0]["f"] is None
    csv = res.render(df, 2, "csv").split("\n", 1)
    assert csv[0] == "id,s,f" and csv[1].startswith('0,"a|b\nc"')
    md = res.render(df, 2, "markdown").splitlines()
    assert md[0] == "| id | s | f |" and md[1] == "| --- | --- | --- |"
    assert md[2] == "| 0 | a\\|b c | NaN |" and md[-1] == "_... 3 more rows (limit 2)_"
    assert res.render(df.where("id < 0"), None, "markdown") == "_no rows_"
    with pytest.raises(ValueError):
        res.render(df, 1, "xml")


def test_csv_export_is_rfc4180(spark, tmp_path):
    import glob
    df = spark.createDataFrame([(1, 'say "hi"', "a,b", None)], "id long, s string, t string, n string")
    assert res.export(df.coalesce(1), str(tmp_path / "x.csv")) == 1
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "x.csv" / "part-*")))
    assert text == 'id,s,t,n\n1,"say ""hi""","a,b",\n'


def test_json_export_value_rules(spark, tmp_path):
    import glob
    df = spark.createDataFrame([(1, float("nan"), dt.datetime(2026, 5, 20, 12, 0))],
                               "id long, f double, t timestamp_ntz")
    assert res.export(df.coalesce(1), str(tmp_path / "x.json")) == 1
    line = "".join(open(f).read() for f in glob.glob(str(tmp_path / "x.json" / "part-*"))).strip()
    assert json.loads(line) == {"id": 1, "f": None, "t": "2026-05-20T12:00:00"}


def test_csv_export_writes_lists_as_list_text(spark, tmp_path):
    import glob
    df = spark.createDataFrame([(1, [1, 2], ["a,b", "it's"], None)],
                               "id long, ids array<long>, names array<string>, e array<long>")
    assert res.export(df.coalesce(1), str(tmp_path / "l.csv")) == 1
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "l.csv" / "part-*")))
    assert text == 'id,ids,names,e\n1,"[1,2]","[\'a,b\',\'it\\\'s\']",\n'
