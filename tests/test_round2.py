"""Faults that only show on hard data: long cells, long lists, failing moves, bad bytes, exports read back."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from daylake import registry
from daylake.functions.typing import typed_array
from daylake.operators.result import export, run_query
from daylake.oracles import ORACLES
from daylake.plans.load import load_days
from daylake.sinks import fs, raw_store
from daylake.sources.raw import raw_dir, scan_raw
from tests.conftest import write_part

LONG = 100_000


def test_long_list_elements(spark, tmp_path):
    cells = [
        "['" + "x" * LONG + "']", "['" + "\\'" * LONG + "']", '["' + "a,b" * LONG + '",1]',
        "['" + "y" * LONG, "[" + ",".join(["'e'"] * 50_000) + "]", "[" + "z" * LONG + "]",
    ]
    spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").write.parquet(f"{tmp_path}/cells")
    got = {r.i: (r.n, r.m) for r in spark.read.parquet(f"{tmp_path}/cells").select(
        "i", F.array_size(typed_array(F.col("c"), "VARCHAR")).alias("n"),
        F.length(F.get(typed_array(F.col("c"), "VARCHAR"), F.lit(0))).alias("m")).collect()}
    assert got == {0: (1, LONG), 1: (1, LONG), 2: (2, 3 * LONG), 3: (None, None), 4: (50_000, 1), 5: (1, LONG)}


HEAD = "v:visitID\tv:clientID\tv:watchIDs\tv:date\tv:pageViews\tv:dateTime\n"
ROW = "{}\t2\t[1,2]\t2026-05-01\t3\t2026-05-01 10:00:00\n"


def _load(spark, lake_dirs, catalog, days):
    lake, landing = lake_dirs
    return {str(r.load_date): (r.status, r.actual) for r in load_days(spark, lake, landing, catalog, "visits", days).collect()}


def test_failed_move_keeps_the_former_day(spark, mini_catalog, lake_dirs, monkeypatch):
    lake, landing = lake_dirs
    write_part(landing, "visits", "2026-05-01", "a.tsv", HEAD + ROW.format(1))
    assert _load(spark, lake_dirs, mini_catalog, ["2026-05-01"]) == {"2026-05-01": ("loaded", 1)}
    write_part(landing, "visits", "2026-05-01", "b.tsv", HEAD + ROW.format(2))
    real = fs.rename

    def broken(s, src, dst):
        if "/staging/" in src:
            raise OSError("no")
        real(s, src, dst)

    monkeypatch.setattr(raw_store.fs, "rename", broken)
    with pytest.raises(OSError, match="no"):
        _load(spark, lake_dirs, mini_catalog, ["2026-05-01"])
    monkeypatch.undo()
    assert scan_raw(spark, lake, mini_catalog, "visits").count() == 1
    assert fs.list_children(spark, raw_dir(lake, "visits")) == ["load_date=2026-05-01"] or not [
        n for n in fs.list_children(spark, raw_dir(lake, "visits")) if n.startswith(".former")]
    assert _load(spark, lake_dirs, mini_catalog, ["2026-05-01"]) == {"2026-05-01": ("loaded", 2)}
    assert scan_raw(spark, lake, mini_catalog, "visits").count() == 2


def test_bad_bytes_fail_the_day_alone(spark, mini_catalog, lake_dirs):
    _, landing = lake_dirs
    write_part(landing, "visits", "2026-05-01", "a.tsv", HEAD.encode() + ROW.format(1).encode().replace(b"[1,2]", b"\xff\xfe"), binary=True)
    write_part(landing, "visits", "2026-05-02", "a.tsv", HEAD + ROW.format(1))
    got = _load(spark, lake_dirs, mini_catalog, ["2026-05-01", "2026-05-02"])
    assert got == {"2026-05-01": ("failed", None), "2026-05-02": ("loaded", 1)}


def test_csv_export_read_back(spark, tmp_path):
    rows = [(1, "  lead", 0.1, dt.datetime(2024, 1, 5, 10, 0)), (2, "trail  ", None, None), (3, 'q"u,o', -1e300, dt.datetime(2024, 1, 5, 10, 0, 0, 250)),
            (4, "two\nlines", 1.0, None), (5, "", None, None), (6, None, 2.5, None), (7, " ", 0.0, None)]
    df = spark.createDataFrame(rows, "i int, s string, x double, t timestamp_ntz").coalesce(1)
    assert export(df, f"{tmp_path}/out.csv") == len(rows)
    got = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/out.csv/*.csv', header = true, columns = {{'i': 'INTEGER', 's': 'VARCHAR', "
                     f"'x': 'DOUBLE', 't': 'TIMESTAMP'}}, allow_quoted_nulls = false) ORDER BY i").fetchall()
    assert got == rows


def test_inline_result_tells_the_page(spark, tmp_path):
    r = run_query(spark.range(300), f"{tmp_path}/x.parquet", 100)
    assert (r.mode, r.total_rows, r.has_more, r.next_offset, r.rows.count()) == ("inline", 300, True, 100, 100)
    r = run_query(spark.range(50), f"{tmp_path}/y.parquet", 100)
    assert (r.has_more, r.next_offset, r.rows.count()) == (False, None, 50)
    r = run_query(spark.range(501), f"{tmp_path}/z.parquet")
    assert (r.mode, r.total_rows) == ("file", 501)


def test_order_of_1200_lines(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("orders", "lineitem", "part"):
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        if name == "lineitem":
            many = df.limit(1)
            key = spark.read.parquet(f"{sf}/orders.parquet").agg(F.min("o_orderkey")).first()[0]
            extra = many.crossJoin(spark.range(1000).toDF("i")).withColumn("l_linenumber", (F.col("i") + 100).cast("int")).drop("i")
            same = many.crossJoin(spark.range(200).toDF("i")).drop("i")
            df = df.where(F.col("l_orderkey") != key).unionByName(extra.unionByName(same).withColumn("l_orderkey", F.lit(key).cast("long")))
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("orders", "lineitem", "part"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("typed_roundtrip_orders", "typed_hugeint", "typed_arrays_num", "typed_arrays_str", "zipped_arrays", "page_meta", "page_rows", "sample_n"):
        df = registry.QUERIES[name](spark, str(tmp_path))
        want = con.sql(ORACLES[name])
        order = sorted(df.columns)
        norm = lambda rows: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows)
        quoted = ", ".join(f'"{c}"' for c in order)
        assert norm(df.select(*order).collect()) == norm(con.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()), name
        assert sorted(want.columns) == order


def test_landed_day_of_empty_parts_is_an_empty_day(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    write_part(landing, "visits", "2026-05-01", "a.tsv", "")
    write_part(landing, "visits", "2026-05-01", "b.tsv", "\r\n\n")
    got = _load(spark, lake_dirs, mini_catalog, ["2026-05-01", "2026-05-02"])
    assert got == {"2026-05-01": ("loaded", 0), "2026-05-02": ("failed", None)}
    assert scan_raw(spark, lake, mini_catalog, "visits").count() == 0


def test_pivot_and_unpivot(spark):
    from daylake.operators.reshape import pivot, unpivot

    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "a", 4), (2, None, 9)], "k int, t string, v int")
    wide = pivot(df, "t", F.sum("v"), ["k"]).orderBy("k")
    assert [tuple(r) for r in wide.collect()] == [(1, 2, 3), (2, 4, None)]
    assert sorted(map(tuple, unpivot(wide, ["a", "b"], "t", "v").collect())) == [(1, "a", 2), (1, "b", 3), (2, "a", 4)]
    assert len(unpivot(wide, ["a", "b"], "t", "v", keep_null=True).collect()) == 4
    with pytest.raises(ValueError, match="more than 1"):
        pivot(df, "t", F.sum("v"), ["k"], max_values=1)


def test_summary_after_a_late_error_tells_what_is_loaded(spark, mini_catalog, lake_dirs, monkeypatch):
    import daylake.views
    from daylake.plans.load import update_all

    lake, landing = lake_dirs
    write_part(landing, "visits", "2026-05-01", "a.tsv", HEAD + ROW.format(1) + ROW.format(2))

    def broken(*a, **k):
        raise RuntimeError("late")

    monkeypatch.setattr(daylake.views, "register_views", broken)
    rows = update_all(spark, lake, landing, mini_catalog, ["visits", "nosuch"], "2026-05-01", "2026-05-01", today=dt.date(2026, 5, 3)).collect()
    assert [(r.source, r.loaded_days, r.total_rows, r.error is None) for r in rows] == [("visits", 1, 2, False), ("nosuch", 0, 0, False)]
