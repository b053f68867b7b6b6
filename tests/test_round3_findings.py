"""Findings of round 3: operators whose work grew faster than their input, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from daylake.operators.intervals import interval_totals
from daylake.operators.result import page_after


@pytest.mark.parametrize("limit, top", [(1, 9), (7, 40), (7, 10_000), (50, 3), (10_000, 400)])
def test_all_pages_in_one_pass_are_the_pages_sought_one_by_one(spark, limit, top):
    rng = random.Random(limit * top)
    rows = [(rng.choice([None, *range(top)]), rng.choice(["a", "b", None]), i) for i in range(300)]
    want, n = {}, 0
    order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or "")))
    last, held = None, 0
    for x, s, i in order:
        if n == 0 or (held >= limit and (x, s) != last):
            n, held = n + 1, 0
        want[i], held, last = n, held + 1, (x, s)
    df = spark.createDataFrame(rows, "x int, s string, i int").repartition(5)
    got = page_after(df, ["x", "s"], limit, all_pages=True)
    assert got.token is None and got.rows.columns == ["x", "s", "i", "page"]
    assert {r.i: r.page for r in got.rows.collect()} == want
    first = page_after(df, ["x", "s"], limit)
    assert {r.i for r in first.rows.collect()} == {i for i, p in want.items() if p == 1}
    if first.token is not None:
        rest = page_after(df, ["x", "s"], limit, first.token, all_pages=True)
        assert {r.i: r.page + 1 for r in rest.rows.collect()} == {i: p for i, p in want.items() if p > 1}


def test_all_pages_of_nothing(spark):
    assert page_after(spark.createDataFrame([], "k int"), ["k"], 5, all_pages=True).rows.count() == 0


@pytest.mark.parametrize("kind", ["double", "timestamp_ntz", "timestamp"])
def test_interval_totals_equal_all_pairs(spark, kind):
    rng = random.Random(5)
    zero = dt.datetime(2024, 1, 1)

    def place(x):
        return None if x is None else x if kind == "double" else zero + dt.timedelta(seconds=x)

    points = [(i, rng.choice([None, *[j / 4 for j in range(-40, 120)]]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 2.25])) for i in range(300)]
    points += points[:20]
    spans = []
    for i in range(60):
        a, n = rng.randrange(-48, 120) / 4, rng.choice([-1, 0, 0.25, 3, 20])
        spans.append((i, rng.choice([None, 1, 2, 4]), rng.choice([None, a, a, a]), a + n))
    want = {}
    for s, u, a, b in spans:
        seen = [(i, v) for i, x, w, v in points if None not in (x, w, u, a) and a <= x <= b and w != u]
        if seen:
            held = [v for _, v in seen if v is not None]
            want[s] = (len(seen), sum(held) if held else None, min(seen)[0] if seen else None, max(i for i, _ in seen))
    p = spark.createDataFrame([(i, place(x), w, v) for i, x, w, v in points], f"i int, at {kind}, other int, v double")
    s = spark.createDataFrame([(s, u, place(a), place(b)) for s, u, a, b in spans], f"s int, u int, a {kind}, b {kind}")
    got = interval_totals(p, s, "at", "a", "b", ["s"], ("other", "u"), value="v", ident="i", width=2.0)
    assert {r.s: (r.n, r.total, r.first, r.last) for r in got.collect()} == want
    assert interval_totals(p.limit(0), s, "at", "a", "b", ["s"], ("other", "u"), value="v", ident="i").count() == 0
    assert interval_totals(p, s.limit(0), "at", "a", "b", ["s"], ("other", "u"), value="v", ident="i").count() == 0


def _line_tables(spark, folder):
    day = dt.datetime(2024, 1, 1)
    lines = [(k, p, 0, n, float(n), 1.5, 0.0, 0.0, "A", "O", day + dt.timedelta(days=n % 3))
             for k, p, n in [(1, 1, 1), (1, 2, 2), (2, 3, 1), (2, 1, 2), (2, 1, 2), (9, 1, 1)]]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "ring", "B#1", "BIG", 1, 1.0), (2, "bolt", None, "BIG", 1, 1.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(k, 7, "O", 2.0, day + dt.timedelta(days=k), "1-URGENT") for k in (1, 2, 3)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{folder}/orders.parquet")


def test_source_frames_are_gathered_before_they_are_widened(spark, tmp_path):
    from daylake.workloads import ID_BASE, lineitem_frame, orders_frame

    _line_tables(spark, str(tmp_path))
    rows = {r.o_orderkey: r for r in orders_frame(spark, str(tmp_path)).collect()}
    assert [int(x - ID_BASE) for x in rows[1].line_ids] == [11, 12] and rows[1].part_names == ["ring", "bolt"]
    assert rows[1].part_labels == ["ring's B#1, \"BIG\"", None]
    assert [int(x - ID_BASE) for x in rows[2].line_ids] == [21, 22, 22] and rows[2].part_labels[0] is None
    assert (rows[3].n_lines, rows[3].line_ids, rows[3].part_labels, rows[3].ship_times) == (0, [], [], [])
    # What is derived is no part of the shuffle by day.
    for frame, made in ((orders_frame, "line_ids"), (lineitem_frame, "line_id")):
        plan = frame(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert f"AS {made}#" in plan.split("RebalancePartitions")[0]


def test_landed_parts_are_small_and_load(spark, mini_catalog, lake_dirs):
    from pathlib import Path

    from daylake.plans.load import load_days
    from daylake.sources.landing import write_landing
    from daylake.views import typed_source

    lake, landing = lake_dirs
    df = spark.range(3000).selectExpr("id AS watch_id", "array(id, id + 1) AS goals_id", "DATE'2024-01-01' AS date",
                                      "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS load_date")
    write_landing(df, landing, "hits", mini_catalog, parts_per_day=2)
    parts = [p for p in Path(landing, "hits").rglob("part-*")]
    assert parts and sum(p.stat().st_size for p in parts) < 40_000
    report = load_days(spark, lake, landing, mini_catalog, "hits", ["2024-01-01", "2024-01-02"]).collect()
    assert [(r.status, r.actual) for r in report] == [("loaded", 1500)] * 2
    got = {int(r.watch_id): r.goals_id for r in typed_source(spark, lake, mini_catalog, "hits").collect()}
    assert got == {i: [i, i + 1] for i in range(3000)}


def test_hot_keys_are_counted_by_slots_first(spark):
    from daylake.operators.relations import hot_keys

    df = spark.range(1000).selectExpr("CASE WHEN id < 600 THEN 1 ELSE id END AS k")
    assert [r.k for r in hot_keys(df, ["k"], 500).collect()] == [1]
    assert hot_keys(df, ["k"], 600) is None
