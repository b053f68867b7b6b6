"""Sessions (gap cuts, carried numbers, paths, transitions) and the interval join."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daylake.operators.intervals import interval_join
from daylake.operators.sessions import session_paths, sessions, transitions

START = dt.datetime(2024, 1, 1)


def events(spark, seed=1, hot=400):
    """A user with most rows over many days, users with few, equal times, rows without user or time."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for user, size in [(1, hot), (2, 1), (3, 25), (4, 60)]:
        at = START + dt.timedelta(seconds=rnd.randint(0, 4000))
        for _ in range(size):
            rows.append((n, user, at, rnd.choice(["view", "click", "buy", None])))
            at += dt.timedelta(seconds=rnd.choice([0, 1, 60, 600, 1799.5, 1800, 1800.000001, 1801, 9000, 90_000]))
            n += 1
    rows += [(n, None, START, "view"), (n + 1, 3, None, "view")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz, kind string").repartition(4)
    return rows, df


def brute(rows, gap):
    out = {}
    last, number = {}, Counter()
    for i, user, ts, kind in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2], r[0])):
        if user not in last or (ts - last[user]).total_seconds() > gap:
            number[user] += 1
        last[user] = ts
        out[i] = (user, number[user], ts, kind)
    return out


@pytest.mark.parametrize("unit", ["day", "hour", "minute"])
def test_sessions_equal_a_walk_over_each_user(spark, unit):
    rows, df = events(spark)
    want = brute(rows, 1800)
    got = {r.id: (r.user, r.session_no, r.ts, r.kind) for r in sessions(df, "user", "ts", ["id"], 1800, unit).collect()}
    assert got == want
    paths = {(r.user, r.session_no): (r.started, r.ended, r.n_events, r.path) for r in session_paths(df, "user", "ts", ["id"], "kind", 1800, unit).collect()}
    each = {}
    for i, (user, no, ts, kind) in sorted(want.items(), key=lambda x: (x[1][0], x[1][2], x[0])):
        each.setdefault((user, no), []).append((ts, kind))
    assert paths == {k: (v[0][0], v[-1][0], len(v), ">".join(x or "" for _, x in v)) for k, v in each.items()}
    steps = {(r.step_from, r.step_to): r.n for r in transitions(df, "user", "ts", ["id"], "kind", 1800, unit).collect()}
    told = Counter()
    for v in each.values():
        told.update((a, b) for (_, a), (_, b) in zip(v, v[1:] + [(None, None)]))
    assert steps == told


def test_a_hot_user_is_cut_into_slices(spark):
    _, df = events(spark, hot=2000)
    plan = sessions(df, "user", "ts", ["id"], 1800)._jdf.queryExecution().executedPlan().toString()
    # Rows are windowed by user and slice; windows by user alone hold a row a slice.
    for line in plan.split("\n"):
        if "Window [" in line and "lag(ts" in line:
            assert "[user" in line and "slice_at" in line.split("], [", 1)[1]
    assert sessions(df.limit(0), "user", "ts", ["id"]).count() == 0


# ---------------------------------------------------------------- interval join


def brute_join(points, spans, closed, keyed):
    out = []
    for pid, k, p in points:
        for sid, k2, a, b in spans:
            if None in (p, a, b) or (keyed and (k is None or k != k2)) or any(x != x for x in (p, a, b)):
                continue
            if a <= p and (p <= b if closed else p < b):
                out.append((pid, sid))
    return sorted(out)


@pytest.mark.parametrize(("kind", "closed", "keyed", "cell"), [
    ("double", True, False, 10_000), ("double", False, True, 7), ("timestamp_ntz", True, True, 10_000), ("timestamp", False, False, 5), ("date", True, False, 11)])
def test_interval_join_equals_all_pairs(spark, kind, closed, keyed, cell):
    rnd = random.Random(len(kind) + cell)

    def place(x):
        if kind == "double":
            return x
        if kind == "date":
            return dt.date(2024, 1, 1) + dt.timedelta(days=int(x))
        return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=round(x, 3))

    lengths = [0, 0.5, 1, 3, 40, 1000, 50_000]
    points = [(i, rnd.choice([1, 2, None]), place(rnd.choice([rnd.uniform(-50, 900), float(rnd.randint(0, 40))]))) for i in range(220)]
    spans = []
    for i in range(150):
        a = rnd.choice([rnd.uniform(-100, 900), float(rnd.randint(0, 40))])
        spans.append((i, rnd.choice([1, 2, None]), place(a), place(a + rnd.choice(lengths))))
    spans += [(900, 1, place(50.0), place(20.0)), (901, 1, None, place(9.0)), (902, 1, place(1.0), None), spans[3]]
    points += [(900, 1, None), points[5]]
    if kind == "double":
        points.append((901, 1, float("nan")))
        spans.append((903, 1, 0.0, float("nan")))
    p = spark.createDataFrame(points, f"pid long, k long, at {kind}").repartition(3)
    s = spark.createDataFrame(spans, f"sid long, k long, a {kind}, b {kind}")
    if not keyed:
        p, s = p.drop("k"), s.drop("k")
    got = interval_join(p, s, "at", "a", "b", on=["k"] if keyed else [], closed=closed, width=2.0, cell_rows=cell)
    assert sorted((r.pid, r.sid) for r in got.collect()) == brute_join(points, spans, closed, keyed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_interval_join_of_empty_sides_and_mixed_times(spark):
    p = spark.createDataFrame([(1, 1.0)], "pid long, at double")
    s = spark.createDataFrame([(1, 0.0, 2.0)], "sid long, a double, b double")
    assert interval_join(p.limit(0), s, "at", "a", "b").count() == 0
    assert interval_join(p, s.limit(0), "at", "a", "b").count() == 0
    assert interval_join(p, s, "at", "a", "b").columns == ["pid", "at", "sid", "a", "b"]
    with pytest.raises(ValueError, match="zone"):
        interval_join(p.withColumn("at", F.lit(START).cast("timestamp")), s, "at", "a", "b")


def test_interval_join_of_one_crowded_bucket(spark):
    """Everything in one bucket: the grid deals points and spans over cells, each pair meets once."""
    p = spark.range(300).select(F.col("id").alias("pid"), (F.col("id") % 10 / 10).alias("at"))
    s = spark.range(200).select(F.col("id").alias("sid"), F.lit(0.0).alias("a"), F.lit(0.95).alias("b"))
    got = interval_join(p, s, "at", "a", "b", cell_rows=30)
    assert got.count() == 300 * 200 and got.distinct().count() == 300 * 200
