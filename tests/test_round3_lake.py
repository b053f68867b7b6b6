"""Look-back windows, seek paging, bucketed links, key lookup, journal numbers, days left by a killed publish."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daylake.operators.relations import read_linked, write_linked
from daylake.operators.result import page_after
from daylake.operators.windows import looking_back
from daylake.plans import file_stats, journal
from daylake.plans.load import load_days
from daylake.sinks import fs
from daylake.sources.raw import day_facts, raw_dir, scan_raw
from daylake.views import typed_source
from tests.conftest import write_part

HV = "v:visitID\tv:clientID\tv:watchIDs\tv:date\tv:pageViews\tv:dateTime"


# ---------------------------------------------------------------- windows


@pytest.mark.parametrize("back", [1, 2, 5])
def test_looking_back_equals_one_window(spark, back):
    rnd = random.Random(back)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, None]), start + dt.timedelta(hours=rnd.randint(0, 400)) if rnd.random() > 0.05 else None, rnd.choice("abc")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz, kind string").repartition(4)
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or start, r[0]))
    want, seen = {}, {}
    for i, user, _, kind in order:
        past = seen.setdefault(user, [])
        want[i] = (len(past) + 1, past[-back:])
        past.append((i, kind))
    got = looking_back(df, "user", "ts", ["id"], ["id", "kind"], back)
    assert {r.id: (r.running_no, [tuple(x) for x in r.previous]) for r in got.collect()} == want
    assert looking_back(df.limit(0), "user", "ts", ["id"], ["id"], back).count() == 0


# ---------------------------------------------------------------- pages


@pytest.mark.parametrize("limit", [1, 7, 10, 300, 10_000])
def test_seek_pages_cover_everything_once(spark, limit):
    rnd = random.Random(limit)
    rows = [(i, rnd.choice([None, 1.5, 2.0, float("nan"), -1.0]), rnd.choice([None, "a", "b", "é", ""])) for i in range(120 if limit > 1 else 20)]
    df = spark.createDataFrame(rows, "i int, x double, s string").repartition(3)
    seen, token, pages = [], None, 0
    while pages == 0 or token is not None:
        p = page_after(df, ["x", "s", "i"], limit, token)
        part = [r.i for r in p.rows.collect()]
        assert len(part) == min(limit, len(rows) - len(seen))
        seen += part
        token, pages = p.token, pages + 1
        assert p.has_more == (token is not None)
    assert seen == [r.i for r in df.orderBy("x", "s", "i").collect()]


def test_rows_with_equal_keys_stay_on_one_page(spark):
    df = spark.createDataFrame([(k, n) for k in range(4) for n in range(5)], "k int, n int")
    first = page_after(df, ["k"], 7)
    assert first.rows.count() == 10
    last = page_after(df, ["k"], 7, first.token)
    assert last.rows.count() == 10 and last.token is None
    assert page_after(df.limit(0), ["k"], 7).rows.count() == 0


# ---------------------------------------------------------------- links


def test_a_bucketed_link_is_read_without_a_shuffle(spark, tmp_path):
    left = spark.createDataFrame([(i, [i, i + 1, None] if i % 3 else []) for i in range(60)], "v int, ids array<int>")
    right = spark.range(0, 50).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).alias("w"))
    write_linked(left, "ids", right, "id", str(tmp_path), ("t_left", "t_right"), 4)
    got = read_linked(spark, ("t_left", "t_right"), "id")
    want = left.select("v", F.explode_outer("ids").alias("id")).join(right, "id", "left")
    key = lambda df: sorted(map(repr, df.select("v", "id", "w").collect()))
    assert key(got) == key(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


# ---------------------------------------------------------------- key lookup


def lake_of_visits(spark, catalog, lake_dirs, odd=False, **kw):
    lake, landing = lake_dirs
    for n in range(5):
        d = f"2026-05-0{n + 1}"
        lines = [f"{(17298374650000000000 + n * 1000 + k) if not (odd and n == 2) else f'0{17298374650000002000 + k}'}\t{k % 7}\t[]\t{d}\t{k}\t{d} 10:00:00" for k in range(0, 100, 2)]
        write_part(landing, "visits", d, "a.tsv", "\n".join([HV, *lines, f"x\t\t[]\t{d}\t\t"]) + "\n")
    load_days(spark, lake, landing, catalog, "visits", [f"2026-05-0{n + 1}" for n in range(5)], **kw)
    return lake


@pytest.mark.parametrize("odd", [False, True])
def test_lookup_equals_a_typed_filter(spark, mini_catalog, lake_dirs, odd):
    lake = lake_of_visits(spark, mini_catalog, lake_dirs, odd, lookup=("visit_id",))
    view = typed_source(spark, lake, mini_catalog, "visits")
    ids = [17298374650000000000 + n * 1000 + k for n in (0, 2) for k in range(0, 30)]

    def check(column, values):
        got = file_stats.lookup(spark, lake, mini_catalog, "visits", column, values)
        want = view.where(F.col(column).cast("string").isin([str(v) for v in values]))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        return got

    check("visit_id", ids)
    file_stats.refresh(spark, lake, mini_catalog, "visits")
    got = check("visit_id", ids)
    assert len(got.inputFiles()) == 2
    if not odd:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(" in plan and "In(visit_id" in plan
    check("client_id", [3, 5, None, 99])
    assert check("visit_id", [5]).count() == 0 and check("visit_id", []).count() == 0
    with pytest.raises(ValueError, match="whole numbers"):
        file_stats.lookup(spark, lake, mini_catalog, "visits", "date_time", [1])
    with pytest.raises(ValueError, match="join them"):
        file_stats.lookup(spark, lake, mini_catalog, "visits", "visit_id", range(5000))


def test_lookup_columns_have_bloom_filters_of_a_fitting_size(spark, mini_catalog, lake_dirs):
    lake = lake_of_visits(spark, mini_catalog, lake_dirs, lookup=("visit_id",))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = f"{raw_dir(lake, 'visits')}/load_date=2026-05-01"
    name = next(n for n in fs.list_children(spark, folder) if n.endswith(".parquet"))
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
    try:
        columns = {c.getPath().toDotString(): c for b in reader.getFooter().getBlocks() for c in b.getColumns()}
        assert columns["visit_id"].getBloomFilterOffset() > 0 and columns["client_id"].getBloomFilterOffset() < 0
        assert path.getFileSystem(conf).getFileStatus(path).getLen() < 20_000
    finally:
        reader.close()


# ---------------------------------------------------------------- journal


def test_marks_rank_as_they_were_made_whatever_the_clocks(spark, lake_dirs, monkeypatch):
    lake, _ = lake_dirs
    now = __import__("time").time
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 1})
    for n, ahead in enumerate((3600, -3600, 0)):
        monkeypatch.setattr("time.time", lambda a=ahead: now() + a)
        monkeypatch.setattr("time.time_ns", lambda a=ahead: int((now() + a) * 1e9))
        journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADED, {"2026-05-01": 10 + n})
        assert [r.row_count for r in journal.current(spark, lake).collect()] == [10 + n]


def test_two_writers_never_share_a_number(spark, lake_dirs, monkeypatch):
    lake, _ = lake_dirs
    assert journal.last_seq(spark, lake) == 0
    first = journal.claim_seq(spark, lake)
    # Another writer that listed before the claim was put tries the same number, then the next.
    monkeypatch.setattr(journal, "last_seq", lambda *a: first - 1)
    assert journal.claim_seq(spark, lake) == first + 1
    monkeypatch.undo()
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.LOADING)
    journal.mark(spark, lake, "hits", ["2026-05-01"], journal.FAILED)
    assert journal.compact_in_place(spark, lake) == 1
    assert journal.claim_seq(spark, lake) == first + 4
    assert [r.status for r in journal.current(spark, lake).collect()] == ["failed"]


# ---------------------------------------------------------------- publish, facts


def day_texts(spark, lake, catalog, day):
    return sorted(r[0] for r in scan_raw(spark, lake, catalog, "visits").where(F.col("load_date") == day).select("page_views").collect())


def test_a_reader_finds_the_former_day_or_the_new_one_at_every_step(spark, mini_catalog, lake_dirs, monkeypatch):
    """A replace is stopped before each of its steps on the file system: the day is whole, old or new, and the next load settles the rest."""
    lake = lake_of_visits(spark, mini_catalog, lake_dirs)
    landing, day = lake_dirs[1], "2026-05-02"
    n = scan_raw(spark, lake, mini_catalog, "visits").count()
    for round_ in range(2):
        former = day_texts(spark, lake, mini_catalog, day)
        fresh = [f"{1000 * (round_ + 1) + k}" for k in range(3)]
        write_part(landing, "visits", day, "a.tsv", "\n".join([HV, *[f"{k}\t1\t[]\t{day}\t{x}\t" for k, x in enumerate(fresh)]]) + "\n")
        step = 0
        while True:
            calls = []

            def stopping(real):
                def run(s, *args, **kw):
                    if "/versions/" in " ".join(map(str, args)):
                        calls.append(real.__name__)
                        if len(calls) > step:
                            raise OSError("stopped")
                        if real.__name__ in ("rename", "create_new"):
                            # Between the steps the day is there.
                            assert day_texts(spark, lake, mini_catalog, day) == former
                    return real(s, *args, **kw)
                return run
            from daylake.sinks import raw_store
            with monkeypatch.context() as m:
                for f in ("rename", "mkdirs", "create_new"):
                    m.setattr(raw_store.fs, f, stopping(getattr(fs, f)))
                try:
                    load_days(spark, lake, landing, mini_catalog, "visits", [day])
                    done = True
                except OSError:
                    done = False
            if done:
                break
            assert day_texts(spark, lake, mini_catalog, day) == former
            step += 1
        assert step >= 3
        assert day_texts(spark, lake, mini_catalog, day) == sorted(fresh)
        assert {str(r.load_date): r.fact for r in day_facts(spark, lake, mini_catalog, "visits").collect()}[day] == 3
    # The next load drops what is no longer read.
    load_days(spark, lake, landing, mini_catalog, "visits", ["2026-05-03"])
    assert f"load_date={day}" not in fs.list_children(spark, raw_dir(lake, "visits"))
    assert len(fs.list_children(spark, f"{lake}/versions/visits/load_date={day}")) == 1
    assert [x for x in fs.list_children(spark, f"{lake}/versions/visits/_current") if x.startswith(f"load_date={day}")][1:] == []
    assert scan_raw(spark, lake, mini_catalog, "visits").count() == n - 51 + 3
    file_stats.refresh(spark, lake, mini_catalog, "visits")
    assert file_stats.lookup(spark, lake, mini_catalog, "visits", "page_views", [2000, 2001, 0]).count() == 6
    assert file_stats.where_between(spark, lake, mini_catalog, "visits", "page_views", 2000, None).frame.count() == 3


def test_day_facts_of_many_suspects(spark, mini_catalog, lake_dirs, monkeypatch):
    from daylake.sources import raw
    lake = lake_of_visits(spark, mini_catalog, lake_dirs)
    root = raw_dir(lake, "visits")
    monkeypatch.setattr(raw, "SUSPECTS", 2)
    monkeypatch.setattr(raw, "EMPTY_FILE_BYTES", 5_000)
    empty = f"{lake}/empty"
    spark.createDataFrame([], mini_catalog.raw_schema("visits")).coalesce(1).write.parquet(empty)
    name = next(x for x in fs.list_children(spark, empty) if x.endswith(".parquet"))
    for n in (1, 2, 3):
        fs.copy(spark, f"{empty}/{name}", f"{root}/load_date=2026-05-0{n}/e.parquet")
    fs.write_bytes(spark, f"{root}/load_date=2026-05-03/junk.parquet", b"junk")
    fs.write_bytes(spark, f"{root}/load_date=2026-05-04/long.parquet", b"junk" * 5000)
    facts = {str(r.load_date)[-1]: r.fact for r in day_facts(spark, lake, mini_catalog, "visits").collect()}
    assert facts == {"1": 51, "2": 51, "3": None, "4": None, "5": 51}
