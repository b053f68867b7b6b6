"""Findings of round 3: steps that cost more by the row than they need to."""

from __future__ import annotations

import io
import random
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import write_part
from daylake.functions.typing import typed, typed_projection
from daylake.llm import spotsigs
from daylake.plans import file_stats
from daylake.plans.load import load_days
from daylake.sources.landing import tab_count

HV = "v:visitID\tv:clientID\tv:watchIDs\tv:date\tv:pageViews\tv:dateTime"


def plan(df) -> str:
    told = io.StringIO()
    with redirect_stdout(told):
        df.explain(True)
    return told.getvalue()


def test_lists_are_marked_where_they_would_be_made(spark, mini_catalog):
    cells = ["[1,2]", "[]", " [1,x]\n", "[a", "a]", "", None, "[['a,b',NULL]]", "[1,\n2]", "[1,2] x", "\t[\\']", "[,]", "NULL"]
    df = spark.createDataFrame([(c,) for c in cells], "watch_ids string")
    full = df.select(typed(F.col("watch_ids"), "HUGEINT[]").isNull().alias("gone")).collect()
    raw = df.select(*[(F.col("watch_ids") if f.storage_name == "watch_ids" else F.lit(None).cast("string")).alias(f.storage_name)
                      for f in mini_catalog.fields_for("visits")])
    marked = typed_projection(raw, mini_catalog, "visits", lists=False).select(F.col("watch_ids").isNull().alias("gone"))
    assert marked.collect() == full and {r.gone for r in full} == {True, False}
    assert "regexp_extract_all" not in plan(marked)


def test_counts_and_bounds_leave_the_sketches_unread(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    days = ["2026-05-01", "2026-05-02", "2026-05-03"]
    for n, d in enumerate(days):
        write_part(landing, "visits", d, "a.tsv", "\n".join([HV, *(f"{n * 100 + k}\t{k}\t{'[1,2]' if k % 2 else 'none'}\t{d}\t{k}\t{d} 10:00:00" for k in range(20))]) + "\n")
    load_days(spark, lake, landing, mini_catalog, "visits", days)
    counts = file_stats.column_counts_merged(spark, lake, mini_catalog, ["visits"])
    assert {r.column_name: r.non_null for r in counts.collect()}["watch_ids"] == 30
    context = file_stats.context_merged(spark, lake, mini_catalog, ["visits"])
    assert context.first().row_count == 60
    for df in (counts, context):
        scans = [x for x in plan(df).split("== Physical Plan ==")[1].splitlines() if "ReadSchema" in x and "held" in x or "min" in x and "ReadSchema" in x]
        assert scans and not any("hll" in x or "kll" in x for x in scans)
    # More values than one list holds, met by the set of all first.
    wanted = [*range(5, 25), 107, 219, 999]
    found = file_stats.lookup(spark, lake, mini_catalog, "visits", "visit_id", wanted)
    assert sorted(int(r.visit_id) for r in found.collect()) == [*range(5, 20), 107, 219]
    assert "INSET" in plan(found).upper()


def test_tabs_are_counted_by_bytes(spark):
    lines = ["a\tb", "\t\t", "", "é\t漢\t😀\t", "no tab", None, "\ta\\t"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    counted = df.select("line", tab_count(F.col("line")).alias("n"))
    assert [r.n for r in counted.collect()] == [None if x is None else x.count("\t") for x in lines]
    assert "translate" not in plan(counted)


def test_fingerprints_tell_their_hashes_as_numbers(spark):
    rng = random.Random(4)
    words = ["the", "of", "und", "la", "stone", "river", "Blau", "x", "montaña"]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 3, 40, 4_000)] + [None, "the", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = spotsigs.fingerprints(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.sigs == spotsigs.parse(r.fingerprint).astype(np.int64).tolist() == spotsigs.signatures(texts[r.doc_id]).tolist()
    assert "substring" not in plan(spotsigs.near_duplicates(df))


@pytest.mark.parametrize("lists", [[], [[]], [[], [1, 2**32 - 1], [], [7]]])
def test_arrays_of_signatures(lists):
    assert spotsigs.as_lists([np.array(x, np.uint32) for x in lists]).to_pylist() == lists
