"""Array-key links, bounded list building, zipped arrays and the driver contract."""


from daylake.operators.relations import bounded_lists, link_array_to_key, zipped_rows


def test_bounded_lists_split_hot_key(spark):
    rows = [(1, i, f"x{i}") for i in range(10)] + [(2, 0, "y")]
    df = spark.createDataFrame(rows, "k long, pos long, v string")
    for split_rows in (1_000_000, 4):
        out = bounded_lists(df, ["k"], ["pos"], ["v"], max_len=3, split_rows=split_rows).collect()
        got = sorted((r["k"], r["list_part"], r["v"]) for r in out)
        assert got == [(1, 0, ["x0", "x1", "x2"]), (1, 1, ["x3", "x4", "x5"]), (1, 2, ["x6", "x7", "x8"]), (1, 3, ["x9"]), (2, 0, ["y"])]


def test_bounded_lists_equal_rows_and_text_order(spark):
    rows = [(1, 5, "same")] * 200 + [(1, i, f"v{i}") for i in range(1000)] + [(None, 1, "n")]
    df = spark.createDataFrame(rows, "k long, pos long, v string")
    want = [v for _, _, v in sorted((r for r in rows if r[0]), key=lambda r: (r[1], r[2]))]
    for split_rows in (1_000_000, 100):
        out = sorted((r["list_part"], r["v"]) for r in bounded_lists(df.where("k = 1"), ["k"], ["pos"], ["v"], split_rows=split_rows).collect())
        assert [len(v) for _, v in out] == [500, 500, 200] and [x for _, v in out for x in v] == want


def test_link_and_zip(spark):
    visits = spark.createDataFrame([(1, [10, 11]), (2, [])], "visit_id long, watch_ids array<long>")
    hits = spark.createDataFrame([(10, "a"), (11, "b"), (12, "c")], "watch_id long, url string")
    inner = link_array_to_key(visits, "watch_ids", hits, "watch_id").collect()
    assert sorted((r["visit_id"], r["url"]) for r in inner) == [(1, "a"), (1, "b")]
    left = link_array_to_key(visits, "watch_ids", hits, "watch_id", how="left").collect()
    assert sorted((r["visit_id"], r["url"] or "") for r in left) == [(1, "a"), (1, "b"), (2, "")]
    z = spark.createDataFrame([(1, [1, 2], ["a", "b"])], "k long, ids array<long>, names array<string>")
    got = [tuple(r) for r in zipped_rows(z, ["k"], {"ids": "id", "names": "name"}).collect()]
    assert got == [(1, 1, "a"), (1, 2, "b")]


def test_driver_contract(spark):
    import __spark_entry__ as E
    from daylake.registry import QUERIES
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)
    assert set(QUERIES) <= set(o)
    df = E.entry(spark)
    assert df.columns == ["date", "n"]
    rows = df.collect()
    assert len(rows) == 30 and sum(r["n"] for r in rows) > 0
