"""The SQL read surface over registered typed views (statements of the read channel)."""

import datetime as dt

from daylake.plans.load import load_days
from daylake.views import query, register_views
from tests.conftest import write_part

HH = "h:watchID\th:goalsID\th:date"


def test_sql_statements(spark, mini_catalog, lake_dirs):
    lake, landing = lake_dirs
    for d, n in (("2026-05-20", 3), ("2026-05-21", 2)):
        body = "".join(f"{i}\t[{i},{i + 1}]\t{d}\n" for i in range(n))
        write_part(landing, "hits", d, "p.tsv", f"{HH}\n{body}")
    load_days(spark, lake, landing, mini_catalog, "hits", ["2026-05-20", "2026-05-21"])
    register_views(spark, lake, mini_catalog)
    assert spark.sql("FROM hits SELECT count(*)").first()[0] == 5
    assert spark.sql("TABLE hits").count() == 5
    assert [r[0] for r in spark.sql("SELECT date, count(*) FROM hits GROUP BY 1 ORDER BY 1").collect()] == [
        dt.date(2026, 5, 20), dt.date(2026, 5, 21)]
    assert spark.sql("SELECT count(*) FROM visits").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM hits WHERE date >= today() - 36500").first()[0] == 5
    assert spark.sql("SELECT sum(size(goals_id)) FROM hits").first()[0] == 10
    assert spark.sql("SELECT count(*) FROM hits LATERAL VIEW explode(goals_id) g AS goal").first()[0] == 10
    assert spark.sql("SELECT count(*) FROM hits WHERE array_contains(goals_id, 1)").first()[0] == 4
    piv = spark.sql("SELECT * FROM (SELECT date, watch_id FROM hits) "
                    "PIVOT (count(watch_id) FOR date IN (DATE'2026-05-20' AS d20, DATE'2026-05-21' AS d21))")
    assert tuple(piv.first()) == (3, 2)
    unp = spark.sql("SELECT * FROM (SELECT 1 AS k, 3 AS a, 2 AS b) UNPIVOT (n FOR c IN (a, b))")
    assert unp.count() == 2
    assert {r[0] for r in spark.sql("SHOW TABLES").select("tableName").collect()} >= {"hits", "visits"}
    assert spark.sql("DESCRIBE hits").count() == 3
    assert "Scan" in "\n".join(r[0] for r in spark.sql("EXPLAIN SELECT * FROM hits").collect())
    assert spark.sql("VALUES (1), (2)").count() == 2
    summ = {r["column_name"]: r for r in query(spark, "SUMMARIZE hits;").collect()}
    assert summ["watch_id"]["count"] == 5 and summ["watch_id"]["max"] == "2"
    assert query(spark, "SUMMARIZE SELECT watch_id FROM hits WHERE date = DATE'2026-05-21'").first()["count"] == 2
    assert query(spark, "SELECT 1").first()[0] == 1
    assert query(spark, "summarize (SELECT watch_id FROM hits WHERE watch_id > 0)").first()["count"] == 3
    assert query(spark, "SUMMARIZE FROM hits SELECT watch_id").first()["count"] == 5
    assert spark.sql("WITH x AS (SELECT * FROM hits) SELECT count(*) FROM x").first()[0] == 5
    from daylake.operators.profile import list_objects
    names = [r[0] for r in list_objects(spark).collect()]
    assert names == sorted(names) and {"hits", "visits"} <= set(names)
