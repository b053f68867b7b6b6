from daylake.plans import journal
from daylake.streaming.landing_stream import start_landing_stream
from daylake.views import typed_source
from tests.conftest import write_part

HH = "h:watchID\th:goalsID\th:date"


def test_stream_loads_days_as_parts_land(spark, mini_catalog, lake_dirs, tmp_path):
    lake, landing = lake_dirs
    ckpt = str(tmp_path / "stream-ckpt")
    write_part(landing, "hits", "2026-05-20", "a.tsv", f"{HH}\n1\t[]\t2026-05-20\n")
    q = start_landing_stream(spark, lake, landing, mini_catalog, "hits", ckpt)
    q.awaitTermination()
    assert typed_source(spark, lake, mini_catalog, "hits").count() == 1
    # A second part of the same day and a new day arrive: both days are (re)loaded whole.
    write_part(landing, "hits", "2026-05-20", "b.tsv", f"{HH}\n2\t[]\t2026-05-20\n")
    write_part(landing, "hits", "2026-05-21", "a.tsv", f"{HH}\n3\t[]\t2026-05-21\n")
    q = start_landing_stream(spark, lake, landing, mini_catalog, "hits", ckpt)
    q.awaitTermination()
    assert typed_source(spark, lake, mini_catalog, "hits").count() == 3
    st = {str(r["load_date"]): (r["status"], r["row_count"]) for r in journal.current(spark, lake).collect()}
    assert st == {"2026-05-20": ("loaded", 2), "2026-05-21": ("loaded", 1)}
