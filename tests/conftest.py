import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daylake.session import get_spark  # noqa: E402
from daylake.sources.catalog import catalog_from_rows  # noqa: E402

# A small two-source catalog in the shape of the export: a visits-like source
# with an array key and a hits-like source.
MINI_ROWS = [
    ("visits", "visit_id", "v:visitID", "HUGEINT", "Visit id"),
    ("visits", "client_id", "v:clientID", "HUGEINT", "Client id"),
    ("visits", "watch_ids", "v:watchIDs", "HUGEINT[]", "Hits of the visit"),
    ("visits", "date", "v:date", "DATE", "Visit day"),
    ("visits", "page_views", "v:pageViews", "INTEGER", "Page views"),
    ("visits", "date_time", "v:dateTime", "TIMESTAMP", "Visit time"),
    ("hits", "watch_id", "h:watchID", "HUGEINT", "Hit id"),
    ("hits", "goals_id", "h:goalsID", "BIGINT[]", "Goals reached"),
    ("hits", "date", "h:date", "DATE", ""),
]


@pytest.fixture(scope="session")
def spark():
    s = get_spark("daylake-tests", master="local[2]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def mini_catalog(spark):
    return catalog_from_rows(spark, MINI_ROWS, allowed_sources=("visits", "hits"),
                             prefixes={"visits": "v:", "hits": "h:"})


@pytest.fixture()
def lake_dirs(tmp_path):
    return str(tmp_path / "lake"), str(tmp_path / "landing")


def write_part(landing, source, day, name, text, binary=False):
    d = Path(landing) / source / f"load_date={day}"
    d.mkdir(parents=True, exist_ok=True)
    p = d / name
    if binary:
        p.write_bytes(text)
    else:
        p.write_bytes(text.encode("utf-8"))
    return p
