"""Bench: land + verified load of the driver tables as day sources, then the registered queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line.  Query times run each plan to completion with the
``noop`` sink (nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daylake.registry import QUERIES  # noqa: E402
from daylake.session import get_spark  # noqa: E402
from daylake.workloads import SOURCES, base_lake, land, load_all, memo  # noqa: E402

HEADLINE = ["daily_counts", "day_filter", "typed_roundtrip_lineitem", "typed_roundtrip_orders",
            "typed_arrays_num", "zipped_arrays", "visit_hits_join", "typed_int_rounding", "typed_bad_cells",
            "retention_days", "props_json", "pivot_types", "context_profile", "summarize_exact", "summarize",
            "page_meta", "tsv_part_counts", "reconcile_truth", "select_days", "row_check_report",
            "day_replace", "schema_drift", "empty_day", "range_load_summary", "stream_daily_counts",
            "export_counts",
            "encode_csv", "encode_md"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("daylake-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    lake = memo(spark, ("base", sf), lambda: base_lake(spark, sf, []))
    for s in SOURCES:
        t = time.time()
        land(spark, lake, s)
        times[f"land_{s}"] = time.time() - t
        t = time.time()
        rep = load_all(spark, lake, s)
        memo(spark, ("base", sf, s), lambda rep=rep: rep)
        bad = rep.where("status != 'loaded'").count()
        times[f"load_{s}"] = time.time() - t
        if bad:
            raise SystemExit(f"{s}: {bad} days failed to load")
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = time.time() - t
    total = sum(times.values())
    print(json.dumps({"metric": "land_load_and_queries_total", "value": round(total, 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": Path(sf).name.replace("sf", "")}))


if __name__ == "__main__":
    main()
