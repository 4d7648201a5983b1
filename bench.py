"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data folder, BENCH_CPUS the
local cores. Every query is run once to warm up at the smallest scale, then timed
at the wanted one with its result written nowhere.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telemorph.queries import QUERIES  # noqa: E402
from telemorph.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_error_groups",
    "s01_scan_range_open_closed",
    "a13_bucket_counts",
    "p01_upgrade_spans_v2",
    "p02_span_model_json",
    "p09_upgrade_spans_v3",
    "p07_merge_number_attrs",
    "p27_resource_fingerprint",
    "a10_resource_catalog",
    "j01_attach_metric_name",
    "j12_resolve_attributes",
    "p31_upgrade_series",
    "p30_remap_samples",
    "r03_assign_tier",
    "d09_rewrite_dashboards",
    "d11_rewrite_alerts",
    "d15_upgrade_dashboards_v3",
    "b17_avg_logs",
    "b27_p95_logs",
    "b30_sum_rate_metrics",
    "b42_hist_quantile_99",
    "b51_composite",
    "c02_service_overview",
    "x_sql_5_inner_join",
    "x_pq_2_rate",
    "x_pq_7_subquery",
]


def run(spark, name: str, folder: str) -> float:
    start = time.time()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "telemorph-bench", shuffle_partitions=int(cores) if cores.isdigit() else 8)
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in HEADLINE:
            run(spark, name, small)
    times = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
