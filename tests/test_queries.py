"""Registered queries against their SQL.

A cross-section runs by default; TELEMORPH_ALL=1 runs every query (also:
``python tests/compare.py <folder> [prefix ...]``).
"""

import os

import pytest
from compare import compare, connect

from telemorph.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "flagship_error_groups", "s01_scan_range_open_closed", "s04_promoted_fields", "s05_read_documents", "s06_write_upgraded",
    "s07_fan_out", "p02_span_model_json", "p09_upgrade_spans_v3", "p08_upgrade_logs_v2", "p27_resource_fingerprint",
    "a10_resource_catalog", "j01_attach_metric_name", "j04_pair_metrics", "j12_resolve_attributes", "p31_upgrade_series",
    "p30_remap_samples", "j08_quarantine", "a05_cutover_ts", "a13_bucket_counts", "l03_time_gaps", "b43_query_faults", "b52_request_faults", "b59_rule_history", "j02_links_of_stored_spans", "s05_documents_job", "j07_dotted_twins_promoted",
    "r04_reconcile_ttl", "v01_count_parity", "d03_rewrite_names_from_series", "d09_rewrite_dashboards", "d10_panel_isolation", "d11_rewrite_alerts",
    "d13_rename_log_fields", "d15_upgrade_dashboards_v3", "d16_upgrade_rules_v3", "d17_upgrade_dashboards_promql", "d18_repair_layout",
    "b12_group_by", "b15_count_distinct_metrics", "b27_p95_logs", "b30_sum_rate_metrics", "b42_hist_quantile_99", "b46_limit_groups",
    "b51_composite", "b59_rule_states", "c02_service_overview", "c05_filtered_spans", "c07_span_facets", "c09_list_errors",
    "x_sql_11_parameters", "x_sql_17_quantile", "x_pq_2_rate", "x_pq_7_subquery", "x_pq_8_group_left", "x_pq_10_or", "x_pq_13_absent",
]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("TELEMORPH_ALL") else SAMPLE)
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, FOLDER)
    assert ok, note


def test_every_query_is_checked():
    assert QUERIES.keys() == ORACLES.keys()
