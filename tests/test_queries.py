"""Registered queries against their SQL on the smallest tables.

A sample that touches every module; `python tests/oracle.py` runs them all.
"""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from faremeld.plans import table_queries

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "cross_source_merge",
    "incremental_merge",
    "stream_run_log",
    "snapshot_series",
    "failure_isolation",
    "master_dims",
    "master_without_ports",
    "output_order",
    "price_history",
    "consecutive_dedup",
    "fx_provider_fallback",
    "split_title",
    "nested_items",
    "embedded_items",
    "event_stream",
    "html_links",
    "result_table_last_wins",
    "sailing_cards",
    "clean_text",
    "csv_projection",
    "record_json",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_every_table_query_has_sql():
    """All of the library's own; the corpus queries, if there, state SQL where it can express them."""
    own = set(table_queries.all_queries())
    assert own == set(table_queries.all_sql())
    assert own <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_merge_is_cut_before_its_shuffles(spark):
    """Both reductions happen on the map side, and nothing is a cross join."""
    plan = entry.queries()["cross_source_merge"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Partial" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
