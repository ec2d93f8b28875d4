"""Table queries that must stay whole and scale, over rows of their own."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as entry
from conftest import values
from pyspark.sql import functions as F

from faremeld.functions import names
from faremeld.plans.table_queries import feeds


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, 7 * k, "O", 1000.5 + k, datetime(1996, 3, 1 + k), "1-URGENT") for k in range(20)] + [(None, None, None, None, None, None)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, schema).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    items = [(k, 1, k, k, "N", "O") for k in range(20)]
    spark.createDataFrame(
        items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string"
    ).write.parquet(f"{folder}/lineitem.parquet")
    pages = [
        (1, "https://a.example/1", '<li><a href="/é">Longer label</a><li><a href="/b">B</a><p>The</p><p>x</p><p>y</p>'),
        (2, "https://a.example/2", "<li>no link<p>The</p>"),
        (3, "https://a.example/3", "<p>The</p>"),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="module")
def feed_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    parts = [(1, "hot bolt", "B#1", "SMALL", 1), (2, "red ring", "B#2", "LARGE", 2), (3, None, None, None, None)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    day = datetime(1996, 3, 1)
    lines = [(k, 2 * (k % 2) + 2, 1, k, 10.0 + k % 7, 0.1, "N", "OF"[k % 3 % 2], day) for k in range(1800)]
    lines += [(k, 1, 2, k, 5.0, 0.0, "R", "F", datetime(1996, 1 + k % 12, 1)) for k in range(190)]
    lines += [(7, 1, 3, 7, 5.0, 0.1, "A", "O", None), (7, 1, 3, 7, 5.0, 0.1, "A", "O", None), (None, None, 2, None, None, None, None, None, None)]
    lines += [(8, 1, None, 8, 5.0, 0.1, "A", "O", day)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def plan_of(spark, tables, name):
    return entry.queries()[name](spark, tables)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "name, once",
    [
        ("embedded_items", "soon"),  # the text of a page
        ("embedded_items_cheapest", "soon"),  # F12
        ("result_table", "MapInArrow"),  # F2
        ("result_table_last_wins", "MapInArrow"),  # F3
        ("card_page_states", "MapInArrow"),  # pages are read once
        ("sailing_cards", "([A-Z][a-z]{2}"),  # the date cell
        ("journey_ports", "RLIKE"),  # only the sea day is tested
    ],
)
def test_work_is_dealt_and_done_once(spark, tables, name, once):
    plan = plan_of(spark, tables, name)
    assert "RepartitionByExpression" in plan
    assert plan.count(once) == 1


def test_page_meta_builds_each_text_once_per_side(spark, tables):
    """claims and items, as the two sides of a join."""
    plan = plan_of(spark, tables, "page_meta")
    assert "RepartitionByExpression" in plan and plan.count("soon") <= 4


@pytest.mark.parametrize("name, rows", [("embedded_items", 40), ("result_table", 40), ("card_page_states", 21), ("journey_ports", 20)])
def test_dealt_rows_are_all_there(spark, tables, name, rows):
    assert entry.queries()[name](spark, tables).count() == rows


def test_parse_health_counts_every_link(spark, tables):
    """all links, whatever their address and label; paragraphs are not results."""
    got = {r.page_id: (r.claimed, r.parsed, r.verdict) for r in entry.queries()["parse_health"](spark, tables).collect()}
    assert got == {1: (2, 2, "ok"), 2: (1, 0, "unreadable"), 3: (0, 0, "empty")}


def test_day_place_of_odd_lines(spark):
    days = ["第1天", "Day 2", "第3天\n\n 那霸 抵達\n基隆", "第 四 天 ： 抵達", "ＤＡＹ", "  Day 3:Naha  DEPARTS 8", "", None, "第五天 at  sea", "Day 4 第5天 X"]
    assert values(spark, names.day_place, days) == ["", "", "那霸", "", "ＤＡＹ", "Naha", "", "", "", "第5天 X"]


@pytest.mark.parametrize("name", ["merge_carried_maps", "incremental_merge", "merge_already_stale", "merge_without_rate", "cross_source_merge"])
def test_merges_take_dealt_quotes(spark, feed_tables, name):
    """F8: a merge sorts quotes in tasks of a set size, not in splits of the file."""
    assert "RepartitionByExpression" in plan_of(spark, feed_tables, name)


def test_dealt_quotes_are_the_same_in_even_tasks(spark, feed_tables, monkeypatch):
    """F8: one sailing holds nine tenths of all lines, and no task more than half of it."""
    monkeypatch.setattr(feeds, "LINES_PER_TASK", 50)
    plain, dealt = (feeds.quote_feed(spark, feed_tables, d).drop("other_sources") for d in (False, True))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert dealt.rdd.getNumPartitions() == 40
    hot = dealt.where("lower(ship_name) = 'hot bolt'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) <= 5 and sum(r["count"] for r in hot) == 1800 and max(r["count"] for r in hot) < 900
