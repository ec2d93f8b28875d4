from __future__ import annotations

import csv
import glob
import io
import json
import os
import time
from datetime import date, datetime, timezone
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import quote, quotes_df
from pyspark.sql import functions as F

from faremeld.operators.history import price_changes
from faremeld.plans import publish, serving, store
from faremeld.plans.daily_run import run, run_sources
from faremeld.schemas import FX, RUN_STATUS
from faremeld.sources.published import read_csv, read_previous, read_previous_rate, read_snapshots
from faremeld.sources.registry import Source
from faremeld.streaming.daily_stream import land_run, merge_stream

OLD = {
    "generated_at": "2026-08-13T21:36:31+00:00",
    "run_report": {"generated_at": "x", "sources": []},
    "count": 1,
    "deals": [
        {
            "source": "cruisedirect",
            "sail_date": "2026-08-16",
            "depart_port": "Keelung",
            "ports_of_call": ["a", "b"],
            "ship_name": "Costa Serena",
            "cruise_line": "Costa Cruises",
            "nights": 3,
            "price": "379",
            "scraped_at": "2026-08-13T21:35:58.853832+00:00",
            "stale_since": None,
            "other_sources": {"icruise": None, "expedia": "379.25"},
        }
    ],
}


def text_of(path):
    parts = sorted(p for p in glob.glob(f"{path}/part-*") if os.path.getsize(p))
    return "".join(open(p, encoding="utf-8").read() for p in parts)


def fixed(name, make, error=None):
    """A source that gives ready quotes, or one reason to fail."""
    return Source(
        name,
        lambda df, start, end: make(df),
        lambda df, start, end: df.sparkSession.createDataFrame([(error,)] if error else [], "error string"),
    )


def registry(**sources):
    return {
        name: fixed(name, (lambda df: df.where("1/0 > 1")) if value == "boom" else (lambda df: df), value if isinstance(value, str) and value != "boom" else None)
        for name, value in sources.items()
    }


def test_run_publish_and_fail_over(spark, tmp_path):
    out = str(tmp_path)
    rows = [quote(), quote(ship_name="愛達魔都號", price=None), quote(sail_date=date(2026, 8, 1), price="100.50")]
    raw = {"icruise": (quotes_df(spark, rows),), "bwt": (quotes_df(spark, []),)}
    first = run(spark, raw, out, start=date(2026, 8, 13), selected=["icruise", "bwt"], manual_rate="32", registry=registry(icruise=1, bwt=1))
    assert not first.all_failed and "愛達魔都號" in first.warnings[0]
    document = json.loads(text_of(f"{out}/data/deals.json"))
    assert document["count"] == 3 and document["fx"]["usd_twd"] == "32" and document["fx"]["stale"] is False
    assert [d["price_twd"] for d in document["deals"]] == ["3216", "19584", None]
    assert document["run_report"]["sources"][0] == {**document["run_report"]["sources"][0], "source": "icruise", "ok": True, "count": 3, "error": None}
    assert document["run_report"]["sources"][1]["count"] == 0 and document["run_report"]["warnings"] == first.warnings
    assert document["deals"][1]["scraped_at"] == "2026-08-13T19:45:00+00:00" and document["deals"][1]["other_sources"] == {}

    # The published document is readable as the previous side.
    single = tmp_path / "deals.json"
    single.write_text(json.dumps(document), encoding="utf-8")
    back = read_previous(spark, str(single)).orderBy("row_ord").collect()
    assert [(r.ship_name, r.price) for r in back] == [("Carnival Luminosa", Decimal("100.5")), ("Carnival Luminosa", 612), ("愛達魔都號", None)]
    assert read_previous_rate(spark, str(single)).first().usd_twd == 32

    table = list(csv.reader(io.StringIO(text_of(f"{out}/data/deals.csv"))))
    assert table[0][0] == "﻿出發日期" and len([r for r in table if r[0] != table[0][0]]) == 3
    assert table[1][6] == "100.5" and table[3][6] == ""

    # Next day the source fails: its rows stay, stale, at the carried rate.
    second = run(spark, raw, out, start=date(2026, 8, 14), selected=["icruise"], registry=registry(icruise="Cloudflare"))
    got = second.quotes.collect()
    assert second.all_failed and len(got) == 3 and {r.stale_since for r in got} == {date(2026, 8, 13)}
    assert second.rate.first().stale and {r.price_twd for r in got} == {None, 3216, 19584}
    history = f"{out}/data/history"
    assert [tuple(r) for r in store.calendar(spark, history).orderBy("snapshot_date").collect()] == [(date(2026, 8, 13), None, date(2026, 8, 14)), (date(2026, 8, 14), date(2026, 8, 13), None)]
    kept = {r.day: r for r in store.of_days(store.commits(spark, history)).collect()}
    assert kept[date(2026, 8, 13)].warnings == first.warnings and [r.ok for r in kept[date(2026, 8, 14)].report] == [False]
    assert kept[date(2026, 8, 14)].fx.stale and kept[date(2026, 8, 14)].rows == 3


def test_exceptions_fail_only_their_source(spark, tmp_path):
    raw = {"icruise": (quotes_df(spark, [quote()]),), "expedia": (quotes_df(spark, [quote(source="expedia")]),)}
    got = run(spark, raw, str(tmp_path), start=date(2026, 8, 13), selected=["icruise", "expedia"], registry=registry(icruise=1, expedia="boom"), dry_run=True)
    report = {r.source: r.ok for r in got.report.collect()}
    assert report == {"icruise": True, "expedia": False} and not got.all_failed
    assert got.quotes.count() == 1 and got.rate.count() == 0 and os.listdir(tmp_path) == []


def placed(spark, rows):
    return quotes_df(spark, rows).withColumn("published_pos", F.col("row_ord")[0])


def publish_rows(spark, path, run_id, day, rows):
    report = spark.createDataFrame([(0, "icruise", True, 2, 1.0, None)], "src_ord int, source string, ok boolean, count bigint, duration_s double, error string")
    store.publish(placed(spark, rows), path, run_id, F.lit(day), report, spark.createDataFrame([], "warning string"), spark.createDataFrame([], FX))


def test_snapshot_of_a_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "h")
    assert store.snapshots(spark, path).count() == 0 and store.calendar(spark, path).count() == 0
    for i, (day, rows) in enumerate(((date(2026, 8, 1), [quote()]), (date(2026, 8, 2), [quote()]), (date(2026, 8, 2), [quote(), quote(nights=4)]))):
        publish_rows(spark, path, i, day, rows)
    counts = {r.snapshot_date: r["count"] for r in store.snapshots(spark, path).groupBy("snapshot_date").count().collect()}
    assert counts == {date(2026, 8, 1): 1, date(2026, 8, 2): 2}
    commit = store.newest_before(store.commits(spark, path), 2).first()
    assert (commit.run_id, commit.rows, commit.fx, commit.warnings, commit.report[0].source) == (1, 1, None, [], "icruise")


def test_a_write_without_its_commit_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "h")
    publish_rows(spark, path, 0, date(2026, 8, 1), [quote()])
    store.write_aside(placed(spark, [quote(), quote(nights=9)]), path)
    os.makedirs(f"{path}/quotes/attempt=torn")
    with open(f"{path}/quotes/attempt=torn/part-0.parquet", "wb") as file:
        file.write(b"PAR1 half")
    assert [r.nights for r in store.snapshots(spark, path).collect()] == [6]
    # A snapshot with a part missing is told from a whole one.
    publish_rows(spark, str(tmp_path / "i"), 0, date(2026, 8, 1), [quote(), quote(nights=9)])
    lost = [p for p in glob.glob(f"{tmp_path}/i/quotes/attempt=*/part-*.parquet") if pq.read_metadata(p).num_rows]
    os.remove(lost[0])
    with pytest.raises(Exception, match="damaged snapshot of 2026-08-01"):
        store.snapshots(spark, str(tmp_path / "i")).collect()


def test_a_run_committed_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "h")
    for rows in ([quote()], [quote(), quote(nights=4)]):
        publish_rows(spark, path, 7, date(2026, 8, 1), rows)
    assert store.commits(spark, path).count() == 1 and store.snapshots(spark, path).count() == 2


def test_sources_run_at_once_and_one_that_hangs_is_cancelled(spark, tmp_path):
    rows = quotes_df(spark, [quote(), quote(nights=4)])

    def wait(batches):
        for batch in batches:
            time.sleep(120)
            yield batch

    hanging = fixed("hanging", lambda df: df.mapInPandas(wait, df.schema))
    outside = fixed("outside", lambda df: time.sleep(60) or df)
    sources = [Source("hanging", hanging.parse, hanging.health, 5.0), fixed("good", lambda df: df), fixed("raising", lambda df: df.where("1/0 > 1")), Source("outside", outside.parse, outside.health, 6.0)]
    began = time.monotonic()
    got = run_sources(spark, sources, {s.name: (rows,) for s in sources}, date(2026, 8, 13), date(2026, 9, 13), {"good": f"{tmp_path}/good"})
    assert time.monotonic() - began < 50
    assert [(r["source"], r["ok"]) for r in got] == [("hanging", False), ("good", True), ("raising", False), ("outside", False)]
    assert got[0]["error"] == "gave no answer within 5 s" and "DIVIDE_BY_ZERO" in got[2]["error"] and got[1]["rows"].count() == 2
    for _ in range(100):  # the cancelled job frees its tasks
        if not spark.sparkContext.statusTracker().getActiveJobsIds():
            break
        time.sleep(0.1)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_previous_is_all_or_nothing(spark, tmp_path):
    assert read_previous(spark, str(tmp_path / "nope.json")).count() == 0
    path = tmp_path / "deals.json"
    cases = [
        ("{ not json", 0),
        (json.dumps(OLD), 1),
        (json.dumps({**OLD, "deals": OLD["deals"] + [{**OLD["deals"][0], "price": "亂碼"}]}), 0),
        (json.dumps({**OLD, "deals": [{k: v for k, v in OLD["deals"][0].items() if k != "nights"}]}), 0),
        (json.dumps({**OLD, "deals": []}), 0),
    ]
    for i, (text, rows) in enumerate(cases):
        path = tmp_path / f"deals{i}.json"
        path.write_text(text, encoding="utf-8")
        assert read_previous(spark, str(path)).count() == rows
        assert read_previous_rate(spark, str(path)).count() == 0


def test_document_in_parts_is_readable(spark, tmp_path):
    rows = [quote(sail_date=date(2026, 8, 1 + i % 28), ship_name=f"Ship {i}", price=str(100 + i), price_twd=str(3200 + i), fx_rate="32") for i in range(40)]
    rows[7]["other_sources"] = {"bwt": ("1", "TWD", "1")}
    quotes = quotes_df(spark, rows).withColumn("first_seen", F.col("row_ord"))
    rate = spark.sql("SELECT named_struct('usd_twd', 32.5BD, 'as_of', DATE'2026-08-13', 'source', 's', 'stale', false) AS r").select(F.col("r").cast(FX)).first()[0]
    rate = F.struct(*[F.lit(rate[n]).cast(FX[n].dataType).alias(n) for n in FX.fieldNames()])
    report = spark.createDataFrame([], RUN_STATUS).withColumn("count", F.lit(0))
    head = publish.envelope_head(report, rate, F.array().cast("array<string>"), F.lit(datetime(2026, 8, 13, tzinfo=timezone.utc)), F.lit(40))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    path = str(tmp_path / "d")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "6")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        publish.write_json(quotes, head, path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    parts = sorted(p for p in glob.glob(f"{path}/part-*") if os.path.getsize(p))
    assert len(parts) >= 4
    back = read_previous(spark, path).orderBy("row_ord").collect()
    assert [(r.sail_date, r.ship_name) for r in back] == [(r["sail_date"], r["ship_name"]) for r in sorted(rows, key=lambda r: (r["sail_date"], r["price_twd"]))]
    assert {r.ship_name: {k: tuple(v) for k, v in r.other_sources.items()} for r in back if r.other_sources} == {"Ship 7": {"bwt": ("1", "TWD", "1")}}
    assert read_previous_rate(spark, path).first().usd_twd == Decimal("32.5")
    # Without one of its parts the document is damaged, as a whole.
    copy = tmp_path / "damaged"
    copy.mkdir()
    for p in parts[:2] + parts[3:]:
        (copy / os.path.basename(p)).write_bytes(open(p, "rb").read())
    assert read_previous(spark, str(copy)).count() == 0


def test_both_generations_of_snapshots(spark, tmp_path):
    new = json.loads(json.dumps(OLD))
    new["deals"][0].update(price_twd="12065", fx_rate="31.8", other_sources={"x": {"price": "1", "currency": "TWD", "price_twd": "1"}, "y": {"price": None}})
    for day, doc in (("2026-08-13", OLD), ("2026-08-15", new)):
        (tmp_path / f"{day}.json").write_text(json.dumps(doc), encoding="utf-8")
    rows = read_snapshots(spark, f"{tmp_path}/*.json").orderBy("snapshot_date").collect()
    assert [r.snapshot_date for r in rows] == [date(2026, 8, 13), date(2026, 8, 15)]
    maps = [{k: tuple(v) for k, v in r.other_sources.items()} for r in rows]
    assert maps == [
        {"icruise": (None, "USD", None), "expedia": ("379.25", "USD", None)},
        {"x": ("1", "TWD", "1"), "y": (None, "USD", None)},
    ]
    assert rows[0].scraped_at.replace(tzinfo=timezone.utc) == datetime(2026, 8, 13, 21, 35, 58, 853832, tzinfo=timezone.utc)
    assert rows[0].currency == "USD" and rows[1].price_twd == 12065


def test_price_changes_over_missing_days(spark):
    data = [("a", 1, 10), ("a", 2, 10), ("a", 4, 12), ("b", 1, 5), ("b", 4, 5), ("c", 2, None), ("c", 4, 3), ("d", 2, 9)]
    df = spark.createDataFrame([(k, date(2026, 8, d), p) for k, d, p in data], "k string, snapshot_date date, p int")
    got = {(r.k, r.snapshot_date.day): (r.change, r.previous_price, r.dropped) for r in price_changes(df, ["k"], "p").collect()}
    assert got == {
        ("a", 1): ("new", None, False),
        ("a", 2): ("same", 10, False),
        ("a", 4): ("up", 10, False),
        ("b", 1): ("new", None, True),
        ("b", 4): ("new", None, False),
        ("c", 2): ("new", None, False),
        ("c", 4): ("requoted", None, False),
        ("d", 2): ("new", None, True),
    }


def test_stream_of_runs(spark, tmp_path):
    landing, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    rate = spark.sql("SELECT CAST(32 AS decimal(18,8)) AS usd_twd, DATE'2026-08-13' AS as_of, 's' AS source, false AS stale")

    def land(run_id, ok, rows=None):
        status = spark.createDataFrame([(i, s, o, None, 1.0) for i, (s, o) in enumerate(ok.items())], RUN_STATUS)
        land_run(landing, run_id, F.lit(date(2026, 8, 13 + run_id)), status, None if rows is None else quotes_df(spark, rows))

    def published():
        merge_stream(spark, landing, out, check, rate).awaitTermination(120)
        rows = store.quotes_of(spark, out, store.commits(spark, out), "run_id").orderBy("run_id", "ship_name").collect()
        return [(r.run_id, r.ship_name, r.price, r.stale_since is not None) for r in rows]

    land(0, {"icruise": True, "expedia": True}, [quote(), quote(source="expedia", ship_name="B")])
    first = [(0, "B", 612, False), (0, "Carnival Luminosa", 612, False)]
    assert published() == first
    # No source gives anything: nothing but a manifest lands, and the old rows are published as stale.
    land(1, {"icruise": False, "expedia": False})
    second = [(1, "B", 612, True), (1, "Carnival Luminosa", 612, True)]
    assert published() == first + second
    land(2, {"icruise": True, "expedia": False}, [quote(price="400")])
    land(3, {"expedia": True}, [])
    rest = [(2, "B", 612, True), (2, "Carnival Luminosa", 400, False), (3, "Carnival Luminosa", 400, True)]
    assert published() == first + second + rest
    # A run that comes again gives the same rows, and nothing new is nothing to do.
    land(1, {"icruise": False, "expedia": False})
    assert published() == first + second + rest and published() == first + second + rest
    reports = {r.run_id: [x.ok for x in r.report] for r in store.commits(spark, out).collect()}
    assert reports == {0: [True, True], 1: [False, False], 2: [True, False], 3: [True]}


def page_rows(spark):
    return quotes_df(
        spark,
        [
            quote(depart_port="Yokohama", ship_name="Diamond Princess", cruise_line="Princess Cruises", price="2812", price_twd="89984", fx_rate="32"),
            quote(price=None, currency="USD"),
            quote(source="asiayo", ship_name="Star Voyager", ship_name_raw="探索星號", cruise_line="", price="18000", currency="TWD", price_twd="18000"),
        ],
    )


def test_serving_views(spark):
    df = page_rows(spark)
    assert tuple(serving.summary_stats(df).first()) == (3, 18000, 2, "NT$18,000")
    assert serving.summary_stats(df.where("price_twd IS NULL")).first().lowest_text == "—"
    assert [tuple(r) for r in serving.facets(df).collect()] == [
        ("line", "Carnival Cruise Line"),
        ("line", "Princess Cruises"),
        ("port", "Keelung"),
        ("port", "Yokohama"),
    ]
    names = lambda **k: sorted(r.ship_name for r in serving.search(df, **k).collect())
    assert names(text=" DIAMOND ") == ["Diamond Princess"] and names(text="探索") == ["Star Voyager"]
    assert len(names(text="nagasaki")) == 3 and names(text="zzz") == [] and len(names()) == 3
    assert names(port="Keelung", line="Carnival Cruise Line") == ["Carnival Luminosa"]
    shown = serving.display_columns(df).collect()
    assert [(r.price_main, r.price_sort, r.price_original) for r in shown] == [
        ("NT$89,984", "89984", "US$2,812"),
        ("洽詢報價", "", ""),
        ("NT$18,000", "18000", ""),
    ]
    assert shown[0].note == "per guest, taxes extra（1 USD = 32 TWD）"


def test_csv_in_parts_has_one_header(spark, tmp_path):
    rows = [quote(sail_date=date(2026, 8, 1 + i % 28), ship_name=f"Ship {i}", price=str(100 + i)) for i in range(40)]
    rows[3].update(price_note='say "from", or\nso', ship_name="=1+1, x", price=None)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    path = str(tmp_path / "c")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "6")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        publish.write_csv(quotes_df(spark, rows).withColumn("first_seen", F.col("row_ord")), path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len([p for p in glob.glob(f"{path}/part-*") if os.path.getsize(p)]) >= 4
    text = text_of(path)
    assert text.count("出發日期") == 1 and text.startswith("\ufeff出發日期,")
    assert '"say ""from"", or\nso"' in text
    back = read_csv(spark, path).collect()
    assert {r["郵輪名"] for r in back} == {r["ship_name"] for r in rows} and len(back) == 40
    odd = next(r for r in back if r["郵輪名"] == "=1+1, x")
    assert odd["價格說明"] == 'say "from", or\nso' and odd["最低價格"] == ""


def test_document_without_rate_or_rows(spark, tmp_path):
    report = spark.createDataFrame([], RUN_STATUS).withColumn("count", F.lit(0))
    nothing = F.lit(None)
    empty = quotes_df(spark, []).withColumn("first_seen", F.col("row_ord"))
    head = publish.envelope_head(report, nothing.cast(FX), nothing.cast("array<string>"), F.lit(datetime(2026, 8, 13, tzinfo=timezone.utc)), F.lit(0))
    publish.write_json(empty, head, str(tmp_path / "d"))
    document = json.loads(text_of(tmp_path / "d"))
    assert document["deals"] == [] and document["fx"] is None and document["run_report"]["warnings"] == []
