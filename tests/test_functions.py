from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from faremeld.functions import dates, money, names, text


def check(spark, fn, pairs, dtype="string"):
    got = values(spark, fn, [p[0] for p in pairs], dtype)
    assert got == [p[1] for p in pairs]


def test_clean_text(spark):
    check(spark, text.clean_text, [(None, ""), ("  a \n\t b ", "a b"), ("a　b c", "a b c"), ("　", "")])


def test_strip_prefix_label(spark):
    check(
        spark,
        text.strip_prefix_label,
        [
            ("Starts: Keelung (Taipei), Taiwan", "Keelung (Taipei), Taiwan"),
            ("Ends: Busan (Pusan), South Korea", "Busan (Pusan), South Korea"),
            ("Starts:   Tokyo,\n  Japan  ", "Tokyo, Japan"),
            ("Tokyo, Japan", "Tokyo, Japan"),
            ("port of call Tokyo", "Tokyo"),
            ("Shipping lane", "Shipping lane"),
            (None, ""),
        ],
    )


def test_match_port(spark):
    check(
        spark,
        names.match_port,
        [
            ("Keelung (Taipei), Taiwan", "Keelung"),
            ("Tokyo, Japan", "Tokyo"),
            ("Yokohama, Japan", "Yokohama"),
            ("KEELUNG (TAIPEI), TAIWAN", "Keelung"),
            ("Busan (Pusan), South Korea", None),
            ("", None),
            ("基隆港", "Keelung"),
            ("日本東京出發：下午 4:30", "Tokyo"),
            ("横浜港", "Yokohama"),
            ("日本 東京 (橫濱) 登船", "Yokohama"),
            ("高雄", None),
        ],
    )


def test_port_group(spark):
    check(
        spark,
        names.port_group,
        [("Tokyo", "tokyo/yokohama"), ("Yokohama", "tokyo/yokohama"), ("tokyo", "tokyo"), ("Kobe", "kobe"), (None, "")],
    )


def test_parse_date(spark):
    d = date(2026, 8, 16)
    check(
        spark,
        dates.parse_date,
        [
            ("Aug 16, 2026", d),
            ("August 16, 2026", d),
            ("2026-08-16", d),
            ("20260816", d),
            ("2026-W33-7", d),
            ("08/16/2026", d),
            ("8/16/2026", d),
            ("16-Aug-2026", d),
            ("2026/8/16", d),
            ("16 Aug 2026", d),
            ("2026-08-16T23:30:00-05:00", d),
            ("  Aug 16, 2026 \n", d),
            ("2026-08-16Tgarbage", None),
            ("2026-02-30", None),
            ("not a date", None),
            ("", None),
            (None, None),
        ],
    )


def test_date_range_cell(spark):
    d = date(2026, 8, 30)
    check(
        spark,
        dates.first_date_in_range_cell,
        [("Aug 30, 2026 - Sep 11, 2026 Sun - Fri Bonus Details", d), ("Aug 30, 2026", d), ("Bonus Details", None)],
    )


def test_parse_price(spark):
    check(
        spark,
        money.parse_price,
        [
            ("$479", Decimal(479)),
            ("$1,299", Decimal(1299)),
            ("$1,299.50", Decimal("1299.50")),
            ("Pricing On Request", None),
            ("", None),
            (None, None),
            ("$0", None),
            ("１２３元", Decimal(123)),
        ],
    )


def test_parse_nights(spark):
    check(
        spark,
        money.parse_nights,
        [
            ("3 Nights", 3),
            ("1 Night", 1),
            ("3 Night Keelung to Keelung Cruise", 3),
            ("2026: 14 nights", 14),
            ("7", 7),
            ("６", 6),
            ("no number here", None),
        ],
    )


def test_split_ports(spark):
    check(
        spark,
        text.split_ports,
        [
            ("Keelung (Taipei), Naha, Ishigaki, Keelung (Taipei)", ["Keelung (Taipei)", "Naha", "Ishigaki", "Keelung (Taipei)"]),
            ("", []),
            ("Ports of Call: Tokyo, Osaka, Kochi", ["Tokyo", "Osaka", "Kochi"]),
            ("a,, b ,", ["a", "b"]),
        ],
    )
    check(
        spark,
        lambda c: text.split_ports(c, " - "),
        [("Port of Call Tokyo, Japan - Kochi, Japan", ["Tokyo, Japan", "Kochi, Japan"])],
    )


def test_canonical_ship(spark):
    check(
        spark,
        names.canonical_ship,
        [
            ("鑽石公主號", "Diamond Princess"),
            ("Diamond Princess", "Diamond Princess"),
            ("藍寶石公主號", "Sapphire Princess"),
            ("【名人遊輪凱旋號】CELEBRITY ASCENT～ 12 晚", "CELEBRITY ASCENT"),
            ("愛達魔都號", "愛達魔都號"),
            (None, ""),
        ],
    )
    check(spark, names.is_unmapped_ship, [("愛達魔都號", True), ("鑽石公主號", False), ("Costa Serena", False)])


def test_longest_alias_prefers_length_then_order(spark):
    table = {"ab": "short", "abc": "long", "xyz": "other"}
    check(
        spark,
        lambda c: names.match_alias(c, table),
        [("..abc..", "long"), ("ab", "short"), ("abc xyz", "long"), ("q", None), ("", None)],
    )


def test_split_title(spark):
    rows = [
        ("【麗星郵輪探索星號】鹿兒島、熊本、那霸6天-週日出發", ("Star Voyager", "探索星號", "Star Cruises")),
        ("【MSC郵輪．榮耀號】沖繩自主遊４天", ("MSC Bellissima", "榮耀號", "MSC Cruises")),
        ("【公主遊輪】鑽石公主號～日本探險家之旅 11天｜可加購橫濱飯店", ("Diamond Princess", "鑽石公主號", "Princess Cruises")),
        ("", ("", "", "")),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, t string")
    got = names.with_ship_and_line(df, "t").orderBy("i").collect()
    assert [(r.ship_name, r.ship_name_raw, r.cruise_line) for r in got] == [r[1] for r in rows]
    unknown = names.with_ship_and_line(spark.createDataFrame([("【愛達郵輪】魔都號～上海３天",)], "t string"), "t").first()
    assert unknown.ship_name == unknown.ship_name_raw == "魔都號"


def test_line_from_slug(spark):
    check(
        spark,
        names.line_from_slug,
        [("celebrity", "Celebrity Cruises"), (" Holland America ", "Holland America Line"), ("ama-water ways", "Ama-Water Ways"), ("", ""), (None, "")],
    )


def test_canonical_line(spark):
    check(spark, names.canonical_line, [("MSC郵輪", "MSC Cruises"), ("Viking ", "Viking"), (None, "")])


def test_itinerary_ports(spark):
    check(
        spark,
        names.itinerary_ports,
        [
            ("【MSC郵輪．榮耀號】日韓自主遊６天～鹿兒島、濟州", ["鹿兒島", "濟州"]),
            ("【MSC郵輪．榮耀號】宮古島、沖繩、石垣島自主遊５天", ["宮古島", "沖繩", "石垣島"]),
            ("【MSC郵輪．榮耀號】日韓自主遊６天～佐世保、釜山(加購岸上觀光)", ["佐世保", "釜山"]),
            ("", []),
        ],
    )


def test_day_place(spark):
    check(
        spark,
        names.day_place,
        [
            ("第三天：鹿兒島【郵輪7:00抵達、19:00啟航】", "鹿兒島"),
            ("第1天\n日本 東京 (橫濱) 登船\n15:00 啟航", "日本 東京 (橫濱)"),
            ("第二天：海上巡航", ""),
            ("Day 4: at sea", ""),
            (None, ""),
        ],
    )


def test_journey_keeps_return_to_home_port(spark):
    days = ["第一天：基隆港【郵輪20:00啟航】", "第二天：海上巡航", "第三天：鹿兒島", "第四天：鹿兒島【12:00啟航】", "第五天：基隆港"]
    df = spark.createDataFrame([([(d,) for d in days],), (None,)], "daily array<struct<description:string>>")
    got = [r.ports for r in names.with_journey_ports(df, "daily", "ports").collect()]
    assert got == [["基隆港", "鹿兒島", "基隆港"], []]


def test_date_chunks(spark):
    df = spark.createDataFrame(
        [(date(2026, 8, 13), date(2026, 9, 12)), (date(2026, 8, 1), date(2026, 8, 1)), (date(2026, 8, 2), date(2026, 8, 1))],
        "s date, e date",
    )
    got = [r.c for r in df.select(dates.date_chunks(F.col("s"), F.col("e"), 5).alias("c")).collect()]
    assert len(got[0]) == 7 and got[0][0].chunk_start == date(2026, 8, 13) and got[0][-1].chunk_end == date(2026, 9, 12)
    for a, b in zip(got[0], got[0][1:]):
        assert (b.chunk_start - a.chunk_end).days == 1
    assert [(c.chunk_start, c.chunk_end) for c in got[1]] == [(date(2026, 8, 1), date(2026, 8, 1))]
    assert got[2] == []
    with pytest.raises(ValueError):
        dates.date_chunks(F.col("s"), F.col("e"), 0)


def test_chunk_of_agrees_with_chunks(spark):
    s, e = F.lit(date(2026, 8, 13)), F.lit(date(2026, 9, 12))
    days = spark.range(-3, 35).select(F.date_add(s, F.col("id").cast("int")).alias("d"))
    joined = days.join(
        spark.range(1).select(F.explode(dates.date_chunks(s, e)).alias("c")),
        (F.col("d") >= F.col("c.chunk_start")) & (F.col("d") <= F.col("c.chunk_end")),
        "left",
    ).select("d", F.col("c.chunk_start").alias("a"), F.col("c.chunk_end").alias("b"))
    direct = days.withColumn("c", dates.chunk_of(F.col("d"), s, e)).select("d", "c.chunk_start", "c.chunk_end")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, direct.collect()))


def test_epoch_days(spark):
    row = spark.range(1).select(
        dates.day_start_epoch(F.lit(date(2026, 8, 13))).alias("a"), dates.day_end_epoch(F.lit(date(2026, 8, 13))).alias("b")
    ).first()
    assert (row.a, row.b) == (1786579200, 1786665599)


def test_money_wording(spark):
    df = spark.createDataFrame(
        [(Decimal("89984"), "TWD"), (Decimal("2812"), "USD"), (Decimal("379.25"), "usd"), (Decimal("10"), "CAD"), (None, "USD")],
        "p decimal(18,4), c string",
    )
    got = [r.v for r in df.select(money.money(F.col("p"), F.col("c")).alias("v")).collect()]
    assert got == ["NT$89,984", "US$2,812", "US$379.25", "CAD 10", "洽詢報價"]


def test_quote_wording(spark):
    q = "struct<price:string,currency:string,price_twd:string>"
    rows = [("469.25", "USD", "14928"), ("120969", "TWD", "120969"), (None, "USD", None), ("50", "JPY", None)]
    check(
        spark,
        money.quote_for_table,
        list(zip(rows, ["NT$14928（USD 469.25）", "NT$120969", "洽詢報價", "JPY 50"])),
        q,
    )
    check(spark, money.quote_for_page, list(zip(rows, ["NT$14,928", "NT$120,969", "洽詢報價", "JPY 50"])), q)
    check(
        spark,
        lambda c: money.quote_for_tooltip(F.lit("x"), c),
        list(zip(rows, ["x：US$469.25", "x：NT$120,969", "x：洽詢報價", "x：JPY 50"])),
        q,
    )


def test_display_time(spark):
    row = spark.sql("select timestamp '2026-08-13 21:30:00' t").select(money.display_time(F.col("t")).alias("v")).first()
    assert row.v == "2026-08-14 05:30"
