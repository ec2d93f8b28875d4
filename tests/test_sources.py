from __future__ import annotations

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from faremeld.operators.fx import (
    rate_as_of,
    carry_rate_forward,
    convert,
    provider_rates,
    rate_from_fallback,
    rate_from_primary,
    resolve_rate,
)
from faremeld.operators.quality import is_blocked
from faremeld.schemas import FX
from faremeld.sources import embedded_items, event_stream, html_tree, itinerary_api, result_table, sailing_cards
from faremeld.sources.registry import default_sources, select_sources

NOW = datetime(2026, 8, 13, 5, tzinfo=timezone.utc)
START, END = date(2026, 8, 13), date(2026, 9, 12)


# --- exchange rates --------------------------------------------------------------

PRIMARY = json.dumps(
    {"result": "success", "time_last_update_utc": "Mon, 17 Aug 2026 00:02:31 +0000", "rates": {"USD": 1, "TWD": 31.966724}}
)
FALLBACK = json.dumps({"USDTWD": {"Exrate": 31.875, "UTC": "2026-08-17 03:00:01"}})


def rates(spark, fn, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, payload string")
    return [r.v for r in df.select("i", fn(F.col("payload")).alias("v")).orderBy("i").collect()]


def test_primary_payload(spark):
    good, failed, missing, undated = rates(
        spark,
        rate_from_primary,
        [
            PRIMARY,
            '{"result":"error","rates":{"TWD":32}}',
            '{"result":"success","rates":{"JPY":159}}',
            '{"result":"success","rates":{"TWD":32},"time_last_update_utc":"亂碼"}',
        ],
    )
    assert (good.usd_twd, good.as_of, good.source) == (Decimal("31.96672400"), date(2026, 8, 17), "open.er-api.com")
    assert failed is None and missing is None
    assert undated.usd_twd == 32 and undated.as_of is not None


def test_fallback_payload(spark):
    good, no_pair, zero = rates(spark, rate_from_fallback, [FALLBACK, '{"USDJPY":{"Exrate":159}}', '{"USDTWD":{"Exrate":0}}'])
    assert (good.usd_twd, good.as_of, good.source) == (Decimal("31.875"), date(2026, 8, 17), "tw.rter.info")
    assert no_pair is None and zero is None


def payloads(spark, primary, fallback):
    return spark.createDataFrame([("tw.rter.info", fallback), ("open.er-api.com", primary)], "provider string, payload string")


def test_rate_resolution_order(spark):
    previous = spark.createDataFrame([(Decimal("30.5"), date(2026, 8, 10), "old", False)], FX)
    both, second, none = payloads(spark, PRIMARY, FALLBACK), payloads(spark, None, FALLBACK), payloads(spark, "x", "{}")
    pick = lambda *a: [(r.usd_twd, r.source, r.stale) for r in resolve_rate(spark, *a).collect()]
    assert pick("31.5", both, previous) == [(Decimal("31.5"), "--fx-rate（手動指定）", False)]
    assert pick("不是數字", both, previous)[0][1] == "open.er-api.com"
    assert pick(None, second, previous)[0][1] == "tw.rter.info"
    assert pick(None, none, previous) == [(Decimal("30.5"), "old", True)]
    assert pick(None, none, None) == [] and pick(None, None, None) == []
    assert provider_rates(both).count() == 2


def test_convert(spark):
    rows = [("2812", "USD", 89984), ("1742.5", " usd ", 55760), ("18000", "TWD", 18000), ("2.5", "TWD", 2), ("3.5", "TWD", 4), ("5", "JPY", None), (None, "USD", None)]
    df = spark.createDataFrame([(Decimal(p) if p else None, c) for p, c, _ in rows], "p decimal(18,4), c string")
    got = [r.v for r in df.select(convert(F.col("p"), F.col("c"), F.lit("32").cast("decimal(18,8)")).alias("v")).collect()]
    assert got == [w for _, _, w in rows]
    none = df.select(convert(F.col("p"), F.col("c"), F.lit(None).cast("decimal(18,8)")).alias("v")).collect()
    assert [r.v for r in none] == [None, None, 18000, 2, 4, None, None]


def test_carry_forward(spark):
    df = spark.createDataFrame([("p", 1, None), ("p", 2, 3.0), ("p", 3, None), ("q", 4, None)], "pair string, day int, rate double")
    got = {(r.pair, r.day): (r.rate, r.stale) for r in carry_rate_forward(df, "pair", "day", "rate").collect()}
    assert got == {("p", 1): (None, False), ("p", 2): (3.0, False), ("p", 3): (3.0, True), ("q", 4): (None, False)}


# --- itinerary items --------------------------------------------------------------

MASTER = {
    "isSucceed": True,
    "data": {
        "ship": [{"id": 1095, "name": "Old", "parentId": 1}, {"id": 1095, "name": "Costa Serena", "parentId": 7}],
        "cruiseline": [{"id": 7, "name": "Costa Cruises"}],
        "port": [{"code": "KEEL", "name": "Keelung"}, {"code": "SIN", "name": "Singapore"}],
    },
}


def item(**over):
    base = {
        "itinerary": {"duration": 3, "departure": {"code": "KEEL"}, "arrival": {"code": "XXX"}},
        "ship": {"id": 1095},
        "packages": [
            {
                "id": 1,
                "startDateTime": "16-Aug-2026",
                "prices": [
                    {
                        "items": [
                            {"name": "Inside", "value": 379.25},
                            {"name": "Suite", "value": 964.0},
                            {"code": "CruiseTax", "value": 4.35},
                            {"name": "Balcony", "value": 0},
                        ],
                        "currencyCode": "CAD",
                    }
                ],
            },
            {"id": 2, "startDateTime": "19-Aug-2026", "prices": []},
            {"id": 3, "prices": []},
            {"id": 4, "startDateTime": "16-Aug-2029"},
        ],
    }
    return {**base, **over}


def items_df(spark, rows):
    return spark.createDataFrame([(i, json.dumps(r), NOW) for i, r in enumerate(rows)], "item_no long, payload string, scraped_at timestamp")


def master_df(spark, data=MASTER):
    return spark.createDataFrame([(json.dumps(data),)], "payload string")


def test_itinerary_items(spark):
    rows = [item(), item(ship={"id": 9}, packages=item()["packages"][:1]), item(itinerary={"departure": {"code": "SIN"}})]
    got = itinerary_api.parse(items_df(spark, rows), master_df(spark), START, END).orderBy("row_ord").collect()
    assert [(r.sail_date, r.ship_name, r.cruise_line, r.nights, r.price, r.currency) for r in got] == [
        (date(2026, 8, 16), "Costa Serena", "Costa Cruises", 3, Decimal("379.25"), "CAD"),
        (date(2026, 8, 19), "Costa Serena", "Costa Cruises", 3, None, "USD"),
        (date(2026, 8, 16), "", "", 3, Decimal("379.25"), "CAD"),
    ]
    assert {r.depart_port for r in got} == {"Keelung"} and {r.arrive_port for r in got} == {"XXX"}
    assert got[0].detail_url.endswith("/package/1?siid=1095905&lang=1")


def test_master_data_in_parts_keeps_the_last_entry(spark):
    first = {"data": {"ship": [{"id": "1", "name": "A", "parentId": "9"}, {"id": "1", "name": "B"}], "port": [{"code": "KEE", "name": "old"}]}}
    second = {"data": {"cruiseline": [{"id": "9", "name": "Line"}], "port": [{"code": "KEE", "name": "new"}, {"code": "KEE", "name": "last"}], "ship": None}}
    parts = spark.createDataFrame([(json.dumps(second), 2), (json.dumps(first), 1), ("broken", 3), (None, 4)], "payload string, part int")
    got = sorted(tuple(r) for r in itinerary_api.master_dims(parts).collect())
    assert got == [("line", "9", "Line", None), ("port", "KEE", "last", None), ("ship", "1", "B", None)]


def test_items_without_port_dimension_fail(spark):
    empty = {"data": {"ship": [], "cruiseline": [], "port": []}}
    assert itinerary_api.health(items_df(spark, [item()]), master_df(spark, empty)).count() == 1
    assert itinerary_api.health(items_df(spark, []), master_df(spark, empty)).count() == 0
    assert itinerary_api.health(items_df(spark, [item()]), master_df(spark)).count() == 0


# --- embedded items -----------------------------------------------------------------


def pushed(text):
    cut = len(text) // 2
    parts = [json.dumps(text[:cut], ensure_ascii=False), "null", json.dumps(text[cut:])]
    return "<html>" + "".join(f"<script>self.__next_f.push([1,{p}])</script>" for p in parts) + "</html>"


def embedded(number, name, dates, price=18000, days=6, first="第一天：基隆港【郵輪20:00啟航】"):
    return {
        "id": number,
        "name": name,
        "activityDays": days,
        "availableDates": dates,
        "price": price,
        "port": {"id": "TYO", "name": "東京（東京/橫濱）"},
        "journey": {"daily": [{"description": d} for d in (first, "第二天：海上巡航", "第三天：鹿兒島", "第四天：基隆港")]},
    }


def flight(*items, total=None):
    body = "".join(f'x"item":{json.dumps(i, ensure_ascii=False)},"y":[' for i in items)
    meta = f'{{"total":{total},"currentPage":1,"limit":20}}' if total is not None else ""
    return pushed("8:[" + body + meta)


def pages_df(spark, htmls, start=START, end=END):
    rows = [(i, h, start, end, NOW) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_no long, html string, chunk_start date, chunk_end date, scraped_at timestamp")


def test_embedded_items(spark):
    star = "【麗星郵輪探索星號】鹿兒島、熊本、那霸6天-週日出發"
    diamond = "【公主遊輪】鑽石公主號～日本探險家之旅 11天"
    html = flight(
        embedded(51219, star, ["2026-08-23", "2026-09-13", "soon"]),
        embedded(51220, star, ["2026-08-23"], price=17000.5),
        embedded(7, diamond, ["2026-08-26"], first="第1天\n日本 東京 (橫濱) 登船\n15:00 啟航"),
        total=3,
    )
    got = embedded_items.parse(pages_df(spark, [html])).orderBy("sail_date").collect()
    assert [(r.sail_date, r.ship_name, r.ship_name_raw, r.cruise_line, r.nights, r.price, r.currency) for r in got] == [
        (date(2026, 8, 23), "Star Voyager", "探索星號", "Star Cruises", 5, Decimal(17000), "TWD"),
        (date(2026, 8, 26), "Diamond Princess", "鑽石公主號", "Princess Cruises", 5, Decimal(18000), "TWD"),
    ]
    assert got[0].ports_of_call == ["基隆港", "鹿兒島", "基隆港"] and got[0].arrive_port == "基隆港"
    assert got[0].depart_port == "Keelung" and got[1].depart_port == "Yokohama"
    assert got[0].detail_url.endswith("/cruise/item/51220/?activityStartDate=2026-08-23")
    assert got[0].depart_port_raw == "東京（東京/橫濱）" and got[0].row_ord == [0, 0, 0]


def test_nested_item_mark_is_read_whole(spark):
    outer = embedded(1, "A", [])
    outer["extra"] = {"item": {"id": 2, "name": "B"}}
    df = pages_df(spark, [pushed('"item":' + json.dumps(outer) + " tail")])
    got = embedded_items.read_items(df).select("item.id", "item.name").collect()
    assert sorted(map(tuple, got)) == [("1", "A"), ("2", "B")]


def test_embedded_page_health(spark):
    pages = [flight(embedded(1, "A", []), total=6), flight(total=12), "<html>nothing here</html>"]
    got = {r.page_no: (r.claimed, r.parsed, r.verdict) for r in embedded_items.page_health(pages_df(spark, pages)).collect()}
    assert got == {0: (6, 1, "ok"), 1: (12, 0, "unreadable"), 2: (0, 0, "empty")}
    # Only the first page of a chunk is judged; an empty later one ends the list.
    assert embedded_items.health(pages_df(spark, pages)).count() == 0
    second = pages_df(spark, pages).where("page_no > 0")
    assert embedded_items.health(second).count() == 1
    two = pages_df(spark, pages).withColumn("port_id", F.col("page_no") % 2)
    assert [r.error for r in embedded_items.health(two).collect()] == ["ParseError: page 1 claims 12 results, none read"]


# --- event stream --------------------------------------------------------------------


def lines_df(spark, *streams):
    rows = [(s, i, line, NOW) for s, lines in enumerate(streams) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "stream_id long, line_no long, value string, scraped_at timestamp")


def step(name, data):
    return "data: " + json.dumps({"step": name, "data": data}, ensure_ascii=False)


MAINS = [
    {"mainGroupCode": "M", "groupName": "old", "hasCruisePrice": False},
    {"mainGroupCode": "M", "groupName": "【MSC郵輪．榮耀號】沖繩自主遊４天", "hasCruisePrice": True},
    {"mainGroupCode": "F", "groupName": "【單訂船票】八重山丸", "hasCruisePrice": False},
    {"mainGroupCode": "", "groupName": "x", "hasCruisePrice": True},
]
GROUPS = [
    {"leaveDate": "2026/08/29", "groupDay": 6, "price": 9900, "groupName": "【MSC郵輪．榮耀號】日韓自主遊６天～鹿兒島、濟州", "groupCode": "G1"},
    {"leaveDate": "2026/08/29", "groupDay": 6, "price": 11900, "groupCode": "G2"},
    {"leaveDate": "2026/09/04", "groupDay": 4, "price": 99999999},
    {"leaveDate": "bad", "groupDay": 4, "price": 1},
    {"leaveDate": "2026/09/05", "groupDay": 1, "price": 1},
]
DETAILS = [
    {"mainGroupCode": "M", "departure": " 基隆港 ", "groups": GROUPS},
    {"mainGroupCode": "M", "departure": "桃園國際機場", "groups": GROUPS},
    {"mainGroupCode": "F", "departure": "基隆港", "groups": GROUPS},
    {"mainGroupCode": "?", "departure": "基隆港", "groups": GROUPS},
]


def test_event_lines(spark):
    df = lines_df(spark, ["", ": keep-alive", step("step1", []), "data: {broken", "data: [DONE]", 'data: {"step":"a"} junk', "event: complete", step("step1", [1])])
    assert [(r.step, r.data) for r in event_stream.read_events(df).collect()] == [("step1", "[1]")]


def test_event_stream_rows(spark):
    df = lines_df(spark, [step("step1", MAINS), step("step2", DETAILS), step("step3", {"totalGroups": 1})])
    got = event_stream.parse(df, START, END).orderBy("sail_date").collect()
    assert [(r.sail_date, r.ship_name, r.nights, r.price, r.ports_of_call, r.detail_url) for r in got] == [
        (date(2026, 8, 29), "MSC Bellissima", 5, Decimal(9900), ["鹿兒島", "濟州"], "https://www.bwt.com.tw/Tour/G1"),
        (date(2026, 9, 4), "MSC Bellissima", 3, None, ["沖繩"], ""),
    ]
    assert {(r.depart_port, r.arrive_port, r.cruise_line) for r in got} == {("Keelung", "Keelung", "MSC Cruises")}
    assert event_stream.health(df).count() == 0
    assert event_stream.parse(df, date(2026, 1, 1), date(2026, 1, 31)).count() == 0


def test_incomplete_streams_fail(spark):
    cut = lines_df(spark, [step("step1", MAINS), step("step2", DETAILS)])
    no_start = lines_df(spark, [step("step1", []), step("step2", []), step("step3", {})])
    assert "incomplete" in event_stream.health(cut).first().error
    assert "no_start" in event_stream.health(no_start).first().error
    assert event_stream.health(lines_df(spark, [": keep-alive"])).count() == 1
    no_code = lines_df(spark, [step("step1", [{"groupName": "x"}, {"mainGroupCode": ""}]), step("step2", []), step("step3", {})])
    assert "no_start" in event_stream.health(no_code).first().error


# --- result tables ---------------------------------------------------------------------


def result_row(day, port, price, ship="Costa Serena", length="3 Nights", href="/itineraries/a.html?x=1"):
    return (
        f"<tr><td><div class='celldata depart'><h2>{day}</h2></div><td><div class='celldata itin2'><h2>3 Night Tour</h2>"
        f"<div class=ship>{ship}</div><div class=line>Costa Cruises</div></div><div class=route><div class=start><b>Starts: </b>{port}</div>"
        "<div class=end><b>Ends: </b>Busan (Pusan), South Korea</div></div><div class=ports><div class=port_list>Keelung (Taipei), Naha</div></div>"
        f"<td><div class='celldata length'><h2>{length}</h2></div><td><div class='celldata price'>{price}<a href='{href}'>Learn More</a></div></tr>"
    )


def result_page(claimed, *rows):
    return f"<html><span>{claimed} Matched Sailings</span><table id='results_table'><tr><th>h</th></tr>{''.join(rows)}</table></html>"


def html_df(spark, htmls, title="ok"):
    return spark.createDataFrame([(i, title, h, NOW) for i, h in enumerate(htmls)], "page_no long, title string, html string, scraped_at timestamp")


def test_result_table(spark):
    page = result_page(
        3,
        result_row("Aug 16, 2026", "Keelung (Taipei), Taiwan", "<h2>Pricing On<br>Request</h2>"),
        result_row("Sep 5, 2026", "Yokohama, Japan", "from <h2>$1,742</h2> per person", "Diamond Princess", ""),
        result_row("Sep 6, 2026", "Singapore", "<h2>$5</h2>"),
    )
    later = result_page(1, result_row("Aug 16, 2026", "Keelung", "<h2>$500</h2>", "COSTA SERENA"))
    got = result_table.parse(html_df(spark, [page, later])).orderBy("sail_date").collect()
    assert [(r.sail_date, r.depart_port, r.ship_name, r.nights, r.price, r.price_note) for r in got] == [
        (date(2026, 8, 16), "Keelung", "COSTA SERENA", 3, Decimal(500), ""),
        (date(2026, 9, 5), "Yokohama", "Diamond Princess", 3, Decimal(1742), "from per person"),
    ]
    assert got[0].arrive_port == "Busan (Pusan), South Korea" and got[0].ports_of_call == ["Keelung (Taipei)", "Naha"]
    assert got[0].detail_url == "https://www.icruise.com/itineraries/a.html" and got[0].row_ord == [0, 0]
    assert result_table.health(html_df(spark, [page])).count() == 0


def test_result_table_fails_loudly(spark):
    assert result_table.health(html_df(spark, [result_page(42)])).count() == 1
    assert result_table.health(html_df(spark, ["<html><span>0 Matched Sailings</span></html>"])).count() == 0
    assert result_table.health(html_df(spark, [result_page(1, result_row("soon", "Keelung", ""))])).count() == 1
    assert [r.claimed for r in result_table.warnings(html_df(spark, [result_page(119), result_page(25)])).collect()] == [119]


# --- cards -----------------------------------------------------------------------------


def card(city, *tables, ports="Tokyo, Japan - Kochi, Japan - Tokyo, Japan", slug="celebrity"):
    body = "".join(
        "<div class=price-table><div class=price-table-body>"
        + "".join(f"<div class=price-table-cell>{c}</div>" for c in cells)
        + f"</div><a href='https://book.example/{n}'>Select</a></div>"
        for n, cells in enumerate(tables)
    )
    return (
        "<article class='node node--type-sailing'>"
        f"<div class='field--name-field-itinerary-id'>Port of Call {ports} Itinerary Details</div>"
        f"<div class='field--name-field-sailing-departure-city-id'>{city}</div><div class='field--name-field-sailing-ship-id'>Ship: Celebrity Millennium</div>"
        f"<div class='x-cruiseline-logo'><img alt='{slug}'></div><div class='field--name-field-sailing-duration'>12 Nights</div>{body}</article>"
    )


def test_cards(spark):
    html = card(
        "Tokyo",
        ("Aug 18, 2026 - Aug 30, 2026 Sun", "$2,772 USD", "-", "$3,001 USD"),
        ("Aug 30, 2026", "-", "-"),
        ("Bonus Details", "$5"),
        ("Sep 30, 2026", "$7"),
    )
    fallback = card("", ("Aug 20, 2026", "$100"), ports="Keelung (taipei) - Naha", slug="costa")
    got = sailing_cards.parse(html_df(spark, [html, fallback, card("Singapore", ("Aug 21, 2026", "$1"), ports="Singapore")]), START, END)
    got = got.orderBy("sail_date").collect()
    assert [(r.sail_date, r.depart_port, r.price, r.cruise_line, r.detail_url) for r in got] == [
        (date(2026, 8, 18), "Tokyo", Decimal(2772), "Celebrity Cruises", "https://book.example/0"),
        (date(2026, 8, 20), "Keelung", Decimal(100), "Costa Cruises", "https://book.example/0"),
        (date(2026, 8, 30), "Tokyo", None, "Celebrity Cruises", "https://book.example/1"),
    ]
    assert got[0].ports_of_call == ["Tokyo, Japan", "Kochi, Japan", "Tokyo, Japan"] and got[0].nights == 12
    assert got[1].depart_port_raw == "Keelung (taipei)" and got[0].ship_name == "Celebrity Millennium"


def test_card_health(spark):
    good = card("Tokyo", ("Aug 18, 2026", "$1"))
    empty = "<html><article class='node node--type-sailing'><div>x</div></article></html>"
    states = sailing_cards.page_states(html_df(spark, [good, empty, "<h1>x</h1>", good + "<i>cf-chl</i>"])).orderBy("page_no")
    assert [r.state for r in states.collect()] == ["ok", "unreadable", "no_cards", "blocked"]
    errors = lambda *h: [r.error.split(":")[0] for r in sailing_cards.health(html_df(spark, list(h))).collect()]
    assert errors(good) == [] and errors(good, "cf-chl") == []
    assert errors("cf-chl") == ["BlockedError"] and errors(good, empty) == ["ParseError"]
    # Rows outside the window are no reason to trust a run with blocked pages.
    late = html_df(spark, [good, "cf-chl"])
    assert sailing_cards.health(late, date(2027, 1, 1), date(2027, 2, 1)).count() == 1
    assert sailing_cards.health(late, START, END).count() == 0
    assert sailing_cards.health(html_df(spark, [good]), date(2027, 1, 1), date(2027, 2, 1)).count() == 0


def test_block_page_detection(spark):
    df = spark.createDataFrame(
        [("<html></html>", "Just a moment..."), ("<html></html>", "Attention Required! | X"), ("a challenges.cloudflare.com b", ""), ("<p>7 Night</p>", "Deals"), ("", "x"), (None, None)],
        "html string, title string",
    )
    got = [r.b for r in df.select(is_blocked(F.col("html"), F.col("title")).alias("b")).collect()]
    assert got == [True, True, True, False, False, False]


# --- registry and helper -----------------------------------------------------------------


def test_select_sources():
    everything = ["icruise", "expedia", "cruisedirect", "asiayo", "bwt"]
    assert select_sources(None) == everything and select_sources(" ALL ") == everything
    assert select_sources(" icruise , expedia ") == ["icruise", "expedia"]
    assert select_sources("bwt,,bwt, icruise") == ["bwt", "icruise"] and select_sources(" , ") == []
    with pytest.raises(ValueError):
        select_sources("nosuchsite")
    assert list(default_sources()) == everything


def test_html_tree():
    page = html_tree.parse(
        "<!-- <p class=a>no</p> --><DIV class='a b'><p id=x>one<p>two &amp; <b>three</b></div>"
        "<script>if (a < b) '<p class=a>'</script><ul><li>1<li>2</ul><img src=y><a title='a > b' href=\"/q?a=1&amp;b\">z</a>"
    )
    assert [n.text() for n in page.find_all("div.a p")] == ["one", "two &  three"]
    assert page.find("#x").text() == "one" and page.find("div.b.a") is not None and page.find("p.a") is None
    assert [n.text() for n in page.find_all("ul li")] == ["1", "2"]
    assert html_tree.attr_at(page, "a[href]", "href") == "/q?a=1&b" and html_tree.attr_at(page, "a[title*=b]", "title") == "a > b"
    assert html_tree.text_at(page, "h1") is None and html_tree.parse("").text() == "" and html_tree.parse("a < b").text() == "a < b"


# --- dated rates ----------------------------------------------------------------------


def test_rates_as_of_a_day(spark):
    day = lambda text: date.fromisoformat(text)
    rates = spark.createDataFrame([("a", day("2026-01-10"), 1.0), ("a", day("2026-01-31"), 2.0), ("a", day("2026-01-31"), 1.5), ("a", day("2026-04-05"), 3.0), ("b", day("2027-01-01"), 9.0), (None, day("2026-01-01"), 8.0), ("c", day("2026-01-01"), None)], "p string, d date, rate double")
    asked = [("a", "2026-01-09", None), ("a", "2026-01-10", 1.0), ("a", "2026-01-30", 1.0), ("a", "2026-01-31", 2.0), ("a", "2026-02-01", 2.0), ("a", "2026-03-31", 2.0), ("a", "2026-04-04", 2.0), ("a", "2026-04-05", 3.0), ("a", "2028-12-31", 3.0), ("b", "2026-12-31", None), ("c", "2026-06-01", None), (None, "2026-06-01", None), ("a", None, None)]
    rows = spark.createDataFrame([(i, p, d and day(d)) for i, (p, d, _) in enumerate(asked)], "i int, p string, d date")
    got = [r.rate for r in rate_as_of(rows, rates, "p", "d").orderBy("i").collect()]
    assert got == [want for *_, want in asked]
    assert rate_as_of(rows, rates.limit(0), "p", "d").where("rate IS NOT NULL").count() == 0 and rate_as_of(rows.limit(0), rates, "p", "d").count() == 0
