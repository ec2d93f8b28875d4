"""Source readers over payloads that Spark derives from the tables.

Each table row becomes raw source text (JSON, event lines, HTML); the reader
turns it back into quotes, and the SQL states those quotes directly.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from faremeld.functions.money import plain_number
from faremeld.functions.text import computed
from faremeld.plans.table_queries.feeds import raw_table, spread, table
from faremeld.plans.table_queries.registry import query
from faremeld.sources import embedded_items, event_stream, itinerary_api, published, result_table, sailing_cards

FIRST, LAST = date(1996, 1, 1), date(1998, 12, 31)
_IN_WINDOW = "BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"


def _text(name: str):
    return F.coalesce(plain_number(F.col(name)), F.lit("")).alias(name)


def _record(names: str, *values):
    return F.struct(*[v.alias(n) for v, n in zip(values, names.split(), strict=True)])


def _day(name: str = "sail_date"):
    return F.col(name).cast("string").alias(name)


# --- nested itinerary items ---------------------------------------------------


def _items(spark, sf_dir) -> DataFrame:
    orders = raw_table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    none = F.lit(None).cast("string")
    inside = F.when(F.col("o_orderkey") % 3 == 0, price - 500).otherwise(0).cast("decimal(18,2)")
    cabins = F.array(
        _record("name code value", F.lit("Balcony"), none, price),
        _record("name code value", F.lit("Inside"), none, inside),
        _record("name code value", none, F.lit("CruiseTax"), F.lit("4.35").cast("decimal(18,2)")),
    )
    currency = F.when(F.col("o_orderkey") % 4 == 0, "CAD").when(F.col("o_orderkey") % 4 == 1, "").otherwise(None)
    package = F.struct(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "dd-MMM-yyyy").alias("startDateTime"),
        F.array(F.struct(currency.alias("currencyCode"), cabins.alias("items"))).alias("prices"),
    )
    undated = F.struct(
        (F.col("o_orderkey") + 1).alias("id"),
        F.lit(None).cast("string").alias("startDateTime"),
        F.array().cast("array<struct<currencyCode:string,items:array<struct<name:string,code:string,value:decimal(18,2)>>>>").alias("prices"),
    )
    item = F.struct(
        F.struct(
            (F.col("o_orderkey") % 9).alias("duration"),
            F.struct((F.col("o_custkey") % 25).cast("string").alias("code")).alias("departure"),
            F.struct((F.col("o_custkey") % 30).cast("string").alias("code")).alias("arrival"),
        ).alias("itinerary"),
        F.struct((F.col("o_custkey") % 1000).alias("id")).alias("ship"),
        F.array(undated, package).alias("packages"),
    )
    return orders.select(
        F.col("o_orderkey").alias("item_no"),
        F.to_json(item).alias("payload"),
        F.to_timestamp("o_orderdate").alias("scraped_at"),
    )


@query(
    "nested_items",
    f"""
WITH ports AS (SELECT CAST(n_nationkey AS BIGINT) AS code, CASE WHEN n_nationkey % 3 = 0 THEN 'Keelung ' || n_name WHEN n_nationkey % 3 = 1 THEN 'Yokohama (Tokyo) ' || n_name ELSE n_name END AS name FROM nation),
o AS (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)
SELECT o_orderkey AS item_no, CAST(d AS VARCHAR) AS sail_date,
  CASE WHEN dp.code % 3 = 0 THEN 'Keelung' ELSE 'Yokohama' END AS depart_port,
  coalesce(ap.name, CAST(o_custkey % 30 AS VARCHAR)) AS arrive_port,
  coalesce(s_name, '') AS ship_name, coalesce(n.n_name, '') AS cruise_line, o_orderkey % 9 AS nights,
  coalesce(rtrim(rtrim(CAST(CASE WHEN o_orderkey % 3 = 0 AND p > 500 THEN p - 500 WHEN p > 0 THEN p END AS VARCHAR), '0'), '.'), '') AS price,
  CASE WHEN o_orderkey % 4 = 0 THEN 'CAD' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey = 0 THEN '' ELSE 'https://bookus.expediacruises.com/swift/cruise/package/' || o_orderkey || '?siid=1095905&lang=1' END AS detail_url
FROM o JOIN ports dp ON o_custkey % 25 = dp.code AND dp.code % 3 <> 2
LEFT JOIN ports ap ON o_custkey % 30 = ap.code
LEFT JOIN supplier ON o_custkey % 1000 = s_suppkey
LEFT JOIN nation n ON s_nationkey = n_nationkey
WHERE d {_IN_WINDOW}""",
)
def nested_items(spark, sf_dir):
    """Items flattened to one row per package, with three look-up tables."""
    nation = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 3
    name = F.when(k == 0, F.concat(F.lit("Keelung "), "n_name")).when(k == 1, F.concat(F.lit("Yokohama (Tokyo) "), "n_name")).otherwise(F.col("n_name"))
    ports = nation.select(F.col("n_nationkey").cast("string").alias("id"), name.alias("name"))
    lines = nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    ships = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("line_id")
    )
    rows = itinerary_api.to_rows(_items(spark, sf_dir), ports, ships, lines, FIRST, LAST)
    return rows.select(
        F.col("row_ord")[0].alias("item_no"),
        _day(),
        "depart_port",
        "arrive_port",
        "ship_name",
        "cruise_line",
        F.col("nights").cast("bigint").alias("nights"),
        _text("price"),
        "currency",
        "detail_url",
    )


@query(
    "lowest_component",
    """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 AND p > 500 THEN p - 500 WHEN p > 0 THEN p END AS VARCHAR) AS price,
       CASE WHEN o_orderkey % 4 = 0 THEN 'CAD' ELSE 'USD' END AS currency
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,4)) AS p FROM orders)""",
)
def lowest_component(spark, sf_dir):
    """Lowest cabin price and the currency of nested price blocks."""
    item = F.from_json("payload", itinerary_api.ITEM)
    rows = _items(spark, sf_dir).select(F.col("item_no").alias("o_orderkey"), item.alias("i"))
    prices = F.col("i.packages")[1]["prices"]
    return rows.select(
        "o_orderkey",
        itinerary_api.lowest_cabin_price(prices).cast("string").alias("price"),
        itinerary_api.currency_of(prices).alias("currency"),
    )


# --- items embedded in pages ---------------------------------------------------


def _item_pages(spark, sf_dir, vary: bool = False) -> DataFrame:
    """A page per order: two items in script fragments cut mid-text.

    With `vary`, of five pages one claims its two items and holds none, one
    neither claims nor holds any, and one claims a third.
    """
    columns = "o_orderkey o_custkey o_totalprice o_orderdate o_orderpriority".split()
    orders = spread(raw_table(spark, sf_dir, "orders").select(*columns))
    day = F.to_date("o_orderdate")
    first_day = F.when(F.col("o_orderkey") % 2 == 0, "第1天\n日本 東京 (橫濱) 登船\n15:00 啟航").otherwise("第一天：基隆港【郵輪20:00啟航】")

    def item(number: int, title, price, dates):
        return F.to_json(
            F.struct(
                (F.col("o_orderkey") * 10 + number).alias("id"),
                title.alias("name"),
                (F.col("o_custkey") % 8).alias("activityDays"),
                dates.alias("availableDates"),
                price.alias("price"),
                F.struct(F.lit("TYO").alias("id"), F.lit("東京（東京/橫濱）").alias("name")).alias("port"),
                F.struct(
                    F.array(
                        F.struct(first_day.alias("description")),
                        F.struct(F.lit("第二天：海上巡航").alias("description")),
                        F.struct(F.concat(F.lit("第三天："), "o_orderpriority", F.lit(" \"灣\"抵達")).alias("description")),
                    ).alias("daily")
                ).alias("journey"),
            )
        )

    price = F.col("o_totalprice").cast("decimal(18,2)")
    one = item(1, F.lit("【麗星郵輪探索星號】鹿兒島、那霸6天-週日出發"), price, F.array(day.cast("string"), F.date_add(day, 9).cast("string"), F.lit("soon")))
    two = item(2, F.lit("【公主遊輪】鑽石公主號～日本探險家之旅 11天"), F.lit(0).cast("decimal(18,2)"), F.array(F.date_add(day, 4).cast("string")))
    text = F.concat(F.lit('{"x":1,"item":'), one, F.lit('},{"item":'), two, F.lit('},{"total":2,"currentPage":1,"limit":20}]'))
    if vary:
        kind = F.col("o_orderkey") % 5
        text = (
            F.when(kind == 1, '[{"x":1},{"total":2,"currentPage":1,"limit":20}]')
            .when(kind == 2, '[{"x":1}]')
            .when(kind == 3, F.replace(text, F.lit('"total":2,'), F.lit('"total":3,')))
            .otherwise(text)
        )
    orders = computed(orders, {"_text": text})
    text = F.col("_text")
    cut = F.floor(F.length(text) / 2).cast("int")
    # A JSON string literal of any text: the value of a one-element array.
    halves = F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text))
    orders = computed(orders, {f"_array_{i}": F.to_json(F.array(half)) for i, half in enumerate(halves)})

    def literal(array):
        return F.substring(array, F.lit(2), F.length(array) - 2)

    def push(part):
        return F.concat(F.lit("<script>self.__next_f.push([1,"), part, F.lit("])</script>"))

    html = F.concat(
        F.lit("<html><body><p>"),
        "o_orderpriority",
        F.lit("</p>"),
        push(literal("_array_0")),
        push(F.lit("null")),
        push(literal("_array_1")),
        F.lit("</body></html>"),
    )
    return orders.select(
        F.col("o_orderkey").alias("page_no"),
        html.alias("html"),
        day.alias("chunk_start"),
        F.date_add(day, 4).alias("chunk_end"),
        F.to_timestamp("o_orderdate").alias("scraped_at"),
    )


_ITEMS_SQL = """
o AS (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(38,2)) AS p,
             greatest(o_custkey % 8 - 1, 0) AS nights FROM orders),
item_rows AS (
  SELECT o_orderkey * 10 + 1 AS id, d AS sail_date, 'Star Voyager' AS ship_name, '探索星號' AS ship_name_raw, 'Star Cruises' AS cruise_line,
         CAST(round_even(p, 0) AS DECIMAL(38,0)) AS price, o_orderkey, nights, o_orderpriority, 0 AS item_no FROM o
  UNION ALL
  SELECT o_orderkey * 10 + 2, d + 4, 'Diamond Princess', '鑽石公主號', 'Princess Cruises', NULL, o_orderkey, nights, o_orderpriority, 1 FROM o
),
item_quotes AS (
  SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'Yokohama' ELSE 'Keelung' END AS depart_port,
    CASE WHEN o_orderkey % 2 = 0 THEN '日本 東京 (橫濱)' ELSE '基隆港' END || '|' || o_orderpriority || ' "灣"' AS ports
  FROM item_rows
)"""


@query(
    "embedded_items",
    f"""WITH {_ITEMS_SQL}
SELECT id, CAST(sail_date AS VARCHAR) AS sail_date, depart_port, ship_name, ship_name_raw, cruise_line, nights,
  coalesce(CAST(price AS VARCHAR), '') AS price, ports, o_orderpriority || ' "灣"' AS arrive_port
FROM item_quotes""",
)
def embedded(spark, sf_dir):
    """Every item and date of every page, before de-duplication."""
    rows = embedded_items.to_rows(embedded_items.read_items(_item_pages(spark, sf_dir)))
    item_id = F.regexp_extract("detail_url", "/item/([0-9]+)/", 1).cast("bigint")
    return rows.select(
        item_id.alias("id"),
        _day(),
        "depart_port",
        "ship_name",
        "ship_name_raw",
        "cruise_line",
        F.col("nights").cast("bigint").alias("nights"),
        _text("price"),
        F.array_join("ports_of_call", "|").alias("ports"),
        "arrive_port",
    )


@query(
    "embedded_items_cheapest",
    f"""WITH {_ITEMS_SQL}
SELECT ship_name, CAST(sail_date AS VARCHAR) AS sail_date, nights, depart_port, coalesce(CAST(price AS VARCHAR), '') AS price, id
FROM (SELECT *, row_number() OVER (PARTITION BY ship_name, sail_date, nights, depart_port ORDER BY price IS NULL, price, o_orderkey, item_no) AS place
      FROM item_quotes) WHERE place = 1""",
)
def embedded_cheapest(spark, sf_dir):
    rows = embedded_items.parse(_item_pages(spark, sf_dir))
    item_id = F.regexp_extract("detail_url", "/item/([0-9]+)/", 1).cast("bigint")
    return rows.select("ship_name", _day(), F.col("nights").cast("bigint").alias("nights"), "depart_port", _text("price"), item_id.alias("id"))


@query(
    "page_meta",
    """
SELECT o_orderkey AS page_no, CASE o_orderkey % 5 WHEN 2 THEN 0 WHEN 3 THEN 3 ELSE 2 END AS claimed, CASE WHEN o_orderkey % 5 IN (1, 2) THEN 0 ELSE 2 END AS parsed,
       CASE o_orderkey % 5 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'empty' ELSE 'ok' END AS verdict FROM orders""",
)
def page_meta(spark, sf_dir):
    """Claimed result counts of the item pages against the items read."""
    rows = embedded_items.page_health(_item_pages(spark, sf_dir, vary=True))
    return rows.select("page_no", F.col("claimed").cast("bigint").alias("claimed"), "parsed", "verdict")


# --- event streams ---------------------------------------------------------------


def _stream_lines(spark, sf_dir, vary: bool = False) -> DataFrame:
    """A stream per order: two main groups, two departures each, then the end.

    Every fifth stream breaks off before its last step. With `vary`, of seven
    streams one has an empty first step, one a first step without a code, and
    one none.
    """
    orders = raw_table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    code = F.col("o_orderkey").cast("string")
    price = F.floor("o_totalprice").cast("bigint")
    fields = "mainGroupCode groupName hasCruisePrice"
    cruise = F.lit("【MSC郵輪．榮耀號】沖繩自主遊４天")
    mains = F.array(
        _record(fields, F.concat(F.lit("M"), code), cruise, F.lit(False)),
        _record(fields, F.concat(F.lit("M"), code), cruise, F.lit(True)),
        _record(fields, F.concat(F.lit("F"), code), F.lit("【單訂船票】八重山丸"), F.lit(False)),
    )

    def group(leave, days, amount, suffix):
        return F.struct(
            leave.alias("leaveDate"),
            days.alias("groupDay"),
            amount.alias("price"),
            F.lit(None).cast("string").alias("groupName"),
            F.concat(F.lit("G"), code, F.lit(suffix)).alias("groupCode"),
        )

    groups = F.array(
        group(day, F.lit(6).cast("bigint"), price, "a"),
        group(day, F.lit(5).cast("bigint"), F.lit(99999999).cast("bigint"), "b"),
        group(F.lit("soon"), F.lit(5).cast("bigint"), price, "c"),
        group(day, F.lit(1).cast("bigint"), price, "d"),
    )
    place = F.when(F.col("o_orderkey") % 3 == 0, "桃園國際機場").otherwise("基隆港")
    parts = "mainGroupCode departure groups"
    details = F.array(
        _record(parts, F.concat(F.lit("M"), code), place, groups),
        _record(parts, F.concat(F.lit("F"), code), F.lit("基隆港"), groups),
        _record(parts, F.lit("unknown"), F.lit("基隆港"), groups),
    )

    def event(step, data):
        return F.concat(F.lit(f'data: {{"step":"{step}","data":'), F.to_json(data), F.lit("}"))

    end = F.when(F.col("o_orderkey") % 5 == 0, ": keep-alive").otherwise('data: {"step":"step3","data":{"totalGroups":3}}')
    first = event("step1", mains)
    if vary:
        kind = F.col("o_orderkey") % 7
        empty, nameless = 'data: {"step":"step1","data":[]}', 'data: {"step":"step1","data":[{"groupName":"x"}]}'
        first = F.when(kind == 0, empty).when(kind == 1, nameless).when(kind == 2, ": keep-alive").otherwise(first)
    lines = F.array(
        F.lit(": keep-alive"),
        F.lit('data: {"step":"step2","data":[]}'),
        first,
        F.lit("data: {broken"),
        event("step2", details),
        end,
        F.lit("data: [DONE]"),
    )
    return orders.select(
        F.col("o_orderkey").alias("stream_id"), F.to_timestamp("o_orderdate").alias("scraped_at"), F.posexplode(lines).alias("line_no", "value")
    )


@query(
    "event_stream",
    f"""
SELECT o_orderkey AS stream_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sail_date, 'MSC Bellissima' AS ship_name, 'MSC Cruises' AS cruise_line,
  6 - g AS nights, CASE g WHEN 1 THEN CASE WHEN floor(o_totalprice) > 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) ELSE '' END ELSE '' END AS price,
  '沖繩' AS ports, 'https://www.bwt.com.tw/Tour/G' || o_orderkey || CASE g WHEN 1 THEN 'a' ELSE 'b' END AS detail_url
FROM orders, (VALUES (1), (2)) t(g)
WHERE o_orderkey % 3 <> 0 AND CAST(o_orderdate AS DATE) {_IN_WINDOW}""",
)
def stream_rows(spark, sf_dir):
    """Departures of all streams: step 1 joined to step 2, filtered, parsed."""
    joined = event_stream.departures(_stream_lines(spark, sf_dir))
    rows = event_stream.to_rows(joined, FIRST, LAST)
    return rows.select(
        F.col("row_ord")[0].alias("stream_id"),
        _day(),
        "ship_name",
        "cruise_line",
        F.col("nights").cast("bigint").alias("nights"),
        _text("price"),
        F.array_join("ports_of_call", "|").alias("ports"),
        "detail_url",
    )


@query(
    "stream_verdicts",
    """
SELECT o_orderkey AS stream_id, o_orderkey % 5 <> 0 AS has_end, o_orderkey % 7 > 2 AS has_start,
       CASE WHEN o_orderkey % 5 = 0 THEN 'incomplete' WHEN o_orderkey % 7 < 3 THEN 'no_start' ELSE 'ok' END AS verdict FROM orders""",
)
def stream_verdicts(spark, sf_dir):
    return event_stream.verdicts(event_stream.read_events(_stream_lines(spark, sf_dir, vary=True)))


@query(
    "step_join",
    """
SELECT o_orderkey AS stream_id, kind || o_orderkey AS code, cruise AS has_cruise_price, 'G' || o_orderkey || suffix AS group_code
FROM orders, (VALUES ('M', 'true'), ('F', 'false')) m(kind, cruise), (VALUES ('a'), ('b'), ('c'), ('d')) g(suffix)""",
)
def step_join(spark, sf_dir):
    """Step 2 joined to step 1: the last entry of a code wins, details of an unknown code go."""
    joined = event_stream.departures(_stream_lines(spark, sf_dir))
    return joined.select(
        "stream_id",
        F.col("mainGroupCode").alias("code"),
        F.col("main.hasCruisePrice").alias("has_cruise_price"),
        F.col("departure.groupCode").alias("group_code"),
    )


# --- HTML result tables and cards ------------------------------------------------


def _result_pages(spark, sf_dir) -> DataFrame:
    """A result page per order: a header row, a priced and an unpriced row."""
    columns = "o_orderkey o_custkey o_totalprice o_orderdate o_orderpriority".split()
    orders = spread(raw_table(spark, sf_dir, "orders").select(*columns))
    start = F.when(F.col("o_orderkey") % 4 == 3, "Busan (Pusan), South Korea").when(F.col("o_orderkey") % 4 == 2, "Tokyo, Japan").otherwise("Keelung (Taipei), Taiwan")
    price = F.floor("o_totalprice").cast("decimal(18,0)")
    ship = F.concat(F.lit("Ship "), (F.col("o_custkey") % 40).cast("string"))

    def row(nights: str, length: str, price_html):
        return F.concat(
            F.lit("<tr><td><div class='celldata depart'><h2>"),
            F.date_format("o_orderdate", "MMM d, yyyy"),
            F.lit(f"</h2></div></td><td><div class=\"x celldata itin2\"><h2>{nights} Night Grand Tour</h2><div class=ship>"),
            ship,
            F.lit("</div><div class=line>Line &amp; Co</div></div><div class=route><div class=start><b>Starts:&nbsp;</b> "),
            start,
            F.lit("</div><div class=end><b>Ends: </b>Naha,\n Japan</div></div><div class=ports><div class=port_list><b>Ports of Call: </b> Keelung (Taipei), "),
            "o_orderpriority",
            F.lit(f",, Naha</div></div></td><td><div class='celldata length'><h2>{length}</h2></div></td><td><div class='celldata price'>"),
            price_html,
            F.lit("<a class=b href='/itineraries/"),
            F.col("o_orderkey").cast("string"),
            F.lit(f"-{nights}.html?src=1&amp;x=2'>Learn More</a></div></td>"),
        )

    priced = F.concat(F.lit("from <h2>$"), F.format_number(price, 0), F.lit("</h2> per person"))
    html = F.concat(
        F.lit("<html><body><span>2 Matched Sailings</span><table id=results_table><tr><th>Departs</th></tr>"),
        row("3", "3 Nights", priced),
        row("5", "", F.lit("<h2 class=noprice>Pricing On<br>Request</h2>")),
        F.lit("</table></body></html>"),
    )
    return orders.select(F.col("o_orderkey").alias("page_no"), html.alias("html"), F.to_timestamp("o_orderdate").alias("scraped_at"))


_RESULT_SQL = """
result_rows AS (
  SELECT o_orderkey, r AS row_no, CAST(o_orderdate AS DATE) AS sail_date, 'Ship ' || o_custkey % 40 AS ship_name, CASE r WHEN 0 THEN 3 ELSE 5 END AS nights,
    CASE o_orderkey % 4 WHEN 3 THEN 'Busan (Pusan), South Korea' WHEN 2 THEN 'Tokyo' ELSE 'Keelung' END AS depart_port,
    CASE WHEN r = 0 AND floor(o_totalprice) > 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) ELSE '' END AS price,
    CASE r WHEN 0 THEN 'from per person' ELSE '' END AS price_note, o_orderpriority,
    'https://www.icruise.com/itineraries/' || o_orderkey || CASE r WHEN 0 THEN '-3.html' ELSE '-5.html' END AS detail_url
  FROM orders, (VALUES (0), (1)) t(r)
)"""


@query(
    "result_table",
    f"""WITH {_RESULT_SQL}
SELECT o_orderkey AS page_no, row_no, CAST(sail_date AS VARCHAR) AS sail_date, ship_name, 'Line & Co' AS cruise_line, nights, depart_port,
  'Naha, Japan' AS arrive_port, price, price_note, 'Keelung (Taipei)|' || o_orderpriority || '|Naha' AS ports, detail_url
FROM result_rows""",
)
def result_rows(spark, sf_dir):
    """Every row of every result page, parsed from its HTML."""
    rows = result_table.to_rows(result_table.read_cells(_result_pages(spark, sf_dir)))
    return rows.select(
        "page_no",
        (F.col("row_ord")[1]).alias("row_no"),
        _day(),
        "ship_name",
        "cruise_line",
        F.col("nights").cast("bigint").alias("nights"),
        "depart_port",
        "arrive_port",
        _text("price"),
        "price_note",
        F.array_join("ports_of_call", "|").alias("ports"),
        "detail_url",
    )


@query(
    "result_table_last_wins",
    f"""WITH {_RESULT_SQL}
SELECT ship_name, CAST(sail_date AS VARCHAR) AS sail_date, nights, depart_port, price, detail_url
FROM (SELECT *, row_number() OVER (PARTITION BY ship_name, sail_date, nights, depart_port ORDER BY o_orderkey DESC, row_no DESC) AS place
      FROM result_rows WHERE depart_port IN ('Keelung', 'Tokyo')) WHERE place = 1""",
)
def result_last_wins(spark, sf_dir):
    rows = result_table.parse(_result_pages(spark, sf_dir))
    return rows.select("ship_name", _day(), F.col("nights").cast("bigint").alias("nights"), "depart_port", _text("price"), "detail_url")


def _card_pages(spark, sf_dir) -> DataFrame:
    """A page per order with one card of three price tables, one undated."""
    columns = "o_orderkey o_custkey o_totalprice o_orderdate o_orderpriority".split()
    orders = spread(raw_table(spark, sf_dir, "orders").select(*columns))
    price = F.floor("o_totalprice").cast("decimal(18,0)")
    city = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, "Departing From Yokohama, Japan").otherwise("Singapore")
    stop = F.when(F.col("o_orderkey") % 3 == 2, "Singapore").otherwise("Keelung (taipei)")
    day = F.date_format("o_orderdate", "MMM d, yyyy")
    later = F.date_format(F.date_add("o_orderdate", 7), "MMM d, yyyy")

    def price_table(date_text, *cells, link: str):
        out = [F.lit("<div class=price-table><div class=price-table-body><div class=price-table-cell>"), date_text, F.lit("</div>")]
        for cell in cells:
            out += [F.lit("<div class='price-table-cell c'>"), cell, F.lit("</div>")]
        return F.concat(*out, F.lit(f"</div><a href='https://book.example/{link}/"), F.col("o_orderkey").cast("string"), F.lit("'>Select</a></div>"))

    html = F.concat(
        F.lit("<html><body><article class='node node--type-sailing'><div class='a field--name-field-itinerary-id'><b>Port of Call</b> "),
        stop,
        F.lit(" - Naha, Japan - "),
        "o_orderpriority",
        F.lit(" Itinerary Details</div><div class=field--name-field-sailing-departure-city-id>"),
        city,
        F.lit("</div><div class=field--name-field-sailing-ship-id>Ship: Grand "),
        (F.col("o_custkey") % 40).cast("string"),
        F.lit("</div><div class='logo cruiseline-logo-x'><img alt='Holland America'></div><div class=field--name-field-sailing-duration>10 Nights</div>"),
        price_table(F.concat(day, F.lit(" - "), later, F.lit(" Sun - Fri Bonus Details")), F.concat(F.lit("$"), F.format_number(price, 0), F.lit(" USD")), F.lit("-"), F.lit("$1,500,000 USD"), link="p1"),
        price_table(later, F.lit("-"), F.lit("-"), link="p2"),
        price_table(F.lit("Bonus Details"), F.lit("$1"), link="p3"),
        F.lit("</article></body></html>"),
    )
    title = F.when(F.col("o_orderkey") % 10 == 9, "Just a moment...").otherwise("Cruise Search Results")
    pages = computed(orders, {"title": title, "html": html})
    return pages.select(F.col("o_orderkey").alias("page_no"), "title", "html", F.to_timestamp("o_orderdate").alias("scraped_at"))


_CARD_SQL = """
card_rows AS (
  SELECT o_orderkey, r, CAST(o_orderdate AS DATE) + CASE r WHEN 0 THEN 0 ELSE 7 END AS sail_date, 'Grand ' || o_custkey % 40 AS ship_name,
    CASE o_orderkey % 3 WHEN 0 THEN 'Keelung' ELSE 'Yokohama' END AS depart_port, o_orderpriority AS arrive_port,
    CASE o_orderkey % 3 WHEN 0 THEN 'Keelung (taipei)' ELSE 'Yokohama, Japan' END AS depart_port_raw,
    CASE WHEN r = 0 THEN CAST(CASE WHEN floor(o_totalprice) > 0 THEN least(CAST(floor(o_totalprice) AS BIGINT), 1500000) ELSE 1500000 END AS VARCHAR) ELSE '' END AS price,
    'https://book.example/p' || (r + 1) || '/' || o_orderkey AS detail_url
  FROM orders, (VALUES (0), (1)) t(r) WHERE o_orderkey % 3 <> 2 AND o_orderkey % 10 <> 9
)"""


@query(
    "sailing_cards",
    f"""WITH {_CARD_SQL}
SELECT o_orderkey AS page_no, CAST(sail_date AS VARCHAR) AS sail_date, ship_name, 'Holland America Line' AS cruise_line, 10 AS nights,
  depart_port, depart_port_raw, arrive_port, price, detail_url FROM card_rows""",
)
def card_rows(spark, sf_dir):
    """Every price table of every card page that is not blocked."""
    pages = sailing_cards.readable_pages(_card_pages(spark, sf_dir))
    rows = sailing_cards.to_rows(sailing_cards.read_cells(pages))
    return rows.select(
        "page_no",
        _day(),
        "ship_name",
        "cruise_line",
        F.col("nights").cast("bigint").alias("nights"),
        "depart_port",
        "depart_port_raw",
        "arrive_port",
        _text("price"),
        "detail_url",
    )


@query(
    "card_page_states",
    """
SELECT o_orderkey AS page_no, o_orderkey % 10 = 9 AS blocked, CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE 1 END AS cards,
  CASE WHEN o_orderkey % 10 = 9 OR o_orderkey % 3 = 2 THEN 0 ELSE 2 END AS parsed,
  CASE WHEN o_orderkey % 10 = 9 THEN 'blocked' WHEN o_orderkey % 3 = 2 THEN 'unreadable' ELSE 'ok' END AS state
FROM orders""",
)
def card_page_states(spark, sf_dir):
    return sailing_cards.page_states(_card_pages(spark, sf_dir))


# --- published records -----------------------------------------------------------


@query(
    "upgrade_other_sources",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_suppkey % 2 = 0 THEN 'a:' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ':USD:-;b:-:USD:-'
       ELSE 'a:' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ':TWD:' || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ';b:-:USD:-' END AS others
FROM lineitem""",
)
def upgrade_other_sources(spark, sf_dir):
    """Competing quotes of both generations read into the present map."""
    from faremeld.plans.table_queries.feeds import others_text

    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    old = F.concat(F.lit('{"a":"'), price, F.lit('","b":null}'))
    twd = F.floor("l_quantity").cast("string")
    new = F.concat(F.lit('{"a":{"price":"'), price, F.lit('","currency":"TWD","price_twd":"'), twd, F.lit('"},"b":{"price":null,"currency":""}}'))
    raw = F.when(F.col("l_suppkey") % 2 == 0, old).otherwise(new)
    rows = raw_table(spark, sf_dir, "lineitem").withColumn("other_sources", published.upgrade_other_sources(raw))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", others_text().alias("others"))


def _record_texts(spark, sf_dir) -> DataFrame:
    """Orders as published records in text, every seventh with a bad price."""
    k = F.col("o_orderkey")
    nothing = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.lit("icruise").alias("source"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("sail_date"),
        F.lit("Keelung").alias("depart_port"),
        nothing.alias("depart_port_raw"),
        nothing.alias("arrive_port"),
        F.lit(None).cast("array<string>").alias("ports_of_call"),
        F.col("o_orderpriority").alias("ship_name"),
        F.col("o_orderstatus").alias("cruise_line"),
        (k % 9).cast("string").alias("nights"),
        F.when(k % 7 == 0, "亂碼").when(k % 7 == 1, nothing).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(k % 2 == 0, "TWD").alias("currency"),
        nothing.alias("price_note"),
        nothing.alias("detail_url"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'05:00:00.250000+00:00").alias("scraped_at"),
        F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("stale_since"),
        nothing.alias("other_sources"),
        nothing.alias("price_twd"),
        F.when(k % 2 == 1, "31.966724").alias("fx_rate"),
        nothing.alias("ship_name_raw"),
        F.array(k).alias("row_ord"),
    )


@query(
    "decode_records",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS sail_date, o_orderkey % 9 AS nights,
  CASE WHEN o_orderkey % 7 > 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) END AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN 'TWD' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS stale_since,
  CASE WHEN o_orderkey % 2 = 1 THEN '31.96672400' END AS fx_rate, strftime(o_orderdate, '%Y-%m-%d') || ' 05:00:00.25' AS scraped_at,
  o_orderkey % 7 = 0 AS damaged
FROM orders""",
)
def decode_records(spark, sf_dir):
    rows = published.decode(_record_texts(spark, sf_dir))
    return rows.select(
        F.col("row_ord")[0].alias("o_orderkey"),
        _day(),
        F.col("nights").cast("bigint").alias("nights"),
        F.col("price").cast("string").alias("price"),
        "currency",
        _day("stale_since"),
        F.col("fx_rate").cast("string").alias("fx_rate"),
        F.col("scraped_at").cast("string").alias("scraped_at"),
        F.col("_damaged").alias("damaged"),
    )


@query(
    "previous_all_or_nothing",
    """
SELECT 'sound' AS file, count(*) AS rows_read FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT 'damaged', CASE WHEN count_if(o_orderkey % 7 = 0) > 0 THEN 0 ELSE count(*) END FROM orders""",
)
def previous_all_or_nothing(spark, sf_dir):
    """One damaged record discards its whole file; a sound file is kept."""
    decoded = published.decode(_record_texts(spark, sf_dir))
    sound = published.all_or_nothing(decoded.where(F.col("row_ord")[0] % 7 != 0))
    damaged = published.all_or_nothing(decoded)
    return sound.agg(F.count("*").alias("rows_read")).select(F.lit("sound").alias("file"), "rows_read").unionByName(
        damaged.agg(F.count("*").alias("rows_read")).select(F.lit("damaged").alias("file"), "rows_read")
    )
