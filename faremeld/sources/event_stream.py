"""Server-sent event lines that arrive in steps (source bwt).

Input `lines`: stream_id bigint, line_no bigint, value string,
scraped_at timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.dates import in_window, parse_date
from faremeld.functions.money import nights_from_days, parse_price, positive
from faremeld.functions.names import (
    MATCH_KEY,
    itinerary_ports,
    match_port,
    with_match_key,
    with_ship_and_line,
)
from faremeld.functions.text import clean_text, let
from faremeld.operators.dedupe import keep_cheapest
from faremeld.operators.quality import stream_health
from faremeld.schemas import as_quotes

NAME = "bwt"
MAINS = "array<struct<mainGroupCode:string,groupName:string,hasCruisePrice:string>>"
DETAILS = (
    "array<struct<mainGroupCode:string,departure:string,groups:array<struct<leaveDate:string,"
    "groupDay:string,price:string,groupName:string,groupCode:string>>>>"
)


def event_rows(lines: DataFrame) -> DataFrame:
    """(stream_id, line_no, scraped_at, step, data) of every event.

    Lines that are no data, the end mark and unreadable JSON are skipped.
    """
    payload = F.trim(F.substring(F.col("value"), len(fv.STREAM_PREFIX) + 1, 2**31 - 1))
    payloads = lines.where(F.col("value").startswith(fv.STREAM_PREFIX)).withColumn("_payload", payload)
    payloads = payloads.where((F.col("_payload") != "") & (F.col("_payload") != fv.STREAM_END))
    # Read as the only element of an array: text behind the object then makes
    # the whole line unreadable instead of being overlooked.
    events = F.from_json(F.concat(F.lit("["), "_payload", F.lit("]")), "array<struct<step:string,data:string>>")
    only = let(events, lambda found: F.when(F.size(found) == 1, found))
    return payloads.select("stream_id", "line_no", "scraped_at", F.inline(only)).where("step <> ''")


def read_events(lines: DataFrame) -> DataFrame:
    """(stream_id, step, data, scraped_at): the last event of each step."""
    return event_rows(lines).groupBy("stream_id", "step").agg(F.max_by("data", "line_no").alias("data"), F.max_by("scraped_at", "line_no").alias("scraped_at"))


def departures(lines: DataFrame) -> DataFrame:
    """Step 2 with its entries of step 1, one row per group departure; a code given twice keeps its last entry.

    A stream's last events of both steps become one row, so its lines are read
    and dealt once; the steps meet inside that row, not in a join.
    """
    first, second = F.col("step") == "step1", F.col("step") == "step2"
    both = event_rows(lines).where(first | second).groupBy("stream_id").agg(
        F.max_by(F.when(first, F.col("data")), F.when(first, F.col("line_no"))).alias("mains"),
        F.max_by(F.when(second, F.struct("data", "scraped_at")), F.when(second, F.col("line_no"))).alias("details"),
    )
    coded = F.filter(F.from_json("mains", MAINS), lambda m: F.coalesce(m["mainGroupCode"], F.lit("")) != "")
    placed = F.sort_array(F.transform(coded, lambda m, i: F.struct(m["mainGroupCode"].alias("code"), i.alias("i"), m.alias("main"))))
    both = both.select("stream_id", "details.scraped_at", F.from_json("details.data", DETAILS).alias("details"), placed.alias("placed"))
    last = F.filter("placed", lambda x, i: (i == F.size("placed") - 1) | (x["code"] != F.get(F.col("placed"), i + 1)["code"]))
    both = both.select("stream_id", "scraped_at", "details", F.map_from_entries(F.transform(last, lambda x: F.struct(x["code"], x["main"]))).alias("mains"))
    rows = both.select("stream_id", "scraped_at", "mains", F.posexplode("details").alias("detail_no", "detail"))
    named = rows.select("stream_id", "scraped_at", "detail_no", "detail", F.col("detail.mainGroupCode").alias("mainGroupCode"), F.try_element_at("mains", F.col("detail.mainGroupCode")).alias("main"))
    return named.where("main IS NOT NULL").select("*", F.posexplode("detail.groups").alias("group_no", "departure"))


def to_rows(joined: DataFrame, start, end) -> DataFrame:
    """Pure sailings from the one departure place, with a date and a night."""
    departure = clean_text(F.col("detail.departure"))
    name = F.coalesce(
        F.nullif(F.col("departure.groupName"), F.lit("")), F.nullif(F.col("main.groupName"), F.lit("")), F.lit("")
    )
    number = F.col("departure.price").try_cast("decimal(38,4)")
    number = F.nullif(number, F.lit(fv.BWT_NO_PRICE).cast("decimal(38,4)"))
    is_number = F.col("departure.price").try_cast("decimal(38,4)").isNotNull()
    kept = (
        joined.where((departure == fv.BWT_DEPARTURE) & ~F.lower(F.coalesce(F.col("main.hasCruisePrice"), F.lit(""))).isin("", "0", "0.0", "false", "[]", "{}"))
        .withColumns(
            {
                "depart_port": match_port(F.col("detail.departure")),
                "depart_port_raw": departure,
                "sail_date": parse_date(F.col("departure.leaveDate")),
                "nights": nights_from_days(F.col("departure.groupDay")),
                "price": F.when(is_number, positive(number)).otherwise(parse_price(F.col("departure.price"))),
                "_name": name,
                "_code": F.coalesce("departure.groupCode", F.lit("")),
            }
        )
        .where(F.col("depart_port").isNotNull() & (F.col("nights") > 0))
        .where(in_window(F.col("sail_date"), F.lit(start), F.lit(end)))
    )
    return with_ship_and_line(kept, "_name").select(
        F.lit(NAME).alias("source"),
        "sail_date",
        "depart_port",
        "depart_port_raw",
        F.col("depart_port").alias("arrive_port"),
        itinerary_ports(F.col("_name")).alias("ports_of_call"),
        "ship_name",
        "cruise_line",
        "nights",
        "price",
        F.lit("TWD").alias("currency"),
        F.lit(fv.BWT_NOTE).alias("price_note"),
        F.when(F.col("_code") != "", F.replace(F.lit(fv.BWT_URL), F.lit("{code}"), "_code")).otherwise("").alias("detail_url"),
        "scraped_at",
        "ship_name_raw",
        F.array(*[F.col(c).cast("bigint") for c in ("stream_id", "detail_no", "group_no")]).alias("row_ord"),
    )


def parse(lines: DataFrame, start, end) -> DataFrame:
    """Quotes of complete streams. None in the window is normal, not a fault."""
    rows = to_rows(departures(lines), start, end)
    return as_quotes(keep_cheapest(with_match_key(rows), MATCH_KEY), "row_ord")


def verdicts(events: DataFrame) -> DataFrame:
    """Per stream: has_end, has_start and verdict. A first step without any code is no start."""
    codes = F.filter(F.from_json("data", MAINS), lambda m: F.coalesce(m["mainGroupCode"], F.lit("")) != "")
    empty = (F.col("step") == "step1") & (F.coalesce(F.size(codes), F.lit(0)) <= 0)
    return stream_health(events.withColumn("data", F.when(~empty, F.col("data"))), "stream_id", "step", "data")


def health(lines: DataFrame, start=None, end=None) -> DataFrame:
    events = read_events(lines)
    bad = verdicts(events).where("verdict <> 'ok'").select(
        F.concat(F.lit("ParseError: stream "), "stream_id", F.lit(" "), "verdict").alias("error")
    )
    silent = events.agg(F.count("*").alias("n")).where("n = 0").select(
        F.lit("ParseError: stream without events").alias("error")
    )
    return bad.unionByName(silent)
