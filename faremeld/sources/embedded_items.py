"""Items embedded as script-pushed JSON fragments in a page (source asiayo).

Input `pages`: page_no bigint, html string, chunk_start date, chunk_end date,
scraped_at timestamp. Reading stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.dates import in_window, parse_date
from faremeld.functions.money import nights_from_days, parse_price, positive
from faremeld.functions.names import (
    MATCH_KEY,
    match_port,
    with_journey_ports,
    with_match_key,
    with_ship_and_line,
)
from faremeld.functions.text import clean_text, computed, let
from faremeld.operators.dedupe import keep_cheapest
from faremeld.operators.quality import parse_health
from faremeld.schemas import as_quotes

NAME = "asiayo"
ITEM = (
    "struct<id:string,name:string,activityDays:string,availableDates:array<string>,price:string,"
    "port:struct<id:string,name:string>,journey:struct<daily:array<struct<description:string>>>>"
)


def flight_text(html: Column) -> Column:
    """The text pushed by all script fragments, unescaped and joined.

    Fragments that are no strings, or no valid JSON strings, are left out.
    """
    literals = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(fv.SCRIPT_PUSH_TEXT), F.lit(1))
    texts = F.transform(
        literals, lambda s: F.get(F.from_json(F.concat(F.lit("["), s, F.lit("]")), "array<string>"), F.lit(0))
    )
    return F.array_join(texts, "")


def page_meta(flight: Column) -> Column:
    """(total, page_limit) of the result list; nulls when the page has none."""
    return F.struct(
        F.regexp_extract(flight, fv.PAGE_META, 1).try_cast("int").alias("total"),
        F.regexp_extract(flight, fv.PAGE_META, 2).try_cast("int").alias("page_limit"),
    )


def with_items(pages: DataFrame, flight: str, out: str = "item") -> DataFrame:
    """One row per item object in the text, with its number `item_no`.

    The text is cut before each item; reading JSON stops at the end of the
    first value, so what follows an item does no harm. Should an item hold a
    nested start mark, its cut is too short to read, and the whole rest of
    the text is read instead.

    Items are read while they are exploded, so that filters above do not
    repeat the JSON work.
    """
    cut = computed(pages, {"_parts": F.split(F.col(flight), fv.ITEM_START)})

    def read(part: Column, i: Column) -> Column:
        rest = F.array_join(F.slice("_parts", i + 2, F.size("_parts")), '"item":')
        return let(
            F.from_json(part, ITEM),
            lambda short: F.when(short["id"].isNotNull(), short).otherwise(F.from_json(rest, ITEM)),
        )

    items = F.transform(F.slice("_parts", F.lit(2), F.size("_parts")), read)
    rows = cut.select(*pages.columns, F.posexplode(items).alias("item_no", out))
    return rows.where(F.col(f"{out}.id").isNotNull())


def read_items(pages: DataFrame) -> DataFrame:
    with_text = pages.withColumn("_flight", flight_text(F.col("html"))).drop("html")
    return with_items(with_text, "_flight").drop("_flight")


def to_rows(items: DataFrame) -> DataFrame:
    """One row per item and departure date, inside the page's own window."""
    daily = items.withColumns(
        {
            "_name": F.col("item.name"),
            "_daily": F.col("item.journey.daily"),
            "_port": clean_text(F.col("item.port.name")),
        }
    )
    # The port field may name two ports; the first day tells which one it is.
    first_day = F.get("_daily", F.lit(0))["description"]
    daily = computed(
        daily, {"depart_port": F.coalesce(match_port(first_day), match_port(F.col("_port")))}
    ).where("depart_port IS NOT NULL")
    named = with_journey_ports(with_ship_and_line(daily, "_name"), "_daily", "ports_of_call")
    days = F.transform("item.availableDates", lambda d: parse_date(d))
    dated = named.select("*", F.posexplode(days).alias("date_no", "sail_date"))
    dated = dated.where(in_window(F.col("sail_date"), F.col("chunk_start"), F.col("chunk_end")))
    number = F.col("item.price").try_cast("decimal(38,4)")
    price = F.when(number.isNotNull(), positive(number)).otherwise(parse_price(F.col("item.price")))
    return dated.select(
        F.lit(NAME).alias("source"),
        "sail_date",
        "depart_port",
        F.col("_port").alias("depart_port_raw"),
        F.coalesce(F.try_element_at("ports_of_call", F.lit(-1)), F.lit("")).alias("arrive_port"),
        "ports_of_call",
        "ship_name",
        "cruise_line",
        nights_from_days(F.col("item.activityDays")).alias("nights"),
        F.bround(price, 0).alias("price"),
        F.lit("TWD").alias("currency"),
        F.lit(fv.ASIAYO_NOTE).alias("price_note"),
        F.replace(
            F.replace(F.lit(fv.ASIAYO_URL), F.lit("{date}"), F.date_format("sail_date", "yyyy-MM-dd")), F.lit("{id}"), "item.id"
        ).alias("detail_url"),
        "scraped_at",
        "ship_name_raw",
        F.array(*[F.col(c).cast("bigint") for c in ("page_no", "item_no", "date_no")]).alias("row_ord"),
    )


def parse(pages: DataFrame, start=None, end=None) -> DataFrame:
    """Quotes of all pages, the cheapest kept per sailing."""
    rows = to_rows(read_items(pages))
    return as_quotes(keep_cheapest(with_match_key(rows), MATCH_KEY), "row_ord")


def page_health(pages: DataFrame) -> DataFrame:
    texts = pages.select("page_no", flight_text(F.col("html")).alias("_flight"))
    claims = texts.select("page_no", F.coalesce(page_meta(F.col("_flight"))["total"], F.lit(0)).alias("claimed"))
    return parse_health(claims, with_items(texts, "_flight"), "page_no", "claimed")


def health(pages: DataFrame, start=None, end=None) -> DataFrame:
    """Chunks whose first page claims results and yields none; an empty later page is a list's normal end.

    Where pages of several ports share a chunk, a column `port_id` tells them apart.
    """
    chunk = [c for c in ("port_id", "chunk_start", "chunk_end") if c in pages.columns]
    firsts = pages.groupBy(*chunk).agg(F.min("page_no").alias("page_no")).select("page_no")
    return page_health(pages.join(firsts, "page_no", "left_semi")).where("verdict = 'unreadable'").select(
        F.concat(F.lit("ParseError: page "), "page_no", F.lit(" claims "), "claimed", F.lit(" results, none read")).alias("error")
    )
