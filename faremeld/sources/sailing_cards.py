"""Sailing cards with one price table per departure (source cruisedirect).

Input `pages`: page_no bigint, title string, html string, scraped_at timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from faremeld import fixed_values as fv
from faremeld.functions.dates import first_date_in_range_cell, in_window
from faremeld.functions.money import lowest_positive, parse_nights, parse_price
from faremeld.functions.names import MATCH_KEY, line_from_slug, match_port, with_match_key
from faremeld.functions.text import clean_text, computed, split_ports, strip_prefix_label
from faremeld.operators.dedupe import keep_last
from faremeld.operators.quality import is_blocked, page_state, source_outcome
from faremeld.schemas import as_quotes
from faremeld.sources.html_rows import explode_pages
from faremeld.sources.html_tree import attr_at, text_at

NAME = "cruisedirect"

# Where each field is in a card.
CARD = "article.node--type-sailing"
FIELDS = {
    "itinerary_text": ".field--name-field-itinerary-id",
    "city_text": ".field--name-field-sailing-departure-city-id",
    "ship_text": ".field--name-field-sailing-ship-id",
    "duration_text": ".field--name-field-sailing-duration",
}
LOGO = "[class*=cruiseline-logo] img"
TABLE = ".price-table"
CELL = ".price-table-body .price-table-cell"


def _read(page):
    for card_no, card in enumerate(page.find_all(CARD)):
        base = {name: text_at(card, path) for name, path in FIELDS.items()}
        base["slug"] = attr_at(card, LOGO, "alt")
        base["card_no"] = card_no
        # A card without tables still counts as a card.
        yield {**base, "cells": None}
        for table in card.find_all(TABLE):
            cells = [cell.text() for cell in table.find_all(CELL)]
            if cells:
                yield {**base, "cells": cells, "href": attr_at(table, "a[href]", "href")}


def read_cells(pages: DataFrame) -> DataFrame:
    fields = [(n, T.StringType()) for n in [*FIELDS, "slug", "href"]]
    fields += [("card_no", T.LongType()), ("cells", T.ArrayType(T.StringType()))]
    return explode_pages(pages, "html", ["page_no", "scraped_at"], fields, _read)


_IS_QUOTE = "cells IS NOT NULL AND depart_port IS NOT NULL AND sail_date IS NOT NULL"


def _placed(cells: DataFrame) -> DataFrame:
    """Cells with their port and date; those that meet `_IS_QUOTE` are quotes."""
    itinerary = F.regexp_replace(clean_text(F.col("itinerary_text")), fv.ITINERARY_SUFFIX, "")
    staged = computed(
        cells,
        {
            "ports_of_call": split_ports(itinerary, " - "),
            "_city": strip_prefix_label(F.col("city_text")),
            "sail_date": first_date_in_range_cell(clean_text(F.get("cells", F.lit(0)))),
        },
    )
    first_stop = F.get("ports_of_call", F.lit(0))
    staged = computed(staged, {"_by_city": match_port(F.col("_city"))})
    # Some pages leave the city empty; the first stop then tells.
    use_stop = F.col("_by_city").isNull() & first_stop.isNotNull()
    staged = computed(staged, {"depart_port": F.coalesce("_by_city", match_port(first_stop))})
    return staged.withColumn("depart_port_raw", F.when(use_stop, first_stop).otherwise(F.col("_city")))


def to_rows(cells: DataFrame) -> DataFrame:
    """Quotes of every readable price table from a target port."""
    staged = _placed(cells.where("cells IS NOT NULL")).where(_IS_QUOTE)
    cabins = F.slice("cells", F.lit(2), F.size("cells"))
    return staged.select(
        "page_no",
        F.lit(NAME).alias("source"),
        "sail_date",
        "depart_port",
        "depart_port_raw",
        F.coalesce(F.try_element_at("ports_of_call", F.lit(-1)), F.lit("")).alias("arrive_port"),
        "ports_of_call",
        strip_prefix_label(F.col("ship_text")).alias("ship_name"),
        line_from_slug(F.col("slug")).alias("cruise_line"),
        F.coalesce(parse_nights(F.col("duration_text")), F.lit(0)).alias("nights"),
        lowest_of_cabins(cabins).alias("price"),
        F.lit("USD").alias("currency"),
        F.lit(fv.CRUISEDIRECT_NOTE).alias("price_note"),
        F.coalesce("href", F.lit("")).alias("detail_url"),
        "scraped_at",
        F.array("page_no", "row_no").alias("row_ord"),
    )


def lowest_of_cabins(cells):
    """Lowest price among cells; "-" and button words hold no number."""
    return lowest_positive(F.transform(cells, lambda c: parse_price(c)))


def readable_pages(pages: DataFrame) -> DataFrame:
    return pages.where(~is_blocked(F.col("html"), F.col("title")))


def parse(pages: DataFrame, start, end) -> DataFrame:
    rows = to_rows(read_cells(readable_pages(pages)))
    rows = rows.where(in_window(F.col("sail_date"), F.lit(start), F.lit(end)))
    return as_quotes(keep_last(with_match_key(rows), MATCH_KEY), "row_ord")


def _states(pages: DataFrame, start, end) -> DataFrame:
    """The page states with `collected`: rows inside the window."""
    inside = F.lit(True) if start is None else in_window(F.col("sail_date"), F.lit(start), F.lit(end))
    quote = F.expr(_IS_QUOTE)
    # Pages are read once: one row per card and one per table, counted together.
    counts = (
        _placed(read_cells(readable_pages(pages)))
        .groupBy("page_no")
        .agg(
            F.count_if(F.col("cells").isNull()).alias("cards"),
            F.count_if(quote).alias("parsed"),
            F.count_if(quote & inside).alias("collected"),
        )
    )
    return (
        pages.select("page_no", is_blocked(F.col("html"), F.col("title")).alias("blocked"))
        .join(counts, "page_no", "left")
        .na.fill(0, ["cards", "parsed", "collected"])
        .withColumn("state", page_state(F.col("blocked"), F.col("cards"), F.col("parsed")))
    )


def page_states(pages: DataFrame) -> DataFrame:
    """Per page: cards seen, rows read and the state they mean."""
    return _states(pages, None, None).drop("collected")


def health(pages: DataFrame, start=None, end=None) -> DataFrame:
    """Why the source fails: an unreadable page, or blocked pages and no row inside the window."""
    states = _states(pages, start, end)
    verdict = source_outcome(states.select(F.lit(NAME).alias("source"), "state", F.col("collected").alias("parsed")))
    unread = states.where("state IN ('no_cards', 'unreadable')").select(
        F.concat(F.lit("ParseError: page "), "page_no", F.lit(" is "), "state").alias("error")
    )
    blocked = verdict.where("NOT ok AND collected = 0").select(
        F.concat(F.lit("BlockedError: "), "failed_parts", F.lit(" pages blocked or unread")).alias("error")
    )
    return unread.unionByName(blocked)
