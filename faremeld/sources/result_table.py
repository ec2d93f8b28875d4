"""Server-rendered result tables (source icruise).

Input `pages`: page_no bigint, html string, scraped_at timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from faremeld import fixed_values as fv
from faremeld.functions.dates import parse_date
from faremeld.functions.money import claimed_count, parse_nights, parse_price
from faremeld.functions.names import MATCH_KEY, match_port, with_match_key
from faremeld.functions.text import before_query, clean_text, split_ports, strip_prefix_label
from faremeld.operators.dedupe import keep_last
from faremeld.operators.quality import parse_health, truncated_pages
from faremeld.schemas import as_quotes
from faremeld.sources.html_rows import explode_pages
from faremeld.sources.html_tree import attr_at, text_at

NAME = "icruise"

# Where each cell is in the page.
CELLS = {
    "date_text": "div.celldata.depart h2",
    "title_text": "div.celldata.itin2 h2",
    "start_text": "div.route div.start",
    "end_text": "div.route div.end",
    "length_text": "div.celldata.length h2",
    "price_text": "div.celldata.price h2",
    "price_cell": "div.celldata.price",
    "ports_text": "div.ports div.port_list",
    "ship_text": "div.celldata.itin2 div.ship",
    "line_text": "div.celldata.itin2 div.line",
}
LINK = "div.celldata.price a[href]"


def _read(page):
    table = page.find("table#results_table")
    if table is None:
        return
    for row in table.find_all("tr"):
        if not (text_at(row, CELLS["date_text"]) or "").strip():
            continue  # header or advertisement
        record = {name: text_at(row, path) for name, path in CELLS.items()}
        record["href"] = attr_at(row, LINK, "href")
        yield record


def read_cells(pages: DataFrame) -> DataFrame:
    """Raw cell texts, one row per result row of each page."""
    fields = [(n, T.StringType()) for n in [*CELLS, "href"]]
    return explode_pages(pages, "html", ["page_no", "scraped_at"], fields, _read)


def price_note(cell: Column, price_text: Column) -> Column:
    """What the price cell says besides the price and the button."""
    note = F.coalesce(cell, F.lit(""))
    price = clean_text(price_text)
    note = F.when(price != "", F.replace(note, price, F.lit(" "))).otherwise(note)
    return clean_text(F.replace(note, F.lit("Learn More"), F.lit(" ")))


def to_rows(cells: DataFrame) -> DataFrame:
    """Parsed rows before any filter; unreadable dates or nights stay null."""
    start = strip_prefix_label(F.col("start_text"))
    href = F.coalesce("href", F.lit(""))
    return cells.select(
        "page_no",
        F.lit(NAME).alias("source"),
        parse_date(F.col("date_text")).alias("sail_date"),
        F.coalesce(match_port(start), start).alias("depart_port"),
        start.alias("depart_port_raw"),
        strip_prefix_label(F.col("end_text")).alias("arrive_port"),
        split_ports(F.col("ports_text")).alias("ports_of_call"),
        clean_text(F.col("ship_text")).alias("ship_name"),
        clean_text(F.col("line_text")).alias("cruise_line"),
        F.coalesce(parse_nights(F.col("length_text")), parse_nights(F.col("title_text"))).alias("nights"),
        parse_price(F.col("price_text")).alias("price"),
        F.lit("USD").alias("currency"),
        price_note(F.col("price_cell"), F.col("price_text")).alias("price_note"),
        F.when(href != "", F.concat(F.lit(fv.ICRUISE_BASE), before_query(href))).otherwise("").alias("detail_url"),
        "scraped_at",
        F.array("page_no", "row_no").alias("row_ord"),
    )


def in_target_ports(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("depart_port").isin([name for name, _ in fv.PORT_RULES]))


def parse(pages: DataFrame, start=None, end=None) -> DataFrame:
    """Quotes from target ports; a later page replaces the same sailing.

    The date window is applied by the request, not here.
    """
    rows = in_target_ports(to_rows(read_cells(pages)))
    return as_quotes(keep_last(with_match_key(rows), MATCH_KEY), "row_ord")


def health(pages: DataFrame, start=None, end=None) -> DataFrame:
    """Pages that make the whole source fail, with the reason."""
    rows = to_rows(read_cells(pages))
    claims = pages.select("page_no", claimed_count(F.col("html")).alias("claimed"))
    unread = parse_health(claims, rows, "page_no", "claimed").where("verdict = 'unreadable'")
    broken = rows.where("sail_date IS NULL OR nights IS NULL")
    return unread.select(
        F.concat(F.lit("ParseError: page "), "page_no", F.lit(" claims "), "claimed", F.lit(" results, none read")).alias("error")
    ).unionByName(
        broken.select(F.concat(F.lit("ValueError: unreadable date or nights on page "), "page_no").alias("error"))
    )


def warnings(pages: DataFrame) -> DataFrame:
    """Pages whose results do not fit on one page."""
    return truncated_pages(pages.select("page_no", claimed_count(F.col("html")).alias("claimed")), "claimed")
