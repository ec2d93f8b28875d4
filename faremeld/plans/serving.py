"""What readers of the merged table see: columns, search, facets, figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.money import (
    money,
    plain_number,
    quote_for_page,
    quote_for_table,
    quote_for_tooltip,
)
from faremeld.functions.text import search_haystack
from faremeld.operators.fx import amount


def sorted_entries(others: Column) -> Column:
    """Map entries in order of source name."""
    return F.array_sort(F.map_entries(others))


def others_text(others: Column) -> Column:
    """"source: quote; source: quote" in order of source name."""
    parts = F.transform(
        sorted_entries(others), lambda e: F.concat(e["key"], F.lit(": "), quote_for_table(e["value"]))
    )
    return F.array_join(parts, "; ")


def csv_columns(quotes: DataFrame, *extra: str) -> DataFrame:
    """The 16 exported columns, all text, '' for missing values, and the columns in `extra`."""
    stale = F.concat(
        F.lit(fv.CSV_STALE[0]), F.date_format("stale_since", "yyyy-MM-dd"), F.lit(fv.CSV_STALE[1])
    )
    values = [
        F.date_format("sail_date", "yyyy-MM-dd"),
        F.col("depart_port"),
        F.col("arrive_port"),
        F.col("ship_name"),
        F.col("cruise_line"),
        F.col("nights").cast("string"),
        plain_number(F.col("price")),
        F.col("currency"),
        F.col("price_twd").cast("string"),
        plain_number(F.col("fx_rate")),
        F.col("price_note"),
        F.array_join("ports_of_call", " → "),
        F.col("source"),
        others_text(F.col("other_sources")),
        F.when(F.col("stale_since").isNotNull(), stale).otherwise(fv.CSV_FRESH),
        F.col("detail_url"),
    ]
    return quotes.select(
        *[F.coalesce(v, F.lit("")).alias(h) for v, h in zip(values, fv.CSV_HEADERS, strict=True)], *extra
    )


def with_haystack(quotes: DataFrame, name: str = "haystack") -> DataFrame:
    fields = [F.col(c) for c in ("ship_name", "ship_name_raw", "cruise_line", "depart_port", "arrive_port")]
    return quotes.withColumn(name, search_haystack(*fields, ports=F.col("ports_of_call")))


def search(quotes: DataFrame, text: str = "", port: str = "", line: str = "") -> DataFrame:
    """Port and line must match exactly, the text anywhere; '' asks nothing."""
    found = quotes
    if port:
        found = found.where(F.col("depart_port") == port)
    if line:
        found = found.where(F.col("cruise_line") == line)
    wanted = text.strip().lower()
    if wanted:
        found = with_haystack(found).where(F.col("haystack").contains(wanted)).drop("haystack")
    return found


def facets(quotes: DataFrame) -> DataFrame:
    """Distinct filter values (facet, value); empty lines are no choice."""
    ports = quotes.select(F.lit("port").alias("facet"), F.col("depart_port").alias("value"))
    lines = quotes.where("cruise_line <> ''").select(
        F.lit("line").alias("facet"), F.col("cruise_line").alias("value")
    )
    return ports.distinct().unionByName(lines.distinct()).orderBy("facet", "value")


def summary_stats(quotes: DataFrame) -> DataFrame:
    """Number of sailings, lowest TWD price and number of departure ports."""
    return quotes.agg(
        F.count("*").alias("sailings"),
        F.min("price_twd").alias("lowest_twd"),
        F.count_distinct("depart_port").alias("ports"),
    ).withColumn(
        "lowest_text",
        F.when(F.col("lowest_twd").isNull(), fv.NO_VALUE).otherwise(money(F.col("lowest_twd"), F.lit("TWD"))),
    )


def display_columns(quotes: DataFrame) -> DataFrame:
    """Price cell of the table view: main, original, competing quotes, note."""
    has_twd = F.col("price_twd").isNotNull()
    shown_currency = F.when(has_twd, F.lit("TWD")).otherwise(F.col("currency"))
    show_original = F.col("price").isNotNull() & has_twd & (F.upper("currency") != "TWD")
    entries = sorted_entries(F.col("other_sources"))
    badge = F.transform(entries, lambda e: F.concat(e["key"], F.lit(" "), quote_for_page(e["value"])))
    tooltip = F.transform(entries, lambda e: quote_for_tooltip(e["key"], e["value"]))
    rate_note = F.concat(F.lit("（1 USD = "), plain_number(F.col("fx_rate")), F.lit(" TWD）"))
    return quotes.withColumns(
        {
            "price_main": money(amount(), shown_currency),
            "price_sort": F.coalesce(plain_number(amount()), F.lit("")),
            "price_original": F.when(show_original, money(F.col("price"), F.col("currency"))).otherwise(""),
            "badge": F.array_join(badge, "、"),
            "tooltip": F.array_join(tooltip, "；"),
            "note": F.trim(F.concat("price_note", F.coalesce(rate_note, F.lit("")))),
        }
    )
