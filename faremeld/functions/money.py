"""Prices, nights and money wording."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.text import clean_text, extract

# Digits other than ASCII that count as digits.
_WIDE_DIGITS = "０１２３４５６７８９٠١٢٣٤٥٦٧٨٩"
_ASCII_DIGITS = "01234567890123456789"


def _ascii_digits(text: Column) -> Column:
    return F.translate(text, _WIDE_DIGITS, _ASCII_DIGITS)


def positive(value: Column) -> Column:
    """A price of zero or less is no price."""
    return F.when(value > 0, value)


def parse_price(text: Column, dtype: str = "decimal(38,4)") -> Column:
    """First number in a text, thousands commas allowed; null when not above 0."""
    digits = F.translate(extract(text, fv.NUMBER), ",", "")
    return positive(_ascii_digits(digits).try_cast(dtype))


def parse_nights(text: Column) -> Column:
    """"N Night(s)" if present, else the first integer, else null."""
    cleaned = clean_text(text)
    named = _ascii_digits(extract(cleaned, fv.NIGHTS, 1)).try_cast("int")
    first = _ascii_digits(extract(cleaned, fv.INTEGER)).try_cast("int")
    return F.coalesce(named, first)


def nights_from_days(days: Column) -> Column:
    """Days as a number or its text; fractions are cut off, anything else counts as no day."""
    days = days.try_cast("double").try_cast("int")
    return F.greatest(F.coalesce(days, F.lit(0)) - 1, F.lit(0)).cast("int")


def claimed_count(html: Column) -> Column:
    """Number of results a page says it has; 0 when it says nothing."""
    digits = F.translate(extract(html, fv.CLAIMED_COUNT, 1), ",", "")
    return F.coalesce(_ascii_digits(digits).try_cast("int"), F.lit(0))


def lowest_positive(prices: Column) -> Column:
    """Smallest positive entry of an array, null when there is none."""
    return F.array_min(F.filter(prices, lambda p: p > 0))


def plain_number(value: Column) -> Column:
    """Decimal as text without trailing zeros ("479", "379.25")."""
    text = value.cast("string")
    return F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def format_amount(value: Column) -> Column:
    """Thousands separators; two decimals only when they are needed."""
    whole = F.format_number(F.bround(value, 0).cast("decimal(38,0)"), 0)
    cents = F.format_number(F.bround(value, 2), 2)
    return (
        F.when(value.isNull(), fv.ON_REQUEST)
        .when(value == F.floor(value), whole)
        .otherwise(cents)
    )


def money(value: Column, currency: Column) -> Column:
    """"NT$89,984", "US$2,812", "CAD 10"; "on request" when there is no price."""
    symbol = F.concat(currency, F.lit(" "))
    for code, sign in fv.MONEY_SYMBOLS.items():
        symbol = F.when(F.upper(currency) == code, sign).otherwise(symbol)
    return F.when(value.isNull(), fv.ON_REQUEST).otherwise(F.concat(symbol, format_amount(value)))


def quote_for_table(entry: Column) -> Column:
    """A competing quote in the exported table: TWD first, original beside it."""
    twd, price = entry["price_twd"], entry["price"]
    currency = F.coalesce(entry["currency"], F.lit(""))
    has_twd = F.coalesce(twd, F.lit("")) != ""
    return (
        F.when(price.isNull(), fv.ON_REQUEST)
        .when(has_twd & (currency != "TWD"), F.concat(F.lit("NT$"), twd, F.lit("（"), currency, F.lit(" "), price, F.lit("）")))
        .when(has_twd, F.concat(F.lit("NT$"), twd))
        .otherwise(F.trim(F.concat(currency, F.lit(" "), price)))
    )


def quote_for_page(entry: Column) -> Column:
    """A competing quote on the page: TWD where known, else its own currency."""
    twd, price = entry["price_twd"], entry["price"]
    currency = F.upper(F.coalesce(entry["currency"], F.lit("")))
    has_twd = F.coalesce(twd, F.lit("")) != ""
    return (
        F.when(price.isNull(), fv.ON_REQUEST)
        .when(has_twd, money(twd.try_cast("decimal(38,4)"), F.lit("TWD")))
        .otherwise(money(price.try_cast("decimal(38,4)"), currency))
    )


def quote_for_tooltip(source: Column, entry: Column) -> Column:
    """"source：original price", always in the quote's own currency."""
    currency = F.upper(F.coalesce(entry["currency"], F.lit("")))
    own = money(entry["price"].try_cast("decimal(38,4)"), currency)
    return F.concat(source, F.lit("："), F.when(entry["price"].isNull(), fv.ON_REQUEST).otherwise(own))


def display_time(ts: Column) -> Column:
    """UTC instant as the page shows it."""
    return F.date_format(F.from_utc_timestamp(ts, fv.DISPLAY_ZONE), "yyyy-MM-dd HH:mm")
