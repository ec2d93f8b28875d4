"""Date parsing, windows and chunks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.text import clean_text, extract, let

# The ISO shapes accepted, extended and basic, time part optional.
_ISO_TIME = (
    r"(?:.(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)
_ISO_HEAD = r"^\d{4}-?[\dW]"
_ISO_EXTENDED = r"^(\d{4}-\d{2}-\d{2})" + _ISO_TIME
_ISO_BASIC = r"^(\d{8})" + _ISO_TIME
_ISO_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?" + _ISO_TIME


def parse_date(raw: Column) -> Column:
    """Text to date, null when no known form fits.

    An ISO timestamp keeps the date it was written with; no zone shift. A
    form is tried only on a text of its shape: a failed try costs an
    exception per row.
    """

    def read(text: Column) -> Column:
        iso = F.when(text.rlike(_ISO_HEAD), parse_iso_date(text))
        for shape, form in fv.DATE_FORMATS:
            iso = iso.when(text.rlike(shape), F.try_to_date(text, form))
        return iso

    return let(clean_text(raw), read)


def parse_iso_date(text: Column) -> Column:
    """ISO forms only: extended, basic or week date, with or without a time."""
    extended = F.try_to_date(extract(text, _ISO_EXTENDED, 1), "yyyy-MM-dd")
    basic = F.try_to_date(extract(text, _ISO_BASIC, 1), "yyyyMMdd")
    return (
        F.when(text.rlike(_ISO_EXTENDED), extended)
        .when(text.rlike(_ISO_BASIC), basic)
        .when(text.rlike(_ISO_WEEK), _iso_week(text))
    )


def _iso_week(text: Column) -> Column:
    year = extract(text, _ISO_WEEK, 1).try_cast("int")
    week = extract(text, _ISO_WEEK, 2).try_cast("int")
    day = F.coalesce(extract(text, _ISO_WEEK, 3).try_cast("int"), F.lit(1))
    first_monday = F.to_date(F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))))
    found = F.date_add(first_monday, (week - 1) * 7 + day - 1)
    # Week 53 exists only in years whose 28 December lies in it.
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    return F.when((year > 0) & (week >= 1) & (week <= last), found)


def first_date_in_range_cell(raw: Column) -> Column:
    """Departure date of a cell like "Aug 30, 2026 - Sep 11, 2026 ..."."""
    return parse_date(extract(raw, fv.DATE_CELL, 1))


def window_end(start: Column, lookahead_days: int = fv.LOOKAHEAD_DAYS) -> Column:
    return F.date_add(start, lookahead_days)


def in_window(day: Column, start: Column, end: Column) -> Column:
    """Inclusive on both ends."""
    return (day >= start) & (day <= end)


def date_chunks(start: Column, end: Column, chunk_days: int = fv.CHUNK_DAYS) -> Column:
    """Array of (chunk_start, chunk_end) covering the window without gaps.

    Empty when the window is empty.
    """
    _check(chunk_days)
    # sequence() wants a rising range, so an empty window is given one day and
    # then discarded.
    starts = F.sequence(start, F.greatest(start, end), F.expr(f"INTERVAL {chunk_days} DAY"))
    chunks = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("chunk_start"),
            F.least(F.date_add(s, chunk_days - 1), end).alias("chunk_end"),
        ),
    )
    return F.filter(chunks, lambda _c: start <= end)


def chunk_of(day: Column, start: Column, end: Column, chunk_days: int = fv.CHUNK_DAYS) -> Column:
    """The chunk a day falls in, by arithmetic: no range join is needed.

    Null outside the window.
    """
    _check(chunk_days)
    offset = F.floor(F.datediff(day, start) / chunk_days).cast("int") * chunk_days
    chunk_start = F.date_add(start, offset)
    chunk = F.struct(
        chunk_start.alias("chunk_start"),
        F.least(F.date_add(chunk_start, chunk_days - 1), end).alias("chunk_end"),
    )
    return F.when(in_window(day, start, end), chunk)


def day_start_epoch(day: Column) -> Column:
    return F.unix_date(day).cast("long") * 86400


def day_end_epoch(day: Column) -> Column:
    return day_start_epoch(day) + 86399


def _check(chunk_days: int) -> None:
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
