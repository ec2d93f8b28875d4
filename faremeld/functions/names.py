"""Ports, ships and cruise lines: alias look-ups and title parsing.

Steps that reuse an intermediate text several times are written as staged
projections over a DataFrame, so that each text is computed once per row
and the alias chains compile to plain `contains` tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.text import (
    clean_text,
    contains_any,
    extract,
    has_cjk,
    let,
    split_list,
    strip_prefix_label,
)


def first_rule(text: Column, rules) -> Column:
    """Value of the first rule with a keyword inside the text, else null."""

    def chain(t: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for value, keywords in reversed(list(rules)):
            chosen = F.when(contains_any(t, keywords), value).otherwise(chosen)
        return chosen

    return let(text, chain)


def match_port(raw: Column, rules=fv.PORT_RULES) -> Column:
    return first_rule(F.lower(strip_prefix_label(raw)), rules)


def port_group(port: Column, groups=fv.PORT_GROUPS) -> Column:
    """Exact, case-sensitive group name; any other port is its own group."""
    name = clean_text(port)
    grouped = F.lower(name)
    for member, group in groups.items():
        grouped = F.when(name == member, group).otherwise(grouped)
    return grouped


def longest_alias(text: Column, aliases: dict[str, str]) -> Column:
    """Value of the longest alias inside an already cleaned text.

    Equal lengths go to the earlier entry; no match gives null.
    """
    by_length = sorted(aliases.items(), key=lambda kv: -len(kv[0]))
    return first_rule(text, [(value, (alias,)) for alias, value in by_length])


def match_alias(text: Column, aliases: dict[str, str]) -> Column:
    """As `longest_alias` of any text. Cleaning only changes white space, so aliases without any are found without it."""
    plain = not any(c.isspace() for alias in aliases for c in alias)
    return longest_alias(F.coalesce(text, F.lit("")) if plain else clean_text(text), aliases)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def canonical_ship(name: Column) -> Column:
    """One spelling of a ship across languages; unknown names stay as they are.

    Every alias holds a CJK character, so a name without one skips the table.
    """

    def ship(text: Column) -> Column:
        embedded = extract(text, fv.ASCII_NAME)
        known = longest_alias(text, fv.SHIP_ALIASES)
        foreign = F.coalesce(known, F.when(embedded != "", clean_text(embedded)), text)
        return F.when(is_ascii(text) | ~has_cjk(text), text).otherwise(foreign)

    return let(clean_text(name), ship)


def is_unmapped_ship(name: Column) -> Column:
    return has_cjk(canonical_ship(name))


def canonical_line(name: Column) -> Column:
    return let(clean_text(name), lambda t: F.coalesce(longest_alias(t, fv.LINE_ALIASES), t))


def line_from_slug(slug: Column) -> Column:
    """Cruise line from a logo text; an unknown one is put in title case."""
    text = F.lower(F.regexp_replace(F.coalesce(slug, F.lit("")), r"(?U)^\s+|\s+$", ""))
    table = F.create_map(*[F.lit(v) for pair in fv.LINE_BY_SLUG.items() for v in pair])
    known = F.try_element_at(table, F.replace(text, F.lit(" "), F.lit("")))
    words = F.split(text, r"(?<=\P{L})(?=\p{L})")
    return F.coalesce(known, F.array_join(F.transform(words, F.initcap), ""))


def without_line_names(text: Column) -> Column:
    """Remove every cruise-line alias, then separators at both ends."""
    bare = reduce(lambda t, alias: F.replace(t, F.lit(alias), F.lit("")), fv.LINE_ALIASES, text)
    return F.btrim(clean_text(bare), F.lit(fv.NAME_EDGE_CHARS))


def with_ship_and_line(df: DataFrame, title: str) -> DataFrame:
    """Add ship_name, ship_name_raw and cruise_line read from a product title."""
    staged = df.withColumn("_title", clean_text(F.col(title)))
    title_c = F.col("_title")
    outer = F.regexp_replace(extract(title_c, fv.TITLE_BRACKET, 2), fv.NAME_TAIL, "")
    whole = F.regexp_replace(title_c, fv.NAME_TAIL, "")

    def unless_empty(text: Column) -> Column:
        return let(text, lambda t: F.when(t != "", t))

    # The next one is looked at only where the one before says nothing.
    raw = F.coalesce(
        let(extract(title_c, fv.TITLE_BRACKET, 1), lambda t: F.when(~t.rlike(fv.LINE_ONLY), unless_empty(without_line_names(t)))),
        unless_empty(without_line_names(outer)),
        without_line_names(whole),
    )
    staged = staged.withColumn("ship_name_raw", raw)
    ship = F.coalesce(longest_alias(title_c, fv.SHIP_ALIASES), canonical_ship(F.col("ship_name_raw")))
    line = F.coalesce(longest_alias(title_c, fv.LINE_ALIASES), F.lit(""))
    return staged.withColumns({"ship_name": ship, "cruise_line": line}).drop(
        "_title"
    )


def itinerary_ports(title: Column) -> Column:
    """Ports named in a tour title: after the wave dash, else before "N days"."""
    text = F.regexp_replace(F.regexp_replace(clean_text(title), fv.LEADING_BRACKET, ""), fv.TRAILING_NOTE, "")
    dash = F.locate("～", text)
    after_dash = F.when(dash > 0, F.substring(text, dash + 1, F.length(text)))
    chosen = F.coalesce(after_dash, F.regexp_replace(text, fv.DAYS_TAIL, ""))
    return split_list(F.regexp_replace(clean_text(chosen), fv.TOUR_WORDS, ""), "、")


def day_place(description: Column) -> Column:
    """Place named by one day of an itinerary; '' for a sea day or none.

    A line that is empty or only counts the day has nothing left between its ends.
    """
    lines = F.split(F.coalesce(description, F.lit("")), "\n")

    def place(line: Column) -> Column:
        # A cleaned line has single spaces, and the edge characters hold the space.
        return F.btrim(F.regexp_replace(clean_text(line), fv.DAY_ENDS, ""), F.lit(fv.DAY_EDGE_CHARS))

    found = F.get(F.filter(F.transform(lines, place), lambda p: p != ""), F.lit(0))
    return let(found, lambda f: F.when(f.isNull() | f.rlike(fv.SEA_DAY), "").otherwise(f))


def drop_repeats(values: str) -> Column:
    """Collapse neighbouring equal elements of an array column.

    Takes a column name: the lambda looks back into the array, which must be a
    stored value and not an expression evaluated again for each element.
    """
    arr = F.col(values)
    return F.filter(arr, lambda v, i: (i == 0) | (v != F.get(arr, i - 1)))


def with_journey_ports(df: DataFrame, daily: str, out: str) -> DataFrame:
    """Ports along a day-by-day journey, sea days left out."""
    places = F.filter(
        F.transform(F.coalesce(F.col(daily), F.array().cast(df.schema[daily].dataType)),
                    lambda d: day_place(d["description"])),
        lambda p: p != "",
    )
    return df.withColumn("_places", places).withColumn(out, drop_repeats("_places")).drop("_places")


def with_match_key(df: DataFrame) -> DataFrame:
    """Columns that identify one sailing across sources and languages.

    Together with sail_date and nights. The cruise line is left out on
    purpose: sources spell it too differently.
    """
    name = F.col("ship_name")
    # Most names are ASCII and take the compiled branch.
    ship = F.when(is_ascii(name), clean_text(name)).otherwise(canonical_ship(name))
    return df.withColumns(
        {
            "k_ship": F.lower(ship),
            "k_port": port_group(F.col("depart_port")),
        }
    )


MATCH_KEY = ["k_ship", "sail_date", "nights", "k_port"]
