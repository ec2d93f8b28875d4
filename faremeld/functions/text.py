"""Text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once and named only once.

    Keeps plans small: a filter pushed below a projection copies the column it
    tests into the condition, and a rule chain that names a long text formula
    forty times would multiply with every such step.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever names them later.

    Neighbouring projections are merged and filters pushed below them, each
    with a copy of the formulas they name; a generator keeps them apart.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))))


def clean_text(raw: Column) -> Column:
    """Collapse any Unicode whitespace to one space and trim; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), fv.WHITESPACE, " "))


def strip_prefix_label(raw: Column) -> Column:
    """Drop one leading field label such as "Starts:", then clean."""
    return clean_text(F.regexp_replace(F.coalesce(raw, F.lit("")), fv.FIELD_LABEL, ""))


def key_part(value: Column) -> Column:
    """A text as it enters a match key: case and spacing do not count."""
    return F.lower(clean_text(value))


def has_cjk(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(fv.CJK)


def split_list(text: Column, separator: str) -> Column:
    """Split on a literal separator, trim the parts, drop empty ones."""
    parts = F.split(text, _literal(separator))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def split_ports(raw: Column, separator: str = ",") -> Column:
    return split_list(strip_prefix_label(raw), separator)


def contains_any(text: Column, needles) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return found


def extract(text: Column, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, '' when there is none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group)


def before_query(url: Column) -> Column:
    """An address without its query string."""
    return F.split_part(url, F.lit("?"), F.lit(1))


def search_haystack(*fields: Column, ports: Column) -> Column:
    """Lower-cased text that the free-text search looks into."""
    parts = F.concat(F.array(*[F.coalesce(f, F.lit("")) for f in fields]), ports)
    return F.lower(F.array_join(parts, " "))


def _literal(separator: str) -> str:
    return "\\Q" + separator + "\\E"
