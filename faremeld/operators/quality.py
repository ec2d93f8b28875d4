"""Data-quality checks: loud failure instead of silent loss."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.names import is_unmapped_ship
from faremeld.functions.text import contains_any

#: Names that a warning spells out.
LISTED_NAMES = 100


def is_blocked(html: Column, title: Column) -> Column:
    """The page is a bot-protection page, by its title or its markers."""
    by_title = contains_any(F.lower(F.coalesce(title, F.lit(""))), fv.BLOCKED_TITLES)
    return by_title | contains_any(F.coalesce(html, F.lit("")), fv.BLOCKED_MARKERS)


def page_state(blocked: Column, cards: Column, parsed: Column) -> Column:
    """blocked, no_cards, unreadable or ok. Blocked is tested first."""
    return (
        F.when(blocked, "blocked")
        .when(cards == 0, "no_cards")
        .when(parsed == 0, "unreadable")
        .otherwise("ok")
    )


def parse_health(pages: DataFrame, rows: DataFrame, page: str, claimed: str) -> DataFrame:
    """Per page: how many results it claims, how many were read, and a verdict.

    Claiming some and yielding none is `unreadable`; neither is `empty`.
    """
    read = rows.groupBy(page).agg(F.count("*").alias("parsed"))
    return (
        pages.join(read, page, "left")
        .withColumn("parsed", F.coalesce("parsed", F.lit(0)))
        .withColumn(
            "verdict",
            F.when((F.col(claimed) > 0) & (F.col("parsed") == 0), "unreadable")
            .when(F.col("parsed") == 0, "empty")
            .otherwise("ok"),
        )
    )


def truncated_pages(pages: DataFrame, claimed: str, limit: int = fv.ICRUISE_PAGE_LIMIT) -> DataFrame:
    """Pages that claim more results than one page can show."""
    return pages.where(F.col(claimed) > limit)


def stream_health(events: DataFrame, stream: str, step: str, data: str) -> DataFrame:
    """Per stream: complete only with a final step and a non-empty first one."""
    has_end = F.coalesce(F.bool_or((F.col(step) == "step3") & F.col(data).isNotNull()), F.lit(False))
    has_start = F.coalesce(
        F.bool_or(
            (F.col(step) == "step1")
            & F.col(data).isNotNull()
            & ~F.col(data).isin("[]", "null")
        ),
        F.lit(False),
    )
    return events.groupBy(stream).agg(
        has_end.alias("has_end"),
        has_start.alias("has_start"),
    ).withColumn(
        "verdict",
        F.when(~F.col("has_end"), "incomplete").when(~F.col("has_start"), "no_start").otherwise("ok"),
    )


def dimension_missing(items: DataFrame, dimension: DataFrame) -> Column:
    """There is work to look up but nothing to look it up in."""
    return items.select(F.lit(1)).exists() & ~dimension.select(F.lit(1)).exists()


def unmapped_names(quotes: DataFrame, name: str = "ship_name") -> DataFrame:
    """Distinct ship names without an English form, one per row."""
    return quotes.select(name).distinct().where(is_unmapped_ship(F.col(name)))


def unmapped_warning(names: DataFrame, name: str = "ship_name", listed: int = LISTED_NAMES) -> DataFrame:
    """The one warning text that lists them; no row when there are none.

    It names the first `listed` in order, and of more their number: the rest
    are rows of `unmapped_rows`. So the text has a bound, and no task sees more.
    """
    first = names.select(F.col(name).alias("n")).orderBy("n").limit(listed + 1).agg(F.sort_array(F.collect_list("n")).alias("n"))
    every = names.agg(F.count("*").alias("total"))
    text = F.concat(F.lit(fv.UNMAPPED_WARNING), F.array_join(F.slice("n", 1, listed), fv.LIST_MARK))
    more = F.when(F.size("n") > listed, F.concat(F.lit("… ("), F.col("total").cast("string"), F.lit(")"))).otherwise("")
    return first.withColumn("total", every.scalar()).where(F.size("n") > 0).select(F.concat(text, more).alias("warning"))


def unmapped_rows(quotes: DataFrame, run_id: Column, name: str = "ship_name") -> DataFrame:
    """(ship_name, source, quotes, first_run, last_run): which names lack an English form, and where they come from."""
    found = quotes.groupBy(name, "source").agg(F.count("*").alias("quotes")).where(is_unmapped_ship(F.col(name)))
    run = run_id.cast("bigint")
    return found.select(F.col(name).alias("ship_name"), "source", "quotes", run.alias("first_run"), run.alias("last_run"))


def merge_unmapped(*runs: DataFrame) -> DataFrame:
    """The rows of several runs as one: the quotes of the last run that had the name, its first and its last run."""
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy("ship_name", "source").agg(
        F.max_by("quotes", "last_run").alias("quotes"), F.min("first_run").alias("first_run"), F.max("last_run").alias("last_run")
    )


def source_outcome(parts: DataFrame) -> DataFrame:
    """One verdict per source from its parts (source, state, parsed).

    An unreadable part fails the source. Blocked parts fail it only when
    nothing at all was collected; otherwise they are tolerated.
    """
    collected = F.sum("parsed")
    unreadable = F.bool_or(F.col("state").isin("no_cards", "unreadable"))
    blocked = F.bool_or(F.col("state") == "blocked")
    return parts.groupBy("source").agg(
        F.count("*").alias("parts"),
        F.count_if(F.col("state") != "ok").alias("failed_parts"),
        collected.alias("collected"),
        (~unreadable & ~(blocked & (collected == 0))).alias("ok"),
    )


def run_report(status: DataFrame, quotes: DataFrame) -> DataFrame:
    """Status of each attempted source with its row count, 0 for none."""
    counts = quotes.groupBy("source").agg(F.count("*").alias("count"))
    return status.join(counts, "source", "left").select(
        "src_ord",
        "source",
        "ok",
        F.when(F.col("ok"), F.coalesce("count", F.lit(0))).otherwise(0).cast("bigint").alias("count"),
        F.round("duration_s", 2).alias("duration_s"),
        "error",
    )


def run_totals(report: DataFrame) -> DataFrame:
    """any_ok and all_failed; a run without sources is neither."""
    any_ok = F.coalesce(F.bool_or("ok"), F.lit(False))
    return report.agg(
        F.count("*").alias("sources"),
        any_ok.alias("any_ok"),
        ((F.count("*") > 0) & ~any_ok).alias("all_failed"),
    )
