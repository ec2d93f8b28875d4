"""Incremental merge of one run with what was published before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld.functions.names import with_match_key
from faremeld.operators.dedupe import best_quotes
from faremeld.operators.fx import apply_rate
from faremeld.operators.ordering import in_output_order
from faremeld.schemas import QUOTE_COLUMNS


def mark_stale(rows: DataFrame) -> DataFrame:
    """Date of the last good fetch; a date already set stays."""
    return rows.withColumn("stale_since", F.coalesce("stale_since", F.to_date("scraped_at")))


def mark_fresh(rows: DataFrame) -> DataFrame:
    return rows.withColumn("stale_since", F.lit(None).cast("date"))


def rows_after_run(current: DataFrame, previous: DataFrame, status: DataFrame) -> DataFrame:
    """All quotes that count after a run, each with its place `ord`.

    * source ok: its new rows replace its old ones
    * source failed: its old rows stay, marked stale
    * source not run: likewise

    `status` has one row per attempted source (src_ord, source, ok). Sources
    not run come last, in order of first appearance. Both inputs carry
    `row_ord`, an array of positions.

    What is joined has one row per source and goes to every task: dealt by
    source, the quotes would meet in as many tasks as there are sources.
    """
    status = status.select("source", "ok", F.col("src_ord").cast("bigint").alias("src_ord"))
    first_rows = previous.groupBy("source").agg(F.min("row_ord").alias("first_row"))

    fresh = mark_fresh(current.join(F.broadcast(status.where("ok")), "source"))
    fresh = fresh.withColumn("ord", F.concat(F.array("src_ord"), "row_ord"))

    # One pass over the old rows: of failed sources, and of sources not run.
    kept = previous.join(F.broadcast(status), "source", "left").where("NOT coalesce(ok, false)").join(F.broadcast(first_rows), "source")
    after_all = F.concat(F.array(F.lit(2**31).cast("bigint")), "first_row", "row_ord")
    in_turn = F.concat(F.array("src_ord"), "row_ord")
    kept = mark_stale(kept).withColumn("ord", F.when(F.col("ok").isNull(), after_all).otherwise(in_turn))

    drop = ["ok", "src_ord", "first_row", "row_ord"]
    return fresh.drop(*drop).unionByName(kept.drop(*drop))


def merge_run(current: DataFrame, previous: DataFrame, status: DataFrame, rate: Column) -> DataFrame:
    """Merged quotes, one row per sailing, all at today's rate.

    Carried rows are converted again too, so that the table has one basis.
    """
    rows = apply_rate(rows_after_run(current, previous, status), rate)
    return best_quotes(with_match_key(rows))


def as_published(merged: DataFrame) -> DataFrame:
    """Merged quotes in output order with their place, ready to be written.

    The ids rise over the range partitions of the sort; once written they are
    plain values.
    """
    return in_output_order(merged).withColumn("published_pos", F.monotonically_increasing_id())


def as_previous(published: DataFrame) -> DataFrame:
    """A published table as the previous side of the next merge."""
    return published.withColumn("row_ord", F.array("published_pos")).select(*QUOTE_COLUMNS, "row_ord")
