"""Output order, exact positions, and the page's column sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremeld.operators.fx import amount
from faremeld.session import ensure_checkpoint_dir


def output_keys(tie: str = "first_seen") -> list[Column]:
    """Sail date, then amount with unpriced last, then place of first sight."""
    return [F.col("sail_date").asc(), amount().asc_nulls_last(), F.col(tie).asc()]


def in_output_order(quotes: DataFrame, tie: str = "first_seen") -> DataFrame:
    """Total order by range partitioning; the unique tie breaks up hot dates."""
    return quotes.orderBy(*output_keys(tie))


def numeric_key(value: Column, ascending: bool = True) -> Column:
    """Sort key of a number: empty values last either way."""
    return value.asc_nulls_last() if ascending else value.desc_nulls_last()


def text_key(value: Column, ascending: bool = True) -> Column:
    """Sort key of a text, letter case secondary; a missing text counts as empty."""
    collated = F.collate(F.coalesce(value, F.lit("")), "UNICODE")
    return collated.asc() if ascending else collated.desc()


def sort_numeric(rows: DataFrame, value: Column, ascending: bool = True, *ties: Column) -> DataFrame:
    """Numeric column sort of the page."""
    return rows.orderBy(numeric_key(value, ascending), *ties)


def sort_text(rows: DataFrame, value: Column, ascending: bool = True, *ties: Column) -> DataFrame:
    """Text column sort of the page."""
    return rows.orderBy(text_key(value, ascending), *ties)


def with_position(rows: DataFrame, keys: list[Column], name: str = "position") -> DataFrame:
    """Exact 1-based position in a total order, without a one-task window.

    The sorted rows are range partitioned and written once with `checkpoint`,
    so that ids, counts and rows come from the same partitions even if an
    executor is lost. A row's position is the size of the partitions before
    its own plus its place inside it; sizes are one row per partition.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = rows.orderBy(*keys).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = tagged.groupBy(part.alias("_part")).count().collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["count"]
    offset_table = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _offset bigint"))
    inside = F.col("_id") - F.shiftleft(part, 33)
    return (
        tagged.withColumn("_part", part)
        .join(offset_table, "_part")
        .withColumn(name, F.col("_offset") + inside + 1)
        .drop("_id", "_part", "_offset")
    )


def previous_in_order(
    rows: DataFrame, key: list[str], order: list[str], value: str, bucket: Column, out: str
) -> DataFrame:
    """The value of the row before, per key, as `lag` gives it.

    A plain `lag` would put all rows of a hot key in one task. Here rows are
    split by `bucket`, which must rise with `order` (a time truncated to the
    hour, say): `lag` runs inside buckets, and the first row of a bucket takes
    the last value of the key's bucket before it, from a summary with one row
    per key and bucket. Rows with a null in the key form a group like others.
    """
    # Inside a struct, null equals null, so that the join keeps null keys.
    split = rows.withColumn("_key", F.struct(*key, bucket.alias("_bucket")))
    inner = Window.partitionBy("_key").orderBy(*order)
    # A struct tells "no row before" from "a row with a null value before".
    boxed = F.struct(F.col(value).alias("v"))
    ends = split.groupBy("_key").agg(F.max_by(boxed, F.struct(*order)).alias("_last"))
    outer = Window.partitionBy(*[F.col("_key")[c] for c in key]).orderBy("_key._bucket")
    ends = ends.select("_key", F.lag("_last").over(outer).alias("_before"))
    return (
        split.withColumn("_prev", F.lag(boxed).over(inner))
        .join(ends, "_key", "left")
        .withColumn(out, F.coalesce("_prev", "_before")["v"])
        .drop("_key", "_prev", "_before")
    )
