"""Sinks: JSON document, CSV, dated snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.money import plain_number
from faremeld.operators.fx import amount
from faremeld.plans.serving import csv_columns
from faremeld.schemas import QUOTE_COLUMNS

KEEP_NULLS = {"ignoreNullFields": "false"}


def iso_timestamp(ts: Column) -> Column:
    """ISO text in UTC; the fraction appears only when there is one."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(seconds, fraction, F.lit("+00:00"))


def record_columns(quotes: DataFrame) -> list[Column]:
    """A quote as its JSON record: dates ISO, decimals as text, nulls kept."""
    as_text = {
        "sail_date": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "stale_since": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "scraped_at": iso_timestamp,
        "price": plain_number,
        "price_twd": lambda c: c.cast("string"),
        "fx_rate": plain_number,
    }
    return [as_text.get(n, lambda c: c)(F.col(n)).alias(n) for n in QUOTE_COLUMNS]


def record_json(quotes: DataFrame) -> Column:
    return F.to_json(F.struct(*record_columns(quotes)), KEEP_NULLS)


def rate_columns(rate: Column) -> Column:
    """A rate as its JSON record."""
    return F.when(
        rate.isNotNull(),
        F.struct(
            plain_number(rate["usd_twd"]).alias("usd_twd"),
            F.date_format(rate["as_of"], "yyyy-MM-dd").alias("as_of"),
            rate["source"].alias("source"),
            rate["stale"].alias("stale"),
        ),
    )


def envelope_head(report: DataFrame, rate: Column, warnings: Column, generated_at: Column, count: Column) -> DataFrame:
    """The JSON document up to its list of quotes, as one text row.

    `report` has one row per source that ran.
    """
    sources = F.sort_array(F.collect_list(F.struct("src_ord", "source", "ok", "count", "duration_s", "error")))
    stamp = iso_timestamp(generated_at)
    head = report.agg(sources.alias("s")).select(
        F.struct(
            stamp.alias("generated_at"),
            F.struct(
                stamp.alias("generated_at"),
                F.transform("s", lambda r: r.dropFields("src_ord")).alias("sources"),
                F.coalesce(warnings, F.array().cast("array<string>")).alias("warnings"),
            ).alias("run_report"),
            rate_columns(rate).alias("fx"),
            count.alias("count"),
        ).alias("head")
    )
    text = F.to_json("head", KEEP_NULLS)
    open_end = F.substring(text, F.lit(1), F.length(text) - 1)
    return head.select(F.concat(open_end, F.lit(',"deals":[')).alias("value"))


def place_of(tie: str = "first_seen") -> Column:
    """What the published order sorts by, as one value."""
    return F.struct("sail_date", amount().isNull().alias("unpriced"), amount().alias("amount"), F.col(tie).alias("tie"))


def json_lines(quotes: DataFrame, head: DataFrame, tie: str = "first_seen") -> DataFrame:
    """The whole document as ordered text lines: head, one per quote, end.

    Lines carry sort columns and are range partitioned, so the document is
    written by many tasks; its part files, joined in name order, are the
    document. No task ever holds all quotes.
    """
    place = place_of(tie)
    first = quotes.agg(F.min(place)).scalar()
    comma = F.when(F.col("_place").eqNullSafe(first), "").otherwise(",")
    rows = quotes.withColumn("_place", place).select(
        F.lit(1).alias("section"), "_place", F.concat(comma, record_json(quotes)).alias("value")
    )
    nothing = F.lit(None).cast(rows.schema["_place"].dataType)
    start = head.select(F.lit(0).alias("section"), nothing.alias("_place"), "value")
    end = head.select(F.lit(2).alias("section"), nothing.alias("_place"), F.lit("]}").alias("value"))
    return start.unionByName(rows).unionByName(end).orderBy("section", "_place").select("value")


def write_json(quotes: DataFrame, head: DataFrame, path: str) -> None:
    json_lines(quotes, head).write.mode("overwrite").text(path)


def csv_lines(quotes: DataFrame, tie: str = "first_seen") -> DataFrame:
    """The whole CSV as ordered text lines: a UTF-8 mark and the header, then one per quote.

    Like the JSON document, it is range partitioned and written by many tasks;
    its part files, joined in name order, are the file, so the mark and the
    header stand in the first of them alone.
    """
    table = csv_columns(quotes.withColumn("_place", place_of(tie)), "_place")
    line = F.to_csv(F.struct(*[F.col(h) for h in fv.CSV_HEADERS]), {"emptyValue": "", "escape": '"'})
    rows = table.select(F.lit(1).alias("section"), "_place", line.alias("value"))
    nothing = F.lit(None).cast(rows.schema["_place"].dataType)
    head = quotes.sparkSession.range(1).select(F.lit(0).alias("section"), nothing.alias("_place"), F.lit(fv.CSV_MARK + ",".join(fv.CSV_HEADERS)).alias("value"))
    return head.unionByName(rows).orderBy("section", "_place").select("value")


def write_csv(quotes: DataFrame, path: str) -> None:
    csv_lines(quotes).write.mode("overwrite").text(path)
