"""Declared schemas. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

PRICE = T.DecimalType(18, 4)
AMOUNT = T.DecimalType(20, 0)
RATE = T.DecimalType(18, 8)

QUOTE_ENTRY = T.StructType(
    [
        T.StructField("price", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("price_twd", T.StringType()),
    ]
)
OTHER_SOURCES = T.MapType(T.StringType(), QUOTE_ENTRY)

QUOTE_FIELDS = [
    ("source", T.StringType()),
    ("sail_date", T.DateType()),
    ("depart_port", T.StringType()),
    ("depart_port_raw", T.StringType()),
    ("arrive_port", T.StringType()),
    ("ports_of_call", T.ArrayType(T.StringType())),
    ("ship_name", T.StringType()),
    ("cruise_line", T.StringType()),
    ("nights", T.IntegerType()),
    ("price", PRICE),
    ("currency", T.StringType()),
    ("price_note", T.StringType()),
    ("detail_url", T.StringType()),
    ("scraped_at", T.TimestampType()),
    ("stale_since", T.DateType()),
    ("other_sources", OTHER_SOURCES),
    ("price_twd", AMOUNT),
    ("fx_rate", RATE),
    ("ship_name_raw", T.StringType()),
]
QUOTE_COLUMNS = [name for name, _ in QUOTE_FIELDS]
QUOTES = T.StructType([T.StructField(n, t) for n, t in QUOTE_FIELDS])

# A quote's place in the run: source order, then position inside the source.
# Spark rows have no order of their own, so every tie is broken by these two.
ORDER_COLUMNS = ["src_ord", "row_ord"]

RUN_STATUS = T.StructType(
    [
        T.StructField("src_ord", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_s", T.DoubleType()),
    ]
)

FX = T.StructType(
    [
        T.StructField("usd_twd", RATE),
        T.StructField("as_of", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("stale", T.BooleanType()),
    ]
)

# Published envelope as text: one schema reads both generations on disk, since
# fields an older file lacks come back null and `other_sources` stays raw JSON.
PUBLISHED_DEAL = T.StructType(
    [
        T.StructField(n, T.ArrayType(T.StringType()) if n == "ports_of_call" else T.StringType())
        for n in QUOTE_COLUMNS
    ]
)
PUBLISHED = T.StructType(
    [
        T.StructField("generated_at", T.StringType()),
        T.StructField(
            "fx",
            T.StructType(
                [
                    T.StructField("usd_twd", T.StringType()),
                    T.StructField("as_of", T.StringType()),
                    T.StructField("source", T.StringType()),
                    T.StructField("stale", T.StringType()),
                ]
            ),
        ),
        T.StructField("count", T.LongType()),
        T.StructField("deals", T.ArrayType(PUBLISHED_DEAL)),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def as_quotes(df: DataFrame, *extra: str) -> DataFrame:
    """Project to the quote schema, filling fields the source does not carry.

    A price beyond 14 digits before the point is unreadable, hence null like
    any other unreadable price: one absurd text must not fail its source.
    """
    have = set(df.columns)
    defaults = {
        "depart_port_raw": F.lit(""),
        "arrive_port": F.lit(""),
        "ports_of_call": F.array().cast("array<string>"),
        "currency": F.lit("USD"),
        "price_note": F.lit(""),
        "detail_url": F.lit(""),
        "ship_name_raw": F.lit(""),
        "other_sources": F.create_map().cast(OTHER_SOURCES),
    }
    cols = []
    for name, dtype in QUOTE_FIELDS:
        col = F.col(name) if name in have else defaults.get(name, F.lit(None))
        cols.append((col.try_cast(dtype) if name == "price" else col.cast(dtype)).alias(name))
    return df.select(*cols, *extra)
