"""What earlier runs published: quotes, rate and dated snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from faremeld import fixed_values as fv
from faremeld.functions.dates import parse_iso_date
from faremeld.schemas import FX, OTHER_SOURCES, PRICE, PUBLISHED, PUBLISHED_DEAL, QUOTE_FIELDS, QUOTES, RATE, as_quotes

# Fields a record cannot do without, and typed fields that must read if given.
REQUIRED = ("source", "sail_date", "depart_port", "ship_name", "cruise_line", "nights", "scraped_at")


def upgrade_other_sources(raw: Column) -> Column:
    """Competing quotes of either generation as the present map.

    The older files hold {source: price or null}, all in US dollars. The
    newer hold {source: {price, currency, price_twd}}.
    """
    values = F.from_json(raw, "map<string,variant>")

    def upgrade(_source: Column, value: Column) -> Column:
        kind = F.schema_of_variant(value)
        is_object = kind.startswith("OBJECT")
        currency = F.nullif(F.try_variant_get(value, "$.currency", "string"), F.lit(""))
        return F.struct(
            F.when(is_object, F.try_variant_get(value, "$.price", "string"))
            .otherwise(F.try_variant_get(value, "$", "string"))
            .alias("price"),
            F.coalesce(F.when(is_object, currency), F.lit("USD")).alias("currency"),
            F.when(is_object, F.try_variant_get(value, "$.price_twd", "string")).alias("price_twd"),
        )

    upgraded = F.transform_values(values, upgrade).cast(OTHER_SOURCES)
    return F.coalesce(upgraded, F.create_map().cast(OTHER_SOURCES))


def _timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def decode(deals: DataFrame) -> DataFrame:
    """Text records to quotes, with `row_ord` and a flag for damaged ones."""
    readers = {
        "sail_date": parse_iso_date,
        "stale_since": lambda c: parse_iso_date(F.nullif(c, F.lit(""))),
        "scraped_at": _timestamp,
        "nights": lambda c: c.try_cast("int"),
        "price": lambda c: c.try_cast(PRICE),
        "price_twd": lambda c: c.try_cast("decimal(20,0)"),
        "fx_rate": lambda c: c.try_cast(RATE),
        "other_sources": upgrade_other_sources,
    }
    defaults = {"depart_port_raw": "", "arrive_port": "", "currency": "USD", "price_note": "", "detail_url": "", "ship_name_raw": ""}
    cols, damaged = [], F.lit(False)
    for name, _ in QUOTE_FIELDS:
        raw = F.col(name)
        value = readers[name](raw) if name in readers else raw
        if name in defaults:
            value = F.coalesce(raw, F.lit(defaults[name]))
        if name == "ports_of_call":
            value = F.coalesce(raw, F.array().cast("array<string>"))
        if name in REQUIRED:
            damaged = damaged | value.isNull()
        elif name in readers and name != "other_sources":
            given = raw if name != "stale_since" else F.nullif(raw, F.lit(""))
            damaged = damaged | (given.isNotNull() & value.isNull())
        cols.append(value.alias(name))
    keep = [c for c in deals.columns if c not in QUOTES.fieldNames()]
    return deals.select(*cols, damaged.alias("_damaged"), *keep)


def read_published_text(spark: SparkSession, path: str) -> DataFrame:
    """Published envelopes as text fields, with a flag for unreadable files."""
    return (
        spark.read.schema(PUBLISHED)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
    )


def deals_of(envelopes: DataFrame) -> DataFrame:
    """One text row per published record; `row_ord` is its place in the list."""
    rows = envelopes.select(F.posexplode("deals").alias("_pos", "_d"))
    return rows.select(
        *[F.col(f"_d.{n}").alias(n) for n, _ in QUOTE_FIELDS],
        F.array(F.col("_pos").cast("bigint")).alias("row_ord"),
    )


def all_or_nothing(decoded: DataFrame) -> DataFrame:
    """All rows if every one of them is sound, else none.

    The test is an uncorrelated EXISTS, which stops at the first damaged row.
    """
    bad = decoded.where("_damaged")
    return decoded.where(~bad.exists()).drop("_damaged")


# Lines of a document in parts that are no record.
IS_HEAD = "(startswith(value, '{') AND endswith(value, '\"deals\":['))"
IS_END = "(value = ']}')"


def document_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """(value, row_ord): the lines of a document that `write_json` wrote in parts; None for any other file.

    A line's place is its part number, its block in the part, and its turn in the block.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint")
    place = F.array(F.coalesce(part, F.lit(0)), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", place.alias("row_ord")).where("value <> ''")
    return None if lines.where(IS_HEAD).isEmpty() else lines


def deals_in_lines(lines: DataFrame) -> DataFrame:
    """One text row per record line."""
    record = F.from_json(F.regexp_replace("value", "^,", ""), PUBLISHED_DEAL)
    rows = lines.where(f"NOT {IS_HEAD} AND NOT {IS_END}").select(record.alias("_d"), "row_ord")
    return rows.select(*[F.col(f"_d.{n}").alias(n) for n, _ in QUOTE_FIELDS], "row_ord")


def envelope_in_lines(lines: DataFrame) -> DataFrame:
    """The head line as an envelope without quotes."""
    head = F.from_json(F.concat("value", F.lit("]}")), PUBLISHED)
    return lines.where(IS_HEAD).select(head.alias("_e")).select("_e.*")


def _complete(lines: DataFrame) -> DataFrame:
    """One row if no part is missing: one head, one end, as many records as the head counts; else none."""
    claimed = F.from_json(F.concat("value", F.lit("]}")), PUBLISHED)["count"]
    totals = lines.agg(
        F.count_if(F.expr(IS_HEAD)).alias("heads"),
        F.count_if(F.expr(IS_END)).alias("ends"),
        F.count("*").alias("lines"),
        F.max(F.when(F.expr(IS_HEAD), claimed)).alias("claimed"),
    )
    return totals.where("heads = 1 AND ends = 1 AND lines = claimed + 2")


def read_previous(spark: SparkSession, path: str) -> DataFrame:
    """Quotes published last time: one JSON file, or the parts of a document.

    A missing or damaged file or part counts as none.
    """
    try:
        lines = document_lines(spark, path)
        if lines is not None:
            return all_or_nothing(decode(deals_in_lines(lines)).where(_complete(lines).exists()))
        envelopes = read_published_text(spark, path)
    except AnalysisException:
        return spark.createDataFrame([], QUOTES).withColumn("row_ord", F.array().cast("array<bigint>"))
    # A corrupt file yields one row without deals, hence no rows.
    return all_or_nothing(decode(deals_of(envelopes)))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV that `write_csv` wrote in parts, all text, '' for missing values."""
    schema = ", ".join(f"`{h}` string" for h in fv.CSV_HEADERS)
    rows = spark.read.schema(schema).option("multiLine", True).option("escape", '"').csv(path)
    first = fv.CSV_HEADERS[0]
    kept = rows.where(~F.coalesce(F.col(first), F.lit("")).isin(first, fv.CSV_MARK + first))
    return kept.select(*[F.coalesce(F.col(h), F.lit("")).alias(h) for h in fv.CSV_HEADERS])


def decode_rate(envelopes: DataFrame) -> DataFrame:
    """The rate an envelope holds; none when it is missing or unreadable."""
    return (
        envelopes.where("fx IS NOT NULL")
        .select(
            F.col("fx.usd_twd").try_cast(RATE).alias("usd_twd"),
            parse_iso_date(F.col("fx.as_of")).alias("as_of"),
            F.coalesce("fx.source", F.lit("")).alias("source"),
            F.coalesce(F.col("fx.stale").try_cast("boolean"), F.lit(False)).alias("stale"),
        )
        .where("usd_twd IS NOT NULL AND as_of IS NOT NULL")
    )


def read_previous_rate(spark: SparkSession, path: str) -> DataFrame:
    try:
        lines = document_lines(spark, path)
        return decode_rate(read_published_text(spark, path) if lines is None else envelope_in_lines(lines))
    except AnalysisException:
        return spark.createDataFrame([], FX)


def read_snapshots(spark: SparkSession, pattern: str) -> DataFrame:
    """All dated snapshot files as one table with `snapshot_date`; a damaged row or file ends the job.

    Both file generations are read by the one schema; the date is the name.
    """
    unreadable = F.raise_error(F.concat(F.lit("unreadable snapshot: "), F.col("_metadata.file_path")))
    envelopes = read_published_text(spark, pattern).select(
        F.when(F.col("deals").isNull(), unreadable).otherwise(F.col("deals")).alias("deals"), F.to_date(F.regexp_extract("_metadata.file_name", r"(\d{4}-\d{2}-\d{2})", 1)).alias("snapshot_date")
    )
    rows = envelopes.select("snapshot_date", F.posexplode("deals").alias("_pos", "_d"))
    flat = rows.select(
        "snapshot_date",
        *[F.col(f"_d.{n}").alias(n) for n, _ in QUOTE_FIELDS],
        F.array(F.col("_pos").cast("bigint")).alias("row_ord"),
    )
    damaged = F.raise_error(F.concat(F.lit("damaged row in the snapshot of "), F.col("snapshot_date").cast("string")))
    whole = decode(flat).where(F.when(F.col("_damaged"), damaged.cast("boolean")).otherwise(F.lit(True)))
    return as_quotes(whole, "snapshot_date", "row_ord")
