"""Text, date and number functions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremeld.functions import dates, money, text
from faremeld.plans.table_queries.feeds import raw_table, table
from faremeld.plans.table_queries.registry import query


@query(
    "clean_text",
    r"""
SELECT doc_id, length(t) AS n, md5(t) AS digest, md5(lower(t)) AS key_digest FROM (
  SELECT doc_id, trim(regexp_replace(replace(coalesce(text, ''), ' the ', chr(12288) || 'the' || chr(160) || chr(10)),
    '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS t
  FROM documents)""",
)
def clean_documents(spark, sf_dir):
    """Whole documents with wide and non-breaking spaces put in first."""
    odd = F.replace(F.coalesce("text", F.lit("")), F.lit(" the "), F.lit("　the \n"))
    rows = raw_table(spark, sf_dir, "documents").select("doc_id", odd.alias("raw"))
    rows = rows.select("doc_id", text.clean_text(F.col("raw")).alias("t"), text.key_part(F.col("raw")).alias("k"))
    return rows.select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5("t").alias("digest"), F.md5("k").alias("key_digest"))


@query(
    "strip_label",
    """
SELECT p_partkey, CASE p_partkey % 5 WHEN 2 THEN 'Shipping ' || p_name WHEN 4 THEN 'Starts:' || p_name ELSE p_name END AS value
FROM part""",
)
def strip_label(spark, sf_dir):
    raw = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(" Starts: "), "p_name"))
        .when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("PORTS OF CALL\n"), "p_name", F.lit("　")))
        .when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("Shipping "), "p_name"))
        .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("Departing From :  "), "p_name"))
        .otherwise(F.concat(F.lit("Starts:"), "p_name"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_prefix_label(raw).alias("value"))


@query(
    "parse_price",
    """
SELECT doc_id, CAST(CASE WHEN v > 0 THEN v END AS VARCHAR) AS price FROM (
  SELECT doc_id, TRY_CAST(replace(regexp_extract(text, '[0-9][0-9,]*(?:[.][0-9]+)?'), ',', '') AS DECIMAL(38,4)) AS v
  FROM documents)""",
)
def price_in_documents(spark, sf_dir):
    """First number of each whole document."""
    return raw_table(spark, sf_dir, "documents").select(
        "doc_id", money.parse_price(F.col("text")).cast("string").alias("price")
    )


@query(
    "price_wordings",
    """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(38,4)) AS VARCHAR)
  WHEN 1 THEN CAST(CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS VARCHAR)
  WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE CAST(CAST(o_custkey AS DECIMAL(38,4)) AS VARCHAR) END AS price
FROM orders WHERE o_orderkey % 5 <> 4 OR o_custkey > 0
UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 5 = 4 AND o_custkey <= 0""",
)
def price_wordings(spark, sf_dir):
    exact = F.col("o_totalprice").cast("decimal(18,2)")
    raw = (
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("$"), F.format_number(exact, 2), F.lit(" USD")))
        .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("from $"), F.format_number(F.floor(exact).cast("decimal(18,0)"), 0), F.lit(" per person")))
        .when(F.col("o_orderkey") % 5 == 2, F.lit("Pricing On Request"))
        .when(F.col("o_orderkey") % 5 == 3, F.lit("$0"))
        .otherwise(F.concat(F.translate(F.col("o_custkey").cast("string"), "0123456789", "０１２３４５６７８９"), F.lit(" 元")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", money.parse_price(raw).cast("string").alias("price"))


@query(
    "lowest_cell",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_discount = 0 THEN CAST(l_extendedprice AS DECIMAL(38,4))
  ELSE least(CAST(l_extendedprice AS DECIMAL(38,4)), CAST(nullif(l_quantity, 0) * 100 AS DECIMAL(38,4))) END AS VARCHAR) AS price
FROM lineitem""",
)
def lowest_cell(spark, sf_dir):
    """Lowest price among the cells of a row, buttons and dashes ignored."""
    from faremeld.sources.sailing_cards import lowest_of_cabins

    price = F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2), F.lit(" USD"))
    cabin = F.when(F.col("l_discount") == 0, "-").otherwise(
        F.concat(F.lit("$"), F.format_number((F.col("l_quantity") * 100).cast("decimal(18,2)"), 2))
    )
    cells = F.array(F.lit("Select"), price, F.lit("-"), cabin, F.lit("$0"))
    return raw_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lowest_of_cabins(cells).cast("string").alias("price")
    )


@query(
    "parse_nights",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 4 = 3 THEN NULL
  ELSE CAST(l_quantity AS BIGINT) END AS nights,
  CASE WHEN l_linenumber % 4 = 3 THEN 0 ELSE greatest(CAST(l_quantity AS BIGINT) - 1, 0) END AS nights_of_days
FROM lineitem""",
)
def nights_wordings(spark, sf_dir):
    n = F.col("l_quantity").cast("int").cast("string")
    raw = (
        F.when(F.col("l_linenumber") % 4 == 0, F.concat(n, F.lit(" Nights")))
        .when(F.col("l_linenumber") % 4 == 1, F.concat(F.lit("Spring 2026: "), n, F.lit("　night Grand Tour 7")))
        .when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit("Length: "), n, F.lit(" days")))
        .otherwise(F.lit("on request"))
    )
    rows = raw_table(spark, sf_dir, "lineitem").withColumn("n", money.parse_nights(raw))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("n").cast("bigint").alias("nights"),
        money.nights_from_days(F.col("n")).cast("bigint").alias("nights_of_days"),
    )


@query(
    "split_list",
    r"""
SELECT doc_id, len(parts) AS n, md5(array_to_string(parts, '|')) AS digest FROM (
  SELECT doc_id, list_filter(list_transform(string_split(t, ','), lambda x: trim(x)), lambda x: x <> '') AS parts
  FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS t FROM documents))""",
)
def split_documents(spark, sf_dir):
    """Whole documents split at commas, as port lists are."""
    rows = raw_table(spark, sf_dir, "documents").select("doc_id", text.split_ports(F.col("text")).alias("parts"))
    return rows.select(
        "doc_id", F.size("parts").cast("bigint").alias("n"), F.md5(F.array_join("parts", "|")).alias("digest")
    )


_DATE_FORMS = ("MMM d, yyyy", "MMMM d, yyyy", "d-MMM-yyyy", "dd-MMMM-yyyy", "MM/dd/yyyy", "yyyy/M/d", "d MMM yyyy", "yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd'T'23:30:00-05:00")


@query(
    "parse_date_formats",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 < 10 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""",
)
def parse_date_formats(spark, sf_dir):
    """Dates written in ten forms, and one that is no date, read back."""
    raw = F.lit("soon")
    for i, form in enumerate(_DATE_FORMS):
        raw = F.when(F.col("o_orderkey") % 11 == i, F.date_format("o_orderdate", form)).otherwise(raw)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.parse_date(F.concat(F.lit(" "), raw, F.lit("\n"))).cast("string").alias("parsed")
    )


@query(
    "date_range_cell",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS departs FROM orders""",
)
def date_range_cell(spark, sf_dir):
    day = F.date_format("o_orderdate", "MMM d, yyyy")
    back = F.date_format(F.date_add("o_orderdate", 7), "MMM d, yyyy")
    cell = F.when(F.col("o_orderkey") % 6 != 0, F.concat(day, F.lit(" - "), back, F.lit(" Sun - Fri Bonus Details"))).otherwise(
        "Bonus Details"
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.first_date_in_range_cell(cell).cast("string").alias("departs")
    )


@query(
    "date_chunks",
    """
WITH bounds AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY ALL),
chunks AS (SELECT o_custkey, e, CAST(unnest(generate_series(s, e, INTERVAL 30 DAY)) AS DATE) AS cs FROM bounds)
SELECT o_custkey, CAST(cs AS VARCHAR) AS chunk_start, CAST(least(cs + 29, e) AS VARCHAR) AS chunk_end FROM chunks""",
)
def chunks_per_customer(spark, sf_dir):
    """The span of each customer's orders cut into thirty-day chunks."""
    bounds = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e")
    )
    chunks = bounds.select("o_custkey", F.inline(dates.date_chunks(F.col("s"), F.col("e"), 30)))
    return chunks.select(
        "o_custkey",
        F.col("chunk_start").cast("string").alias("chunk_start"),
        F.col("chunk_end").cast("string").alias("chunk_end"),
    )


@query(
    "chunk_range_join",
    """
WITH chunks AS (
  SELECT CAST(s AS DATE) AS cs, least(CAST(s AS DATE) + 4, DATE '1997-12-31') AS ce
  FROM generate_series(DATE '1996-01-01', DATE '1997-12-31', INTERVAL 5 DAY) t(s))
SELECT CAST(cs AS VARCHAR) AS chunk_start, CAST(ce AS VARCHAR) AS chunk_end, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total
FROM orders JOIN chunks ON CAST(o_orderdate AS DATE) BETWEEN cs AND ce GROUP BY ALL""",
)
def chunk_range_join(spark, sf_dir):
    """Orders matched to five-day chunks by arithmetic instead of a range join."""
    start, end = F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date")
    rows = table(spark, sf_dir, "orders").where(F.col("o_orderdate").between("1996-01-01", "1997-12-31 23:59:59"))
    rows = rows.withColumn("chunk", dates.chunk_of(F.to_date("o_orderdate"), start, end)).where("chunk IS NOT NULL")
    return rows.groupBy(
        F.col("chunk.chunk_start").cast("string").alias("chunk_start"),
        F.col("chunk.chunk_end").cast("string").alias("chunk_end"),
    ).agg(
        F.count("*").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("total"),
    )


@query(
    "date_window",
    """
SELECT l_returnflag, count(*) AS n, CAST(min(l_shipdate) AS DATE)::VARCHAR AS first_day, CAST(max(l_shipdate) AS DATE)::VARCHAR AS last_day
FROM lineitem WHERE l_shipdate >= DATE '1998-03-01' AND l_shipdate <= DATE '1998-03-31' GROUP BY ALL""",
)
def date_window(spark, sf_dir):
    """Thirty days ahead of a start day; the bounds reach the Parquet scan."""
    start = F.lit("1998-03-01").cast("timestamp_ntz")
    end = F.lit("1998-03-31").cast("timestamp_ntz")
    rows = table(spark, sf_dir, "lineitem").where(dates.in_window(F.col("l_shipdate"), start, end))
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.to_date(F.min("l_shipdate")).cast("string").alias("first_day"),
        F.to_date(F.max("l_shipdate")).cast("string").alias("last_day"),
    )


@query(
    "epoch_days",
    """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS day_start,
       CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) + 86399 AS day_end FROM orders""",
)
def epoch_days(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(
        F.col("d").cast("string").alias("day"),
        dates.day_start_epoch(F.col("d")).alias("day_start"),
        dates.day_end_epoch(F.col("d")).alias("day_end"),
    )


@query(
    "display_time",
    "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS shown FROM events",
)
def display_time(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", money.display_time(F.col("ts").cast("timestamp")).alias("shown")
    )


@query(
    "url_without_query",
    "SELECT page_id, split_part(url, '?', 1) AS url FROM pages",
)
def url_without_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.before_query(F.col("url")).alias("url"))


@query(
    "json_props",
    """
SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS total, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS top
FROM events GROUP BY ALL""",
)
def json_props(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(k).alias("total"), F.max(k).alias("top")
    )
