"""Exchange-rate operators over the quote feed and the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.money import plain_number
from faremeld.operators.fx import apply_rate, carry_rate_forward, convert, first_valid_rate, provider_rates, rate_as_of, requote, resolve_rate
from faremeld.plans.publish import rate_columns
from faremeld.plans.table_queries.feeds import FEED_SQL, RATE, quote_feed, raw_table, table
from faremeld.plans.table_queries.registry import query
from faremeld.schemas import OTHER_SOURCES, RATE as RATE_TYPE


@query(
    "fx_convert",
    f"""WITH {FEED_SQL}
SELECT row_ord[1] AS order_no, row_ord[2] AS line_no, row_ord[3] AS part_no, row_ord[4] AS supplier_no, currency,
       CAST(price_twd AS VARCHAR) AS price_twd,
       CASE WHEN currency = 'USD' THEN '31.966724' END AS fx_rate, CAST(amount AS VARCHAR) AS amount
FROM ranked""",
)
def fx_convert(spark, sf_dir):
    from faremeld.operators.fx import amount

    rows = apply_rate(quote_feed(spark, sf_dir), F.lit(RATE))
    ord_ = F.col("row_ord")
    return rows.select(
        ord_[0].alias("order_no"),
        ord_[1].alias("line_no"),
        ord_[2].alias("part_no"),
        ord_[3].alias("supplier_no"),
        "currency",
        F.col("price_twd").cast("string").alias("price_twd"),
        plain_number(F.col("fx_rate")).alias("fx_rate"),
        amount().cast("decimal(38,4)").cast("string").alias("amount"),
    )


def hourly_rates(spark, sf_dir) -> DataFrame:
    """Mean event value per hour, standing in for a published rate."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", "ts").alias("hour"))
        .agg((F.sum(F.col("value").cast("decimal(18,2)")) / F.count("*")).cast("decimal(18,4)").alias("mean"))
    )


_HOURLY_SQL = """
hourly AS (
  SELECT date_trunc('hour', ts) AS hour,
         CAST(round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,8)) / count(*), 4) AS DECIMAL(18,4)) AS mean
  FROM events GROUP BY ALL
)"""


def provider_payloads(spark, sf_dir) -> DataFrame:
    """Two provider payloads per hour, faulty in turn.

    First provider: an error every fourth hour, a rate of zero every fifth.
    Fallback: no pair every sixth hour.
    """
    hours = hourly_rates(spark, sf_dir).withColumn("h", (F.unix_timestamp(F.to_timestamp("hour")) / 3600).cast("bigint"))
    stamp = F.date_format("hour", "EEE, dd MMM yyyy HH:mm:ss +0000")
    rate = F.when(F.col("h") % 5 == 0, F.lit(0).cast("decimal(18,4)")).otherwise(F.col("mean"))
    primary = F.to_json(
        F.struct(
            F.when(F.col("h") % 4 == 0, "error").otherwise("success").alias("result"),
            stamp.alias("time_last_update_utc"),
            F.create_map(F.lit("USD"), F.lit(1).cast("decimal(18,4)"), F.lit("TWD"), rate).alias("rates"),
        )
    )
    pair = F.when(F.col("h") % 6 == 0, "USDJPY").otherwise("USDTWD")
    quote = F.struct(
        (F.col("mean") + 1).cast("decimal(18,4)").alias("Exrate"), F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("UTC")
    )
    fallback = F.to_json(F.create_map(pair, quote))
    both = F.array(
        F.struct(F.lit(fv.FX_PRIMARY).alias("provider"), primary.alias("payload")),
        F.struct(F.lit(fv.FX_FALLBACK).alias("provider"), fallback.alias("payload")),
    )
    return hours.select("hour", F.inline(both))


@query(
    "fx_provider_fallback",
    f"""WITH {_HOURLY_SQL},
h AS (SELECT *, CAST(epoch(hour) AS BIGINT) // 3600 AS h FROM hourly)
SELECT strftime(hour, '%Y-%m-%d %H') AS hour,
       rtrim(rtrim(CAST(CASE WHEN h % 4 <> 0 AND h % 5 <> 0 AND mean > 0 THEN mean ELSE mean + 1 END AS VARCHAR), '0'), '.') AS usd_twd,
       strftime(hour, '%Y-%m-%d') AS as_of,
       CASE WHEN h % 4 <> 0 AND h % 5 <> 0 AND mean > 0 THEN 'open.er-api.com' ELSE 'tw.rter.info' END AS source,
       false AS stale
FROM h WHERE (h % 4 <> 0 AND h % 5 <> 0 AND mean > 0) OR h % 6 <> 0""",
)
def fx_provider_fallback(spark, sf_dir):
    rates = first_valid_rate(provider_rates(provider_payloads(spark, sf_dir)), "hour")
    return rates.select(
        F.date_format("hour", "yyyy-MM-dd HH").alias("hour"),
        plain_number(F.col("usd_twd")).alias("usd_twd"),
        F.col("as_of").cast("string").alias("as_of"),
        "source",
        "stale",
    )


@query(
    "rate_record",
    f"""WITH {_HOURLY_SQL}
SELECT strftime(hour, '%Y-%m-%d %H') AS hour,
       '{{"usd_twd":"' || rtrim(rtrim(CAST(mean AS VARCHAR), '0'), '.') || '","as_of":"' || strftime(hour, '%Y-%m-%d')
       || '","source":"hourly","stale":' || CASE WHEN hour(hour) % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS record
FROM hourly""",
)
def rate_record(spark, sf_dir):
    """Rates as the JSON records that runs publish."""
    rate = F.struct(
        F.col("mean").cast(RATE_TYPE).alias("usd_twd"),
        F.to_date("hour").alias("as_of"),
        F.lit("hourly").alias("source"),
        (F.hour("hour") % 2 == 0).alias("stale"),
    )
    rows = hourly_rates(spark, sf_dir).withColumn("rate", rate)
    return rows.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), F.to_json(rate_columns(F.col("rate"))).alias("record"))


@query(
    "fx_carry_forward",
    """
WITH days AS (
  SELECT event_type AS pair, CAST(ts AS DATE) AS day, max(CAST(value AS DECIMAL(18,2))) AS top
  FROM events GROUP BY ALL
),
gaps AS (SELECT pair, day, CASE WHEN day(day) % 3 <> 0 AND day(day) <> 1 THEN top END AS rate FROM days)
SELECT pair, CAST(day AS VARCHAR) AS day,
       CAST(last_value(rate IGNORE NULLS) OVER w AS VARCHAR) AS rate,
       rate IS NULL AND last_value(rate IGNORE NULLS) OVER w IS NOT NULL AS stale
FROM gaps WINDOW w AS (PARTITION BY pair ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def fx_carry_forward(spark, sf_dir):
    day = F.to_date("ts")
    days = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("pair"), day.alias("day")).agg(
        F.max(F.col("value").cast("decimal(18,2)")).alias("top")
    )
    known = (F.dayofmonth("day") % 3 != 0) & (F.dayofmonth("day") != 1)
    gaps = days.select("pair", "day", F.when(known, F.col("top")).alias("rate"))
    return carry_rate_forward(gaps, "pair", "day", "rate").select(
        "pair", F.col("day").cast("string").alias("day"), F.col("rate").cast("string").alias("rate"), "stale"
    )


@query(
    "requote_carried",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_suppkey % 3 = 0 THEN CAST(round_even(CAST(l_extendedprice AS DECIMAL(38,4)) * CAST(31.966724 AS DECIMAL(18,6)), 0) AS DECIMAL(38,0))::VARCHAR END AS usd_twd,
       CASE WHEN l_suppkey % 3 = 2 THEN 'old' END AS unpriced_twd,
       CAST(CAST(round_even(CAST(l_quantity AS DECIMAL(38,4)), 0) AS DECIMAL(38,0)) AS VARCHAR) AS twd_twd
FROM lineitem""",
)
def requote_carried(spark, sf_dir):
    """Carried quotes at a new rate: good, unreadable, unpriced and TWD ones."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    first = (
        F.when(F.col("l_suppkey") % 3 == 0, F.struct(price, F.lit("USD"), F.lit("old")))
        .when(F.col("l_suppkey") % 3 == 1, F.struct(F.lit("亂碼"), F.lit("USD"), F.lit("old")))
        .otherwise(F.struct(F.lit(None).cast("string"), F.lit("USD"), F.lit("old")))
    )
    second = F.struct(F.col("l_quantity").cast("decimal(18,2)").cast("string"), F.lit("TWD"), F.lit(None).cast("string"))
    rows = raw_table(spark, sf_dir, "lineitem").withColumn(
        "carried", F.create_map(F.lit("a"), first, F.lit("b"), second).cast(OTHER_SOURCES)
    )
    rows = rows.withColumn("carried", F.transform_values("carried", lambda _s, q: requote(q, F.lit(RATE).cast(RATE_TYPE))))
    entry = F.col("carried")["a"]
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(entry["price"].isNotNull(), entry["price_twd"]).alias("usd_twd"),
        F.when(entry["price"].isNull(), entry["price_twd"]).alias("unpriced_twd"),
        F.col("carried")["b"]["price_twd"].alias("twd_twd"),
    )


@query(
    "convert_by_currency",
    f"""WITH {FEED_SQL}
SELECT source, currency, count(*) AS n, count(price_twd) AS converted, CAST(sum(price_twd) AS VARCHAR) AS total_twd,
       CAST(min(price_twd) AS VARCHAR) AS lowest, CAST(max(price_twd) AS VARCHAR) AS highest
FROM priced GROUP BY ALL""",
)
def convert_by_currency(spark, sf_dir):
    twd = convert(F.col("price"), F.lower("currency"), F.lit(RATE).cast(RATE_TYPE))
    rows = quote_feed(spark, sf_dir).withColumn("twd", twd)
    return rows.groupBy("source", "currency").agg(
        F.count("*").alias("n"),
        F.count("twd").alias("converted"),
        F.sum("twd").cast("string").alias("total_twd"),
        F.min("twd").cast("string").alias("lowest"),
        F.max("twd").cast("string").alias("highest"),
    )


# ---- dated rates


@query(
    "rate_as_of",
    """
WITH rates AS (
  SELECT o_custkey % 7 AS pair, CAST(o_orderdate AS DATE) AS day, max(CAST(o_totalprice AS DECIMAL(18,2))) AS rate
  FROM orders WHERE o_orderdate >= '1993-01-01' AND (o_custkey % 7 <> 3 OR month(o_orderdate) IN (2, 3, 9)) GROUP BY ALL
), quotes AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 8 AS pair, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, pair, CAST(rate AS VARCHAR) AS rate, CAST(rates.day AS VARCHAR) AS rate_day
FROM quotes ASOF LEFT JOIN rates USING (pair, day)""",
)
def dated_rates(spark, sf_dir):
    """Every line with the last known rate of its pair: one pair has rates in three months a year, one has none."""
    kept = (F.col("pair") != 3) | F.month("day").isin(2, 3, 9)
    orders = table(spark, sf_dir, "orders").where("o_orderdate >= '1993-01-01'")
    rates = orders.select((F.col("o_custkey") % 7).alias("pair"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("rate")).where(kept)
    quotes = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 8).alias("pair"), F.to_date("l_shipdate").alias("day"))
    return rate_as_of(quotes, rates, "pair", "day").select(
        "l_orderkey", "l_linenumber", "l_partkey", "pair", F.col("rate").cast("string").alias("rate"), F.col("rate_day").cast("string").alias("rate_day")
    )


@query(
    "rate_resolution",
    """
WITH dearest AS (SELECT o_orderpriority AS kind, max(CAST(o_totalprice AS DECIMAL(18,2))) AS top FROM orders GROUP BY ALL)
SELECT kind, CASE substr(kind, 1, 1) WHEN '1' THEN '32.5' WHEN '2' THEN rtrim(rtrim(CAST(top AS VARCHAR), '0'), '.') WHEN '3' THEN rtrim(rtrim(CAST(top + 1 AS VARCHAR), '0'), '.')
    WHEN '4' THEN rtrim(rtrim(CAST(top AS VARCHAR), '0'), '.') END AS usd_twd,
  CASE substr(kind, 1, 1) WHEN '1' THEN 'manual' WHEN '2' THEN 'primary' WHEN '3' THEN 'previous' WHEN '4' THEN 'primary' END AS via,
  substr(kind, 1, 1) = '3' AS stale
FROM dearest""",
)
def order_of_rates(spark, sf_dir):
    """Which rate a run takes: the given one, else a fetched one, else the last published one as stale, else none.

    The cases are the order priorities, each with the dearest order as its rate:
    a given rate over all others; a fetched over a published one; a published
    one where the payload is no success; a text for a given rate that is no
    number; nothing at all.
    """
    rows = None
    for kind in [r["kind"] for r in table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind")).distinct().collect()]:  # the five priorities
        top = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == kind).agg(F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("top"))
        case = kind[0]
        result = "success" if case in "124" else "error"
        payload = F.concat(F.lit(f'{{"result":"{result}","time_last_update_utc":"Mon, 17 Aug 2026 00:00:01 +0000","rates":{{"TWD":'), F.col("top").cast("string"), F.lit("}}"))
        payloads = top.select(F.lit(fv.FX_PRIMARY).alias("provider"), payload.alias("payload"))
        old = top.select((F.col("top") + 1).cast("decimal(18,8)").alias("usd_twd"), F.lit("2026-08-16").cast("date").alias("as_of"), F.lit("previous").alias("source"), F.lit(False).alias("stale"))
        chosen = resolve_rate(spark, {"1": "32.5", "4": "many"}.get(case), payloads, None if case == "5" else old)
        via = F.when(F.col("source") == fv.FX_MANUAL, "manual").when(F.col("source") == fv.FX_PRIMARY, "primary").otherwise(F.col("source"))
        found = chosen.select(F.struct(plain_number(F.col("usd_twd")).alias("usd_twd"), via.alias("via"), "stale"))
        given = spark.range(1).select(F.lit(kind).alias("kind"), found.scalar().alias("r"))
        given = given.select("kind", "r.usd_twd", "r.via", F.coalesce("r.stale", F.lit(False)).alias("stale"))
        rows = given if rows is None else rows.unionByName(given)
    return rows
