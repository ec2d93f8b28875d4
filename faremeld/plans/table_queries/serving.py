"""Served views of the merged feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from faremeld.functions.money import plain_number
from faremeld.operators.fx import apply_rate
from faremeld.plans import serving
from faremeld.plans.publish import record_json, write_csv
from faremeld.plans.table_queries.feeds import FEED_SQL, RATE, quote_feed, table
from faremeld.plans.table_queries.merging import MERGED_FEED_SQL, merged_feed
from faremeld.plans.table_queries.registry import query
from faremeld.session import ensure_checkpoint_dir
from faremeld.sources.published import read_csv


def thousands(expr: str) -> str:
    """DuckDB text of a whole number with thousands commas."""
    return f"format('{{:,}}', CAST({expr} AS BIGINT))"


_CSV_SQL = (
    MERGED_FEED_SQL
    + """
SELECT CAST(sail_date AS VARCHAR) AS "出發日期", depart_port AS "出發港口", arrive_port AS "目的港口", ship_name AS "郵輪名",
  cruise_line AS "船公司", CAST(nights AS VARCHAR) AS "航行天數", coalesce(rtrim(rtrim(CAST(price AS VARCHAR), '0'), '.'), '') AS "最低價格",
  currency AS "幣別", coalesce(CAST(price_twd AS VARCHAR), '') AS "台幣價格",
  CASE WHEN currency = 'USD' THEN '31.966724' ELSE '' END AS "匯率", '' AS "價格說明",
  lower(arrive_port) || ' → ' || lower(cruise_line) AS "停靠港", source AS "來源",
  coalesce(array_to_string(list_transform(list_filter(string_split(others, ';'), lambda q: q <> ''), lambda q:
    split_part(q, ':', 1) || ': ' || CASE
      WHEN split_part(q, ':', 2) = '-' THEN '洽詢報價'
      WHEN split_part(q, ':', 4) <> '-' AND split_part(q, ':', 3) <> 'TWD'
        THEN 'NT$' || split_part(q, ':', 4) || '（' || split_part(q, ':', 3) || ' ' || split_part(q, ':', 2) || '）'
      WHEN split_part(q, ':', 4) <> '-' THEN 'NT$' || split_part(q, ':', 4)
      ELSE split_part(q, ':', 3) || ' ' || split_part(q, ':', 2) END), '; '), '') AS "其他來源報價",
  '最新' AS "資料狀態", '' AS "連結"
FROM best"""
)


@query("csv_projection", _CSV_SQL)
def csv_projection(spark, sf_dir):
    return serving.csv_columns(merged_feed(spark, sf_dir))


@query("csv_round_trip", _CSV_SQL)
def csv_round_trip(spark, sf_dir):
    """The merged feed written as one CSV in parts, and read back from it."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/csv-{uuid.uuid4().hex}"
    write_csv(merged_feed(spark, sf_dir), path)
    return read_csv(spark, path)


@query(
    "summary_stats",
    MERGED_FEED_SQL
    + f"""
SELECT count(*) AS sailings, CAST(min(price_twd) AS VARCHAR) AS lowest_twd, count(DISTINCT depart_port) AS ports,
       'NT$' || {thousands('min(price_twd)')} AS lowest_text
FROM best""",
)
def summary_stats(spark, sf_dir):
    return serving.summary_stats(merged_feed(spark, sf_dir)).withColumn("lowest_twd", F.col("lowest_twd").cast("string"))


@query(
    "facets",
    f"""WITH {FEED_SQL}
SELECT DISTINCT 'port' AS facet, depart_port AS value FROM feed
UNION ALL SELECT DISTINCT 'line', cruise_line FROM feed WHERE cruise_line <> ''""",
)
def facets(spark, sf_dir):
    return serving.facets(quote_feed(spark, sf_dir))


@query(
    "search_filter",
    f"""WITH {FEED_SQL}
SELECT row_ord[1] AS order_no, row_ord[2] AS line_no, row_ord[3] AS part_no, row_ord[4] AS supplier_no, ship_name
FROM feed
WHERE depart_port = 'Yokohama' AND contains(lower(concat_ws(' ', ship_name, '', cruise_line, depart_port, arrive_port,
      lower(arrive_port), lower(cruise_line))), 'widget')""",
)
def search_filter(spark, sf_dir):
    found = serving.search(quote_feed(spark, sf_dir), text="  WIDGET ", port="Yokohama")
    ord_ = F.col("row_ord")
    return found.select(
        ord_[0].alias("order_no"), ord_[1].alias("line_no"), ord_[2].alias("part_no"), ord_[3].alias("supplier_no"), "ship_name"
    )


@query(
    "search_haystack",
    f"""WITH {FEED_SQL}
SELECT lower(concat_ws(' ', ship_name, '', cruise_line, depart_port, arrive_port, lower(arrive_port), lower(cruise_line))) AS haystack,
       count(*) AS n
FROM feed GROUP BY ALL""",
)
def haystacks(spark, sf_dir):
    rows = serving.with_haystack(quote_feed(spark, sf_dir))
    return rows.groupBy("haystack").agg(F.count("*").alias("n"))


@query(
    "display_columns",
    f"""WITH {FEED_SQL}, shown AS (
  SELECT *, {thousands('floor(price)')} AS whole, CAST(round_even(price, 2) AS DECIMAL(38,2)) AS cents FROM priced
), worded AS (
  SELECT *, whole || CASE WHEN price = floor(price) THEN '' ELSE '.' || right(CAST(cents AS VARCHAR), 2) END AS own FROM shown
)
SELECT row_ord[1] AS order_no, row_ord[2] AS line_no, row_ord[3] AS part_no, row_ord[4] AS supplier_no,
  CASE WHEN price IS NULL THEN '洽詢報價' WHEN price_twd IS NOT NULL THEN 'NT$' || {thousands('price_twd')} ELSE 'JPY ' || own END AS price_main,
  coalesce(rtrim(rtrim(CAST(coalesce(CAST(price_twd AS DECIMAL(38,4)), price) AS VARCHAR), '0'), '.'), '') AS price_sort,
  CASE WHEN currency = 'USD' AND price IS NOT NULL THEN 'US$' || own ELSE '' END AS price_original,
  CASE WHEN currency = 'USD' THEN '（1 USD = 31.966724 TWD）' ELSE '' END AS note
FROM worded""",
)
def display_columns(spark, sf_dir):
    rows = serving.display_columns(apply_rate(quote_feed(spark, sf_dir), F.lit(RATE)))
    ord_ = F.col("row_ord")
    return rows.select(
        ord_[0].alias("order_no"),
        ord_[1].alias("line_no"),
        ord_[2].alias("part_no"),
        ord_[3].alias("supplier_no"),
        "price_main",
        "price_sort",
        "price_original",
        "note",
    )


@query(
    "display_rivals",
    MERGED_FEED_SQL
    + f"""
, rival_words AS (
  SELECT k_ship, sail_date, nights, k_port,
    string_agg(source || ' ' || CASE WHEN price_text = '-' THEN '洽詢報價' WHEN twd_text <> '-' THEN 'NT$' || {thousands('twd_text')}
      ELSE currency || ' ' || {thousands("split_part(price_text, '.', 1)")} ||
        CASE WHEN contains(price_text, '.') THEN '.' || rpad(split_part(price_text, '.', 2), 2, '0') ELSE '' END END, '、' ORDER BY source) AS badge,
    string_agg(source || '：' || CASE WHEN price_text = '-' THEN '洽詢報價' ELSE
      CASE currency WHEN 'USD' THEN 'US$' WHEN 'TWD' THEN 'NT$' ELSE currency || ' ' END || {thousands("split_part(price_text, '.', 1)")} ||
        CASE WHEN contains(price_text, '.') THEN '.' || rpad(split_part(price_text, '.', 2), 2, '0') ELSE '' END END, '；' ORDER BY source) AS tooltip
  FROM rival GROUP BY ALL)
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, coalesce(badge, '') AS badge, coalesce(tooltip, '') AS tooltip
FROM best LEFT JOIN rival_words USING (k_ship, sail_date, nights, k_port)""",
)
def display_rivals(spark, sf_dir):
    rows = serving.display_columns(merged_feed(spark, sf_dir))
    return rows.select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        "badge",
        "tooltip",
    )


@query(
    "record_json",
    f"""WITH {FEED_SQL}
SELECT row_ord[1] AS order_no, row_ord[2] AS line_no, row_ord[3] AS part_no, row_ord[4] AS supplier_no, md5(
  '{{"source":"' || source || '","sail_date":"' || CAST(sail_date AS VARCHAR) || '","depart_port":"' || depart_port ||
  '","depart_port_raw":"","arrive_port":"' || arrive_port || '","ports_of_call":["' || lower(arrive_port) || '","' || lower(cruise_line) ||
  '"],"ship_name":"' || ship_name || '","cruise_line":"' || cruise_line || '","nights":' || nights || ',"price":' ||
  coalesce('"' || rtrim(rtrim(CAST(price AS VARCHAR), '0'), '.') || '"', 'null') || ',"currency":"' || currency ||
  '","price_note":"","detail_url":"","scraped_at":"' || CAST(scraped_day AS VARCHAR) || 'T00:00:00+00:00","stale_since":null,"other_sources":{{}},"price_twd":' ||
  coalesce('"' || CAST(price_twd AS VARCHAR) || '"', 'null') || ',"fx_rate":' || CASE WHEN currency = 'USD' THEN '"31.966724"' ELSE 'null' END ||
  ',"ship_name_raw":""}}') AS digest
FROM priced""",
)
def records(spark, sf_dir):
    rows = apply_rate(quote_feed(spark, sf_dir), F.lit(RATE))
    ord_ = F.col("row_ord")
    return rows.select(
        ord_[0].alias("order_no"),
        ord_[1].alias("line_no"),
        ord_[2].alias("part_no"),
        ord_[3].alias("supplier_no"),
        F.md5(record_json(rows)).alias("digest"),
    )


@query(
    "plain_prices",
    "SELECT p_partkey, rtrim(rtrim(CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS VARCHAR), '0'), '.') AS price FROM part",
)
def plain_prices(spark, sf_dir):
    price = F.col("p_retailprice").cast("decimal(18,4)")
    return table(spark, sf_dir, "part").select("p_partkey", plain_number(price).alias("price"))
