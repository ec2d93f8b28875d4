"""Merge, de-duplication, order, staleness and history over the quote feed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from faremeld.functions.names import with_match_key
from faremeld.functions.money import plain_number
from faremeld.operators.dedupe import best_quotes, keep_cheapest, keep_last
from faremeld.operators.fx import apply_rate
from faremeld.operators.history import price_changes
from faremeld.operators.merge import merge_run, rows_after_run
from faremeld.operators.ordering import numeric_key, output_keys, previous_in_order, text_key, with_position
from faremeld.operators.quality import run_report, run_totals
from faremeld.plans.publish import envelope_head, write_json
from faremeld.plans.table_queries.feeds import FEED_SQL, RATE, merged_sql, others_text, quote_feed, table
from faremeld.plans.table_queries.registry import query
from faremeld.schemas import FX, RUN_STATUS
from faremeld.session import ensure_checkpoint_dir
from faremeld.sources.published import read_previous, read_previous_rate
from faremeld.sources.registry import select_sources


def merged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed merged as one successful run."""
    quotes = apply_rate(with_match_key(quote_feed(spark, sf_dir, dealt=True)), F.lit(RATE))
    quotes = quotes.withColumn("ord", F.concat(F.array("src_ord"), "row_ord")).drop("src_ord", "row_ord", "line_status")
    return best_quotes(quotes)


ALL_AS_ONE_RUN = "placed AS (SELECT *, list_prepend(src_ord, row_ord) AS ord FROM ranked)"
MERGED_FEED_SQL = f"WITH {FEED_SQL}, {ALL_AS_ONE_RUN}, {merged_sql('placed')}"


@query(
    "cross_source_merge",
    MERGED_FEED_SQL
    + """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, source, ship_name, depart_port, currency,
       rtrim(rtrim(CAST(price AS VARCHAR), '0'), '.') AS price, CAST(price_twd AS VARCHAR) AS price_twd,
       CASE WHEN currency = 'USD' THEN '31.966724' END AS fx_rate, others
FROM best""",
)
def cross_source_merge(spark, sf_dir):
    return merged_feed(spark, sf_dir).select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        "source",
        "ship_name",
        "depart_port",
        "currency",
        plain_number(F.col("price")).alias("price"),
        F.col("price_twd").cast("string").alias("price_twd"),
        plain_number(F.col("fx_rate")).alias("fx_rate"),
        others_text().alias("others"),
    )


@query(
    "output_order",
    MERGED_FEED_SQL
    + """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port,
       row_number() OVER (ORDER BY sail_date, amount IS NULL, amount, first_seen) AS position
FROM best""",
)
def output_order(spark, sf_dir):
    placed = with_position(
        merged_feed(spark, sf_dir).select("k_ship", "sail_date", "nights", "k_port", "price", "price_twd", "first_seen"),
        output_keys(),
    )
    return placed.select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        "position",
    )


@query(
    "document_round_trip",
    MERGED_FEED_SQL
    + """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, source, NULL::VARCHAR AS stale_since,
       CAST(price_twd AS VARCHAR) AS price_twd, others, '31.966724' AS usd_twd, '2026-08-12' AS as_of FROM best""",
)
def document_round_trip(spark, sf_dir):
    """The merged feed and its rate, published as a document in parts and read back from it."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/document-{uuid.uuid4().hex}"
    merged_feed(spark, sf_dir).write.parquet(f"{folder}/merged")
    merged = spark.read.parquet(f"{folder}/merged")
    rate = F.struct(F.lit(RATE).alias("usd_twd"), F.lit("2026-08-12").alias("as_of"), F.lit("feed").alias("source"), F.lit(False).alias("stale")).cast(FX)
    report = run_report(spark.createDataFrame(OUTCOMES, RUN_STATUS), merged)
    at = F.to_timestamp(F.lit("2026-08-13 00:00:00"))
    head = envelope_head(report, rate, F.array(F.lit("one warning")), at, F.lit(merged.count()))
    write_json(merged, head, f"{folder}/deals")

    back = with_match_key(read_previous(spark, f"{folder}/deals"))
    published = read_previous_rate(spark, f"{folder}/deals").select(plain_number(F.col("usd_twd")).alias("usd_twd"), F.col("as_of").cast("string"))
    return _merged(back).withColumns({c: published.select(c).scalar() for c in ("usd_twd", "as_of")})


def _numeric_sort_sql(direction: str) -> str:
    return f"""
SELECT o_orderkey, row_number() OVER (ORDER BY v {direction} NULLS LAST, o_orderkey) AS position
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS v FROM orders)"""


def _numeric_sort(spark, sf_dir, ascending: bool) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("v")
    )
    return with_position(rows, [numeric_key(F.col("v"), ascending), F.col("o_orderkey")]).select("o_orderkey", "position")


@query("column_sort_ascending", _numeric_sort_sql("ASC"))
def column_sort_ascending(spark, sf_dir):
    return _numeric_sort(spark, sf_dir, True)


@query("column_sort_descending", _numeric_sort_sql("DESC"))
def column_sort_descending(spark, sf_dir):
    return _numeric_sort(spark, sf_dir, False)


def _text_sort_sql(letters: str, case: str) -> str:
    return f"""
SELECT p_partkey, row_number() OVER (ORDER BY lower(t) {letters}, t {case}, p_partkey) AS position
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN '' ELSE p_name END AS t FROM part)"""


def _text_sort(spark, sf_dir, ascending: bool) -> DataFrame:
    """Names of which some are in capitals, which come after their small letters, and some are missing."""
    name = F.when(F.col("p_partkey") % 5 == 0, F.upper("p_name")).when(F.col("p_partkey") % 5 != 1, F.col("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("t"))
    return with_position(rows, [text_key(F.col("t"), ascending), F.col("p_partkey")]).select("p_partkey", "position")


@query("column_sort_text_ascending", _text_sort_sql("ASC", "DESC"))
def column_sort_text_ascending(spark, sf_dir):
    return _text_sort(spark, sf_dir, True)


@query("column_sort_text_descending", _text_sort_sql("DESC", "ASC"))
def column_sort_text_descending(spark, sf_dir):
    return _text_sort(spark, sf_dir, False)


def _source_ships(spark, sf_dir) -> DataFrame:
    return quote_feed(spark, sf_dir).select(
        "source", F.lower("ship_name").alias("ship"), "sail_date", "price", "currency", "row_ord"
    )


_WITHIN_SQL = f"""WITH {FEED_SQL}
SELECT source, k_ship AS ship, CAST(sail_date AS VARCHAR) AS sail_date,
       rtrim(rtrim(CAST(price AS VARCHAR), '0'), '.') AS price, first_order, first_line
FROM (
  SELECT *, row_number() OVER (PARTITION BY source, k_ship, sail_date ORDER BY {{order}}) AS place,
         min(row_ord) OVER (PARTITION BY source, k_ship, sail_date) AS first_ord,
         first_ord[1] AS first_order, first_ord[2] AS first_line
  FROM feed
) WHERE place = 1"""


def _within(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source",
        "ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        plain_number(F.col("price")).alias("price"),
        F.col("row_ord")[0].alias("first_order"),
        F.col("row_ord")[1].alias("first_line"),
    )


@query("keep_cheapest", _WITHIN_SQL.format(order="price IS NULL, price, row_ord"))
def within_source_cheapest(spark, sf_dir):
    return _within(keep_cheapest(_source_ships(spark, sf_dir), ["source", "ship", "sail_date"]))


@query("keep_last", _WITHIN_SQL.format(order="row_ord DESC"))
def within_source_last(spark, sf_dir):
    return _within(keep_last(_source_ships(spark, sf_dir), ["source", "ship", "sail_date"]))


WITHOUT_RATE_SQL = FEED_SQL.replace("WHEN 'USD' THEN round_even(price * CAST(31.966724 AS DECIMAL(18,6)), 0)", "")
STALE_SINCE_SQL = "CASE WHEN row_ord[1] % 2 = 1 THEN DATE '1990-02-03' ELSE scraped_day END AS stale_since"

# The run of the feed: two sources succeed, two fail, src2 is not attempted.
OUTCOMES = [
    (0, "src0", True, None, 1.234),
    (1, "src1", False, "timeout", 30.005),
    (2, "src3", True, None, 0.5),
    (3, "src4", False, "blocked", 12.0),
]


def _run_inputs(spark, sf_dir, dealt=False):
    feed = quote_feed(spark, sf_dir, dealt).drop("src_ord")
    current = feed.where("line_status = 'O'").drop("line_status")
    previous = feed.where("line_status = 'F'").drop("line_status")
    return current, previous, spark.createDataFrame(OUTCOMES, RUN_STATUS)


_RUN_SQL = """
outcome AS (SELECT * FROM (VALUES ('src0', 0, true), ('src1', 1, false), ('src3', 2, true), ('src4', 3, false)) t(source, run_ord, ok)),
previous AS (SELECT *, min(row_ord) OVER (PARTITION BY source) AS first_row FROM ranked WHERE line_status = 'F'),
after_run AS (
  SELECT r.*, NULL::DATE AS stale_since, list_prepend(CAST(o.run_ord AS BIGINT), row_ord) AS ord
  FROM ranked r JOIN outcome o USING (source) WHERE o.ok AND line_status = 'O'
  UNION ALL BY NAME
  SELECT p.* EXCLUDE (first_row), scraped_day AS stale_since, list_prepend(CAST(o.run_ord AS BIGINT), row_ord) AS ord
  FROM previous p JOIN outcome o USING (source) WHERE NOT o.ok
  UNION ALL BY NAME
  SELECT p.* EXCLUDE (first_row), scraped_day AS stale_since,
         list_prepend(CAST(2147483648 AS BIGINT), list_concat(first_row, row_ord)) AS ord
  FROM previous p WHERE source NOT IN (SELECT source FROM outcome)
)
"""


@query(
    "incremental_merge",
    f"WITH {FEED_SQL}, {_RUN_SQL}, {merged_sql('after_run')}"
    + """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, source, CAST(stale_since AS VARCHAR) AS stale_since,
       CAST(price_twd AS VARCHAR) AS price_twd, others FROM best""",
)
def incremental_merge(spark, sf_dir):
    current, previous, status = _run_inputs(spark, sf_dir, dealt=True)
    return _merged(merge_run(current, previous, status, F.lit(RATE)))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        "source",
        F.col("stale_since").cast("string").alias("stale_since"),
        F.col("price_twd").cast("string").alias("price_twd"),
        others_text().alias("others"),
    )


_MERGED_SQL = """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, source, CAST(stale_since AS VARCHAR) AS stale_since,
       CAST(price_twd AS VARCHAR) AS price_twd, {others} AS others FROM best"""

#: What an old row carries: one rival, whose TWD value is out of date.
_CARRIED_SQL = """CASE WHEN others = '' AND stale_since IS NOT NULL THEN
         'old:' || row_ord[1] || ':' || currency || ':' || coalesce(CAST(CAST(CASE currency WHEN 'TWD' THEN row_ord[1]
           WHEN 'USD' THEN round_even(row_ord[1] * CAST(31.966724 AS DECIMAL(18,6)), 0) END AS DECIMAL(38,0)) AS VARCHAR), '-')
       ELSE others END"""


@query("merge_carried_maps", f"WITH {FEED_SQL}, {_RUN_SQL}, {merged_sql('after_run')}" + _MERGED_SQL.format(others=_CARRIED_SQL))
def merge_carried_maps(spark, sf_dir):
    """Old rows carry a rival each: kept at today's rate without a loser, replaced with one."""
    current, previous, status = _run_inputs(spark, sf_dir, dealt=True)
    entry = F.struct(F.col("row_ord")[0].cast("string").alias("price"), "currency", F.lit("1").alias("price_twd"))
    previous = previous.withColumn("other_sources", F.create_map(F.lit("old"), entry))
    return _merged(merge_run(current, previous, status, F.lit(RATE)))


@query(
    "merge_without_rate",
    f"WITH {WITHOUT_RATE_SQL}, {_RUN_SQL}, {merged_sql('after_run')}" + _MERGED_SQL.format(others="others"),
)
def merge_without_rate(spark, sf_dir):
    """No rate at all: raw numbers are compared, and USD quotes have no TWD value."""
    return _merged(merge_run(*_run_inputs(spark, sf_dir, dealt=True), F.lit(None).cast("string")))


@query(
    "merge_already_stale",
    f"WITH {FEED_SQL}, {_RUN_SQL.replace('scraped_day AS stale_since', STALE_SINCE_SQL)}, {merged_sql('after_run')}"
    + _MERGED_SQL.format(others="others"),
)
def merge_already_stale(spark, sf_dir):
    """Half of the old rows were stale before, and keep their date."""
    current, previous, status = _run_inputs(spark, sf_dir, dealt=True)
    before = F.when(F.col("row_ord")[0] % 2 == 1, F.lit("1990-02-03").cast("date"))
    return _merged(merge_run(current, previous.withColumn("stale_since", before), status, F.lit(RATE)))


@query(
    "rows_after_run",
    f"WITH {FEED_SQL}, {_RUN_SQL}"
    + """
SELECT source, stale_since IS NOT NULL AS is_stale, count(*) AS n, count(price) AS n_priced,
       CAST(min(stale_since) AS VARCHAR) AS oldest, CAST(max(stale_since) AS VARCHAR) AS newest
FROM after_run GROUP BY ALL""",
)
def retained_and_replaced(spark, sf_dir):
    rows = rows_after_run(*_run_inputs(spark, sf_dir))
    return rows.groupBy("source", F.col("stale_since").isNotNull().alias("is_stale")).agg(
        F.count("*").alias("n"),
        F.count("price").alias("n_priced"),
        F.min("stale_since").cast("string").alias("oldest"),
        F.max("stale_since").cast("string").alias("newest"),
    )


_OUTCOME_ROWS = """outcome AS (SELECT * FROM (VALUES (0, 'src0', true, NULL, 1.23), (1, 'src1', false, 'timeout', 30.01),
  (2, 'src3', true, NULL, 0.5), (3, 'src4', false, 'blocked', 12.0)) t(src_ord, source, ok, error, duration_s))"""


@query(
    "run_report",
    f"WITH {FEED_SQL}, {_OUTCOME_ROWS}"
    + """
SELECT source, ok, CASE WHEN ok THEN coalesce(n, 0) ELSE 0 END AS "count",
       CAST(duration_s AS DOUBLE) AS duration_s, error
FROM outcome LEFT JOIN (SELECT source, count(*) AS n FROM feed WHERE line_status = 'O' GROUP BY source) USING (source)""",
)
def report_of_run(spark, sf_dir):
    current, _, status = _run_inputs(spark, sf_dir)
    return run_report(status, current).drop("src_ord")


@query(
    "run_totals",
    f"WITH {FEED_SQL}"
    + """
SELECT CAST(count(*) AS BIGINT) AS sources, bool_or(ok) AS any_ok, NOT bool_or(ok) AS all_failed
FROM (SELECT source, count(price) > 0 AS ok FROM feed GROUP BY source)""",
)
def totals_of_run(spark, sf_dir):
    per_source = quote_feed(spark, sf_dir).groupBy("source").agg((F.count("price") > 0).alias("ok"))
    return run_totals(per_source)


@query(
    "source_selection",
    f"WITH {FEED_SQL} SELECT source, count(*) AS n FROM feed WHERE source IN ('src1', 'src4') GROUP BY source",
)
def source_selection(spark, sf_dir):
    wanted = select_sources(" src1 , src4 ", ("src0", "src1", "src2", "src3", "src4"))
    return quote_feed(spark, sf_dir).where(F.col("source").isin(wanted)).groupBy("source").agg(F.count("*").alias("n"))


@query(
    "price_history",
    """
WITH snap AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, min(CAST(o_totalprice AS DECIMAL(18,2))) AS price
  FROM orders GROUP BY ALL
),
cal AS (SELECT d, lag(d) OVER (ORDER BY d) AS pd, lead(d) OVER (ORDER BY d) AS nd FROM (SELECT DISTINCT d FROM snap)),
seen AS (
  SELECT *, lag(d) OVER w AS sd, lag(price) OVER w AS pp, lead(d) OVER w AS fd
  FROM snap JOIN cal USING (d) WINDOW w AS (PARTITION BY o_custkey ORDER BY d)
)
SELECT o_custkey, CAST(d AS VARCHAR) AS snapshot_date, CAST(price AS VARCHAR) AS price,
       CASE WHEN sd = pd THEN CAST(pp AS VARCHAR) END AS previous_price,
       CASE WHEN sd IS NULL OR sd <> pd THEN 'new' WHEN price = pp THEN 'same'
            WHEN price > pp THEN 'up' ELSE 'down' END AS change,
       nd IS NOT NULL AND (fd IS NULL OR fd <> nd) AS dropped
FROM seen""",
)
def price_history(spark, sf_dir):
    snapshots = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("snapshot_date"))
        .agg(F.min(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"))
    )
    return price_changes(snapshots, ["o_custkey"], "price").select(
        "o_custkey",
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.col("price").cast("string").alias("price"),
        F.col("previous_price").cast("string").alias("previous_price"),
        "change",
        "dropped",
    )


@query(
    "consecutive_dedup",
    """
SELECT event_id, user_id, event_type, coalesce(prev, '') AS previous_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events
) WHERE prev IS DISTINCT FROM event_type""",
)
def consecutive_dedup(spark, sf_dir):
    """Events per user with neighbouring repeats removed, in time order."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    seen = previous_in_order(
        events, ["user_id"], ["ts", "event_id"], "event_type", F.date_trunc("hour", "ts"), "previous_type"
    )
    changed = seen.where(~F.col("previous_type").eqNullSafe(F.col("event_type")))
    return changed.select("event_id", "user_id", "event_type", F.coalesce("previous_type", F.lit("")).alias("previous_type"))
