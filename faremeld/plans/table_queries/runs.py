"""Runs over the quote feed: streamed, stored by day, and with sources that fail."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from faremeld.functions.money import plain_number
from faremeld.functions.names import with_match_key
from faremeld.operators.history import price_changes
from faremeld.operators.merge import as_published
from faremeld.operators.quality import run_report
from faremeld.plans import store
from faremeld.plans.daily_run import run_sources
from faremeld.plans.table_queries.feeds import FEED_SQL, RATE, merged_sql, others_text, quote_feed, table
from faremeld.plans.table_queries.merging import ALL_AS_ONE_RUN, merged_feed
from faremeld.plans.table_queries.registry import query
from faremeld.schemas import FX, RUN_STATUS
from faremeld.session import ensure_checkpoint_dir
from faremeld.sources import itinerary_api
from faremeld.sources.registry import Source
from faremeld.streaming.daily_stream import land_run, merge_stream


def _folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _rate(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT CAST({RATE} AS decimal(18,8)) AS usd_twd, DATE'2026-08-12' AS as_of, 'feed' AS source, false AS stale").select(*FX.fieldNames())


def _status(spark: SparkSession, outcomes: dict[str, bool]) -> DataFrame:
    return spark.createDataFrame([(i, s, ok, None if ok else "down", 1.5) for i, (s, ok) in enumerate(outcomes.items())], RUN_STATUS)


# ---- the stream

#: Runs as they land: all sources well, all failed without a quote, some well; then the second one again.
RUNS = [dict.fromkeys(("src0", "src1", "src2", "src3", "src4"), True), dict.fromkeys(("src0", "src1", "src2", "src3", "src4"), False), {"src0": True, "src1": False, "src3": True, "src4": False}]


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Lands the runs and streams them: the first alone, then the two others, then the second again. Gives the store's folder."""
    where = _folder(spark, "stream")
    landing, out, checkpoint = f"{where}/landing", f"{where}/published", f"{where}/checkpoint"
    feed = quote_feed(spark, sf_dir).drop("src_ord")
    day = [F.lit(f"2026-08-{13 + i}").cast("date") for i in range(3)]

    def stream() -> None:
        merge_stream(spark, landing, out, checkpoint, _rate(spark)).awaitTermination()

    land_run(landing, 0, day[0], _status(spark, RUNS[0]), feed.where("line_status = 'F'").drop("line_status"))
    stream()
    land_run(landing, 1, day[1], _status(spark, RUNS[1]))
    land_run(landing, 2, day[2], _status(spark, RUNS[2]), feed.where("line_status = 'O' AND source IN ('src0', 'src3')").drop("line_status"))
    stream()
    land_run(landing, 1, day[1], _status(spark, RUNS[1]))
    stream()
    return out


_STREAM_SQL = f"""WITH {FEED_SQL},
first_run AS (SELECT *, list_prepend(src_ord, row_ord) AS ord FROM ranked WHERE line_status = 'F'),
{merged_sql("first_run")},
outcome AS (SELECT * FROM (VALUES ('src0', 0, true), ('src1', 1, false), ('src3', 2, true), ('src4', 3, false)) t(source, run_ord, ok)),
third_run AS (
  SELECT r.k_ship, r.sail_date, r.nights, r.k_port, r.source, r.price, r.currency, r.price_twd, r.amount, NULL::DATE AS stale_since, '' AS carried,
         list_prepend(CAST(o.run_ord AS BIGINT), row_ord) AS ord
  FROM ranked r JOIN outcome o USING (source) WHERE o.ok AND line_status = 'O'
  UNION ALL BY NAME
  SELECT b.k_ship, b.sail_date, b.nights, b.k_port, b.source, b.price, b.currency, b.price_twd, b.amount, b.scraped_day AS stale_since, b.others AS carried,
         [coalesce(CAST(o.run_ord AS BIGINT), 2147483648), 0] AS ord
  FROM best b LEFT JOIN outcome o USING (source) WHERE NOT coalesce(o.ok, false)
),
third AS (
{merged_sql("third_run").replace("marked", "marked3").replace("rivals", "rivals3").replace("rival ", "rival3 ").replace("best AS", "best3 AS").strip().join(["WITH ", " SELECT * FROM best3"])}
)
"""


@query(
    "stream_run",
    _STREAM_SQL
    + """
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, source, CAST(stale_since AS VARCHAR) AS stale_since,
       CAST(price_twd AS VARCHAR) AS price_twd, CASE WHEN others = '' THEN carried ELSE others END AS others FROM third""",
)
def stream_run(spark, sf_dir):
    """What three streamed runs, one of them without a quote and one landed twice, have published in the end."""
    out = _streamed(spark, sf_dir)
    newest = with_match_key(store.quotes_of(spark, out, store.newest_before(store.commits(spark, out))))
    return newest.select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        "source",
        F.col("stale_since").cast("string").alias("stale_since"),
        F.col("price_twd").cast("string").alias("price_twd"),
        others_text().alias("others"),
    )


@query(
    "stream_run_log",
    _STREAM_SQL
    + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(n AS BIGINT) AS "rows", CAST(stale AS BIGINT) AS stale, CAST(sources AS BIGINT) AS sources, all_failed, '31.966724' AS usd_twd FROM (
  SELECT 0 AS run_id, count(*) AS n, 0 AS stale, 5 AS sources, false AS all_failed FROM best
  UNION ALL SELECT 1, count(*), count(*), 5, true FROM best
  UNION ALL SELECT 2, count(*), count(stale_since), 4, false FROM third)""",
)
def stream_run_log(spark, sf_dir):
    """One row for each published run, from the commits and the rows they stand for."""
    out = _streamed(spark, sf_dir)
    committed = store.commits(spark, out)
    stale = store.quotes_of(spark, out, committed, "run_id").groupBy("run_id").agg(F.count("stale_since").alias("stale"))
    return committed.join(stale, "run_id").select(
        "run_id",
        "rows",
        "stale",
        F.size("report").cast("bigint").alias("sources"),
        (~F.exists("report", lambda r: r["ok"])).alias("all_failed"),
        plain_number(F.col("fx.usd_twd")).alias("usd_twd"),
    )


# ---- snapshots by day


@query(
    "snapshot_series",
    f"""WITH {FEED_SQL}, {ALL_AS_ONE_RUN}, {merged_sql("placed")}
SELECT snapshot_date, source, count(*) AS n, count(price) AS n_priced, CAST(sum(price_twd) AS VARCHAR) AS total_twd, CAST(any_value(sources) AS BIGINT) AS sources, any_value(warning) AS warning
FROM (
  SELECT *, '2026-08-13' AS snapshot_date, 5 AS sources, 'second try' AS warning FROM best WHERE nights = 3
  UNION ALL SELECT *, '2026-08-15', 5, 'only try' FROM best WHERE nights = 4
  UNION ALL SELECT *, '2026-08-16', 5, 'last day' FROM best WHERE k_port = 'keelung')
GROUP BY snapshot_date, source""",
)
def snapshot_series(spark, sf_dir):
    """Three days' snapshots with their envelopes: one day is run twice, one write breaks off before its commit, one day is missing."""
    path = _folder(spark, "snapshots")
    as_published(merged_feed(spark, sf_dir)).write.parquet(f"{path}/merged")
    merged = spark.read.parquet(f"{path}/merged")
    report = run_report(_status(spark, RUNS[0]), merged)

    def publish(run_id: int, day: str, quotes: DataFrame, warning: str) -> None:
        told = spark.createDataFrame([(warning,)], "warning string")
        store.publish(quotes, path, run_id, F.lit(day).cast("date"), report, told, _rate(spark))

    publish(0, "2026-08-13", merged.where("nights = 4"), "first try")
    publish(1, "2026-08-13", merged.where("nights = 3"), "second try")
    publish(2, "2026-08-15", merged.where("nights = 4"), "only try")
    store.write_aside(merged, path)  # a run that ended before its commit
    publish(4, "2026-08-16", with_match_key(merged).where("k_port = 'keelung'"), "last day")

    envelopes = store.of_days(store.commits(spark, path)).select(F.col("day").alias("snapshot_date"), F.size("report").alias("sources"), F.col("warnings")[0].alias("warning"))
    rows = store.snapshots(spark, path).groupBy("snapshot_date", "source").agg(F.count("*").alias("n"), F.count("price").alias("n_priced"), F.sum("price_twd").cast("string").alias("total_twd"))
    return rows.join(envelopes, "snapshot_date").select(F.col("snapshot_date").cast("string").alias("snapshot_date"), "source", "n", "n_priced", "total_twd", F.col("sources").cast("bigint").alias("sources"), "warning")


@query(
    "snapshot_changes",
    f"""WITH {FEED_SQL}, {ALL_AS_ONE_RUN}, {merged_sql("placed")},
snap AS (
  SELECT k_ship, sail_date, nights, k_port, price_twd, DATE '2026-08-13' AS d FROM best WHERE nights = 3
  UNION ALL SELECT k_ship, sail_date, nights, k_port, price_twd, DATE '2026-08-15' FROM best
  UNION ALL SELECT k_ship, sail_date, nights, k_port, price_twd + CASE WHEN nights = 4 THEN 1 ELSE 0 END, DATE '2026-08-16' FROM best WHERE k_port = 'keelung'),
cal AS (SELECT * FROM (VALUES (DATE '2026-08-13', NULL, DATE '2026-08-15'), (DATE '2026-08-15', DATE '2026-08-13', DATE '2026-08-16'), (DATE '2026-08-16', DATE '2026-08-15', NULL)) t(d, pd, nd)),
seen AS (SELECT *, lag(d) OVER w AS sd, lag(price_twd) OVER w AS pp, lead(d) OVER w AS fd FROM snap JOIN cal USING (d) WINDOW w AS (PARTITION BY k_ship, sail_date, nights, k_port ORDER BY d))
SELECT k_ship, CAST(sail_date AS VARCHAR) AS sail_date, CAST(nights AS BIGINT) AS nights, k_port, CAST(d AS VARCHAR) AS snapshot_date, CASE WHEN sd = pd THEN CAST(pp AS VARCHAR) END AS previous_price,
  CASE WHEN sd IS NULL OR sd <> pd THEN 'new' WHEN price_twd IS NOT DISTINCT FROM pp THEN 'same' WHEN price_twd IS NULL OR pp IS NULL THEN 'requoted' WHEN price_twd > pp THEN 'up' ELSE 'down' END AS change,
  nd IS NOT NULL AND (fd IS NULL OR fd <> nd) AS dropped
FROM seen""",
)
def snapshot_changes(spark, sf_dir):
    """What happened to each sailing between stored snapshots; the days come from the store's commits."""
    path = _folder(spark, "changes")
    as_published(merged_feed(spark, sf_dir)).write.parquet(f"{path}/merged")
    merged = spark.read.parquet(f"{path}/merged")
    report, told = run_report(_status(spark, RUNS[0]), merged), spark.createDataFrame([], "warning string")
    dearer = with_match_key(merged).where("k_port = 'keelung'").withColumn("price_twd", F.expr("CAST(price_twd + IF(nights = 4, 1, 0) AS decimal(20,0))"))
    for run_id, (day, quotes) in enumerate((("2026-08-13", merged.where("nights = 3")), ("2026-08-15", merged), ("2026-08-16", dearer))):
        store.publish(quotes, path, run_id, F.lit(day).cast("date"), report, told, _rate(spark))
    changes = price_changes(with_match_key(store.snapshots(spark, path)), calendar=store.calendar(spark, path))
    return changes.select(
        "k_ship",
        F.col("sail_date").cast("string").alias("sail_date"),
        F.col("nights").cast("bigint").alias("nights"),
        "k_port",
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.col("previous_price").cast("string").alias("previous_price"),
        "change",
        "dropped",
    )


# ---- sources that fail


def _endless(rows: DataFrame) -> DataFrame:
    """The rows, each held up for ten minutes, so that the source must be cancelled."""

    def wait(batches):
        for batch in batches:
            time.sleep(600)
            yield batch

    return rows.mapInPandas(wait, rows.schema)


@query(
    "failure_isolation",
    """
SELECT s.source, s.ok, CASE WHEN s.ok THEN (SELECT count(*) FROM lineitem) ELSE 0 END AS n, s.error
FROM (VALUES ('good', true, NULL), ('blocked', false, 'Cloudflare'), ('raising', false, 'fails'), ('hanging', false, 'gave no answer within 4 s'), ('late', true, NULL)) s(source, ok, error)""",
)
def failure_isolation(spark, sf_dir):
    """Five sources read at once: two good ones, one that reports a fault, one whose rows raise, one that hangs."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    fine = lambda rows, start, end: spark.createDataFrame([], "error string")
    fault = lambda rows, start, end: spark.createDataFrame([("Cloudflare",)], "error string")
    given = lambda rows, start, end: rows
    fails = lambda rows, start, end: rows.where(F.raise_error(F.lit("fails")).isNull())
    sources = [Source("hanging", lambda rows, start, end: _endless(rows), fine, 4.0), Source("good", given, fine), Source("blocked", given, fault), Source("raising", fails, fine), Source("late", given, fine)]
    where = _folder(spark, "isolation")
    outcomes = run_sources(spark, sources, {s.name: (lines,) for s in sources}, None, None, {s.name: f"{where}/{s.name}" for s in sources})
    rows = None
    for outcome in outcomes:
        error = outcome["error"] and ("fails" if "fails" in outcome["error"] else outcome["error"])
        named = F.lit(outcome["source"]).alias("source"), F.lit(outcome["ok"]).alias("ok"), F.lit(error).cast("string").alias("error")
        read = outcome["rows"].agg(F.count("*").alias("n")) if outcome["ok"] else spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        read = read.select("n", *named)
        rows = read if rows is None else rows.unionByName(read)
    return rows


# ---- master data


def _master(spark, sf_dir, ports: bool = True) -> DataFrame:
    """Master data in one payload per nation: its suppliers as ships, itself as a line, its region as a port that many name."""
    nation = table(spark, sf_dir, "nation")
    ship = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("parentId"))
    ships = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list(ship).alias("ship"))
    line = F.array(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    port = F.array(F.struct(F.col("n_regionkey").cast("string").alias("code"), F.col("n_name").alias("name")))
    data = F.struct("ship", line.alias("cruiseline"), (port if ports else F.array()).alias("port"))
    return nation.join(ships, "n_nationkey", "left").select(F.to_json(F.struct(data.alias("data"))).alias("payload"), F.col("n_nationkey").alias("part"))


@query(
    "master_dims",
    """
SELECT 'ship' AS dimension, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS parent_id FROM supplier
UNION ALL SELECT 'line', CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation
UNION ALL SELECT 'port', CAST(n_regionkey AS VARCHAR), arg_max(n_name, n_nationkey), NULL FROM nation GROUP BY n_regionkey""",
)
def master_dims(spark, sf_dir):
    return itinerary_api.master_dims(_master(spark, sf_dir))


@query(
    "master_without_ports",
    """
SELECT 'ports' AS kind, CAST(NULL AS VARCHAR) AS error, count(*) AS items FROM supplier
UNION ALL SELECT 'no ports', CASE WHEN count(*) > 0 THEN 'ParseError: master data without ports' END, count(*) FROM supplier
UNION ALL SELECT 'no items', NULL, 0""",
)
def master_without_ports(spark, sf_dir):
    """Items without a port to look up fail their source; without items there is nothing to fail."""
    item = F.struct(F.struct(F.struct(F.col("s_nationkey").cast("string").alias("code")).alias("departure")).alias("itinerary"))
    items = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item_no"), F.to_json(item).alias("payload"))
    rows = None
    for kind, work, ports in (("ports", items, True), ("no ports", items, False), ("no items", items.where("item_no IS NULL"), False)):
        found = itinerary_api.health(work, _master(spark, sf_dir, ports)).agg(F.min("error").alias("error"))
        named = work.agg(F.count("*").alias("items")).select(F.lit(kind).alias("kind"), found.scalar().alias("error"), "items")
        rows = named if rows is None else rows.unionByName(named)
    return rows
