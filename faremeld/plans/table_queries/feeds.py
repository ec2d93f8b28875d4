"""The tables as a quote feed.

Sources are supplier groups, ships are part names, weeks are sail dates, and
two of the three ports belong to one port group. Every other ship name is in
capitals, so the match key has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faremeld.schemas import PRICE, as_quotes

RATE = "31.966724"

#: What a quote is made of.
FEED_COLUMNS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_discount l_returnflag l_linestatus l_shipdate p_name p_brand p_type p_size"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table ahead of much work per row; `spark.sql.files.maxPartitionBytes` splits its scan."""
    return table(spark, sf_dir, name)


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores, ahead of much work per row: the scan of a small file is one task.

    By a hash of all columns; dealt in turn, each scan would sort its rows first.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *rows.columns)


#: Lines a task takes when a feed is dealt ahead of a merge, and the part of all tasks that shares one sailing.
LINES_PER_TASK = 250_000
SAILING_SPREAD = 8


def by_sailing(rows: DataFrame, n_rows: int) -> DataFrame:
    """Lines with their parts, dealt in about equal numbers to tasks that grow with the table.

    A merge sorts the quotes of a task by sailing, wide as they are, and a split
    of the file may hold millions. Rows of one sailing stay in an eighth of the
    tasks: few enough to be reduced ahead of the merge's shuffle, and so many
    that a hot one fills none. The share is a hash of all columns: those who read
    fewer of them read the same shuffle again.
    """
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // LINES_PER_TASK))
    share = F.pmod(F.hash(*rows.columns), F.lit(max(1, tasks // SAILING_SPREAD)))
    return rows.repartition(tasks, "p_name", F.date_trunc("week", "l_shipdate"), share)


def quote_feed(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Quotes with `src_ord`, `row_ord` and the line status they came with; `dealt` ahead of a merge."""
    lineitem, part = raw_table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    group = F.col("l_suppkey") % 5
    port = F.when(F.col("l_returnflag") == "R", "Keelung").when(F.col("l_returnflag") == "A", "Tokyo").otherwise("Yokohama")
    ship = F.when(F.col("l_linenumber") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    price = F.when(F.col("l_discount") != 0, F.col("l_extendedprice").cast(PRICE))
    currency = F.when(group.isin(3, 4), "TWD").when(group == 2, "JPY").otherwise("USD")
    lines = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if dealt:
        lines = by_sailing(lines.select(*FEED_COLUMNS), lineitem.count())
    rows = lines.select(
        F.concat(F.lit("src"), group).alias("source"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("sail_date"),
        port.alias("depart_port"),
        ship.alias("ship_name"),
        F.col("p_brand").alias("cruise_line"),
        (F.col("p_size") % 2 + 3).alias("nights"),
        price.alias("price"),
        currency.alias("currency"),
        F.col("p_type").alias("arrive_port"),
        F.array(F.lower("p_type"), F.lower("p_brand")).alias("ports_of_call"),
        F.to_timestamp("l_shipdate").alias("scraped_at"),
        F.col("l_linestatus").alias("line_status"),
        group.cast("bigint").alias("src_ord"),
        F.array("l_orderkey", F.col("l_linenumber").cast("bigint"), "l_partkey", "l_suppkey").alias("row_ord"),
    )
    return as_quotes(rows, "line_status", "src_ord", "row_ord")


FEED_SQL = """
feed AS (
  SELECT 'src' || (l_suppkey % 5) AS source, l_suppkey % 5 AS src_ord,
         [l_orderkey, CAST(l_linenumber AS BIGINT), l_partkey, l_suppkey] AS row_ord,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS sail_date,
         CASE l_returnflag WHEN 'R' THEN 'Keelung' WHEN 'A' THEN 'Tokyo' ELSE 'Yokohama' END AS depart_port,
         CASE l_returnflag WHEN 'R' THEN 'keelung' ELSE 'tokyo/yokohama' END AS k_port,
         CASE WHEN l_linenumber % 2 = 0 THEN upper(p_name) ELSE p_name END AS ship_name,
         p_name AS k_ship, p_brand AS cruise_line, p_type AS arrive_port, 3 + p_size % 2 AS nights,
         CASE WHEN l_discount <> 0 THEN CAST(l_extendedprice AS DECIMAL(38,4)) END AS price,
         CASE WHEN l_suppkey % 5 IN (3, 4) THEN 'TWD' WHEN l_suppkey % 5 = 2 THEN 'JPY' ELSE 'USD' END AS currency,
         CAST(l_shipdate AS DATE) AS scraped_day, l_linestatus AS line_status
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
priced AS (
  SELECT *, CAST(CASE currency WHEN 'TWD' THEN round_even(price, 0)
                 WHEN 'USD' THEN round_even(price * CAST(31.966724 AS DECIMAL(18,6)), 0) END AS DECIMAL(38,0)) AS price_twd
  FROM feed
),
ranked AS (
  SELECT *, coalesce(CAST(price_twd AS DECIMAL(38,4)), price) AS amount FROM priced
)
"""

# Price as plain text: no trailing zeros.
PLAIN_PRICE = "rtrim(rtrim(CAST(price AS VARCHAR), '0'), '.')"


def merged_sql(rows: str) -> str:
    """CTEs that merge `rows` (with `ord`) into `best` with its rivals as text."""
    return f"""
marked AS (
  SELECT *, row_number() OVER (PARTITION BY k_ship, sail_date, nights, k_port
                               ORDER BY amount IS NULL, amount, ord) AS place,
         min(ord) OVER (PARTITION BY k_ship, sail_date, nights, k_port) AS first_seen
  FROM {rows}
),
rival AS (
  SELECT k_ship, sail_date, nights, k_port, source,
         coalesce(arg_max(coalesce({PLAIN_PRICE}, '-'), ord), '-') AS price_text,
         arg_max(currency, ord) AS currency,
         arg_max(coalesce(CAST(price_twd AS VARCHAR), '-'), ord) AS twd_text
  FROM marked WHERE place > 1 GROUP BY ALL
),
rivals AS (
  SELECT k_ship, sail_date, nights, k_port,
         string_agg(source || ':' || price_text || ':' || currency || ':' || twd_text, ';' ORDER BY source) AS others
  FROM rival GROUP BY ALL
),
best AS (
  SELECT m.*, coalesce(r.others, '') AS others FROM marked m
  LEFT JOIN rivals r USING (k_ship, sail_date, nights, k_port) WHERE place = 1
)
"""


def others_text(column: str = "other_sources"):
    """The map as sorted text, to compare it across engines."""
    entries = F.array_sort(F.map_entries(column))
    parts = F.transform(
        entries,
        lambda e: F.concat_ws(
            ":",
            e["key"],
            F.coalesce(e["value"]["price"], F.lit("-")),
            e["value"]["currency"],
            F.coalesce(e["value"]["price_twd"], F.lit("-")),
        ),
    )
    return F.array_join(parts, ";")
