"""URL lists with dates: every capture is judged by the entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeld.llm.common import table

#: Days of a bucket in which captures meet intervals; longest host that is looked up.
BUCKET_DAYS, LONGEST_HOST = 32, 253
#: When entries of equal date clash, the later here wins.
ACTIONS = ("remove", "allow", "block")
START = "2024-01-01"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case; null where there is none, or one no name system would take."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))
    return F.when((host != "") & (F.length(host) <= LONGEST_HOST), host)


def validity(entries: DataFrame) -> DataFrame:
    """(pattern, action, since, until) of dated entries (pattern, action, listed_on).

    An entry holds from its day until the day of the pattern's next one; `remove`
    leaves none active. The last entry never ends (null). A pattern has one
    entry a day at most, so its history is bounded by the calendar.
    """
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    clean = entries.where("pattern IS NOT NULL AND listed_on IS NOT NULL").withColumn("rank", rank).where("rank > 0")
    daily = clean.groupBy(F.lower("pattern").alias("pattern"), "listed_on").agg(F.max("rank").alias("rank"))
    until = F.lead("listed_on").over(Window.partitionBy("pattern").orderBy("listed_on"))
    spans = daily.select("pattern", F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("rank").cast("int")).alias("action"), F.col("listed_on").alias("since"), until.alias("until"))
    return spans.where("action <> 'remove'")


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS).cast("int")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row of captures (url, fetched_on) with host, verdict, pattern and since.

    A pattern is a host, a parent domain, or host/first path segment. Of the
    entries active on the day of the fetch, the longest pattern decides:
    `block` or `allow`; without one `unlisted`; `invalid` without a host or
    date. Captures of one host, segment and day are looked up once, and meet
    only intervals of their pattern and month, so neither a hot host nor a long
    history multiplies rows. Columns of these four names are replaced.
    """
    made = ("host", "verdict", "pattern", "since")
    kept = [c for c in captures.columns if c not in made]
    rows = captures.select(F.struct(*kept).alias("_row"), host_of(F.col("url")).alias("host"), F.regexp_extract(F.coalesce("url", F.lit("")), SEGMENT, 1).alias("_segment"), F.col("fetched_on").alias("_day"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    sought = F.concat(suffixes, F.when(F.col("_segment") != "", F.array(F.concat("host", F.lit("/"), F.lower("_segment")))).otherwise(F.array().cast("array<string>")))
    key = ["host", "_segment", "_day"]
    asked = rows.where("host IS NOT NULL AND _day IS NOT NULL").select(*key).distinct().withColumn("pattern", F.explode(sought)).withColumn("bucket", _bucket(F.col("_day")))
    latest = F.lit(captures.agg(F.max("fetched_on")).first()[0]).cast("date")
    last = F.least(F.date_sub("until", 1), latest)  # an open end gives the last fetch
    active = validity(entries).where(F.col("since") <= latest).withColumn("bucket", F.explode(F.sequence(_bucket(F.col("since")), _bucket(last))))
    hits = asked.join(active, ["pattern", "bucket"]).where("since <= _day AND (until IS NULL OR _day < until)")
    best = hits.groupBy(*key).agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "since")).alias("best"))
    joined = rows.join(best, key, "left")
    verdict = F.when(F.col("host").isNull() | F.col("_day").isNull(), "invalid").otherwise(F.coalesce("best.action", F.lit("unlisted")))
    return joined.select("_row.*", "host", verdict.alias("verdict"), F.col("best.pattern").alias("pattern"), F.col("best.since").alias("since"))


def captured_pages(pages: DataFrame) -> DataFrame:
    """The pages, each fetched on a day of a year told by its id."""
    return pages.select("page_id", "url", F.expr(f"date_add(DATE'{START}', CAST(page_id % 366 AS int))").alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list over the pages' own hosts, their domains and first segments: dates and actions follow a hash of the pattern."""
    host = host_of(F.col("url"))
    segment = F.regexp_extract(F.coalesce("url", F.lit("")), SEGMENT, 1)
    names = pages.select(host.alias("host"), segment.alias("segment")).distinct().where("host IS NOT NULL")
    parts = F.array("host", F.substring_index("host", ".", -2), F.concat("host", F.lit("/"), F.lower("segment")))
    patterns = names.select(F.explode(parts).alias("pattern")).distinct()
    number = F.conv(F.substring(F.md5("pattern"), 1, 7), 16, 10).cast("int")
    events = F.expr("""filter(array(
      struct(CASE WHEN n % 3 = 0 THEN 'block' WHEN n % 3 = 1 THEN 'allow' ELSE 'remove' END AS action, n % 200 AS day),
      struct('remove' AS action, n % 200 + 50 AS day),
      struct(CASE WHEN n % 2 = 0 THEN 'block' ELSE 'allow' END AS action, n % 200 + 90 AS day)), e -> n % 5 < 4)""")
    made = patterns.withColumn("n", number).select("pattern", F.explode(events).alias("e"))
    return made.select("pattern", "e.action", F.expr(f"date_add(DATE'{START}', e.day)").alias("listed_on"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(captured_pages(pages), dated_entries(pages)).select("page_id", "host", "fetched_on", "verdict", "pattern", "since")


def oracle() -> str:
    """The same rows in DuckDB."""
    return f"""
    WITH captures AS (SELECT row_number() OVER () AS row_no, page_id, coalesce(url, '') AS url, DATE '{START}' + CAST(page_id % 366 AS INT) AS fetched_on FROM pages),
    hosts AS (SELECT *, CASE WHEN h <> '' AND length(h) <= {LONGEST_HOST} THEN h END AS host, regexp_extract(url, '{SEGMENT}', 1) AS segment
      FROM (SELECT *, lower(regexp_extract(url, '{HOST}', 1)) AS h FROM captures)),
    names AS (SELECT DISTINCT host, segment FROM hosts WHERE host IS NOT NULL),
    patterns AS (SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 7) AS INT) AS n FROM
      (SELECT unnest([host, array_to_string(string_split(host, '.')[-2:], '.'), host || '/' || lower(segment)]) AS pattern FROM names)),
    events AS (
      SELECT pattern, CASE n % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'allow' ELSE 'remove' END AS action, n % 200 AS day, n FROM patterns
      UNION ALL SELECT pattern, 'remove', n % 200 + 50, n FROM patterns
      UNION ALL SELECT pattern, CASE WHEN n % 2 = 0 THEN 'block' ELSE 'allow' END, n % 200 + 90, n FROM patterns),
    spans AS (SELECT pattern, action, DATE '{START}' + CAST(day AS INT) AS since, DATE '{START}' + CAST(lead(day) OVER (PARTITION BY pattern ORDER BY day) AS INT) AS until FROM events WHERE n % 5 < 4),
    hits AS (SELECT row_no, pattern, action, since, row_number() OVER (PARTITION BY row_no ORDER BY length(pattern) DESC, pattern DESC) AS rank
      FROM hosts JOIN spans ON (pattern = host OR ends_with(host, '.' || pattern) OR (segment <> '' AND pattern = host || '/' || lower(segment)))
      WHERE action <> 'remove' AND since <= fetched_on AND (until IS NULL OR fetched_on < until))
    SELECT page_id, host, fetched_on, CASE WHEN host IS NULL OR fetched_on IS NULL THEN 'invalid' ELSE coalesce(action, 'unlisted') END AS verdict, pattern, since
    FROM hosts LEFT JOIN (SELECT * FROM hits WHERE rank = 1) USING (row_no)"""
