"""Raw-page operators over the pages and conversations tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremeld.functions.money import claimed_count
from faremeld.functions.text import before_query, clean_text
from faremeld.operators.quality import (
    is_blocked,
    page_state,
    parse_health,
    source_outcome,
    stream_health,
    truncated_pages,
)
from faremeld.plans.table_queries.feeds import raw_table, table
from faremeld.plans.table_queries.registry import query


NAV_LINK = '<li><a href="([^"]*)">([^<]*)</a>'


def page_links(spark, sf_dir) -> DataFrame:
    """Every navigation link of every whole page, cut out by JVM expressions."""
    found = F.regexp_extract_all("html", F.lit(NAV_LINK), F.lit(0))
    rows = raw_table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("row_no", "link"))
    return rows.select(
        "page_id",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.regexp_extract("link", NAV_LINK, 1).alias("href"),
        F.regexp_extract("link", NAV_LINK, 2).alias("label"),
    )


_LINKS_SQL = """
links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a>', 1)) AS href,
         unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS label,
         unnest(range(len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>')))) AS row_no
  FROM pages
)"""


@query(
    "html_links",
    f"WITH {_LINKS_SQL} SELECT page_id, row_no, split_part(href, '?', 1) AS href, trim(label) AS label FROM links",
)
def html_links(spark, sf_dir):
    """Navigation links of every whole page."""
    return page_links(spark, sf_dir).select(
        "page_id", "row_no", before_query(F.col("href")).alias("href"), clean_text(F.col("label")).alias("label")
    )


@query(
    "html_headings",
    r"""
SELECT page_id, trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&')) AS title,
       trim(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;', '&')) AS heading,
       trim(regexp_replace(replace(replace(replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS footer
FROM pages""",
)
def html_headings(spark, sf_dir):
    """Title, first heading and footer of every whole page, with the entities that they use."""

    def read(tag: str):
        text = F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1)
        for entity, letter in (("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(letter))
        return clean_text(text)

    return raw_table(spark, sf_dir, "pages").select("page_id", read("title").alias("title"), read("h1").alias("heading"), read("footer").alias("footer"))


def _blocked(spark, sf_dir) -> DataFrame:
    """Pages, some with a challenge title and some with a challenge marker."""
    title = F.when(F.col("page_id") % 10 == 3, "Just a Moment...").otherwise(
        F.regexp_extract("html", "<title>(.*?)</title>", 1)
    )
    html = F.when(F.col("page_id") % 10 == 7, F.concat("html", F.lit("<i class='cf-chl'>"))).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", "url", title.alias("title"), html.alias("html"))


@query(
    "blocked_pages",
    """
SELECT page_id, page_id % 10 IN (3, 7) OR contains(html, 'cf-chl') OR contains(html, 'challenges.cloudflare.com') AS blocked FROM pages""",
)
def blocked_pages(spark, sf_dir):
    return _blocked(spark, sf_dir).select("page_id", is_blocked(F.col("html"), F.col("title")).alias("blocked"))


def _claims(spark, sf_dir) -> DataFrame:
    """Pages that announce as many results as they have list entries."""
    announced = F.concat("html", F.regexp_count("html", F.lit("<li>")).cast("string"), F.lit(",000 Matched Sailings"))
    return table(spark, sf_dir, "pages").select("page_id", "url", (claimed_count(announced) / 1000).cast("int").alias("claimed"))


_CLAIMS_SQL = "claims AS (SELECT page_id, url, len(regexp_extract_all(html, '<li>')) AS claimed FROM pages)"


@query(
    "parse_health",
    f"""WITH {_LINKS_SQL}, {_CLAIMS_SQL},
read AS (SELECT page_id, count(*) AS parsed FROM links GROUP BY ALL)
SELECT page_id, claimed, coalesce(parsed, 0) AS parsed,
       CASE WHEN claimed > 0 AND coalesce(parsed, 0) = 0 THEN 'unreadable' WHEN coalesce(parsed, 0) = 0 THEN 'empty' ELSE 'ok' END AS verdict
FROM claims LEFT JOIN read USING (page_id)""",
)
def page_health(spark, sf_dir):
    """The results that pages announce, against every navigation link read from them."""
    health = parse_health(_claims(spark, sf_dir), page_links(spark, sf_dir), "page_id", "claimed")
    return health.select("page_id", F.col("claimed").cast("bigint").alias("claimed"), "parsed", "verdict")


@query("truncated_pages", f"WITH {_CLAIMS_SQL} SELECT page_id, claimed FROM claims WHERE claimed > 5")
def truncated(spark, sf_dir):
    claims = _claims(spark, sf_dir)
    return truncated_pages(claims, "claimed", 5).select("page_id", F.col("claimed").cast("bigint").alias("claimed"))


def _states(spark, sf_dir) -> DataFrame:
    pages = _blocked(spark, sf_dir)
    cards = F.regexp_count("html", F.lit("<p>"))
    parsed = F.regexp_count("html", F.lit("<p>The "))
    state = page_state(is_blocked(F.col("html"), F.col("title")), cards, parsed)
    host = F.substring_index(F.regexp_extract("url", "//([^/]*)", 1), ".", -1)
    return pages.select("page_id", host.alias("source"), state.alias("state"), F.when(state == "blocked", 0).otherwise(parsed).alias("parsed"))


_STATES_SQL = """
states AS (
  SELECT page_id, regexp_extract(url, '//[^/]*[.]([a-z]+)', 1) AS source,
    CASE WHEN page_id % 10 IN (3, 7) THEN 'blocked' WHEN len(regexp_extract_all(html, '<p>')) = 0 THEN 'no_cards'
         WHEN len(regexp_extract_all(html, '<p>The ')) = 0 THEN 'unreadable' ELSE 'ok' END AS state,
    CASE WHEN page_id % 10 IN (3, 7) THEN 0 ELSE len(regexp_extract_all(html, '<p>The ')) END AS parsed
  FROM pages
)"""


@query("page_states", f"WITH {_STATES_SQL} SELECT page_id, source, state FROM states")
def page_states(spark, sf_dir):
    return _states(spark, sf_dir).select("page_id", "source", "state")


@query(
    "source_outcome",
    f"""WITH {_STATES_SQL}
SELECT source, count(*) AS parts, count_if(state <> 'ok') AS failed_parts, CAST(sum(parsed) AS BIGINT) AS collected,
  NOT bool_or(state IN ('no_cards', 'unreadable')) AND NOT (bool_or(state = 'blocked') AND sum(parsed) = 0) AS ok
FROM states GROUP BY ALL""",
)
def outcome(spark, sf_dir):
    return source_outcome(_states(spark, sf_dir)).withColumn("collected", F.col("collected").cast("bigint"))


@query(
    "stream_complete",
    """
WITH last AS (SELECT conv_id, arg_max(role, turn) AS last_role, bool_or(role = 'system') AS has_system,
                     bool_or(role = 'user' AND text <> '') AS has_user
              FROM conversations GROUP BY ALL)
SELECT conv_id, last_role = 'assistant' AS has_end, has_user AS has_start,
       CASE WHEN last_role <> 'assistant' THEN 'incomplete' WHEN NOT has_user THEN 'no_start' ELSE 'ok' END AS verdict
FROM last""",
)
def stream_complete(spark, sf_dir):
    """A conversation is a stream; it is complete if the assistant ends it."""
    turns = table(spark, sf_dir, "conversations")
    ends = turns.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"))
    last = ends.select(
        "conv_id", F.when(F.col("last_role") == "assistant", "step3").otherwise("other").alias("step"), F.lit("{}").alias("data")
    )
    starts = turns.where("role = 'user' AND text <> ''").select("conv_id", F.lit("step1").alias("step"), F.col("text").alias("data"))
    return stream_health(last.unionByName(starts), "conv_id", "step", "data")
