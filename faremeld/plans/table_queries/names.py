"""Alias, port and title operators over parts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremeld.functions import names
from faremeld.operators.quality import merge_unmapped, unmapped_names, unmapped_rows, unmapped_warning
from faremeld.plans.table_queries.feeds import raw_table, spread, table
from faremeld.plans.table_queries.registry import query
from faremeld.sources.itinerary_api import look_up
from faremeld.sources.result_table import in_target_ports

# Rules over words of the documents, in the order they are tried.
LANGUAGE_RULES = (
    ("english", (" the ", " and ")),
    ("french", (" que ", " les ")),
    ("german", (" der ", " und ")),
    ("spanish", (" los ", " una ")),
)


@query(
    "first_match_rule",
    """
SELECT doc_id, CASE WHEN contains(t, ' the ') OR contains(t, ' and ') THEN 'english'
  WHEN contains(t, ' que ') OR contains(t, ' les ') THEN 'french'
  WHEN contains(t, ' der ') OR contains(t, ' und ') THEN 'german'
  WHEN contains(t, ' los ') OR contains(t, ' una ') THEN 'spanish' END AS rule
FROM (SELECT doc_id, lower(text) AS t FROM documents)""",
)
def first_match_rule(spark, sf_dir):
    """First rule, in order, with a keyword anywhere in the whole text."""
    return raw_table(spark, sf_dir, "documents").select(
        "doc_id", names.first_rule(F.lower("text"), LANGUAGE_RULES).alias("rule")
    )


# Aliases over word parts; longest wins, equal lengths go to the first listed.
WORD_ALIASES = {"tion": "suffix", "ation": "long suffix", "ment": "other suffix", "heit": "german", "thanation": "whole", "ing": "short"}


@query(
    "longest_alias",
    r"""
SELECT doc_id, CASE WHEN contains(t, 'thanation') THEN 'whole' WHEN contains(t, 'ation') THEN 'long suffix'
  WHEN contains(t, 'tion') THEN 'suffix' WHEN contains(t, 'ment') THEN 'other suffix' WHEN contains(t, 'heit') THEN 'german'
  WHEN contains(t, 'ing') THEN 'short' END AS alias
FROM (SELECT doc_id, text AS t FROM documents)""",
)
def longest_alias(spark, sf_dir):
    return raw_table(spark, sf_dir, "documents").select(
        "doc_id", names.match_alias(F.col("text"), WORD_ALIASES).alias("alias")
    )


_SHIPS = (("探索星號", "Star Voyager"), ("鑽石公主號", "Diamond Princess"), ("藍寶石公主號", "Sapphire Princess"), ("榮耀號", "MSC Bellissima"))
_LINES = (("麗星郵輪", "Star Cruises"), ("公主遊輪", "Princess Cruises"), ("公主郵輪", "Princess Cruises"), ("MSC郵輪", "MSC Cruises"))


def _pick(values, index: int):
    picked = F.lit(values[-1][index])
    for i, pair in enumerate(values[:-1]):
        picked = F.when(F.col("p_partkey") % 4 == i, pair[index]).otherwise(picked)
    return picked


def _titles(spark, sf_dir):
    """Product titles of four writings around each part's name."""
    ship, line = _pick(_SHIPS, 0), _pick(_LINES, 0)
    tour = F.concat(F.col("p_name"), F.lit("之旅 "), F.col("p_size").cast("string"), F.lit("天"))
    form = F.floor(F.col("p_partkey") / 4) % 4
    title = (
        F.when(form == 0, F.concat(F.lit("【"), line, ship, F.lit("】"), tour))
        .when(form == 1, F.concat(F.lit("【"), line, F.lit("．"), ship, F.lit("】"), tour))
        .when(form == 2, F.concat(F.lit("【"), line, F.lit("】"), ship, F.lit("～"), tour))
        .otherwise(F.concat(F.lit("【愛達郵輪】魔都號"), F.col("p_size").cast("string"), F.lit("～上海３天")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", title.alias("title"))


_PICK_SQL = """
t AS (SELECT *, p_partkey % 4 AS k, (p_partkey // 4) % 4 AS form FROM part),
named AS (SELECT *, ['探索星號','鑽石公主號','藍寶石公主號','榮耀號'][k + 1] AS raw,
  ['Star Voyager','Diamond Princess','Sapphire Princess','MSC Bellissima'][k + 1] AS ship,
  ['Star Cruises','Princess Cruises','Princess Cruises','MSC Cruises'][k + 1] AS line FROM t)
"""


@query(
    "split_title",
    f"""WITH {_PICK_SQL}
SELECT p_partkey, CASE WHEN form < 3 THEN ship ELSE '魔都號' || p_size END AS ship_name,
  CASE WHEN form < 3 THEN raw ELSE '魔都號' || p_size END AS ship_name_raw,
  CASE WHEN form < 3 THEN line ELSE '' END AS cruise_line FROM named""",
)
def split_title(spark, sf_dir):
    return names.with_ship_and_line(_titles(spark, sf_dir), "title").select(
        "p_partkey", "ship_name", "ship_name_raw", "cruise_line"
    )


@query(
    "canonical_ship",
    f"""WITH {_PICK_SQL}
SELECT p_partkey, CASE form WHEN 0 THEN ship WHEN 1 THEN p_name WHEN 2 THEN p_name ELSE '愛達' || p_size END AS ship,
  form = 3 AS unmapped, CASE k WHEN 0 THEN 'Star Cruises' WHEN 3 THEN 'MSC Cruises' ELSE 'Princess Cruises' END AS line
FROM named""",
)
def canonical_ship(spark, sf_dir):
    form = F.floor(F.col("p_partkey") / 4) % 4
    written = (
        F.when(form == 0, F.concat(F.lit("  "), _pick(_SHIPS, 0), F.lit(" ")))
        .when(form == 1, F.concat(F.lit("【凱旋】"), "p_name", F.lit("～ 12 晚")))
        .when(form == 2, F.concat("p_name", F.lit("　")))
        .otherwise(F.concat(F.lit("愛達"), F.col("p_size").cast("string")))
    )
    rows = table(spark, sf_dir, "part").withColumn("written", written)
    return rows.select(
        "p_partkey",
        names.canonical_ship(F.col("written")).alias("ship"),
        names.is_unmapped_ship(F.col("written")).alias("unmapped"),
        names.canonical_line(F.concat(F.lit(" "), _pick(_LINES, 0))).alias("line"),
    )


@query(
    "unmapped_names",
    f"""WITH {_PICK_SQL} SELECT DISTINCT '魔都號' || p_size AS ship_name FROM named WHERE form = 3""",
)
def unmapped(spark, sf_dir):
    return unmapped_names(names.with_ship_and_line(_titles(spark, sf_dir), "title").select("ship_name"))


@query(
    "unmapped_warning",
    f"""WITH {_PICK_SQL}
SELECT '這些船名沒有英文對照，無法跨來源比價：' || string_agg(s, '、' ORDER BY s) AS warning
FROM (SELECT DISTINCT '魔都號' || p_size AS s FROM named WHERE form = 3)""",
)
def warning(spark, sf_dir):
    return unmapped_warning(unmapped(spark, sf_dir))


@query(
    "unmapped_rows",
    f"""WITH {_PICK_SQL}, s AS (SELECT '魔都號' || p_size AS ship_name, p_brand AS source, p_partkey % 2 AS run FROM named WHERE form = 3)
SELECT ship_name, source, count(*) FILTER (run = latest) AS quotes, min(run) AS first_run, max(run) AS last_run
FROM (SELECT *, max(run) OVER (PARTITION BY ship_name, source) AS latest FROM s) GROUP BY ship_name, source""",
)
def unmapped_by_source(spark, sf_dir):
    """Unmapped names with their source and count, merged over two runs: parts of even and of odd keys."""
    rows = names.with_ship_and_line(_titles(spark, sf_dir), "title").join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("source")), "p_partkey")
    return merge_unmapped(*[unmapped_rows(rows.where(F.col("p_partkey") % 2 == i), F.lit(i)) for i in (0, 1)])


@query(
    "itinerary_ports",
    """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || '|' || p_type WHEN 1 THEN p_brand || '|' || p_name
  ELSE p_brand || '|' || p_type END AS ports, 2 AS n FROM part""",
)
def ports_in_titles(spark, sf_dir):
    k = F.col("p_partkey") % 3
    title = (
        F.when(k == 0, F.concat(F.lit("【甲．乙】日韓自主遊６天～"), "p_name", F.lit("、"), "p_type"))
        .when(k == 1, F.concat(F.lit("【甲．乙】"), "p_brand", F.lit("、"), "p_name", F.lit("自主遊５天")))
        .otherwise(F.concat(F.lit("【甲．乙】十天～"), "p_brand", F.lit("、"), "p_type", F.lit("(加購岸上觀光)")))
    )
    ports = names.itinerary_ports(title)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(ports, "|").alias("ports"), F.size(ports).cast("bigint").alias("n")
    )


@query(
    "journey_ports",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  '基隆港|' || l_returnflag || ' Bay|' || CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '' ELSE l_linestatus || ' Isle|' END || '基隆港' AS ports
FROM lineitem""",
)
def journey_ports(spark, sf_dir):
    """Day texts to ports: sea days out, stays of two days once, home kept."""
    bay = F.concat("l_returnflag", F.lit(" Bay"))
    isle = F.concat("l_linestatus", F.lit(" Isle"))
    last = F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("第五天：海上巡航")).otherwise(
        F.concat(F.lit("Day 5: "), isle, F.lit(" Arrival 08:00"))
    )
    days = F.array(
        F.lit("第一天：基隆港【郵輪20:00啟航】"),
        F.lit("第二天：海上巡航"),
        F.concat(F.lit("第３天\n"), bay, F.lit(" 抵達\n15:00 啟航")),
        F.concat(F.lit("第四天："), bay, F.lit("【停留】")),
        last,
        F.lit("第六天：基隆港"),
    )
    daily = F.transform(days, lambda d: F.struct(d.alias("description")))
    columns = "l_orderkey l_linenumber l_partkey l_suppkey l_returnflag l_linestatus".split()
    rows = spread(raw_table(spark, sf_dir, "lineitem").select(*columns)).withColumn("daily", daily)
    return names.with_journey_ports(rows, "daily", "ports").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join("ports", "|").alias("ports")
    )


@query(
    "match_port",
    """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Keelung' WHEN 1 THEN 'Tokyo' WHEN 2 THEN 'Yokohama' WHEN 3 THEN 'Yokohama' WHEN 5 THEN 'Keelung' END AS port,
  CASE o_orderkey % 6 WHEN 0 THEN 'keelung' WHEN 4 THEN '' WHEN 5 THEN 'keelung' ELSE 'tokyo/yokohama' END AS port_group
FROM orders""",
)
def match_port(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    raw = (
        F.when(k == 0, F.concat(F.lit("Starts: KEELUNG "), "o_orderpriority"))
        .when(k == 1, F.concat(F.lit("日本東京出發："), "o_orderpriority"))
        .when(k == 2, F.lit("日本 東京 (橫濱) 登船"))
        .when(k == 3, F.concat("o_orderpriority", F.lit(" 横浜港")))
        .when(k == 4, F.concat(F.lit("Busan "), "o_orderpriority"))
        .otherwise(F.concat(F.lit("Departs　基隆港 "), "o_orderpriority"))
    )
    port = names.match_port(raw)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", port.alias("port"), names.port_group(port).alias("port_group")
    )


@query(
    "target_ports",
    """
SELECT n_name AS depart_port, count(*) AS n FROM (
  SELECT CASE n_nationkey % 5 WHEN 0 THEN 'Keelung' WHEN 1 THEN 'Tokyo' ELSE n_name END AS n_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE n_name IN ('Keelung', 'Tokyo') GROUP BY ALL""",
)
def target_ports(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    port = F.when(F.col("n_nationkey") % 5 == 0, "Keelung").when(F.col("n_nationkey") % 5 == 1, "Tokyo").otherwise(F.col("n_name"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return in_target_ports(rows.select(port.alias("depart_port"))).groupBy("depart_port").agg(F.count("*").alias("n"))


@query(
    "line_from_slug",
    """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Celebrity Cruises' WHEN 1 THEN 'Holland America Line'
  WHEN 2 THEN upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]
  ELSE '' END AS line FROM part""",
)
def line_from_slug(spark, sf_dir):
    k = F.col("p_partkey") % 4
    slug = F.when(k == 0, " Celebrity").when(k == 1, "holland AMERICA").when(k == 2, F.upper("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", names.line_from_slug(slug).alias("line"))


@query(
    "dim_lookup",
    """
SELECT s_suppkey, coalesce(n_name, '') AS nation, coalesce(r_name, '') AS region
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0) ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dim_lookup(spark, sf_dir):
    """Two chained left look-ups; a missing nation leaves both names empty."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 6 <> 0").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id")
    )
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    rows = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation_id")
    rows = look_up(rows, nation, "nation_id", {"nation": "name", "region_id": "region_id"})
    rows = look_up(rows, region, "region_id", {"region": "name"})
    return rows.select("s_suppkey", F.coalesce("nation", F.lit("")).alias("nation"), F.coalesce("region", F.lit("")).alias("region"))
