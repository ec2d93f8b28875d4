"""Mixing sources to target weights: budgets down a tree, shortages to siblings first, seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeld.llm.common import settle, table

LEVELS = ("domain", "lang", "source")
SEED, MAX_EPOCHS, BUDGET_SHARE = "mix-1", 3, 0.9
#: Target weights, whole numbers; a node that is not named has OTHER.
WEIGHTS = {"domain": {"web": 4, "books": 2, "code": 1, "forum": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "source": {}}
OTHER = 1
#: The domain of a source is told by its number's remainder.
DOMAINS = ("web", "books", "code", "forum")
DOMAIN = "element_at(array('web','books','code','forum'), 1 + coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS int), 0) % 4)"
WORD = r"[^ \t\n\r]+"


def water_fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `budget` to children (weight, supply) of parents that have a `total`.

    Each gets total x weight / sum of weights, but no more than its supply; what
    one can't use goes to its siblings, again by weight. Children are looked at
    from the lowest supply per weight up: one is short if its part of what is
    left exceeds its supply. Fractions of a token are cut off. A child without
    weight gets nothing.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = by.orderBy("_ratio", name)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("weight", "supply", "total")}
    rows = nodes.where("weight > 0").withColumns(wide).withColumn("_ratio", F.expr("CAST(supply AS double) / CAST(weight AS double)"))
    rows = rows.withColumns({
        "_left": F.col("total") - F.coalesce(F.sum("supply").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_weights": F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).withColumn("_short", F.expr("CAST(_left AS double) * CAST(weight AS double) >= CAST(supply AS double) * CAST(_weights AS double)"))
    # all from the first that is not short share alike what is left there
    start = F.min(F.when(~F.col("_short"), F.struct("_ratio", name, "_left", "_weights"))).over(by)
    share = F.expr("(CAST(_start._left AS decimal(19,0)) * CAST(weight AS decimal(19,0))) div CAST(_start._weights AS decimal(19,0))")
    enough = F.col("_start").isNull() | (F.struct("_ratio", name) < F.struct("_start._ratio", f"_start.{name}"))
    budget = F.when(enough, F.col("supply").cast("long")).otherwise(F.least(share, F.col("supply").cast("long")))
    return rows.withColumn("_start", start).withColumn("budget", budget).drop("_ratio", "_left", "_weights", "_short", "_start", "total")


def leaf_budgets(supplies: DataFrame, total: int, weights: dict[str, dict[str, int]], max_epochs: int, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(levels, tokens, budget) of the leaves of (levels, tokens).

    A leaf supplies its tokens `max_epochs` times, a node what its leaves do.
    Budgets go down level by level: a shortage is met by siblings first, and
    reaches another branch only if a whole branch is short. The tables grow
    with the number of sources, not of documents.
    """
    above = None
    for depth, name in enumerate(levels, 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        known = F.create_map(*[F.lit(x) for pair in weights[name].items() for x in pair])[F.col(name)] if weights.get(name) else F.lit(None).cast("int")
        nodes = supplies.groupBy(*path).agg(F.sum("tokens").alias("tokens")).withColumn("supply", F.col("tokens") * max_epochs).withColumn("weight", F.coalesce(known, F.lit(OTHER)))
        nodes = nodes.withColumn("total", F.lit(total)) if above is None else nodes.join(above, parent)
        above = settle(water_fill(nodes, parent, name).select(*path, "tokens", "budget"))
        leaves, above = above, above.select(*path, F.col("budget").alias("total"))
    return leaves


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]] = WEIGHTS, share: float = BUDGET_SHARE, seed: str = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`row` (a struct of the columns), the levels, `mix_epoch` from 0, `mix_tokens` and `mix_order`, one row per selected copy.

    The total is `share` of all tokens; tokens are words between white space. A
    leaf with budget b and n tokens gives b div n whole epochs and a prefix of
    the next one, ordered by a hash of seed, epoch and doc_id, then of the text.
    The document in which a budget ends counts in part (`mix_tokens`); equal
    rows there share what is left. Null levels form a node named ''. Documents
    without tokens come with the whole epochs only, and a leaf of such
    documents alone selects nothing. `mix_order` sorts an epoch.

    Only the slice of a leaf in which its prefix ends is put in order: tokens
    are first summed by 16 bits of the hash, so no leaf is sorted as a whole.
    """
    names = list(levels)
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.regexp_count(text, F.lit(WORD)).cast("long")
    leaf = [F.coalesce(c.cast("string"), F.lit("")).alias(f"_{n}") for n, c in levels.items()]
    inner = docs.select(F.struct("*").alias("row"), *leaf, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), text.alias("_text"), tokens.alias("_tokens"))
    inner = inner.select(*[F.col(f"_{n}").alias(n) for n in names], "row", "_id", "_text", "_tokens")

    def place(epoch: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.col("_id")))

    narrow = settle(inner.select(*names, "_id", F.col("_tokens").alias("tokens"), F.md5("_text").alias("_hash")))
    supplies = settle(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    total = supplies.agg(F.floor(F.sum("tokens") * F.lit(share)).cast("long")).first()[0] or 0
    plan = leaf_budgets(supplies.where("tokens > 0"), total, weights, max_epochs, tuple(names))
    plan = settle(plan.select(*names, F.expr("budget div tokens").alias("_full"), F.expr("budget % tokens").alias("_part")))

    ranked = narrow.join(plan.where("_part > 0"), names).withColumn("_key", place(F.col("_full"))).withColumn("_slice", F.substring("_key", 1, 4))
    slices = ranked.groupBy(*names, "_slice").agg(F.sum("tokens").alias("n"), F.max("_part").alias("_part"))
    before = Window.partitionBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    ends = slices.withColumn("_before", F.coalesce(F.sum("n").over(before.orderBy("_slice")), F.lit(0))).where("_before < _part AND _before + n >= _part")
    ties = ranked.join(settle(ends.select(*names, "_slice", "_before")), [*names, "_slice"]).groupBy(*names, "_key", "_hash")
    ties = ties.agg(F.sum("tokens").alias("n"), F.count("*").alias("rows"), F.max("_part").alias("_part"), F.max("_before").alias("_ahead"))
    ties = ties.withColumn("_ahead", F.col("_ahead") + F.coalesce(F.sum("n").over(before.orderBy("_key", "_hash")), F.lit(0)))
    cuts = ties.where("_ahead < _part AND _ahead + n >= _part").select(*names, F.col("_key").alias("_cut"), F.col("_hash").alias("_cut_hash"), F.expr("(_part - _ahead) div rows").alias("_rest"))
    plan = settle(plan.join(cuts, names, "left"))

    here, cut = F.struct(F.col("_key"), F.md5("_text")), F.struct("_cut", "_cut_hash")
    taken = F.when(F.col("_cut").isNull(), F.lit(0)).when(F.col("_key") > F.col("_cut"), 0).when(F.col("_key") < F.col("_cut"), F.col("_tokens")).when(here < cut, F.col("_tokens")).when(here == cut, F.col("_rest")).otherwise(0)
    found = inner.join(plan, names).withColumn("_key", place(F.col("_full"))).withColumn("_taken", taken.cast("long"))
    copies = F.col("_full").cast("int") + F.when(F.col("_taken") > 0, 1).otherwise(0)
    found = found.where(copies > 0).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    counted = F.when(F.col("mix_epoch") < F.col("_full"), F.col("_tokens")).otherwise(F.col("_taken"))
    return found.select("row", *names, "mix_epoch", counted.alias("mix_tokens"), place(F.col("mix_epoch")).alias("mix_order"))


def tree() -> dict[str, Column]:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs, tree()).select("row.doc_id", *LEVELS, "mix_epoch", "mix_tokens", "mix_order")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents by target weights, repeated where a leaf's budget takes more than one epoch; whole texts."""
    return mix(docs, tree(), share=1.0).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def oracle() -> str:
    """The same rows in DuckDB."""
    domain = "['web','books','code','forum'][1 + coalesce(TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') AS INT), 0) % 4]"
    sql = f"""WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens FROM documents),
    supplies AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)"""
    total = f"(SELECT CAST(floor(sum(tokens) * {BUDGET_SHARE}) AS HUGEINT) FROM d)"
    for depth, name in enumerate(LEVELS, 1):
        path, parent = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1])
        weight = f"coalesce(CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[name].items()) + f" END, {OTHER})" if WEIGHTS[name] else f"{OTHER}"
        up = f"OVER ({'PARTITION BY ' + parent if parent else ''} ORDER BY supply / weight, {name} ROWS BETWEEN"
        joined = f"JOIN b{depth - 1} USING ({parent})" if parent else ""
        whole = f"{total}" if not parent else f"b{depth - 1}.budget"
        sql += f""",
    n{depth} AS (SELECT {path}, sum(s.tokens) AS tokens, sum(s.tokens) * {MAX_EPOCHS} AS supply, {weight} AS weight FROM supplies s GROUP BY {path}),
    w{depth} AS (SELECT n{depth}.*, {whole} AS total FROM n{depth} {joined}),
    l{depth} AS (SELECT *, total - coalesce(sum(supply) {up} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
      sum(weight) {up} CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights, row_number() {up} UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM w{depth}),
    f{depth} AS (SELECT *, min(place) FILTER (rest * weight < supply * weights) OVER ({'PARTITION BY ' + parent if parent else ''}) AS opening FROM l{depth}),
    b{depth} AS (SELECT f.* EXCLUDE (total, rest, weights, place, opening), CAST(CASE WHEN f.opening IS NULL OR f.place < f.opening THEN f.supply
      ELSE least(f.supply, (g.rest * f.weight) // g.weights) END AS BIGINT) AS budget
      FROM f{depth} f LEFT JOIN f{depth} g ON g.place = f.opening {''.join(f' AND f.{p} = g.{p}' for p in LEVELS[: depth - 1])})"""
    return sql + f""",
    plan AS (SELECT domain, lang, source, CAST(budget // tokens AS BIGINT) AS whole, CAST(budget % tokens AS BIGINT) AS part FROM b3),
    ranked AS (SELECT row_no, domain, lang, source, tokens, whole, part, md5('{SEED}:' || whole || ':' || id) AS k, md5(t) AS h FROM d JOIN plan USING (domain, lang, source)),
    ties AS (SELECT domain, lang, source, k, h, sum(tokens) AS n, count(*) AS n_rows FROM ranked GROUP BY ALL),
    ahead AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY k, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ties),
    taken AS (SELECT r.row_no, r.tokens, r.whole, CAST(CASE WHEN a.ahead >= r.part THEN 0 WHEN a.ahead + a.n < r.part THEN r.tokens ELSE (r.part - a.ahead) // a.n_rows END AS BIGINT) AS taken
      FROM ranked r JOIN ahead a USING (domain, lang, source, k, h)),
    copies AS (SELECT *, unnest(range(0, whole + CASE WHEN taken > 0 THEN 1 ELSE 0 END)) AS epoch FROM taken)
    SELECT doc_id, domain, lang, source, CAST(epoch AS INT) AS mix_epoch, CAST(CASE WHEN epoch < whole THEN c.tokens ELSE taken END AS BIGINT) AS mix_tokens, md5('{SEED}:' || epoch || ':' || id) AS mix_order
    FROM copies c JOIN d USING (row_no)"""
