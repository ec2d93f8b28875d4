"""One row per sailing: inside a source, and across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremeld.functions.names import MATCH_KEY
from faremeld.operators.fx import amount


def keep_cheapest(rows: DataFrame, key: list[str], price: str = "price", order: str = "row_ord") -> DataFrame:
    """Cheapest row per key by raw price; unpriced rows lose, first wins ties.

    The kept row takes the place of the first row of its key. Both are
    min-type aggregates, so a hot key shrinks to one row per task before the
    shuffle.
    """
    rank = F.struct(F.col(price).isNull(), F.col(price), F.col(order))
    return _one_per_key(rows, key, order, lambda row: F.min_by(row, rank))


def keep_last(rows: DataFrame, key: list[str], order: str = "row_ord") -> DataFrame:
    """Last row per key wins, in the place of the first."""
    return _one_per_key(rows, key, order, lambda row: F.max_by(row, F.col(order)))


def _one_per_key(rows: DataFrame, key: list[str], order: str, choose) -> DataFrame:
    carried = [c for c in rows.columns if c not in key and c != order]
    return (
        rows.groupBy(*key)
        .agg(choose(F.struct(*carried)).alias("_row"), F.min(order).alias(order))
        .select(*key, "_row.*", order)
    )


def quote_entry() -> Column:
    """A quote as the competing-quotes map stores it."""
    from faremeld.functions.money import plain_number

    return F.struct(
        plain_number(F.col("price")).alias("price"),
        F.col("currency").alias("currency"),
        F.col("price_twd").cast("string").alias("price_twd"),
    )


def best_quotes(
    quotes: DataFrame, key: list[str] = MATCH_KEY, order: str = "ord", carry: bool = True
) -> DataFrame:
    """Cheapest quote per sailing, the rest folded into `other_sources`.

    * The winner is the lowest amount; no price loses; first in `order` wins
      ties. `order` must be unique per row.
    * Every source with a losing row gets one map entry, its last losing row.
      That can be the winner's own source.
    * With no loser at all, the winner keeps the map it came with.
    * `first_seen` is the place of the sailing's first row, for stable output.

    Two passes, both reduced on the map side, so a sailing with a third of all
    rows never meets in one task: the winner is a `min_by`; the losers need
    only the last two rows per sailing and source (two, as the last may be the
    winner), which the `row_number() <= 2` group limit cuts before its shuffle.
    """
    rank = F.struct(amount().isNull(), amount(), F.col(order))
    carried = [c for c in quotes.columns if c not in key]
    # Inside a struct, null equals null, so that the join keeps null keys.
    keyed = F.struct(*key).alias("_key")
    winners = quotes.groupBy(keyed).agg(
        F.min_by(F.struct(*carried), rank).alias("_row"), F.min(order).alias("first_seen")
    )

    newest_first = Window.partitionBy("_key", "source").orderBy(F.col(order).desc())
    last_two = (
        quotes.select(keyed, "source", order, quote_entry().alias("entry"))
        .withColumn("_rn", F.row_number().over(newest_first))
        .where("_rn <= 2")
    )
    # At most two short rows per source meet here.
    rivals = last_two.groupBy("_key").agg(
        F.collect_list(F.struct("source", "_rn", F.col(order).alias("_ord"), "entry")).alias("_rivals")
    )

    joined = winners.join(rivals, "_key", "left").select("_key.*", "_row", "first_seen", "_rivals")
    losing = F.sort_array(
        F.filter("_rivals", lambda x: x["_ord"] != F.col(f"_row.{order}"))
    )
    joined = joined.withColumn("_losing", losing)
    newest = F.filter(
        "_losing",
        lambda x, i: (i == 0) | (x["source"] != F.get(F.col("_losing"), i - 1)["source"]),
    )
    others = F.map_from_entries(F.transform(newest, lambda x: F.struct(x["source"], x["entry"])))
    kept = F.col("_row.other_sources") if carry else F.create_map().cast("map<string,struct<price:string,currency:string,price_twd:string>>")
    plain = [F.col(f"_row.{c}").alias(c) for c in carried if c != "other_sources"]
    return joined.select(
        *key,
        *plain,
        F.when(F.size("_losing") > 0, others).otherwise(kept).alias("other_sources"),
        "first_seen",
    )
