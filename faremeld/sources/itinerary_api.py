"""Nested itinerary API items with master data (source expedia).

Input `items`: item_no bigint, payload string (one JSON item), scraped_at
timestamp; `master`: payload string (the master-data JSON, one row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.dates import in_window, parse_date
from faremeld.functions.money import lowest_positive, parse_nights, parse_price, positive
from faremeld.functions.names import match_port
from faremeld.operators.quality import dimension_missing
from faremeld.schemas import as_quotes

NAME = "expedia"
ITEM = (
    "struct<itinerary:struct<duration:string,departure:struct<code:string>,arrival:struct<code:string>>,"
    "ship:struct<id:string>,packages:array<struct<id:string,startDateTime:string,prices:array<struct<"
    "currencyCode:string,items:array<struct<name:string,code:string,value:string>>>>>>>"
)
MASTER = (
    "struct<data:struct<ship:array<struct<id:string,name:string,parentId:string>>,"
    "cruiseline:array<struct<id:string,name:string>>,port:array<struct<code:string,name:string>>>>"
)


def master_dims(master: DataFrame) -> DataFrame:
    """(dimension, id, name, parent_id) of ports, ships and lines, from one parse of the payloads.

    A repeated id keeps its last entry. Master data in several rows has their
    order in `part`.
    """
    part = F.col("part") if "part" in master.columns else F.lit(0)
    data = master.select(part.cast("bigint").alias("part"), F.from_json("payload", MASTER)["data"].alias("d"))

    def entries(field: str, dimension: str, key: str, parent: str | None = None) -> Column:
        made = lambda e, at: F.struct(
            F.lit(dimension).alias("dimension"), e[key].alias("id"), e["name"].alias("name"),
            (e[parent] if parent else F.lit(None).cast("string")).alias("parent_id"), at.alias("at"),
        )
        return F.transform(F.coalesce(f"d.{field}", F.array().cast(data.schema["d"].dataType[field].dataType)), made)

    every = F.concat(entries("port", "port", "code"), entries("ship", "ship", "id", "parentId"), entries("cruiseline", "line", "id"))
    rows = data.select("part", F.explode(every).alias("e")).select("part", "e.*")
    last = F.max_by(F.struct("name", "parent_id"), F.struct("part", "at"))
    return rows.groupBy("dimension", "id").agg(last.alias("e")).select("dimension", "id", "e.*")


def read_master(master: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Port, ship and line dimensions."""
    dims = master_dims(master)
    ports, ships, lines = (dims.where(F.col("dimension") == name) for name in ("port", "ship", "line"))
    return ports.select("id", "name"), ships.select("id", "name", F.col("parent_id").alias("line_id")), lines.select("id", "name")


def look_up(rows: DataFrame, dimension: DataFrame, key: str, out: dict[str, str]) -> DataFrame:
    """Left look-up of a dimension with unique ids; `out` maps new to old names."""
    side = dimension.select(F.col("id").alias(key), *[F.col(old).alias(new) for new, old in out.items()])
    return rows.join(side, key, "left")


def lowest_cabin_price(prices: Column) -> Column:
    """Lowest positive price of a cabin; taxes and fees are no cabins."""
    items = F.flatten(F.transform(prices, lambda p: F.coalesce(p["items"], F.array().cast(_PRICE_ITEMS))))
    cabins = F.filter(items, lambda i: i["name"].isin(*fv.EXPEDIA_CABINS))

    def price(item: Column) -> Column:
        number = item["value"].try_cast("decimal(38,4)")
        return F.when(number.isNotNull(), positive(number)).otherwise(parse_price(item["value"]))

    return lowest_positive(F.transform(cabins, price))


_PRICE_ITEMS = "array<struct<name:string,code:string,value:string>>"


def currency_of(prices: Column) -> Column:
    """First currency code given, else USD."""
    codes = F.filter(F.transform(prices, lambda p: p["currencyCode"]), lambda c: c != "")
    return F.coalesce(F.get(codes, F.lit(0)), F.lit("USD"))


def to_rows(items: DataFrame, ports: DataFrame, ships: DataFrame, lines: DataFrame, start, end) -> DataFrame:
    """One row per package in the window. Look-ups come before the explode."""
    ports, ships, lines = (d for d in (ports, ships, lines))
    flat = items.select("item_no", "scraped_at", F.from_json("payload", ITEM).alias("i")).withColumns(
        {
            "depart_code": F.col("i.itinerary.departure.code"),
            "arrive_code": F.col("i.itinerary.arrival.code"),
            "ship_id": F.col("i.ship.id"),
            "nights": F.coalesce(parse_nights(F.col("i.itinerary.duration")), F.lit(0)),
        }
    )
    flat = look_up(flat, ports, "depart_code", {"depart_name": "name"})
    flat = flat.withColumn("depart_port_raw", _name_or_code("depart_name", "depart_code"))
    flat = flat.withColumn("depart_port", match_port(F.col("depart_port_raw"))).where("depart_port IS NOT NULL")
    flat = look_up(flat, ports, "arrive_code", {"arrive_name": "name"})
    flat = look_up(flat, ships, "ship_id", {"ship": "name", "line_id": "line_id"})
    flat = look_up(flat, lines, "line_id", {"line": "name"})
    packages = flat.select("*", F.posexplode("i.packages").alias("package_no", "package"))
    packages = packages.withColumn("sail_date", parse_date(F.col("package.startDateTime")))
    packages = packages.where(in_window(F.col("sail_date"), F.lit(start), F.lit(end)))
    package_id = F.coalesce("package.id", F.lit(""))
    url = F.replace(F.lit(fv.EXPEDIA_URL), F.lit("{id}"), package_id)
    return packages.select(
        F.lit(NAME).alias("source"),
        "sail_date",
        "depart_port",
        "depart_port_raw",
        _name_or_code("arrive_name", "arrive_code").alias("arrive_port"),
        F.coalesce("ship", F.lit("")).alias("ship_name"),
        F.coalesce("line", F.lit("")).alias("cruise_line"),
        "nights",
        lowest_cabin_price(F.col("package.prices")).alias("price"),
        currency_of(F.col("package.prices")).alias("currency"),
        F.lit(fv.EXPEDIA_NOTE).alias("price_note"),
        F.when(~package_id.isin("", "0"), url).otherwise("").alias("detail_url"),
        "scraped_at",
        F.array(F.col("item_no").cast("bigint"), F.col("package_no").cast("bigint")).alias("row_ord"),
    )


def _name_or_code(name: str, code: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(code), F.lit(""))


def parse(items: DataFrame, master: DataFrame, start, end) -> DataFrame:
    """Quotes of all items. This source is not de-duplicated by itself."""
    return as_quotes(to_rows(items, *read_master(master), start, end), "row_ord")


def health(items: DataFrame, master: DataFrame, start=None, end=None) -> DataFrame:
    ports, _, _ = read_master(master)
    spark = items.sparkSession
    return spark.range(1).where(dimension_missing(items, ports)).select(
        F.lit("ParseError: master data without ports").alias("error")
    )
