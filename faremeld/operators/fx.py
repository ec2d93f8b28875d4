"""Exchange rates: provider payloads, fallback, carry-forward, conversion."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from faremeld import fixed_values as fv
from faremeld.functions.dates import parse_iso_date
from faremeld.functions.money import positive
from faremeld.functions.text import extract
from faremeld.schemas import AMOUNT, FX, RATE

FX_COLUMNS = FX.fieldNames()


def _rate(usd_twd: Column, as_of: Column, source: str) -> Column:
    made = F.struct(
        usd_twd.alias("usd_twd"),
        F.coalesce(as_of, F.current_date()).alias("as_of"),
        F.lit(source).alias("source"),
        F.lit(False).alias("stale"),
    )
    return F.when(usd_twd.isNotNull(), made)


def _number(payload: Column, path: str) -> Column:
    return positive(F.get_json_object(payload, path).try_cast(RATE))


def rate_from_primary(payload: Column) -> Column:
    """Rate struct of the first provider's payload; null when it is no success."""
    written = extract(
        F.get_json_object(payload, "$.time_last_update_utc"),
        r"^[A-Za-z]{3}, (\d{1,2} [A-Za-z]{3} \d{4}) \d{2}:\d{2}:\d{2} [+-]\d{4}$",
        1,
    )
    rate = F.when(F.get_json_object(payload, "$.result") == "success", _number(payload, "$.rates.TWD"))
    return _rate(rate, F.try_to_date(written, "d MMM yyyy"), fv.FX_PRIMARY)


def rate_from_fallback(payload: Column) -> Column:
    as_of = parse_iso_date(F.get_json_object(payload, "$.USDTWD.UTC"))
    return _rate(_number(payload, "$.USDTWD.Exrate"), as_of, fv.FX_FALLBACK)


def provider_rates(payloads: DataFrame) -> DataFrame:
    """Parse (provider, payload) rows; adds `provider_ord` and `rate`."""
    payload = F.col("payload")
    is_first = F.col("provider") == fv.FX_PRIMARY
    return payloads.withColumns(
        {
            "provider_ord": F.when(is_first, 0).otherwise(1),
            "rate": F.when(is_first, rate_from_primary(payload)).otherwise(rate_from_fallback(payload)),
        }
    )


def first_valid_rate(rates: DataFrame, *group: str) -> DataFrame:
    """First provider, in order, with a usable rate; no row when none has one."""
    best = F.min_by("rate", "provider_ord").alias("rate")
    usable = rates.where(F.col("rate").isNotNull())
    if group:
        return usable.groupBy(*group).agg(best).select(*group, "rate.*")
    return usable.agg(best).where(F.col("rate").isNotNull()).select("rate.*")


def resolve_rate(
    spark: SparkSession,
    manual: str | None,
    payloads: DataFrame | None,
    previous: DataFrame | None,
) -> DataFrame:
    """Manual rate, else a fetched one, else the last published one as stale.

    Zero or one row with the columns of `schemas.FX`.
    """
    options = []
    given = _manual(manual)
    if given is not None:
        options.append(_rate(F.lit(given).cast(RATE), F.lit(None).cast("date"), fv.FX_MANUAL))
    if payloads is not None:
        fetched = first_valid_rate(provider_rates(payloads))
        options.append(fetched.select(F.struct(*FX_COLUMNS)).scalar())
    if previous is not None:
        kept = previous.select(
            F.struct("usd_twd", "as_of", "source", F.lit(True).alias("stale")).cast(FX)
        )
        options.append(kept.scalar())
    if not options:
        return spark.createDataFrame([], FX)
    chosen = F.coalesce(*[o.cast(FX) for o in options])
    return spark.range(1).select(chosen.alias("fx")).where("fx IS NOT NULL").select("fx.*")


def _manual(raw: str | None) -> Decimal | None:
    try:
        return Decimal(raw) if raw else None
    except InvalidOperation:
        return None


def carry_rate_forward(rates: DataFrame, pair: str, day: str, rate: str) -> DataFrame:
    """Fill days without a rate from the last day that had one, marked stale.

    The input holds one row per pair and day, so a window sees calendar days
    and never raw quotes.
    """
    w = Window.partitionBy(pair).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last(rate, ignorenulls=True).over(w)
    return rates.withColumns({"stale": F.col(rate).isNull() & carried.isNotNull(), rate: carried})


def rate_as_of(rows: DataFrame, rates: DataFrame, pair: str, day: str, out: str = "rate") -> DataFrame:
    """Each row with the last rate of its pair on or before its day, and that rate's day (`<out>_day`); null before the first.

    `rates` has (pair, day, rate), with the pair and day named as in `rows`; of
    several rates of one day the highest counts. Rates are grouped by month: a
    month holds its own days, 31 at most, and what the months before it left.
    Months without a rate repeat what was left, up to the last month asked for,
    so rows meet rates by pair and month alone: no range join, and no sort of a
    pair's rows. A null pair or day finds nothing.
    """
    daily = rates.where(F.col(pair).isNotNull() & F.col(day).isNotNull() & F.col("rate").isNotNull()).groupBy(pair, day).agg(F.max("rate").alias("rate"))
    entry = F.struct(F.col(day).alias("day"), "rate")
    months = daily.groupBy(pair, F.trunc(day, "month").alias("_month")).agg(F.sort_array(F.collect_list(entry)).alias("_days"))
    # One row a month: a window here sees a calendar, not quotes.
    in_turn = Window.partitionBy(pair).orderBy("_month")
    horizon = rows.agg(F.trunc(F.max(day), "month")).scalar()
    next_month = F.coalesce(F.lead("_month").over(in_turn), F.greatest(F.add_months(horizon, 1), F.add_months("_month", 1)))
    months = months.select(pair, "_month", "_days", F.element_at(F.lag("_days").over(in_turn), -1).alias("_left"), next_month.alias("_next"))
    covered = months.withColumn("_covers", F.explode(F.sequence("_month", F.add_months("_next", -1), F.expr("interval 1 month"))))
    own = F.col("_covers") == F.col("_month")
    covered = covered.select(
        pair,
        F.col("_covers").alias("_month"),
        F.when(own, F.col("_days")).otherwise(F.array().cast(months.schema["_days"].dataType)).alias("_days"),
        F.when(own, F.col("_left")).otherwise(F.element_at("_days", -1)).alias("_left"),
    )
    met = rows.withColumn("_month", F.trunc(day, "month")).join(covered, [pair, "_month"], "left")
    before = F.filter("_days", lambda x: x["day"] <= F.col(day))
    found = F.coalesce(F.try_element_at(before, F.lit(-1)), F.col("_left"))
    return met.withColumn("_found", found).select(*rows.columns, F.col("_found.rate").alias(out), F.col("_found.day").alias(f"{out}_day"))


def convert(price: Column, currency: Column, rate: Column) -> Column:
    """Whole TWD, half to even; null where it cannot be told."""
    code = F.upper(F.trim(F.coalesce(currency, F.lit(""))))
    return (
        F.when(code == "TWD", F.bround(price, 0))
        .when(code == "USD", F.bround(price * rate, 0))
        .cast(AMOUNT)
    )


def requote(entry: Column, rate: Column) -> Column:
    """Refresh the TWD value of a carried competing quote."""
    amount = entry["price"].try_cast("decimal(18,4)")
    currency = F.coalesce(F.nullif(entry["currency"], F.lit("")), F.lit("USD"))
    twd = convert(amount, currency, rate).cast("string")
    return F.when(entry["price"].isNull(), entry).otherwise(
        F.struct(
            entry["price"].alias("price"),
            entry["currency"].alias("currency"),
            twd.alias("price_twd"),
        )
    )


def apply_rate(quotes: DataFrame, rate: Column) -> DataFrame:
    """Set price_twd and fx_rate on quotes and on the quotes they carry.

    `fx_rate` is set for every USD quote, priced or not.
    """
    with_rate = quotes.withColumn("_rate", rate.cast(RATE))
    r = F.col("_rate")
    return with_rate.withColumns(
        {
            "price_twd": convert(F.col("price"), F.col("currency"), r),
            "fx_rate": F.when(F.upper("currency") == "USD", r),
            "other_sources": F.transform_values("other_sources", lambda _s, q: requote(q, r)),
        }
    ).drop("_rate")


def amount() -> Column:
    """What quotes are compared by: TWD where known, else the raw number."""
    return F.coalesce(F.col("price_twd").cast("decimal(24,4)"), F.col("price").cast("decimal(24,4)"))
