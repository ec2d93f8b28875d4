"""Dated snapshots compared with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from faremeld.functions.names import MATCH_KEY


def snapshot_calendar(snapshots: DataFrame) -> DataFrame:
    """Snapshots that exist, each with its neighbours; days may be missing."""
    days = snapshots.select("snapshot_date").distinct()
    # One row per snapshot: a window over the whole calendar is a short list.
    w = Window.partitionBy(F.lit(1)).orderBy("snapshot_date")
    return days.select(
        "snapshot_date",
        F.lag("snapshot_date").over(w).alias("prev_snapshot"),
        F.lead("snapshot_date").over(w).alias("next_snapshot"),
    )


def price_changes(
    snapshots: DataFrame, key: list[str] = MATCH_KEY, price: str = "price_twd", calendar: DataFrame | None = None
) -> DataFrame:
    """What happened to each sailing between neighbouring snapshots.

    `change`: new, same, up, down, or requoted when a price came or went.
    `dropped`: the sailing is gone in the next snapshot. A snapshot holds a
    sailing at most once, so a window sees at most one row per snapshot.
    `calendar` (as of `snapshot_calendar`, or of the store, whose commits know
    it) saves reading the snapshots a second time for their days alone.
    """
    calendar = snapshot_calendar(snapshots) if calendar is None else calendar
    w = Window.partitionBy(*key).orderBy("snapshot_date")
    rows = snapshots.join(calendar, "snapshot_date").withColumns(
        {
            "_seen": F.lag("snapshot_date").over(w),
            "_prev": F.lag(price).over(w),
            "_next": F.lead("snapshot_date").over(w),
        }
    )
    is_new = F.col("_seen").isNull() | (F.col("_seen") != F.col("prev_snapshot"))
    now, before = F.col(price), F.col("_prev")
    change = (
        F.when(is_new, "new")
        .when(now.eqNullSafe(before), "same")
        .when(now.isNull() | before.isNull(), "requoted")
        .when(now > before, "up")
        .otherwise("down")
    )
    dropped = F.col("next_snapshot").isNotNull() & (
        F.col("_next").isNull() | (F.col("_next") != F.col("next_snapshot"))
    )
    return rows.withColumns(
        {
            "previous_price": F.when(~is_new, before),
            "change": change,
            "dropped": dropped,
        }
    ).drop("_seen", "_prev", "_next", "prev_snapshot", "next_snapshot")
