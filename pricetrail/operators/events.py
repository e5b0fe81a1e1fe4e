"""Pricing events with the item and its price before and after."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetrail.functions import numbers, text


def previous_schedules(items: DataFrame) -> DataFrame:
    """Each schedule date with the one before it.

    The unpartitioned window sees distinct schedule dates only, one row per
    published list.
    """
    dates = items.select("effective_date").where("effective_date IS NOT NULL").distinct()
    return dates.withColumn("prev_date", F.lag("effective_date").over(Window.orderBy("effective_date")))


def is_combination(code: Column) -> Column:
    """Flag of combination items; NULL for a NULL code."""
    return code.contains("COMBO")


def price_events(events: DataFrame, items: DataFrame) -> DataFrame:
    """One row per event: item attributes of its schedule, price then and one schedule earlier.

    "Before" is the schedule directly before, not the last known price: an item
    absent there has no price before. Both joins are plain equi-joins on (item,
    date); the schedule map and small item tables are broadcast by size, by
    Spark itself.
    """
    return _with_prices(events, previous_schedules(items), items, items)


def batch_price_events(events: DataFrame, items: DataFrame, schedules: DataFrame, first: date) -> DataFrame:
    """``price_events`` of the events from ``first`` on, for items that are stored by ``effective_date``.

    The schedules of the batch and the ones before them are known from the small ``schedules`` table. Their
    dates are sent to the scans of the items, so that only the folders of those dates are opened: by the
    batch's own dates for the price after, by the dates before for the price before.
    """
    since = F.lit(first)
    dates = previous_schedules(schedules).where(F.col("effective_date") >= since)

    def of_dates(column: str) -> DataFrame:
        wanted = dates.select(F.col(column).alias("__wanted")).where(F.col(column).isNotNull()).distinct()
        # A date per schedule of the batch.
        return items.join(F.broadcast(wanted), F.col("effective_date") == F.col("__wanted"), "left_semi")

    batch = events.where(F.col("effective_date") >= since)
    return _with_prices(batch, dates, of_dates("effective_date"), of_dates("prev_date"))


def _with_prices(events: DataFrame, dates: DataFrame, items: DataFrame, earlier: DataFrame) -> DataFrame:
    cur = items.select(
        "li_item_id", "effective_date", "pbs_code", "li_drug_name", "brand_name", "formulary",
        F.col("determined_price").alias("price_after"),
    )
    before = earlier.select(
        "li_item_id",
        F.col("effective_date").alias("prev_date"),
        F.col("determined_price").alias("price_before"),
    )
    return (
        events.join(dates, "effective_date", "left")
        .join(cur, ["li_item_id", "effective_date"], "left")
        .join(before, ["li_item_id", "prev_date"], "left")
        .select(
            "li_item_id", "pbs_code", "li_drug_name", "brand_name", "formulary",
            F.col("effective_date").alias("event_date"),
            "event_type_code",
            text.event_label(F.col("event_type_code")).alias("event_label"),
            is_combination(F.col("event_type_code")).alias("is_combination"),
            F.col("percentage_applied").cast("double").alias("percentage_applied"),
            numbers.to_price(F.col("price_before")).alias("price_before"),
            numbers.to_price(F.col("price_after")).alias("price_after"),
        )
    )


def events_per_label(events: DataFrame) -> DataFrame:
    return events.groupBy("event_label").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), F.col("event_label").asc_nulls_first()
    )


def spot_check(events: DataFrame, pbs_code: str, event_date: str, rows: int = 3) -> DataFrame:
    """The first few events of one item on one date."""
    found = events.where(
        (F.col("pbs_code") == pbs_code) & (F.col("event_date") == F.lit(event_date).cast("date"))
    )
    columns = [
        "pbs_code", "li_drug_name", "brand_name", "event_date", "event_label",
        "percentage_applied", "price_before", "price_after",
    ]
    ties = [F.col(c) for c in ("event_type_code", "percentage_applied", "price_before", "price_after")]
    return found.orderBy("li_item_id", *ties).select("li_item_id", *columns).limit(rows)


def reconcile(source: DataFrame, derived: DataFrame) -> DataFrame:
    """Row counts of events in and out, and events without a matching item."""
    one = F.lit(1).cast("bigint")
    nothing = F.lit(0).cast("bigint")
    counted = source.select(one.alias("s"), nothing.alias("d"), nothing.alias("m")).unionByName(
        derived.select(
            nothing.alias("s"),
            one.alias("d"),
            F.when(F.col("li_drug_name").isNull(), one).otherwise(nothing).alias("m"),
        )
    )
    return counted.agg(
        F.sum("s").alias("source_rows"),
        F.sum("d").alias("derived_rows"),
        (F.sum("s") == F.sum("d")).alias("rows_match"),
        F.sum("m").alias("rows_without_item"),
    )
