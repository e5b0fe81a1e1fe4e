"""Prices that rose or fell between two months."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.functions import numbers, text
from pricetrail.functions.numbers import PRICE
from pricetrail.operators.ordering import FAN, middle_values
from pricetrail.session import store
from pricetrail.sources.tables import first_present, pick_column

KEYS = ["item_code", "drug", "form", "brand", "responsible"]


def latest_months(prices: DataFrame, n: int = 2) -> DataFrame:
    """The latest distinct snapshot dates that have a price, newest first."""
    months = prices.where(F.col("aemp").isNotNull()).select(F.col("snapshot_date").alias("month")).distinct()
    return months.orderBy(F.col("month").desc()).limit(n)


def star_prices(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Prices of a stored star under the names of a flat price list.

    Brand and responsible person are the fact's, else the line's, if it has any. Lines grow with the data and are not sent to all tasks.
    """
    lines = {
        "item_code": ["item_code_b", "item_code"], "drug": ["name_a", "drug"], "form": ["attr_c", "form"],
        "brand": ["brand_name", "brand"], "responsible": ["responsible_person", "responsible"],
    }
    line = text.packed_id(F.col("product_line_id")).alias("__line")
    prefixed = dim.select(line, *[F.col(c).alias(f"line_{c}") for c in dim.columns if c != "product_line_id"])
    joined = facts.withColumn("__line", line).join(prefixed.hint("merge"), "__line")
    kept = [c for c in ("snapshot_month",) if c in facts.columns]
    return joined.select(
        *[
            first_present([pick_column(facts, *names), pick_column(joined, *[f"line_{n}" for n in names])]).alias(c)
            for c, names in lines.items()
        ],
        "snapshot_date", "aemp", *kept,
    )


def movers(
    prices: DataFrame, start: date, end: date, rising: bool = True, drugs: Sequence[str] = ()
) -> DataFrame:
    """Items whose summed price rose (or fell) from ``start`` to ``end``, largest change first.

    Only the two dates are read; both sums come from one aggregation.
    """
    if start >= end:
        raise ValueError("the end month must be after the start month")
    two = prices.where(F.col("snapshot_date").isin(start, end))
    if "snapshot_month" in prices.columns:  # stored by month: two folders are read
        two = two.where(F.col("snapshot_month").isin(f"{start:%Y-%m}", f"{end:%Y-%m}"))
    if drugs:
        two = two.where(F.lower("drug").isin([d.lower() for d in drugs]))
    sums = two.groupBy(*KEYS).agg(
        F.sum(F.when(F.col("snapshot_date") == F.lit(start), F.col("aemp"))).alias("s"),
        F.sum(F.when(F.col("snapshot_date") == F.lit(end), F.col("aemp"))).alias("e"),
    )
    moved = sums.where("s IS NOT NULL AND e IS NOT NULL").where("e > s" if rising else "e < s")
    change = F.col("e") - F.col("s") if rising else F.col("s") - F.col("e")
    return moved.orderBy(change.desc(), *KEYS).select(
        *KEYS,
        numbers.two_places(F.col("s")).alias("aemp_start"),
        numbers.two_places(F.col("e")).alias("aemp_end"),
        numbers.two_places(change).alias("abs_change"),
        numbers.two_places(numbers.percent_change(F.col("s"), F.col("e"))).alias("pct_change"),
    )


def summary(moved: DataFrame, fan: int = FAN) -> DataFrame:
    """Count, largest, median and total change.

    Equal changes are counted once, before any shuffle; all four figures come from these counts. The exact median
    is found by counting in intervals, so nothing is sorted.
    """
    values = moved.where(F.col("abs_change").isNotNull()).groupBy("abs_change").agg(F.count(F.lit(1)).alias("n"))
    values = store(values, "changes")
    median = middle_values(values, "abs_change", "n", fan)
    whole = F.sum(F.col("abs_change").cast("decimal(38,2)") * F.col("n")).cast("decimal(38,2)")
    return values.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_items"), F.max("abs_change").alias("largest"), whole.alias("total"),
    ).withColumn("median", F.lit(sum(median) / 2 if median else None).cast(PRICE))


def summary_text(summarised: DataFrame, rising: bool = True) -> DataFrame:
    sign, verb = ("+", "increased") if rising else ("−", "decreased")
    def amount(c):
        return F.concat(F.lit(sign), numbers.money_text(F.col(c)))
    return summarised.select(
        F.concat(
            F.lit("Summary: "), F.col("n_items").cast("string"), F.lit(f" items {verb}. Largest "),
            amount("largest"), F.lit(", median "), amount("median"), F.lit(", total "), amount("total"), F.lit("."),
        ).alias("summary")
    )
