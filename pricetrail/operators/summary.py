"""Event markers, exemptions and summary cards.

Events and item codes are reduced to distinct (code, month, label) and (group,
code) rows before they meet, so one busy code or month is a handful of rows by
the time it is shuffled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.functions import numbers, text
from pricetrail.functions.months import month_name, month_start

GROUP = ["drug", "form"]
_CENTS = "decimal(18,2)"


def _code(c: str) -> Column:
    return text.collapse_ends(F.col(c))


def code_ends(series: DataFrame) -> DataFrame:
    """One row per drug, form, series and item code with its first and last point.

    All parts of a summary card are read off these rows, so the series itself
    is gone over once. Worth storing where several parts are wanted.
    """
    order = F.struct("month", "display_name", "aemp")
    return series.groupBy(*GROUP, "series_id", "item_code").agg(
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.min(F.col("first_listed_date").try_cast("date")).alias("listed"),
    )


def codes_of_prices(prices: DataFrame) -> DataFrame:
    """Drug, form and item code of the priced rows: all that code lists need of a series."""
    priced = prices.where(F.col("aemp").isNotNull() & F.col("snapshot_date").isNotNull())
    return priced.select(*[F.coalesce(c, F.lit("")).alias(c) for c in (*GROUP, "item_code")]).distinct()


def visible_codes(series: DataFrame) -> DataFrame:
    return series.select(_code("item_code").alias("code")).distinct()


def events_in_view(events: DataFrame, series: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Event counts per (code, month, label) for the codes and months in view."""
    counted = (
        events.select(
            _code("pbs_code").alias("code"),
            month_start(F.col("event_date")).alias("month"),
            F.coalesce("event_label", F.lit("None")).alias("event_label"),
        )
        .where("month IS NOT NULL")
        .groupBy("code", "month", "event_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if first is not None:
        counted = counted.where(F.col("month") >= F.lit(first))
    if last is not None:
        counted = counted.where(F.col("month") <= F.lit(last))
    return counted.join(visible_codes(series), "code", "left_semi")


def event_markers(in_view: DataFrame) -> DataFrame:
    """Events and their distinct labels per month."""
    per_label = in_view.groupBy("month", "event_label").agg(F.sum("n").alias("n"))
    return per_label.groupBy("month").agg(
        F.sum("n").alias("event_count"),
        F.array_join(F.array_sort(F.collect_list("event_label")), ", ").alias("event_labels"),
    )


def exempt_codes(amt_items: DataFrame, items: DataFrame) -> DataFrame:
    """Codes exempt in the latest schedule.

    The latest date is a scalar subquery, so both tables are filtered to it
    before they are joined.
    """
    latest = amt_items.agg(F.max("effective_date")).scalar()
    flagged = amt_items.where(
        (F.col("concept_type_code") == "MPUU") & (F.col("exempt_ind") == "Y") & (F.col("effective_date") == latest)
    ).select("li_item_id").distinct()
    listed = items.where(F.col("effective_date") == latest).select("li_item_id", "pbs_code")
    return listed.join(flagged, "li_item_id").select(_code("pbs_code").alias("code")).distinct()


def exemption_text(exempt: Column, total: Column) -> Column:
    return (
        F.when(exempt == 0, "Not exempt")
        .when(exempt == total, "Exempt (s84AH)")
        .otherwise(F.concat(exempt.cast("string"), F.lit(" of "), total.cast("string"), F.lit(" item codes exempt")))
    )


def group_codes(series: DataFrame) -> DataFrame:
    """Distinct item codes per drug and form."""
    return series.select(*GROUP, _code("item_code").alias("code")).distinct()


def exemption_class(series: DataFrame, exempt: DataFrame) -> DataFrame:
    """Per drug and form: no, some or all item codes exempt."""
    flagged = group_codes(series).join(exempt.select("code", F.lit(1).alias("hit")), "code", "left")
    counted = flagged.groupBy(*GROUP).agg(F.count("hit").alias("n_exempt"), F.count(F.lit(1)).alias("n_codes"))
    return counted.withColumn("exempt", exemption_text(F.col("n_exempt"), F.col("n_codes")))


def last_events(series: DataFrame, in_view: DataFrame) -> DataFrame:
    """Per drug and form: the last month with events and the labels of that month."""
    seen = group_codes(series).join(in_view.select("code", "month", "event_label"), "code")
    per_month = (
        seen.select(*GROUP, "month", "event_label").distinct()
        .groupBy(*GROUP, "month")
        .agg(F.array_join(F.array_sort(F.collect_list("event_label")), ", ").alias("labels"))
    )
    return per_month.groupBy(*GROUP).agg(
        F.max("month").alias("last_event_month"), F.max_by("labels", "month").alias("last_event_labels")
    )


def summary_cards(ends: DataFrame, in_view: DataFrame, exempt: DataFrame) -> DataFrame:
    """One card per drug and form, from the ``code_ends`` of the series in view.

    Agreement of all series on a price is read from the smallest and largest
    of their first and last prices, so no list of prices is ever built.
    """
    per_series = ends.groupBy(*GROUP, "series_id").agg(
        F.min("first").getField("aemp").alias("first_aemp"),
        F.max("last").getField("aemp").alias("last_aemp"),
        F.min("first.month").alias("first_month"),
        F.max("last.month").alias("last_month"),
        F.min("listed").alias("listed"),
    )
    first, last = F.col("first_aemp").cast("decimal(18,6)"), F.col("last_aemp").cast("decimal(18,6)")
    groups = per_series.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_series"),
        F.min("first_month").alias("first_month"),
        F.max("last_month").alias("last_month"),
        F.min("listed").alias("listed"),
        F.min(F.round(first, 2).cast(_CENTS)).alias("first_low"),
        F.max(F.round(first, 2).cast(_CENTS)).alias("first_high"),
        F.min(F.round(last, 2).cast(_CENTS)).alias("last_low"),
        F.max(F.round(last, 2).cast(_CENTS)).alias("last_high"),
    )
    low, high = numbers.money_text(F.col("last_low")), numbers.money_text(F.col("last_high"))
    agreed = (
        (F.col("first_low") == F.col("first_high"))
        & (F.col("last_low") == F.col("last_high"))
        & (F.col("first_low") != 0)
    )
    change = numbers.two_places(numbers.percent_change(F.col("first_low"), F.col("last_low")))
    dash = F.lit(" – ")
    return (
        groups.join(last_events(ends, in_view), GROUP, "left")
        .join(exemption_class(ends, exempt), GROUP)
        .select(
            *GROUP,
            F.concat(month_name(F.col("first_month")), dash, month_name(F.col("last_month"))).alias("range"),
            F.coalesce(month_name(F.col("listed")), F.lit("unknown")).alias("first_listed"),
            F.when(F.col("last_low") == F.col("last_high"), low).otherwise(F.concat(low, dash, high)).alias("latest"),
            F.when(
                agreed,
                F.concat(
                    numbers.percent_text(change, signed=True), F.lit(" from "), numbers.money_text(F.col("first_low"))
                ),
            )
            .otherwise(F.concat(F.lit("varies across "), F.col("n_series").cast("string"), F.lit(" products")))
            .alias("change"),
            F.coalesce(
                F.concat(month_name(F.col("last_event_month")), F.lit(" · "), F.col("last_event_labels")),
                F.lit("none in view"),
            ).alias("last_event"),
            "exempt",
        )
    )
