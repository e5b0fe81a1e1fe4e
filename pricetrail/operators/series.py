"""Price series and what is read off them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.functions import numbers, text
from pricetrail.functions.months import four_month_bucket, month_name, month_start
from pricetrail.operators.ordering import in_order, places

_SHOWN = ["item_code", "brand", "form", "formulary", "amt_pack", "responsible"]
_KEYED = ["drug", "form", "brand", "responsible", "amt_pack"]
_IDS = ["item_code", "drug", "form", "brand", "formulary", "responsible", "amt_pack", "first_listed_date"]


def price_series(prices: DataFrame, drugs: Sequence[str] | None = None) -> DataFrame:
    """Long series over the selected drugs, or all: mean price per identity and month.

    Names and keys start with the drug, so series of different drugs stay
    apart. The drug filter sits below the aggregation. Names are made once per
    identity, whose months are gathered meanwhile: prices are read once.
    """
    points, ids = _monthly_points(prices, drugs)
    return _series_points(points, ids, drugs)


def _series_points(points: DataFrame, ids: list[str], drugs: Sequence[str] | None, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Named points; rows dealt by the columns ``dealt_by``, which are kept, stay where they are."""
    # An identity has a point per month at most: few enough to travel in one row while it is named.
    identities = points.groupBy(*dealt_by, *ids).agg(F.collect_list(F.struct("month", "aemp")).alias("points"))
    named = _named(identities, drugs)
    return named.select(*[c for c in named.columns if c != "points"], F.inline("points")).select(
        "month", "display_name", "aemp", "item_code", "form", "responsible", "amt_pack",
        "series_id", "first_listed_date", F.col("selected").alias("drug"), *dealt_by,
    )


def _monthly_points(prices: DataFrame, drugs: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Mean price per identity and month, and the columns that make an identity."""
    ids = [c for c in _IDS if c in prices.columns]
    if drugs is not None:
        prices = prices.where(F.lower("drug").isin([d.lower() for d in drugs]))
    usable = prices.where(F.col("aemp").isNotNull() & F.col("snapshot_date").isNotNull())
    usable = usable.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ids})
    points = usable.groupBy(*ids, month_start(F.col("snapshot_date")).alias("month")).agg(
        (F.sum("aemp").cast("double") / F.count("aemp")).alias("aemp")
    )
    return points, ids


def _named(identities: DataFrame, drugs: Sequence[str] | None) -> DataFrame:
    if "first_listed_date" not in identities.columns:
        identities = identities.withColumn("first_listed_date", F.lit(None).cast("string"))
    if drugs is None:
        tagged = identities.withColumn("selected", F.col("drug"))
    else:
        # The user's own list of picks, each spelling apart, as a literal.
        spelt: dict[str, list[str]] = {}
        for d in dict.fromkeys(drugs):
            spelt.setdefault(d.lower(), []).append(d)
        picked = F.lit(None).cast("array<string>")
        for low, names in spelt.items():
            picked = F.when(F.lower("drug") == low, F.array(*[F.lit(n) for n in names])).otherwise(picked)
        tagged = identities.withColumn("selected", F.explode(picked))
    return tagged.withColumns(
        {
            "display_name": F.concat(
                F.col("selected"), F.lit(" · "), text.display_name([F.col(c) for c in _SHOWN])
            ),
            "series_id": F.concat(
                F.col("selected"), F.lit("|"), text.series_key(*[F.col(c) for c in _KEYED])
            ),
        }
    )


def in_range(series: DataFrame, first=None, last=None, picked: Sequence[str] = ()) -> DataFrame:
    """Series points of a month range and of the picked names; no pick means all."""
    if first is not None:
        series = series.where(F.col("month") >= F.lit(first))
    if last is not None:
        series = series.where(F.col("month") <= F.lit(last))
    return series.where(F.col("display_name").isin(list(picked))) if picked else series


def monthly_mean(prices: DataFrame) -> DataFrame:
    """Mean price per drug and snapshot month over all its variants."""
    return (
        prices.where(F.col("aemp").isNotNull())
        .groupBy(F.lower("drug").alias("drug"), F.col("snapshot_date").alias("month"))
        .agg((F.sum("aemp").cast("double") / F.count("aemp")).alias("aemp"))
    )


def line_listing(dim: DataFrame, facts: DataFrame, drug: str | None = None) -> DataFrame:
    """Prices per line in month order. Ids are packed while rows are joined and put in order."""
    if drug is not None:
        dim = dim.where(F.lower("name_a") == drug.lower())
    line = text.packed_id(F.col("product_line_id")).alias("__line")
    whole = text.unpacked_id(F.col("__line")).cast(dict(facts.dtypes)["product_line_id"])
    lines = dim.select(line, F.col("item_code_b").alias("item_code")).hint("merge")
    listed = facts.select(line, F.col("snapshot_date").alias("month"), "aemp").join(lines, "__line")
    return listed.orderBy("month", whole, "item_code").select("month", whole.alias("product_line_id"), "item_code", "aemp")


def coverage(series: DataFrame) -> DataFrame:
    """First and last month of every series and name."""
    spans = series.groupBy("series_id", "display_name").agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month")
    )
    return spans.withColumns(
        {
            "first_month_text": month_name(F.col("first_month")),
            "last_month_text": month_name(F.col("last_month")),
        }
    )


def overall_coverage(series: DataFrame) -> DataFrame:
    return series.agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def identifiers(series: DataFrame) -> DataFrame:
    return series.select("series_id", "display_name").distinct().orderBy("display_name", "series_id")


_IN_SERIES = ("month", "display_name", "aemp", "item_code", "first_listed_date")


def change_points(series: DataFrame, sliced: bool = False) -> DataFrame:
    """First and last point of each series and the points around each price change.

    All flags come from the neighbours in one sort order (month, name, price).
    A series is bounded by its months and names; ``sliced`` is for series that are not.
    """
    return _at_changes(_with_neighbours(series, ["series_id"], sliced))


def series_changes(prices: DataFrame, drugs: Sequence[str] | None = None) -> DataFrame:
    """``change_points`` of ``price_series``, straight from the prices and with one shuffle less.

    Points are dealt once, by a loose form of the series key. All points of an identity and all identities of a series
    lie in one partition from there on, so that gathering, naming and looking at neighbours move no rows.
    """
    points, ids = _monthly_points(prices, drugs)
    dealt = points.withColumn("__near", text.loose_key(*[F.col(c) for c in _KEYED])).repartition("__near")
    named = _series_points(dealt, ids, drugs, ["__near"])
    return _at_changes(_with_neighbours(named, ["__near", "series_id"])).drop("__near")


def _with_neighbours(series: DataFrame, keys: Sequence[str], sliced: bool = False) -> DataFrame:
    return in_order(
        series, keys, [F.col(c) for c in _IN_SERIES],
        previous={"prev_aemp": "aemp"}, following={"next_aemp": "aemp"}, sliced=sliced,
    )


def _at_changes(seen: DataFrame) -> DataFrame:
    """Rows that start or end a series or stand next to a change, from rows with prev_aemp and next_aemp."""
    flagged = seen.withColumns(
        {
            "is_first_point": F.col("prev_aemp").isNull(),
            "is_last_point": F.col("next_aemp").isNull(),
            "is_before_change": F.coalesce(F.col("aemp") != F.col("next_aemp"), F.lit(False)),
            "is_after_change": F.coalesce(F.col("aemp") != F.col("prev_aemp"), F.lit(False)),
        }
    )
    kept = flagged.where("is_first_point OR is_last_point OR is_before_change OR is_after_change")
    return kept.withColumn("price_label", numbers.money_text(F.col("aemp")))


def price_crowding(points: DataFrame, sliced: bool = True) -> DataFrame:
    """Place and size of each point among points of like month, price and side.

    Nothing bounds the points of a month and price band, so they are placed in slices.
    """
    placed = points.withColumns(
        {
            "month_bucket": four_month_bucket(F.col("month")),
            "price_band": numbers.price_band(F.col("aemp")),
            "label_side": F.when(F.col("is_after_change"), "bottom").otherwise("top"),
        }
    )
    order = [F.col(c) for c in ("series_id", "month", "display_name", "aemp", "item_code", "first_listed_date")]
    place = places if sliced else in_order
    ranked = place(
        placed, ["month_bucket", "price_band", "label_side"], order, row_number="__rn", group_size="collision_size"
    )
    return ranked.withColumn("collision_rank", F.col("__rn") - 1).drop("__rn")


def first_last_prices(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last price, month span and earliest listing per group, combined before the shuffle."""
    order = F.struct("month", "display_name", "aemp")
    return series.groupBy(*keys).agg(
        F.min(order).getField("aemp").alias("first_aemp"),
        F.max(order).getField("aemp").alias("last_aemp"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.min(F.col("first_listed_date").try_cast("date")).alias("listed"),
    )


def drug_codes(pairs: DataFrame) -> DataFrame:
    """Each drug with its sorted item codes and a search label."""
    clean = pairs.select(
        text.collapse_ends(F.coalesce("drug", F.lit(""))).alias("drug"),
        text.blank_to_null(text.collapse_ends(F.col("item_code"))).alias("item_code"),
    ).distinct()
    listed = clean.groupBy("drug").agg(F.array_sort(F.collect_list("item_code")).alias("item_codes"))
    joined = F.array_join("item_codes", ", ")
    return listed.withColumn(
        "search_label",
        F.when(F.size("item_codes") > 0, F.concat(F.col("drug"), F.lit(" | "), joined)).otherwise(F.col("drug")),
    )


def matching_drugs(listed: DataFrame, search: str) -> DataFrame:
    """Drugs holding any of the codes named by one search text; a blank search keeps all."""
    if not search.strip():
        return listed
    codes = F.transform("item_codes", lambda c: F.lower(c))
    return listed.where(F.arrays_overlap(codes, text.search_tokens(F.lit(search))))


def match_searches(searches: DataFrame, pairs: DataFrame) -> DataFrame:
    """Drugs for a whole table of search texts, by an equi-join on single codes."""
    codes = searches.select("search", F.explode(text.search_tokens(F.col("search"))).alias("code")).distinct()
    listed = pairs.select("drug", F.lower(text.collapse_ends(F.col("item_code"))).alias("code")).distinct()
    return codes.join(listed, "code").select("search", "drug").distinct()
