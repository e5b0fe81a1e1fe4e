"""Archive tables once stored."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.functions import text
from pricetrail.functions.months import month_start
from pricetrail.operators.winners import latest_of
from pricetrail.sources.tables import pick, pick_column


def contents(tables: Mapping[str, DataFrame], stamp: str = "_schedule_code") -> DataFrame:
    """Rows and schedules held by each table; a table without the stamp has NULL schedules."""
    counted = []
    for name, df in sorted(tables.items()):
        schedules = F.countDistinct(stamp) if stamp in df.columns else F.lit(None).cast("bigint")
        counted.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"), schedules.alias("n_schedules")).select(
                F.lit(name).alias("table_name"), "n_rows", "n_schedules"
            )
        )
    return reduce(DataFrame.unionByName, counted)


def typed_items(bronze: DataFrame) -> DataFrame:
    """All-text archive items as typed rows; dates and prices that do not parse become NULL."""
    return bronze.withColumns(
        {
            "effective_date": F.col("_effective_date").try_cast("date"),
            "determined_price": F.col("determined_price").try_cast("decimal(18,6)"),
            "organisation_id": text.whole_id(F.col("organisation_id")),
        }
    )


def superseding(items: DataFrame) -> DataFrame:
    """Per item and calendar month, the price of the month's last schedule.

    Schedules of a month that say the same of an item are combined before the shuffle.
    """
    usable = items.where(F.col("determined_price").isNotNull() & F.col("effective_date").isNotNull())
    kept = [c for c in items.columns if c not in ("li_item_id", "effective_date")]
    dated = usable.withColumn("month", month_start(F.col("effective_date")))
    last = latest_of(dated, ["li_item_id", "month"], "effective_date", kept)
    return last.select("li_item_id", "month", *[c for c in items.columns if c != "li_item_id"])


def with_organisation(items: DataFrame, organisations: DataFrame | None) -> DataFrame:
    """Add the responsible person by organisation and schedule date.

    Ids are compared as text, ``102.0`` being ``102``. Without a usable organisation
    table the name is NULL.
    """
    unknown: Column = F.lit(None).cast("string")
    if organisations is None:
        return items.withColumn("responsible", unknown)
    key = pick(organisations, ["organisation_id", "id"])
    name = pick(organisations, ["organisation_name", "name", "responsible_person"])
    if key is None or name is None:
        return items.withColumn("responsible", unknown)
    named = organisations.select(
        text.whole_id(F.col(key)).alias("__org"),
        F.col("effective_date"),
        F.col(name).alias("responsible"),
    )
    return (
        items.withColumn("__org", text.whole_id(F.col("organisation_id")))
        .join(named, ["__org", "effective_date"], "left")
        .drop("__org")
    )


# Price columns and what archive items call them.
_PRICE_COLUMNS = {
    "item_code": ["pbs_code"], "drug": ["li_drug_name", "drug_name"], "form": ["li_form"], "brand": ["brand_name"],
    "formulary": ["formulary"], "amt_pack": ["pack", "amt_pack"], "first_listed_date": ["first_listed_date"],
}


def price_rows(monthly: DataFrame, organisations: DataFrame | None = None) -> DataFrame:
    """Superseding items as the price rows that series and matrices are made of.

    Columns that the items lack are NULL; formularies are named by their rule.
    """
    named = with_organisation(monthly, organisations)
    columns = {c: pick_column(named, *names) for c, names in _PRICE_COLUMNS.items()}
    columns["formulary"] = text.formulary(columns["formulary"])
    return named.select(
        *[c.alias(n) for n, c in columns.items()], "responsible",
        F.col("month").alias("snapshot_date"), F.col("determined_price").alias("aemp"),
    )
