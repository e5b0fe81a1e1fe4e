"""Stored tables and their adaptable columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def load_spread(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table, spread over all cores where the session asks for it.

    A scan cannot split a file of one row group, as the small benchmark tables
    are: a session for those sets ``spark.pricetrail.spread``. Otherwise tables are
    read as they lie, without a shuffle.
    """
    df = load(spark, folder, table)
    if spark.conf.get("spark.pricetrail.spread", "false") == "true":
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def pick(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The frame's own spelling of the first candidate it has, in any case."""
    have = {c.strip().lower(): c for c in df.columns}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def pick_column(df: DataFrame, *candidates: str) -> Column:
    """The first candidate column as text, else NULL."""
    found = pick(df, candidates)
    return F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")


def first_present(columns: Sequence[Column]) -> Column:
    """First non-NULL of several columns as text."""
    return F.coalesce(*[c.cast("string") for c in columns])


# Names under which the roles of a price warehouse occur.
DATE_NAMES = ["snapshot_date", "snapshot", "date"]
PRICE_NAMES = ["aemp", "exmanufacturerprice", "ex_manufacturer_price"]
LINE_KEYS = [
    "product_line_id", "product_id", "line_id", "product_line", "dim_product_line_id", "pl_id", "id",
]
WIDE_NAMES = {
    "Responsible Person": [
        "Responsible Person", "Responsible Person Name", "Sponsor", "Sponsor Name", "responsible_person",
    ],
    "AMT Trade Product Pack": [
        "AMT Trade Product Pack", "AMT Trade Pack", "amt_trade_product_pack",
    ],
    "Item Code": ["Item Code", "Item Code B", "item_code_b", "item_code"],
    "Legal Instrument Form": [
        "Legal Instrument Form", "legal_instrument_form", "variant_signature_base",
    ],
}


def detect_roles(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """Which table holds prices, which holds lines, and the columns that tie them."""
    roles: dict[str, str] = {}
    for name, df in tables.items():
        when, price = pick(df, DATE_NAMES), pick(df, PRICE_NAMES)
        if when and price:
            roles = {"price_table": name, "date_column": when, "price_column": price}
            break
    if not roles:
        raise ValueError("no table has both a date and a price column")
    in_prices = {c.lower() for c in tables[roles["price_table"]].columns}
    for name, df in tables.items():
        if name == roles["price_table"]:
            continue
        shared = [k for k in LINE_KEYS if k in in_prices and pick(df, [k])]
        if shared:
            return {**roles, "line_table": name, "join_column": shared[0]}
    raise ValueError("no table shares a key with the price table")


def canonical_wide(wide: DataFrame) -> DataFrame:
    """Rename known spellings of the identifier columns; absent ones become NULL."""
    for name, spellings in WIDE_NAMES.items():
        found = pick(wide, spellings)
        if found is None:
            wide = wide.withColumn(name, F.lit(None).cast("string"))
        else:
            wide = wide.withColumnRenamed(found, name).withColumn(name, F.col(f"`{name}`").cast("string"))
    return wide


def missing_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> list[str]:
    """Required tables that cannot be opened in ``folder``."""
    missing = []
    for name in names:
        try:
            load(spark, folder, name)
        except AnalysisException:
            missing.append(name)
    return missing
