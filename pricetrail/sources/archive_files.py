"""Landed archive bundles and API pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.session import store

# Bookkeeping keys that may slip into rows.
BOOKKEEPING = ["_meta", "_links"]

# The archive's tables.
ARCHIVE_TABLES = [
    "items", "organisations", "prescribers", "dispensing_rules",
    "item_dispensing_rule_relationships", "amt_items", "programs", "summary_of_changes",
]


def table_name(endpoint_or_stem: str) -> str:
    return endpoint_or_stem.replace("-", "_")


def read_bundle_csv(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """One archive CSV, every column text. The word ``null`` is NULL, an empty cell is ''.

    Files without line breaks inside cells can be split: pass
    ``quoted_newlines=False`` for those.
    """
    raw = spark.read.options(
        header=True, inferSchema=False, escape='"', multiLine=quoted_newlines
    ).csv(path)
    return raw.select(
        *[F.nullif(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit("null")).alias(c) for c in raw.columns]
    )


def read_pages(
    spark: SparkSession, path: str, multi_line: bool = True, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of landed JSON pages, every column text; nested values stay JSON text.

    The pages are opened once in either case. Without ``columns`` every row is read as
    names and texts and stored; the names there are then come from the stored rows. Each value is
    read as text, so rows whose nested keys differ need no common shape.
    """
    if columns:
        return _page_rows(spark, path, multi_line, columns)
    schema = "data array<map<string, string>>"
    pages = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    rows = pages.select(F.explode("data").alias("row")).where(F.col("row").isNotNull())
    rows = store(rows.select("row", F.map_keys("row").alias("names")), "page-rows")
    # One name per column of the table.
    found = rows.select(F.explode("names").alias("name")).distinct()
    names = sorted(r.name for r in found.collect() if r.name not in BOOKKEEPING)
    if not names:
        return spark.createDataFrame([], T.StructType())
    return rows.select(*[F.col("row")[n].alias(n) for n in names])


def read_variant_rows(spark: SparkSession, path: str, multi_line: bool = True, at: str = "$.data") -> DataFrame:
    """Rows of landed JSON pages as one ``row`` of type variant, whatever their shape; the pages are opened once.

    Pages without a list at ``at`` have no rows. Elements that are null are left out.
    """
    pages = spark.read.option("multiLine", multi_line).option("singleVariantColumn", "page").json(path)
    rows = pages.select(F.explode(F.try_variant_get("page", at, "array<variant>")).alias("row"))
    return rows.where(F.col("row").isNotNull() & ~F.is_variant_null("row"))


def typed_fields(rows: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns (path, type) picked from variant rows; what is absent or of another kind is NULL."""
    return rows.select(*[F.try_variant_get("row", path, kind).alias(name) for name, (path, kind) in fields.items()])


def variant_shape(rows: DataFrame) -> DataFrame:
    """One row: the common schema of all variant rows, as text; combined per task before the shuffle."""
    return rows.agg(F.schema_of_variant_agg("row").alias("shape"))


def _page_rows(spark: SparkSession, path: str, multi_line: bool, names: Sequence[str]) -> DataFrame:
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([T.StructField("data", T.ArrayType(as_text))])
    pages = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    return pages.select(F.inline("data"))


def without_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)


def nested_text(c: Column) -> Column:
    """A struct, map or array column as JSON text."""
    return F.to_json(c)


def newest_first(schedules: DataFrame) -> DataFrame:
    return schedules.orderBy(F.col("effective_date").desc(), F.col("schedule_code"))


def target_schedules(schedules: DataFrame, code: str | None = None, backfill: bool = False) -> DataFrame:
    """Schedules to load: one by code, all (oldest first), or the latest."""
    if code is not None:
        return schedules.where(F.col("schedule_code").cast("string") == str(code))
    if backfill:
        return schedules.orderBy("effective_date", "schedule_code")
    return newest_first(schedules).limit(1)
