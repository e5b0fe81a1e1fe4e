"""Snapshot rows to product lines, monthly facts and collisions.

A product line is (base identity, signature, price). Its id is a hash of those
parts, computed on the snapshot row itself, so a fact needs no join to find its
line and ids need no global numbering.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.functions import text
from pricetrail.functions.numbers import PRICE
from pricetrail.operators.ordering import in_order
from pricetrail.operators.winners import agreed
from pricetrail.sources.layouts import Layout

DIM_COLUMNS = [
    "product_line_id", "item_code_b", "name_a", "attr_c", "attr_f", "attr_g", "attr_j", "variant_no",
    "variety_signature", "group_key_no_b", "variant_signature_base", "variant_init_aemp",
]
_BASE_NAMES = {
    "item_code": "item_code_b", "drug": "name_a", "form": "attr_c",
    "formulary": "attr_f", "program": "attr_g", "pack_qty": "attr_j",
}
_ATTRIBUTES = {
    "moa": "moa", "brand": "brand_name", "manufacturer": "manufacturer_code",
    "responsible": "responsible_person", "pricing_qty": "pricing_qty", "max_qty": "max_qty",
    "max_repeats": "max_repeats", "amt_pack": "amt_trade_pack", "amt_pack_program": "amt_pack_program",
}


def signature(df: DataFrame, layout: Layout) -> Column:
    """Everything but the price that sets variants of one base apart."""
    return text.piped([F.col(c) if c in df.columns else F.lit(None).cast("string") for c in layout.signature])


def line_id(layout: Layout, price: str = "aemp") -> Column:
    parts = [F.col(c) for c in layout.base] + [F.col("variant_signature_base"), F.col(price)]
    return text.hashed_key(parts)


def base_key(df_layout: Layout) -> Column:
    return text.piped([F.col(c) for c in df_layout.base])


def signed(rows: DataFrame, layout: Layout) -> DataFrame:
    return rows.withColumn("variant_signature_base", signature(rows, layout))


def collisions(rows: DataFrame, layout: Layout) -> DataFrame:
    """Base and signature with more than one price in a snapshot, and those prices.

    Distinct prices are found first, so the shuffle of the second step carries
    each price once.
    """
    group = [*layout.base, "variant_signature_base", "snapshot_date", "source_file"]
    prices = signed(rows, layout).where(F.col("aemp").isNotNull()).select(*group, "aemp").distinct()
    found = prices.groupBy(*group).agg(
        F.count("aemp").alias("distinct_aemps"),
        F.array_join(F.array_sort(F.collect_list(F.col("aemp").cast("string"))), ", ").alias("example_aemps"),
    )
    return found.where("distinct_aemps > 1").select(
        base_key(layout).alias("base_key"),
        "snapshot_date", "distinct_aemps", "example_aemps", "source_file",
    )


def _parts(rows: DataFrame, layout: Layout) -> DataFrame:
    """What makes a line, and the date, of every row. NULL and '' are one part, as in the id, and written as NULL."""
    parts = [F.nullif(F.col(c), F.lit("")).alias(c) for c in layout.base]
    return signed(rows, layout).select(*parts, "variant_signature_base", "aemp", "snapshot_date")


def _lines(parts: DataFrame) -> DataFrame:
    """Distinct lines with the date each was first seen.

    All texts are keys of the group, so its only buffer is a date and it is hashed.
    """
    keys = [c for c in parts.columns if c != "snapshot_date"]
    return parts.groupBy(*keys).agg(F.min("snapshot_date").alias("first_seen"))


def _described(lines: DataFrame, layout: Layout) -> DataFrame:
    """Numbered lines as the dimension has them. Ids and joined texts are made here, after the shuffles."""
    return lines.select(
        line_id(layout).alias("product_line_id"),
        *[F.col(c).alias(_BASE_NAMES[c]) for c in layout.base],
        text.piped([F.col(c) for c in ("form", "formulary", "program", "pack_qty")]).alias("variety_signature"),
        text.piped([F.col(c) for c in ("drug", "form", "formulary", "program", "pack_qty")]).alias("group_key_no_b"),
        "variant_signature_base",
        F.col("aemp").alias("variant_init_aemp"),
        "variant_no",
    ).select(*DIM_COLUMNS)


def _numbered(lines: DataFrame, layout: Layout, sliced: bool) -> DataFrame:
    return in_order(
        lines,
        list(layout.base),
        [
            F.col("first_seen").asc(),
            F.col("aemp").desc_nulls_last(),
            F.col("variant_signature_base").asc(),
        ],
        row_number="variant_no",
        sliced=sliced,
    )


def product_lines(
    rows: DataFrame, layout: Layout, sliced: bool = False
) -> DataFrame:
    """The whole dimension from the whole history.

    Variants of a base count up in the order they appear; within a snapshot the
    higher price comes first. This equals loading the files one by one.
    A base has a line per price it ever had; ``sliced`` is for bases with more
    of them than a task can sort. Otherwise rows are shuffled once, by their base.
    """
    parts = _parts(rows, layout)
    if not sliced:
        parts = parts.repartition(*layout.base)
    return _described(_numbered(_lines(parts), layout, sliced), layout)


def new_lines(
    rows: DataFrame, dim: DataFrame, layout: Layout, sliced: bool = False
) -> DataFrame:
    """Lines of a batch that the stored dimension lacks, numbered after its variants."""
    # Rows are shuffled by their packed id, which the stored lines then meet; both grow with the data.
    parts = _parts(rows, layout).withColumn("__line", text.packed_hash(line_id(layout))).repartition("__line")
    stored = dim.select(text.packed_id(F.col("product_line_id")).alias("__line")).hint("merge")
    unseen = _lines(parts).join(stored, "__line", "left_anti").drop("__line")
    highest = dim.groupBy(*[F.col(_BASE_NAMES[c]).alias(f"__{c}") for c in layout.base]).agg(F.max("variant_no").alias("__highest"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in layout.base])
    numbered = _numbered(unseen, layout, sliced).join(highest.hint("merge"), same, "left")
    return _described(numbered.withColumn("variant_no", F.col("variant_no") + F.coalesce("__highest", F.lit(0))), layout)


def monthly_facts(rows: DataFrame, layout: Layout, by_month: bool = False) -> DataFrame:
    """One row per (line, snapshot date).

    Rows that agree on both but differ otherwise collapse to the first in value
    order; ``fact_conflicts`` names them. A line has one price, so the price is no key of
    its own. ``by_month`` leaves them in ranges of dates, for ``append_facts(dealt=True)``.
    """
    return _unpacked(_packed_facts(rows, layout, by_month))


def _packed_facts(rows: DataFrame, layout: Layout, by_month: bool = False) -> DataFrame:
    """Monthly facts whose ids are packed, as they are shuffled."""
    kept = [*layout.metrics, "source_file", *_ATTRIBUTES]
    keyed = _keyed(rows, layout).withColumn("product_line_id", text.packed_hash(F.col("product_line_id")))
    ranges = ["snapshot_date", "product_line_id"] if by_month else []
    first = agreed(keyed, ["product_line_id", "snapshot_date"], kept, ranges)
    return first.select(
        "product_line_id", "snapshot_date", *[F.col(c).alias(_ATTRIBUTES.get(c, c)) for c in kept],
    )


def _unpacked(facts: DataFrame) -> DataFrame:
    return facts.withColumn("product_line_id", text.unpacked_id(F.col("product_line_id")))


def fact_conflicts(rows: DataFrame, layout: Layout) -> DataFrame:
    """(line, date) pairs whose other metrics disagree, with the rows given up."""
    metrics = layout.metrics[1:]
    distinct = _keyed(rows, layout).select("product_line_id", "snapshot_date", *metrics).distinct()
    return (
        distinct.groupBy("product_line_id", "snapshot_date")
        .agg((F.count(F.lit(1)) - 1).alias("rows_dropped"))
        .where("rows_dropped > 0")
    )


def _keyed(rows: DataFrame, layout: Layout) -> DataFrame:
    rows = signed(rows, layout)
    wanted = [*layout.metrics, *_ATTRIBUTES]
    absent = {
        c: F.lit(None).cast(PRICE if c in layout.metrics else "string") for c in wanted if c not in rows.columns
    }
    return rows.withColumns({"product_line_id": line_id(layout), **absent})


def new_facts(rows: DataFrame, facts: DataFrame, layout: Layout, dates: Sequence) -> DataFrame:
    """Facts of a batch that are not stored yet: the first write of a (line, date) stays.

    ``dates`` are the snapshot dates of the batch; they prune the stored facts
    to the same months.
    """
    stored = facts.where(F.col("snapshot_date").isin(list(dates)))
    if "snapshot_month" in facts.columns:
        stored = stored.where(F.col("snapshot_month").isin(sorted({f"{d:%Y-%m}" for d in dates})))
    stored = stored.select(text.packed_id(F.col("product_line_id")).alias("product_line_id"), "snapshot_date").hint("merge")
    return _unpacked(_packed_facts(rows, layout).join(stored, ["product_line_id", "snapshot_date"], "left_anti"))


def run_counts(dim: DataFrame, facts: DataFrame, rows: DataFrame) -> DataFrame:
    """Product lines, monthly rows and raw rows read, as (measure, n)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "n")
        for name, df in (("product_lines", dim), ("monthly_rows", facts), ("raw_rows", rows))
    ]
    return reduce(DataFrame.unionByName, counted)
