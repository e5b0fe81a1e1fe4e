"""Reports on the state of a table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values shown of each column.
SAMPLES = 3


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: fill percentage and its three smallest distinct values as text.

    One pass. A task keeps per column a count and three values of the Arrow batches it sees and
    hands on those alone, so neither values nor sets of them are shuffled.
    """
    names = df.columns
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(names)])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, filled, least = 0, [0] * len(names), [pa.array([], pa.string())] * len(names)
        for batch in batches:
            rows += batch.num_rows
            for i, values in enumerate(batch.columns):
                there = values.drop_null().cast(pa.string())
                filled[i] += len(there)
                # Arrow orders texts by their bytes, as Spark does.
                some = pc.unique(pa.concat_arrays([least[i], pc.unique(there)]))
                least[i] = some.take(pc.sort_indices(some)).slice(0, SAMPLES)
        columns = [list(range(len(names))), [rows] * len(names), filled, [s.to_pylist() for s in least]]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["place", "rows", "filled", "least"])

    counted = texts.mapInArrow(tally, "place int, rows long, filled long, least array<string>")
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("least")))), 1, SAMPLES)
    each = counted.groupBy("place").agg(F.sum("rows").alias("n_rows"), F.sum("filled").alias("filled"), merged.alias("least"))
    # The columns in their order, those of a table without any task included.
    listed = df.sparkSession.createDataFrame(list(enumerate(names)), "at int, column_name string")
    joined = listed.join(each, F.col("at") == F.col("place"), "left")
    n_rows = F.coalesce("n_rows", F.lit(0)).cast("bigint")
    share = F.col("filled").cast("decimal(20,0)") * F.lit(Decimal(100)) / F.nullif(n_rows, F.lit(0)).cast("decimal(20,0)")
    return joined.select(
        "column_name", n_rows.alias("n_rows"), F.round(share, 1).cast("decimal(5,1)").alias("fill_pct"),
        F.coalesce(F.nullif(F.array_join("least", " | "), F.lit("")), F.lit("EMPTY")).alias("samples"),
    )


def null_diagnostics(df: DataFrame, drug: str, columns: Sequence[str]) -> DataFrame:
    """For one drug: rows, and NULL and non-NULL counts of each column looked at."""
    present = [c for c in columns if c in df.columns]
    counted = df.where(F.lower("drug") == drug.lower()).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(present)],
    )
    lines = []
    for c in columns:
        there = c in present
        filled = F.col(f"n{present.index(c)}") if there else F.lit(None).cast("bigint")
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(there).alias("column_present"),
                "total_rows",
                filled.alias("non_null_rows"),
                (F.col("total_rows") - filled).alias("null_rows"),
            )
        )
    return counted.select(F.inline(F.array(*lines)))


def sample_rows(df: DataFrame, drug: str, columns: Sequence[str], rows: int = 50) -> DataFrame:
    """A few rows of one drug to look at, in column order so that the pick is stable."""
    shown = [c for c in columns if c in df.columns]
    picked = df.where(F.lower("drug") == drug.lower()).select(*shown)
    return picked.orderBy(*shown).limit(rows)
