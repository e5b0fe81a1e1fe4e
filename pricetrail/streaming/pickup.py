"""Incremental pickup of landed snapshots.

A file source remembers in its checkpoint which files it has taken, so a run looks at new
files only and needs no listing of what was loaded before. Every run takes all there
is and ends. A run that breaks off is repeated from the checkpoint without writing a file twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.functions.months import month_key
from pricetrail.sources.layouts import Layout
from pricetrail.sources.snapshots import canonical, clean_snapshots, map_headers, text_schema


def pick_up(
    spark: SparkSession, glob: str, header: Sequence[str], layout: Layout, table: str, checkpoint: str, files_at_once: int = 1000
) -> int:
    """Append the cleaned rows of all new snapshot files of one header to ``table``, by month; the number of rows taken.

    The files are CSV with ``header``; a feed has one, and a change of it is a new feed with its own checkpoint and
    the same table. ``files_at_once`` bounds a micro-batch, not the run.
    """
    missing = map_headers(header, layout)[1]
    if missing:
        raise ValueError("missing: " + ", ".join(missing))
    landed = (
        spark.readStream.schema(text_schema(header)).option("maxFilesPerTrigger", files_at_once)
        .options(header=True, escape='"', enforceSchema=True).csv(glob)
    )
    rows = clean_snapshots(canonical(landed, header, layout), layout)
    run = (
        rows.withColumn("snapshot_month", month_key(F.col("snapshot_date")))
        .writeStream.format("parquet").partitionBy("snapshot_month")
        .option("path", table).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return sum(batch["numInputRows"] for batch in run.recentProgress)


def picked_up(spark: SparkSession, table: str) -> DataFrame:
    """What has been taken so far, as whole batches only."""
    return spark.read.parquet(table).withColumn("snapshot_month", F.col("snapshot_month").cast("string"))
