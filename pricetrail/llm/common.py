"""Small helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.session import store
from pricetrail.sources.tables import load

__all__ = ["carried", "load", "lower_ascii", "partitions_for", "sent", "slots", "store", "unit_interval", "unsigned_crc32"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed, which ``lower`` would."""
    return F.translate(text, UPPER, LOWER)


def unsigned_crc32(text: Column) -> Column:
    """CRC32 of the UTF-8 bytes as a long; of null: of no bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def unit_interval(*parts: Column, seed: int = 0) -> Column:
    """A repeatable number in (0, 1) drawn from the parts' hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def carried(docs: DataFrame) -> Column:
    """All columns of a row as one, ``doc``, so that none of them meets a name used on the way; ``doc.*`` gives them back."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("doc")


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-rows // per_partition))


#: Rows of a few numbers sent to all tasks at most: some tens of megabytes.
SENT_ROWS = 1 << 20


def sent(ids: DataFrame) -> DataFrame:
    """Stored rows of a few numbers, to be joined with texts: sent to all tasks up to SENT_ROWS
    of them, so that the texts stay where they are; joined by a shuffle beyond that."""
    return F.broadcast(ids) if ids.count() <= SENT_ROWS else ids


def slots(df: DataFrame, group: str, order: list[str], bucket: Column, name: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap, ``name`` being the number.

    ``bucket`` cuts a group into parts. Parts are counted first, so only the rows
    of one part meet in a task and a group may be as large as the table.
    """
    parted = df.withColumn("__part", bucket)
    counts = parted.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("__g"), F.col("__part").alias("__p"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"),
    )
    inside = Window.partitionBy(group, "__part").orderBy(*order)
    numbered = parted.withColumn("__at", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, (F.col(group) == F.col("__g")) & (F.col("__part") == F.col("__p")))
        .withColumn(name, F.col("__from") + F.col("__at"))
        .drop("__part", "__g", "__p", "__from", "__at")
    )
