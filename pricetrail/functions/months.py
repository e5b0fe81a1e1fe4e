"""Months and their labels."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the prefix of a month column in the wide matrix.
LABEL_PREFIX = "AEMP "
_PATTERN = "'AEMP 'MMM yy"


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_label(c: Column) -> Column:
    return F.date_format(c, _PATTERN)


def label_month(label: Column) -> Column:
    """Month of a label; NULL if it is not one. Years 69 to 99 are 1969 to 1999."""
    parsed = F.try_to_timestamp(label, F.lit(_PATTERN)).cast("date")
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)


def label_of(month: date) -> str:
    """The same label for a known month."""
    return f"{LABEL_PREFIX}{month:%b %y}"


def month_of(label: str) -> date:
    from datetime import datetime

    return datetime.strptime(label[len(LABEL_PREFIX):], "%b %y").date()


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMM yyyy")


def four_month_bucket(c: Column) -> Column:
    part = F.floor((F.month(c) - 1) / 4) + 1
    return F.concat(F.year(c).cast("string"), F.lit("-"), F.lpad(part.cast("string"), 2, "0"))


def month_list(df: DataFrame, column: str) -> list[date]:
    """Distinct months of a date column, oldest first: a short list, one per calendar month."""
    months = df.select(month_start(F.col(column)).alias("m")).where("m IS NOT NULL").distinct()
    return sorted(r.m for r in months.collect())


def in_months(df: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of the months from ``first`` to ``last``; either may be open.

    Bare comparisons, which reach the file scan; tables stored by
    ``snapshot_month`` are cut to those folders.
    """
    if first is not None:
        df = df.where(F.col("snapshot_date") >= F.lit(first.replace(day=1)))
    if last is not None:
        df = df.where(F.col("snapshot_date") < F.lit(_next_month(last)))
    return in_stored_months(df, first, last)


def in_stored_months(df: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Only the month folders of the range, where a table is stored by month."""
    if "snapshot_month" not in df.columns:
        return df
    if first is not None:
        df = df.where(F.col("snapshot_month") >= f"{first:%Y-%m}")
    return df if last is None else df.where(F.col("snapshot_month") <= f"{last:%Y-%m}")


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def months_between(first: date, last: date) -> list[date]:
    """Every month from ``first`` to ``last``, both included."""
    out, current = [], first.replace(day=1)
    while current <= last:
        out.append(current)
        current = _next_month(current)
    return out


def labels_of(months: Iterable[date]) -> list[str]:
    return [label_of(m) for m in months]
