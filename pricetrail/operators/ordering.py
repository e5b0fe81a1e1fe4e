"""Positions and neighbours inside ordered groups, whatever the size of a group.

A plain window puts each group into one task. That is the right plan where the
key bounds a group, as a series is bounded by its months, and the wrong one for
a group that may hold a third of the table. The caller says which it is:
``sliced`` cuts the sorted rows into range slices, works inside each slice, and
carries the counts and edge values of the slices across, so that no task sees
more than a slice. The plan never depends on how many rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetrail.session import keep, store

# Rows of a slice, about.
SLICE_ROWS = 1_000_000

# Intervals that a range of values is counted in at a time.
FAN = 4096

# Ranges whose counts, two each at most, are sent to all tasks.
SENT_SLICES = 1 << 16

_SLICE = "__slice"


def in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    row_number: str | None = None,
    group_size: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    sliced: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add positions and neighbour values within ``keys``, sorted by ``order``.

    ``order`` must tell any two rows of a group apart. ``previous`` and
    ``following`` map new columns to the column they take from the row before
    or after. ``sliced`` is for groups that nothing bounds.
    """
    previous, following = dict(previous or {}), dict(following or {})
    if sliced:
        if previous or following or not keys:
            return _across_slices(
                store(df, "ordered"), keys, order, row_number, group_size, previous, following, slice_rows
            )
        # Without neighbours to fetch, only counts are sent across, as ``places`` does.
        rows, number, size = keep(df, "ordered"), row_number or "__number", group_size or "__size"
        placed = places(rows, keys, order, row_number=number, group_size=size, slices=_slices(rows, slice_rows), tight=True)
        return placed.select(*df.columns, *[c for c in (row_number, group_size) if c])
    grouped = Window.partitionBy(*keys)
    w = grouped.orderBy(*order)
    added = {new: F.lag(old).over(w) for new, old in previous.items()}
    added |= {new: F.lead(old).over(w) for new, old in following.items()}
    if row_number:
        added[row_number] = F.row_number().over(w).cast("bigint")
    if group_size:
        added[group_size] = F.count(F.lit(1)).over(grouped)
    return df.withColumns(added)


def _slices(df, slice_rows):
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // slice_rows + 1)


def _across_slices(df, keys, order, row_number, group_size, previous, following, slice_rows):
    slices = _slices(df, slice_rows)
    # Stored, so that the slice of a row cannot change if a task is run again.
    sliced = store(
        df.repartitionByRange(slices, *[F.col(k) for k in keys], *order).withColumn(
            _SLICE, F.spark_partition_id()
        ),
        "slices",
    )
    group = [*keys, _SLICE]
    w = Window.partitionBy(*group).orderBy(*order)
    carried = sorted(set(previous.values()) | set(following.values()))
    local = sliced.withColumns(
        {
            "__rn": F.row_number().over(w).cast("bigint"),
            "__n": F.count(F.lit(1)).over(Window.partitionBy(*group)),
            **{f"__p_{new}": F.lag(old).over(w) for new, old in previous.items()},
            **{f"__f_{new}": F.lead(old).over(w) for new, old in following.items()},
        }
    )
    # `__here` keeps the struct non-NULL where every carried value is NULL.
    edge = F.struct(F.lit(1).alias("__here"), *[F.col(c) for c in carried])
    edges = local.groupBy(*group).agg(
        F.max("__n").alias("__slice_rows"),
        F.max(F.when(F.col("__rn") == 1, edge)).alias("__first"),
        F.max(F.when(F.col("__rn") == F.col("__n"), edge)).alias("__last"),
    )
    # One row per group and slice: at most as many rows per group as slices.
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    edges = edges.select(
        *[F.col(k).alias(f"__k_{k}") for k in group],
        F.coalesce(
            F.sum("__slice_rows").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        F.sum("__slice_rows").over(Window.partitionBy(*keys)).alias("__all"),
        F.lag("__last").over(by_slice).alias("__prev_last"),
        F.lead("__first").over(by_slice).alias("__next_first"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in group])
    joined = local.join(edges, same)
    added = {}
    for new, old in previous.items():
        at_edge = F.col("__rn") == 1
        added[new] = F.when(at_edge, F.col(f"__prev_last.{old}")).otherwise(F.col(f"__p_{new}"))
    for new, old in following.items():
        at_edge = F.col("__rn") == F.col("__n")
        added[new] = F.when(at_edge, F.col(f"__next_first.{old}")).otherwise(F.col(f"__f_{new}"))
    if row_number:
        added[row_number] = F.col("__rn") + F.col("__before")
    if group_size:
        added[group_size] = F.col("__all")
    return joined.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def places(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, row_number: str, group_size: str, slices: int | None = None,
    tight: bool = False,
) -> DataFrame:
    """Row number from 1 and size within ``keys``, for groups that nothing bounds: ``in_order`` without its first copy and its join.

    Rows are dealt to ``slices`` ranges of keys and order (as many as there are shuffle partitions, if not given) and stored once,
    by ``keep`` if ``tight``.
    Rows are counted per group and range; a range is in the middle of two groups at most, its first and its last, so the
    groups that lie in several ranges have two counts per range at most, and those alone are sent to the rows.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = (keep if tight else store)(
        df.repartitionByRange(slices, *[F.col(k) for k in keys], *order).withColumn(_SLICE, F.spark_partition_id()), "slices"
    )
    counts = cut.groupBy(*keys, _SLICE).agg(F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*keys)
    before = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    torn = counts.select(
        *[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], F.col(_SLICE).alias("__in"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(group).alias("__all"), F.count(F.lit(1)).over(group).alias("__ranges"),
    ).where("__ranges > 1").drop("__ranges")
    if slices <= SENT_SLICES:
        torn = F.broadcast(torn)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{i}")) for i, k in enumerate(keys)])
    here = Window.partitionBy(*keys, _SLICE)
    local = cut.withColumns(
        {"__at": F.row_number().over(here.orderBy(*order)).cast("bigint"), "__here": F.count(F.lit(1)).over(here)}
    )
    placed = local.join(torn, same & (F.col(_SLICE) == F.col("__in")), "left")
    return placed.select(
        *df.columns, (F.col("__at") + F.coalesce("__before", F.lit(0))).alias(row_number),
        F.coalesce("__all", "__here").alias(group_size),
    )


def middle_values(counts: DataFrame, value: str, weight: str, fan: int = FAN) -> list[Decimal]:
    """The two middle values of a decimal column, the same twice where one is in the middle; none if there is no row.

    ``counts`` has every value with the number of its rows, and is read once per round. A round counts rows in ``fan`` intervals between
    the least and the greatest value that may still be in the middle and goes on with the one or two intervals in question, until
    a single value is left: as many rounds as the range has digits to the base ``fan``. Nothing is
    sorted, and the driver sees ``fan`` counts at most.
    """
    scale = counts.schema[value].dataType.scale
    step = Decimal(1).scaleb(-scale)
    first = counts.agg(F.min(value), F.max(value), F.sum(weight)).first()
    if first[0] is None:
        return []
    total = int(first[2])
    found = []
    for rank in sorted({(total + 1) // 2, (total + 2) // 2}):
        low, high, before = int(first[0] / step), int(first[1] / step), 0
        while low < high:
            width = -(-(high - low + 1) // fan)
            place = F.floor(
                (F.col(value) / F.lit(step)).cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)")
            ) / F.lit(width).cast("decimal(38,0)")
            inside = counts.where(F.col(value).between(F.lit(low * step), F.lit(high * step)))
            rows = inside.groupBy(F.floor(place).cast("long").alias("at")).agg(F.sum(weight).alias("n")).collect()
            for at, n in sorted((r["at"], int(r["n"])) for r in rows):
                if before + n >= rank:
                    low, high = low + at * width, min(low + (at + 1) * width - 1, high)
                    break
                before += n
        found.append(low * step)
    return [found[0], found[-1]]
