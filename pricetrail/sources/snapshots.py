"""Monthly snapshot files.

A snapshot is one dated CSV or Parquet file, or a folder of part files named
like one. Every cell is read as text. Headers differ between months, so files
are grouped by header first: the plan has one scan per distinct header, not
one per file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.functions import numbers, text
from pricetrail.sources.layouts import Layout

# Cell text that a workbook reader takes as an empty cell.
EMPTY_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

PROBLEMS = "source_file string, problem string"


def find_column(headers: Sequence[str], aliases: Sequence[str]) -> str | None:
    """First alias equal to a header, else the first header containing any alias."""
    plain = [(h.strip().lower(), h) for h in headers]
    exact = dict(plain)
    for alias in aliases:
        if alias in exact:
            return exact[alias]
    return next((h for low, h in plain if any(a in low for a in aliases)), None)


def map_headers(headers: Sequence[str], layout: Layout) -> tuple[dict[str, str], list[str]]:
    """Field to header, and the required fields that no header serves.

    A header wanted by several fields goes to the last of them.
    """
    owner: dict[str, str] = {}
    for name in layout.fields:
        found = find_column(headers, {**layout.required, **layout.optional}[name])
        if found is not None:
            owner[found] = name
    mapped = {name: header for header, name in owner.items()}
    return mapped, [r for r in layout.required if r not in mapped]


def _files(spark: SparkSession, glob: str) -> DataFrame:
    """Every file under ``glob`` with the snapshot it belongs to.

    A part file belongs to its folder, any other file to itself. Only names are
    read, not contents.
    """
    found = spark.read.format("binaryFile").load(glob).select(F.col("_metadata.file_path").alias("__path"), "length")
    is_part = F.col("__path").rlike("/part-[^/]*$")
    folder = F.regexp_replace("__path", "/[^/]*$", "")
    return found.withColumn("snapshot", F.when(is_part, folder).otherwise(F.col("__path")))


def _reader(spark: SparkSession, fmt: str, header: Sequence[str], quoted_newlines: bool):
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Part files are read by position: one with its columns in another order is an error.
        named = len({h.lower() for h in header}) == len(header) and all(h.strip() for h in header)
        reader = reader.options(
            header=True, inferSchema=False, escape='"', multiLine=quoted_newlines, enforceSchema=not named
        )
    return reader


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a CSV header as the reader gives them: unnamed ones by place, repeated ones with their place."""
    cells = next(csv.reader([line.lstrip("\ufeff")]), [])
    low = [c.lower() for c in cells]
    return tuple(
        f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells)
    )


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line that is not empty of every file, from one scan of them all.

    Only the block that begins a file is looked at. Its lines come in order and in one task, so the
    first one met there is the first of the file, however many files there are.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value"
    )
    begun = lines.where((F.col("at") == 0) & (F.trim("value") != ""))
    return begun.groupBy("path").agg(F.first("value").alias("header"))


def _csv_headers(spark: SparkSession, snapshots: dict[str, str]) -> dict[str, tuple[str, ...]]:
    """Header of every snapshot in one job. Snapshots of one header are gathered before they come to the driver."""
    if not snapshots:
        return {}
    alike = first_lines(spark, sorted(snapshots.values())).groupBy("header").agg(F.collect_list("path").alias("paths"))
    of_path = {unquote(p): header_names(r.header) for r in alike.collect() for p in r.paths}
    return {snapshot: of_path.get(sample, ()) for snapshot, sample in snapshots.items()}


def _headers(spark: SparkSession, fmt: str, snapshots: dict[str, str]) -> dict[str, tuple[str, ...]]:
    """Header of every snapshot, from the smallest of its files; other formats than CSV are asked file by file, for their footers."""
    if fmt == "csv":
        return _csv_headers(spark, snapshots)
    with ThreadPoolExecutor(16) as pool:
        return dict(pool.map(lambda s: (s[0], tuple(spark.read.format(fmt).load(s[1]).columns)), snapshots.items()))


def read_snapshots(
    spark: SparkSession, glob: str, layout: Layout, fmt: str = "csv", quoted_newlines: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All snapshots under ``glob`` as canonical text columns, and the problems met.

    Files without a required header are left out and named in the problems. A CSV
    file is one task unless ``quoted_newlines`` is False, for files without line
    breaks inside cells; large loads pass that, or land as Parquet or part files.
    """
    files = _files(spark, glob)
    # One row per snapshot, that is per month.
    filled = F.struct(F.col("length") == 0, "length", "__path")
    found = files.groupBy("snapshot").agg(F.min_by("__path", filled).alias("sample")).collect()
    headers = _headers(spark, fmt, {unquote(r.snapshot): unquote(r.sample) for r in found})

    by_header: dict[tuple[str, ...], list[str]] = {}
    problems = []
    for snapshot, header in sorted(headers.items()):
        missing = map_headers(header, layout)[1]
        if missing:
            problems.append((re.sub("^[A-Za-z_]+=", "", snapshot.rsplit("/", 1)[-1]), "missing: " + ", ".join(missing)))
        else:
            by_header.setdefault(header, []).append(snapshot)

    frames = []
    for header, paths in by_header.items():
        raw = _reader(spark, fmt, header, quoted_newlines).schema(text_schema(header)).load(paths)
        frames.append(canonical(raw, header, layout))
    if frames:
        rows = reduce(DataFrame.unionByName, frames)
    else:
        rows = spark.createDataFrame([], ", ".join(f"{f} string" for f in layout.fields) + ", snapshot_date date, source_file string")
    return rows, spark.createDataFrame(problems, PROBLEMS)


def text_schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in header])


def canonical(raw: DataFrame, header: Sequence[str], layout: Layout) -> DataFrame:
    """Rows of files with one header under the layout's names, with date and file name from each row's own path."""
    mapped, _ = map_headers(header, layout)
    path = F.url_decode(F.col("_metadata.file_path"))
    return raw.select(
        *[_cell(F.col(f"`{mapped[f]}`") if f in mapped else None).alias(f) for f in layout.fields],
        file_date(path, layout).alias("snapshot_date"), file_name(path).alias("source_file"),
    )


def _cell(c: Column | None) -> Column:
    if c is None:
        return F.lit(None).cast("string")
    return F.when(~c.isin(EMPTY_CELLS), c)


def file_date(path: Column, layout: Layout) -> Column:
    """Date in the file name; NULL if there is none or it is no date."""
    found = F.regexp_extract(path, layout.file_date, 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy-MM-d")).cast("date")


def file_name(path: Column) -> Column:
    """Last dated path segment: the file, or the folder holding its parts."""
    return F.regexp_extract(path, r"/(?:[A-Za-z_]+=)?([^/]+\.(?i:csv|parquet))(?:/[^/]*)?$", 1)


def clean_snapshots(rows: DataFrame, layout: Layout) -> DataFrame:
    """Normalised, typed rows with the required keys present.

    Text is trimmed and its punctuation unified, prices become DECIMAL(18,6).
    Rows without drug, item code or date go; rows without a price go too,
    unless the layout keeps them.
    """
    present = rows.where(
        ~text.is_blank(F.col("drug")) & ~text.is_blank(F.col("item_code")) & F.col("snapshot_date").isNotNull()
    )
    plain = [c for c in layout.texts if c not in layout.punctuated]
    prices = {
        c: numbers.to_price(numbers.price_number(F.col(c), layout.currency_sign)) for c in layout.metrics
    }
    typed = present.withColumns(
        {
            **prices,
            "__tidy": text.identifier_texts(F.array(*layout.punctuated)),
            "__plain": F.transform(F.array(*plain).cast("array<string>"), text.normalize_text),
        }
    )
    cleaned = typed.withColumns(
        {
            **{c: F.col("__tidy")[i] for i, c in enumerate(layout.punctuated)},
            **{c: F.col("__plain")[i] for i, c in enumerate(plain)},
        }
    ).drop("__tidy", "__plain")
    cleaned = cleaned.withColumn(
        "amt_pack_program",
        text.joined_label(F.coalesce("amt_pack", F.lit("")), F.coalesce("program", F.lit(""))),
    )
    return cleaned if layout.keep_unpriced else cleaned.where(F.col("aemp").isNotNull())
