"""Snapshots to product lines, facts and collisions."""

from datetime import date

from pyspark.sql import functions as F

from pricetrail.operators import sinks, star
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import SNAP, coarse_snap, coarse_sql, snap
from pricetrail.plans.registry import query
from pricetrail.session import keep, new_path
from pricetrail.sources.layouts import MULTI_PRICE, SINGLE_PRICE
from pricetrail.sources.snapshots import clean_snapshots, read_snapshots
from pricetrail.sources.tables import load
from pricetrail.streaming.pickup import pick_up, picked_up

_SIG = q.piped("NULL", "brand", "NULL", "responsible", "NULL", "NULL", "NULL", "amt_pack")
_BASE = "drug, item_code, form, formulary, program, pack_qty"
_LINE = q.hashed(*_BASE.split(", "), "sig", "aemp")


def _written_snapshots(spark, folder):
    """``snap`` as dated CSV folders with changing headers, and what must be left out.

    Months from 1998 on use other header names. Packs of 13 have a price that is
    none. One file lacks its price column and one has no date.
    """
    rows = snap(spark, folder)
    path = new_path(spark, "snapshots")
    body = [
        F.col("item_code").alias("Item Code"),
        F.regexp_replace("drug", " ", "   ").alias("Legal Instrument Drug"),
        F.concat(F.lit(" "), F.col("form"), F.lit(" ; oral")).alias("Legal Instrument Form"),
        F.col("formulary").alias("Formulary"),
        F.col("program").alias("Program"),
        F.col("pack_qty").alias("Pack Quantity"),
        F.when(F.col("pack_qty") == "13", "on request").otherwise(F.format_number("aemp", 2)).alias("AEMP"),
        F.col("responsible").alias("Responsible Person"),
    ]
    later = F.col("snapshot_date") >= F.lit(date(1998, 1, 1))
    name = F.concat(
        F.lit("ex-manufacturer-prices-non-efc-"), F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit(".csv")
    ).alias("snapshot")

    def write(part, columns, extra=""):
        part.select(*columns, name).hint("rebalance", "snapshot").write.option("header", True).option("escape", '"').partitionBy(
            "snapshot"
        ).csv(f"{path}/{extra}")

    write(rows.where(~later), [*body, F.col("brand").alias("Brand Name")], "early")
    renamed = [c.alias(" Pack Qty ") if i == 5 else c for i, c in enumerate(body)]
    write(rows.where(later), [*renamed, F.col("brand").alias("Brand"), F.lit("null").alias("MoA")], "later")
    parts = load(spark, folder, "part").select(
        F.col("p_partkey").alias("Item Code"), F.col("p_name").alias("Legal Instrument Drug"),
        F.col("p_type").alias("Legal Instrument Form"), F.lit("A").alias("Formulary"), F.lit("O").alias("Program"),
        F.col("p_size").alias("Pack Quantity"), F.col("p_retailprice").alias("AEMP"),
    )
    bad = f"{path}/bad/ex-manufacturer-prices-non-efc"
    parts.drop("AEMP").write.option("header", True).csv(f"{bad}-2099-01-01.csv")
    parts.write.option("header", True).csv(f"{bad}-undated.csv")
    return f"{path}/*/*ex-manufacturer-prices-non-efc-*.csv"


@query(
    f"""WITH {SNAP}
SELECT item_code, drug, form || ', oral' AS form, formulary, program, pack_qty, brand, responsible, CAST(NULL AS VARCHAR) AS moa,
       CAST(aemp AS DECIMAL(18,6)) AS aemp, snapshot_date, program AS amt_pack_program,
       'ex-manufacturer-prices-non-efc-' || strftime(snapshot_date, '%Y-%m-%d') || '.csv' AS source_file
FROM snap WHERE pack_qty <> '13'"""
)
def snapshot_scan(spark, folder):
    rows, _ = read_snapshots(spark, _written_snapshots(spark, folder), SINGLE_PRICE)
    return clean_snapshots(rows, SINGLE_PRICE).select(
        "item_code", "drug", "form", "formulary", "program", "pack_qty", "brand", "responsible", "moa",
        "aemp", "snapshot_date", "amt_pack_program", "source_file",
    )


@query(
    f"""WITH {SNAP}
SELECT CAST(pemp AS DECIMAL(18,6)) AS pemp, item_code, drug, brand, responsible, pack_qty, amt_pack, snapshot_date,
       CASE WHEN pack_qty <> '3' THEN aemp END AS aemp, CAST(NULL AS DECIMAL(18,6)) AS premium, 'S' || program AS dispensing_setting,
       'ex-manufacturer-prices-efc-' || strftime(snapshot_date, '%Y-%m-') || day(snapshot_date) || '.csv' AS source_file
FROM (SELECT *, tax AS pemp FROM snap)"""
)
def multi_price_scan(spark, folder):
    """Files of the list with several prices: one-digit days, dollar signs, rows without a price."""
    path = new_path(spark, "multi")
    name = F.concat(
        F.lit("ex-manufacturer-prices-efc-"), F.date_format("snapshot_date", "yyyy-MM-d"), F.lit(".csv")
    ).alias("snapshot")
    snap(spark, folder).select(
        F.col("item_code").alias("Item Code"), F.col("drug").alias("Drug Name"), F.col("form").alias("Legal Instrument Form"),
        F.col("formulary").alias("Formulary"), F.col("program").alias("Program"), F.col("pack_qty").alias("Pack Quantity"),
        F.when(F.col("pack_qty") != "3", F.concat(F.lit("$"), F.format_number("aemp", 2))).alias("AEMP"),
        F.concat(F.lit("$"), F.col("tax")).alias("PEMP"), F.lit("POA").alias("Premium"),
        F.concat(F.lit("S"), F.col("program")).alias("Dispensing Setting"), F.col("brand").alias("Brand Name"),
        F.col("responsible").alias("Sponsor"), F.col("amt_pack").alias("TPP"), name,
    ).hint("rebalance", "snapshot").write.option("header", True).option("escape", '"').partitionBy("snapshot").csv(path)
    raw, _ = read_snapshots(spark, f"{path}/*efc-*.csv", MULTI_PRICE, quoted_newlines=False)
    return clean_snapshots(raw, MULTI_PRICE).select(
        "pemp", "item_code", "drug", "brand", "responsible", "pack_qty", "amt_pack", "snapshot_date", "aemp", "premium",
        "dispensing_setting", "source_file",
    )


@query("SELECT 'ex-manufacturer-prices-non-efc-2099-01-01.csv' AS source_file, 'missing: aemp' AS problem")
def snapshot_problems(spark, folder):
    return read_snapshots(spark, _written_snapshots(spark, folder), SINGLE_PRICE)[1]


@query(
    f"""WITH {coarse_sql(nulls=True)}, g AS (SELECT DISTINCT {_BASE}, {_SIG} AS sig, snapshot_date, source_file, aemp FROM rws)
SELECT {q.piped(*_BASE.split(', '))} AS base_key, snapshot_date, count(*) AS distinct_aemps,
       string_agg(CAST(aemp AS VARCHAR), ', ' ORDER BY CAST(aemp AS VARCHAR)) AS example_aemps, source_file
FROM g GROUP BY {_BASE}, sig, snapshot_date, source_file HAVING count(*) > 1"""
)
def collision_log(spark, folder):
    return star.collisions(coarse_snap(spark, folder, nulls=True), SINGLE_PRICE)


_DIM_SQL = f"""{coarse_sql(nulls=True)},
lines AS (SELECT {_BASE}, {_SIG} AS sig, aemp, min(snapshot_date) AS first_seen FROM rws GROUP BY ALL),
dim AS (
  SELECT {_LINE} AS product_line_id, item_code AS item_code_b, drug AS name_a, form AS attr_c, formulary AS attr_f,
         program AS attr_g, pack_qty AS attr_j,
         row_number() OVER (PARTITION BY {_BASE} ORDER BY first_seen, aemp DESC NULLS LAST, sig) AS variant_no,
         {q.piped('form', 'formulary', 'program', 'pack_qty')} AS variety_signature,
         {q.piped('drug', 'form', 'formulary', 'program', 'pack_qty')} AS group_key_no_b,
         sig AS variant_signature_base, aemp AS variant_init_aemp
  FROM lines
)"""


@query(f"WITH {_DIM_SQL} SELECT * FROM dim")
def variant_dim(spark, folder):
    return star.product_lines(
        coarse_snap(spark, folder, nulls=True), SINGLE_PRICE
    )


_FACT_COLUMNS = f"""{_LINE} AS product_line_id, snapshot_date, aemp, source_file, CAST(NULL AS VARCHAR) AS moa, brand AS brand_name,
  CAST(NULL AS VARCHAR) AS manufacturer_code, responsible AS responsible_person, CAST(NULL AS VARCHAR) AS pricing_qty,
  CAST(NULL AS VARCHAR) AS max_qty, CAST(NULL AS VARCHAR) AS max_repeats, amt_pack AS amt_trade_pack, amt_pack_program"""
_FACT_SQL = f"{coarse_sql(nulls=True)}, g AS (SELECT *, {_SIG} AS sig FROM rws)"


@query(f"WITH {_FACT_SQL} SELECT DISTINCT {_FACT_COLUMNS} FROM g")
def monthly_fact(spark, folder):
    return star.monthly_facts(coarse_snap(spark, folder, nulls=True), SINGLE_PRICE)


@query(
    f"""WITH {_FACT_SQL}
SELECT 'product_lines' AS measure, count(*) AS n FROM (SELECT DISTINCT {_BASE}, sig, aemp FROM g)
UNION ALL SELECT 'monthly_rows', count(*) FROM (SELECT DISTINCT {_BASE}, sig, aemp, snapshot_date FROM g)
UNION ALL SELECT 'raw_rows', count(*) FROM g"""
)
def ingest_counts(spark, folder):
    rows = coarse_snap(spark, folder, nulls=True)
    dim = star.product_lines(rows, SINGLE_PRICE)
    return star.run_counts(dim, star.monthly_facts(rows, SINGLE_PRICE), rows)


@query(f"WITH {_DIM_SQL} SELECT * FROM dim")
def variant_dim_sliced(spark, folder):
    """The same by the plan for bases with more lines than a task could sort."""
    return star.product_lines(coarse_snap(spark, folder, nulls=True), SINGLE_PRICE, sliced=True)


# Priced by quantity, with tax and discount as further metrics; some prices are NULL.
def _multi(spark, folder):
    rows = coarse_snap(spark, folder, nulls=True)
    return rows.withColumns(
        {
            "aemp": F.when(F.col("pack_qty") != "3", F.col("aemp")),
            "pemp": F.col("tax"),
            "dpma": F.when(F.col("discount") > 0.01, F.col("discount")),
            "source_file": F.regexp_replace("source_file", "non-efc", "efc"),
        }
    )


_MULTI_SIG = q.piped(
    "item_code", "drug", "form", "NULL", "brand", "formulary", "program", "NULL", "responsible", "pack_qty",
    "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "amt_pack", "amt_pack_program",
)
_MULTI_SQL = f"""{coarse_sql(nulls=True)},
multi AS (
  SELECT * REPLACE (CASE WHEN pack_qty <> '3' THEN aemp END AS aemp, replace(source_file, 'non-efc', 'efc') AS source_file),
         tax AS pemp, CASE WHEN discount > 0.01 THEN discount END AS dpma
  FROM rws
),
g AS (SELECT *, {_MULTI_SIG} AS sig FROM multi),
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY {_BASE}, sig, aemp, snapshot_date ORDER BY pemp NULLS FIRST, dpma NULLS FIRST) AS rn
  FROM g
)"""
_NO_PRICE = ", ".join(
    f"CAST(NULL AS DECIMAL(18,6)) AS {c}"
    for c in ("exman_price_per_vial", "claimed_price_pack", "claimed_price_vial", "claimed_dpma", "premium")
)


@query(f"WITH {_MULTI_SQL} SELECT {_FACT_COLUMNS}, pemp, dpma, {_NO_PRICE} FROM keyed WHERE rn = 1")
def multi_metric_fact(spark, folder):
    return star.monthly_facts(_multi(spark, folder), MULTI_PRICE)


@query(
    f"""WITH {_MULTI_SQL}, d AS (SELECT DISTINCT {_LINE} AS product_line_id, snapshot_date, pemp, dpma FROM g)
SELECT product_line_id, snapshot_date, count(*) - 1 AS rows_dropped FROM d GROUP BY ALL HAVING count(*) > 1"""
)
def multi_metric_conflicts(spark, folder):
    return star.fact_conflicts(_multi(spark, folder), MULTI_PRICE)


@query(
    f"""WITH {_MULTI_SQL}, lines AS (SELECT {_BASE}, sig, aemp, min(snapshot_date) AS first_seen FROM g GROUP BY ALL)
SELECT {_LINE} AS product_line_id, aemp AS variant_init_aemp,
       row_number() OVER (PARTITION BY {_BASE} ORDER BY first_seen, aemp DESC NULLS LAST, sig) AS variant_no FROM lines"""
)
def multi_metric_dim(spark, folder):
    dim = star.product_lines(_multi(spark, folder), MULTI_PRICE)
    return dim.select("product_line_id", "variant_init_aemp", "variant_no")


_BATCHES = (date(1998, 6, 1), date(1998, 5, 1))


def _two_batches(spark, folder):
    """A stored first batch and a second one that sends its last month again, changed."""
    rows = keep(coarse_snap(spark, folder, nulls=True), "rows")  # read for the lines and facts of either batch
    first = rows.where(F.col("snapshot_date") < F.lit(_BATCHES[0]))
    again = rows.where(F.col("snapshot_date") >= F.lit(_BATCHES[1])).withColumn(
        "source_file", F.concat(F.lit("resent-"), F.col("source_file"))
    )
    dim_path, fact_path = new_path(spark, "dim"), new_path(spark, "fact")
    sinks.append_lines(star.product_lines(first, SINGLE_PRICE), dim_path)
    sinks.append_facts(star.monthly_facts(first, SINGLE_PRICE, by_month=True), fact_path, dealt=True)
    dim, facts = spark.read.parquet(dim_path), spark.read.parquet(fact_path)
    dates = [r[0] for r in again.select("snapshot_date").distinct().collect()]
    sinks.append_lines(star.new_lines(again, dim, SINGLE_PRICE), dim_path)
    sinks.append_facts(star.new_facts(again, facts, SINGLE_PRICE, dates), fact_path)
    return spark.read.parquet(dim_path), spark.read.parquet(fact_path)


@query(f"WITH {_DIM_SQL} SELECT * FROM dim")
def incremental_append(spark, folder):
    return _two_batches(spark, folder)[0].select(*star.DIM_COLUMNS)


@query(
    f"""WITH {_FACT_SQL}, f AS (SELECT DISTINCT {_FACT_COLUMNS} FROM g)
SELECT * REPLACE (CASE WHEN snapshot_date >= DATE '{_BATCHES[0]}' THEN 'resent-' ELSE '' END || source_file AS source_file) FROM f"""
)
def incremental_facts(spark, folder):
    return _two_batches(spark, folder)[1].drop("snapshot_month")


@query(
    f"""WITH {SNAP}
SELECT item_code, drug, brand, pack_qty, CAST(aemp AS DECIMAL(18,6)) AS aemp, snapshot_date,
       'ex-manufacturer-prices-non-efc-' || strftime(snapshot_date, '%Y-%m-%d') || '.csv' AS source_file,
       strftime(snapshot_date, '%Y-%m') AS snapshot_month
FROM snap"""
)
def stream_pickup(spark, folder):
    """Snapshots that land in two loads and are picked up in three runs, the last of which finds nothing new."""
    path, table, marks = (new_path(spark, name) for name in ("landing", "picked", "pickup-checkpoint"))
    name = F.concat(
        F.lit("ex-manufacturer-prices-non-efc-"), F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit(".csv")
    ).alias("snapshot")
    rows = snap(spark, folder).select(
        F.col("item_code").alias("Item Code"), F.col("drug").alias("Drug Name"), F.col("form").alias("Legal Instrument Form"),
        F.col("formulary").alias("Formulary"), F.col("program").alias("Program"), F.col("pack_qty").alias("Pack Quantity"),
        F.format_number("aemp", 2).alias("AEMP"), F.col("brand").alias("Brand Name"), name, "snapshot_date",
    )
    later = F.col("snapshot_date") >= F.lit(_BATCHES[0])
    for part, load_name in ((rows.where(~later), "first"), (rows.where(later), "second")):
        part.drop("snapshot_date").hint("rebalance", "snapshot").write.option("header", True).option("escape", '"').partitionBy(
            "snapshot"
        ).csv(f"{path}/{load_name}")
        pick_up(spark, f"{path}/*/*", rows.columns[:-2], SINGLE_PRICE, table, marks)
    pick_up(spark, f"{path}/*/*", rows.columns[:-2], SINGLE_PRICE, table, marks)
    return picked_up(spark, table).select(
        "item_code", "drug", "brand", "pack_qty", "aemp", "snapshot_date", "source_file", "snapshot_month"
    )
