"""Column profile and NULL counts."""

from pyspark.sql import functions as F

from pricetrail.operators import quality
from pricetrail.operators.sinks import append_by_name
from pricetrail.plans.fixtures import SNAP, snap
from pricetrail.plans.registry import query
from pricetrail.sources.tables import load, missing_tables

_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "nothing"]


def _profiled(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count(*) AS n_rows,
  CAST(round(CAST(count({c}) * 100 / count(*) AS DECIMAL(18,6)), 1) AS DECIMAL(5,1)) AS fill_pct,
  coalesce((SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM t WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)), 'EMPTY') AS samples
FROM t"""


@query(
    f"""WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS nothing
  FROM orders)
{' UNION ALL '.join(_profiled(c) for c in _COLUMNS)}"""
)
def column_profile(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return quality.column_profile(orders)


_REQUIRED = ["lineitem", "part", "no_such_table", "supplier"]


@query(
    """SELECT 'lineitem' AS table_name, true AS present, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'part', true, count(*) FROM part UNION ALL SELECT 'supplier', true, count(*) FROM supplier
UNION ALL SELECT 'no_such_table', false, NULL"""
)
def required_tables(spark, folder):
    """Which of the tables a load needs are there, and how many rows they hold."""
    absent = missing_tables(spark, folder, _REQUIRED)
    counts = [
        load(spark, folder, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(True).alias("present"), "n_rows"
        )
        for name in _REQUIRED if name not in absent
    ]
    lacking = [(name, False, None) for name in absent]
    return append_by_name([*counts, spark.createDataFrame(lacking, "table_name string, present boolean, n_rows long")])


_LOOKED_AT = ["responsible", "sponsor", "brand"]


@query(
    f"""WITH {SNAP}, t AS (SELECT CASE WHEN form <> 'ECONOMY' THEN responsible END AS responsible, brand FROM snap WHERE lower(drug) = 'small ring')
SELECT 'responsible' AS column_name, true AS column_present, count(*) AS total_rows, count(responsible) AS non_null_rows, count(*) - count(responsible) AS null_rows FROM t
UNION ALL SELECT 'sponsor', false, count(*), NULL, NULL FROM t
UNION ALL SELECT 'brand', true, count(*), count(brand), count(*) - count(brand) FROM t"""
)
def null_diagnostics(spark, folder):
    rows = snap(spark, folder).withColumn(
        "responsible", F.when(F.col("form") != "ECONOMY", F.col("responsible"))
    )
    return quality.null_diagnostics(rows, "Small Ring", _LOOKED_AT)


@query(
    f"""WITH {SNAP} SELECT item_code, brand, form, formulary, responsible FROM snap WHERE lower(drug) = 'small ring'
ORDER BY ALL LIMIT 50"""
)
def sample_rows(spark, folder):
    return quality.sample_rows(
        snap(spark, folder), "small ring", ["item_code", "brand", "form", "formulary", "responsible", "sponsor"]
    )
