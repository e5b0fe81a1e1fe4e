"""Month-to-month movers."""

from pyspark.sql import functions as F

from pricetrail.operators import movers as op
from pricetrail.operators import sinks, star
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import END, SNAP, START, snap
from pricetrail.plans.registry import query
from pricetrail.session import keep, new_path
from pricetrail.sources.layouts import SINGLE_PRICE

_KEYS = ", ".join(op.KEYS)


def _movers_sql(rising: bool) -> str:
    change, sign = ("e - s", ">") if rising else ("s - e", "<")
    return f"""{SNAP},
sums AS (
  SELECT {_KEYS}, sum(CASE WHEN snapshot_date = DATE '{START}' THEN aemp END) AS s,
         sum(CASE WHEN snapshot_date = DATE '{END}' THEN aemp END) AS e
  FROM snap WHERE snapshot_date IN (DATE '{START}', DATE '{END}') GROUP BY ALL
),
moved AS (
  SELECT {_KEYS}, {q.cents('s')} AS aemp_start, {q.cents('e')} AS aemp_end, {q.cents(change)} AS abs_change,
         {q.cents('(CAST(e AS DOUBLE) - CAST(s AS DOUBLE)) / nullif(CAST(s AS DOUBLE), 0) * 100.0')} AS pct_change
  FROM sums WHERE s IS NOT NULL AND e IS NOT NULL AND e {sign} s
)"""


# A price list without item code, brand or responsible person has NULL there.
_BLANKED = SNAP + """,
blanked AS (
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS item_code, CAST(NULL AS VARCHAR) AS brand,
                    CAST(NULL AS VARCHAR) AS responsible) FROM snap
)"""


def _by_form_sql(rising: bool) -> str:
    return _movers_sql(rising).replace(SNAP, _BLANKED, 1).replace("FROM snap WHERE", "FROM blanked WHERE", 1)


def _by_form(spark, folder):
    return snap(spark, folder).withColumns(
        {c: F.lit(None).cast("string") for c in ("item_code", "brand", "responsible")}
    )


@query(f"WITH {_by_form_sql(True)} SELECT * FROM moved")
def mom_increases(spark, folder):
    return op.movers(_by_form(spark, folder), START, END)


@query(f"WITH {_by_form_sql(False)} SELECT * FROM moved")
def mom_decreases(spark, folder):
    return op.movers(_by_form(spark, folder), START, END, rising=False)


@query(f"WITH {_movers_sql(True)} SELECT * FROM moved")
def mom_increases_by_item(spark, folder):
    return op.movers(snap(spark, folder), START, END)


_STAR = SNAP + """,
stored AS (
  SELECT DISTINCT item_code, drug, form, formulary, program, pack_qty, brand, responsible, amt_pack, snapshot_date, aemp FROM snap
)"""


@query(
    "WITH " + _movers_sql(True).replace(SNAP, _STAR, 1).replace("FROM snap WHERE", "FROM stored WHERE", 1) + " SELECT * FROM moved"
)
def mom_increases_star(spark, folder):
    """Movers read off the stored star: lines, facts by month, and the attributes of either."""
    rows = keep(snap(spark, folder).withColumns(
        {"source_file": F.lit("all"), "amt_pack_program": F.concat_ws("_", "amt_pack", "program")}
    ), "rows")  # read for the lines and for the facts
    path = new_path(spark, "facts")
    sinks.append_facts(star.monthly_facts(rows, SINGLE_PRICE, by_month=True), path, dealt=True)
    prices = op.star_prices(star.product_lines(rows, SINGLE_PRICE), spark.read.parquet(path))
    return op.movers(prices, START, END)


_TOTALS = """count(abs_change) AS n_items, max(abs_change) AS largest, CAST(sum(abs_change) AS DECIMAL(38,2)) AS total,
       CAST(quantile_cont(CAST(abs_change AS DOUBLE), 0.5) AS DECIMAL(18,6)) AS median"""


@query(f"WITH {_by_form_sql(True)} SELECT {_TOTALS} FROM moved")
def mom_summary(spark, folder):
    moved = op.movers(_by_form(spark, folder), START, END)
    return op.summary(moved)


@query(
    f"""WITH {_by_form_sql(False)}, t AS (SELECT {_TOTALS} FROM moved)
SELECT 'Summary: ' || n_items || ' items decreased. Largest −' || {q.money('largest')} || ', median −'
       || {q.money('CAST(median AS DOUBLE)')} || ', total −' || {q.money('total')} || '.' AS summary FROM t"""
)
def mom_summary_text(spark, folder):
    moved = op.movers(_by_form(spark, folder), START, END, rising=False)
    return op.summary_text(op.summary(moved), rising=False)


@query(
    f"WITH {SNAP} SELECT DISTINCT snapshot_date AS month FROM snap WHERE aemp IS NOT NULL ORDER BY month DESC LIMIT 2"
)
def latest_two_months(spark, folder):
    return op.latest_months(snap(spark, folder))
