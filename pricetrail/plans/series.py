"""Price series, their change points and their coverage."""

from pyspark.sql import functions as F

from pricetrail.operators import series, star
from pricetrail.operators.sinks import export_csv
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import SIX_MONTHS, SNAP, coarse_snap, coarse_sql, snap
from pricetrail.plans.ingest import _LINE, _SIG
from pricetrail.plans.registry import query
from pricetrail.session import keep, new_path
from pricetrail.sources.layouts import SINGLE_PRICE

_SHOWN = q.shown("item_code", "brand", "form", "formulary", "amt_pack", "responsible")
_KEY = ", ".join(q.canon(c) for c in ("drug", "form", "brand", "responsible", "amt_pack"))

# Suppliers are left out of the series and prices are coarse, so that series repeat items and prices.
SERIES = f"""{SNAP},
means AS (
  SELECT item_code, drug, form, brand, formulary, amt_pack, '' AS responsible, snapshot_date AS month, first_listed_date,
         CAST(sum(coarse) AS DOUBLE) / count(coarse) AS aemp
  FROM snap GROUP BY ALL
),
series AS (
  SELECT month, drug || ' · ' || {_SHOWN} AS display_name, aemp, item_code, form, responsible, amt_pack,
         drug || '|' || concat_ws('|', {_KEY}) AS series_id, first_listed_date, drug
  FROM means
)"""


def coarse_series(spark, folder, drugs=None):
    return series.price_series(coarse_snap(spark, folder), drugs)


@query(f"WITH {SERIES} SELECT * FROM series")
def price_series(spark, folder):
    return coarse_series(spark, folder)


@query(
    f"""WITH {SERIES}
SELECT month, replace(replace(display_name, 'small ring · ', 'Small RING · '), 'red widget · ', 'RED widget · ') AS display_name,
       aemp, item_code, replace(replace(series_id, 'small ring|small', 'Small RING|small'), 'red widget|red', 'RED widget|red') AS series_id
FROM series WHERE drug IN ('small ring', 'red widget')"""
)
def selected_series(spark, folder):
    """Two picked drugs, tagged as the user spelled them."""
    return coarse_series(spark, folder, ["Small RING", "RED widget"]).select(
        "month", "display_name", "aemp", "item_code", "series_id"
    )


@query(
    f"""WITH {SNAP} SELECT lower(drug) AS drug, snapshot_date AS month, CAST(sum(aemp) AS DOUBLE) / count(aemp) AS aemp
FROM snap GROUP BY ALL"""
)
def monthly_mean(spark, folder):
    return series.monthly_mean(snap(spark, folder))


@query(
    f"""WITH {SNAP} SELECT lower(drug) AS drug, snapshot_date AS month, CAST(sum(aemp) AS DOUBLE) / count(aemp) AS aemp
FROM snap GROUP BY ALL"""
)
def csv_export(spark, folder):
    """The monthly means exported as CSV and read back."""
    path = new_path(spark, "export")
    export_csv(series.monthly_mean(snap(spark, folder)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("drug", F.col("month").cast("date").alias("month"), F.col("aemp").cast("double").alias("aemp"))


@query(
    f"""WITH {SERIES}, names AS (SELECT DISTINCT display_name, series_id FROM series ORDER BY display_name, series_id LIMIT 5)
SELECT display_name, count(*) AS n FROM series WHERE display_name IN (SELECT display_name FROM names) GROUP BY ALL"""
)
def picked_series(spark, folder):
    """Points of the first five names, as a user picks names from the list."""
    points = coarse_series(spark, folder)
    names = [r.display_name for r in series.identifiers(points).limit(5).collect()]
    return series.in_range(points, picked=names).groupBy("display_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {coarse_sql()}, g AS (SELECT *, {_SIG} AS sig FROM rws)
SELECT DISTINCT snapshot_date AS month, {_LINE} AS product_line_id, item_code, aemp FROM g"""
)
def line_listing(spark, folder):
    rows = keep(coarse_snap(spark, folder), "rows")  # read for the lines and for the facts
    dim = keep(star.product_lines(rows, SINGLE_PRICE).select("product_line_id", "item_code_b"), "lines")
    return series.line_listing(dim, keep(star.monthly_facts(rows, SINGLE_PRICE), "facts"))


@query(
    f"""WITH {SERIES} SELECT series_id, display_name, min(month) AS first_month, max(month) AS last_month,
       strftime(min(month), '%b %Y') AS first_month_text, strftime(max(month), '%b %Y') AS last_month_text
FROM series GROUP BY ALL"""
)
def series_coverage(spark, folder):
    return series.coverage(coarse_series(spark, folder))


_SPAN = f"month BETWEEN DATE '{SIX_MONTHS[0]}' AND DATE '{SIX_MONTHS[-1]}'"


@query(f"WITH {SERIES} SELECT min(month) AS first_month, max(month) AS last_month FROM series WHERE {_SPAN}")
def overall_coverage(spark, folder):
    points = coarse_series(spark, folder)
    return series.overall_coverage(series.in_range(points, SIX_MONTHS[0], SIX_MONTHS[-1]))


@query(f"WITH {SERIES} SELECT DISTINCT series_id, display_name FROM series")
def identifier_list(spark, folder):
    return series.identifiers(coarse_series(spark, folder))


_CHANGES = f"""{SERIES},
near AS (
  SELECT *, lag(aemp) OVER w AS prev_aemp, lead(aemp) OVER w AS next_aemp FROM series
  WINDOW w AS (PARTITION BY series_id ORDER BY month, display_name, aemp)
),
points AS (
  SELECT *, prev_aemp IS NULL AS is_first_point, next_aemp IS NULL AS is_last_point,
         coalesce(aemp <> next_aemp, false) AS is_before_change, coalesce(aemp <> prev_aemp, false) AS is_after_change,
         {q.money('aemp')} AS price_label
  FROM near WHERE prev_aemp IS NULL OR next_aemp IS NULL OR aemp <> prev_aemp OR aemp <> next_aemp
)"""


@query(f"WITH {_CHANGES} SELECT * FROM points")
def change_points(spark, folder):
    return series.change_points(coarse_series(spark, folder))


@query(f"WITH {_CHANGES} SELECT * FROM points")
def change_points_sliced(spark, folder):
    """The same by the plan for series that no task could sort."""
    return series.change_points(coarse_series(spark, folder), sliced=True)


@query(
    f"""WITH {_CHANGES}, placed AS (
  SELECT series_id, month, display_name, aemp, year(month) || '-0' || ((month(month) - 1) // 4 + 1) AS month_bucket,
         CAST(round(CAST(aemp AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS price_band,
         CASE WHEN is_after_change THEN 'bottom' ELSE 'top' END AS label_side
  FROM points)
SELECT *, row_number() OVER (PARTITION BY month_bucket, price_band, label_side ORDER BY series_id, month, display_name, aemp) - 1
         AS collision_rank,
       count(*) OVER (PARTITION BY month_bucket, price_band, label_side) AS collision_size
FROM placed"""
)
def price_crowding(spark, folder):
    points = series.change_points(coarse_series(spark, folder))
    return series.price_crowding(points).select(
        "series_id", "month", "display_name", "aemp", "month_bucket", "price_band", "label_side",
        "collision_rank", "collision_size",
    )


@query(f"WITH {_CHANGES} SELECT * FROM points")
def change_points_dealt(spark, folder):
    """The same from the prices, dealt once for names and neighbours alike."""
    return series.series_changes(coarse_snap(spark, folder))


_FIRST_LAST = f"""{SERIES},
ends AS (
  SELECT drug, form, series_id, first(aemp ORDER BY month, display_name, aemp) AS first_aemp,
         last(aemp ORDER BY month, display_name, aemp) AS last_aemp, min(month) AS first_month, max(month) AS last_month,
         CAST(min(first_listed_date) AS DATE) AS listed
  FROM series GROUP BY drug, form, series_id
)"""


@query(f"WITH {_FIRST_LAST} SELECT * FROM ends")
def series_first_last(spark, folder):
    return series.first_last_prices(coarse_series(spark, folder), ["drug", "form", "series_id"])
