"""Pricing events, markers, exemptions and summary cards."""

from datetime import date

from pyspark.sql import functions as F

from pricetrail.functions.months import in_months
from pricetrail.operators import events, series, summary
from pricetrail.operators.sinks import build_stamp, replace_table
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import (
    DATED_EVENTS, LISTED, PRICE_EVENTS, SNAP, coarse_snap, dated_events, item_events, items, listed_items,
)
from pricetrail.plans.registry import query
from pricetrail.plans.series import _FIRST_LAST, SERIES
from pricetrail.session import new_path, store

_VIEW = (date(1995, 2, 1), date(1997, 6, 1))


def _price_events(spark, folder):
    return events.price_events(item_events(spark, folder), store(items(spark, folder), "items"))


@query(f"WITH {PRICE_EVENTS} SELECT * FROM price_events")
def price_events(spark, folder):
    """Derived, stored as a table in full, and read back."""
    path = new_path(spark, "price_events")
    replace_table(_price_events(spark, folder), path)
    return spark.read.parquet(path)


_SINCE = date(2024, 1, 20)


@query(f"WITH {PRICE_EVENTS} SELECT * FROM price_events WHERE event_date >= DATE '{_SINCE}'")
def price_events_batch(spark, folder):
    """The latest events only, from items stored by schedule: other schedules' folders stay closed."""
    path = new_path(spark, "items")
    listed = items(spark, folder)
    listed.hint("rebalance", "effective_date").write.partitionBy("effective_date").parquet(path)
    schedules = store(listed.select("effective_date").distinct(), "schedules")
    return events.batch_price_events(item_events(spark, folder), spark.read.parquet(path), schedules, _SINCE)


@query("SELECT count(*) AS n_rows, 1 AS n_stamps, true AS stamp_is_later FROM events")
def build_stamps(spark, folder):
    """The table of events with the stamp that is stored beside it."""
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    path, beside = new_path(spark, "price_events"), new_path(spark, "build")
    replace_table(_price_events(spark, folder), path)
    replace_table(build_stamp(spark), beside)
    stamps = [r.built_at for r in spark.read.parquet(beside).collect()]
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(stamps)).alias("n_stamps"), F.lit(max(stamps) >= began).alias("stamp_is_later")
    )


@query(f"WITH {PRICE_EVENTS} SELECT event_label, count(*) AS n FROM price_events GROUP BY ALL")
def events_per_label(spark, folder):
    return events.events_per_label(_price_events(spark, folder))


@query(
    f"""WITH {PRICE_EVENTS}
SELECT li_item_id, pbs_code, li_drug_name, brand_name, event_date, event_label, percentage_applied, price_before, price_after
FROM price_events WHERE pbs_code = '7' AND event_date = DATE '2024-01-10'
ORDER BY li_item_id, event_type_code NULLS FIRST, percentage_applied, price_before, price_after LIMIT 3"""
)
def events_sample(spark, folder):
    return events.spot_check(_price_events(spark, folder), "7", "2024-01-10")


@query(
    f"""WITH {PRICE_EVENTS}, s AS (SELECT count(*) AS n FROM item_events), d AS (SELECT count(*) AS n, count(*) FILTER (li_drug_name IS NULL) AS m FROM price_events)
SELECT s.n AS source_rows, d.n AS derived_rows, s.n = d.n AS rows_match, d.m AS rows_without_item FROM s, d"""
)
def event_reconcile(spark, folder):
    return events.reconcile(item_events(spark, folder), _price_events(spark, folder))


# One range of months for the prices and the events of a card.
_SERIES_IN_VIEW = SERIES.replace(
    "FROM snap GROUP BY ALL", f"FROM snap WHERE snapshot_date BETWEEN DATE '{_VIEW[0]}' AND DATE '{_VIEW[1]}' GROUP BY ALL"
)
_VIEWED = f"""{DATED_EVENTS},{_SERIES_IN_VIEW},
in_view AS (
  SELECT trim(pbs_code) AS code, CAST(date_trunc('month', event_date) AS DATE) AS month, coalesce(event_label, 'None') AS event_label
  FROM dated_events
  WHERE trim(pbs_code) IN (SELECT item_code FROM series)
    AND CAST(date_trunc('month', event_date) AS DATE) BETWEEN DATE '{_VIEW[0]}' AND DATE '{_VIEW[1]}'
)"""


def _in_view(spark, folder, points):
    return summary.events_in_view(dated_events(spark, folder), points, *_VIEW)


def _ends(spark, folder):
    return store(summary.code_ends(series.price_series(in_months(coarse_snap(spark, folder), *_VIEW))), "ends")


@query(
    f"""WITH {_VIEWED}
SELECT month, CAST(count(*) AS BIGINT) AS event_count,
       array_to_string(list_sort(list_distinct(list(event_label))), ', ') AS event_labels FROM in_view GROUP BY month"""
)
def event_markers(spark, folder):
    codes = summary.codes_of_prices(in_months(coarse_snap(spark, folder), *_VIEW))
    return summary.event_markers(_in_view(spark, folder, codes))


@query(f"WITH {SNAP},{LISTED} SELECT code FROM exempt")
def exempt_codes(spark, folder):
    listed, medicines = listed_items(spark, folder)
    return summary.exempt_codes(medicines, listed)


_EXEMPT_TEXT = """CASE WHEN n_exempt = 0 THEN 'Not exempt' WHEN n_exempt = n_codes THEN 'Exempt (s84AH)'
       ELSE n_exempt || ' of ' || n_codes || ' item codes exempt' END AS exempt"""
_CLASS = """codes AS (SELECT DISTINCT drug, form, item_code AS code FROM series),
class AS (
  SELECT drug, form, count(e.code) AS n_exempt, count(*) AS n_codes
  FROM codes c LEFT JOIN exempt e ON e.code = c.code GROUP BY drug, form
)"""


@query(f"WITH {SERIES},{LISTED},{_CLASS} SELECT drug, form, n_exempt, n_codes, {_EXEMPT_TEXT} FROM class")
def exemption_class(spark, folder):
    listed, medicines = listed_items(spark, folder)
    codes = summary.codes_of_prices(coarse_snap(spark, folder))
    return summary.exemption_class(codes, summary.exempt_codes(medicines, listed))


_LAST_EVENT = """seen AS (SELECT DISTINCT drug, form, v.month, v.event_label FROM codes c JOIN in_view v ON v.code = c.code),
latest_event AS (
  SELECT drug, form, month AS last_event_month, string_agg(event_label, ', ' ORDER BY event_label) AS last_event_labels
  FROM seen s WHERE month = (SELECT max(month) FROM seen t WHERE t.drug = s.drug AND t.form = s.form) GROUP BY ALL
)"""


@query(
    f"WITH {_VIEWED},codes AS (SELECT DISTINCT drug, form, item_code AS code FROM series),{_LAST_EVENT} SELECT * FROM latest_event"
)
def last_events(spark, folder):
    ends = _ends(spark, folder)
    return summary.last_events(ends, _in_view(spark, folder, ends))


_ENDS = _FIRST_LAST[len(SERIES):]
_CENT = "CAST(round(CAST({} AS DECIMAL(18,6)), 2) AS DECIMAL(18,2))"
_PCT = q.cents("(CAST(fl AS DOUBLE) - CAST(ff AS DOUBLE)) / nullif(CAST(ff AS DOUBLE), 0) * 100.0")


@query(
    f"""WITH {_VIEWED}{_ENDS},{LISTED},{_CLASS},{_LAST_EVENT},
groups AS (
  SELECT drug, form, count(*) AS n_series, min(first_month) AS fm, max(last_month) AS lm,
         min({_CENT.format('first_aemp')}) AS ff, max({_CENT.format('first_aemp')}) AS fh,
         min({_CENT.format('last_aemp')}) AS fl, max({_CENT.format('last_aemp')}) AS lh, min(listed) AS lst
  FROM ends GROUP BY drug, form
),
pct AS (SELECT *, {_PCT} AS p FROM groups)
SELECT g.drug, g.form, strftime(fm, '%b %Y') || ' – ' || strftime(lm, '%b %Y') AS range, strftime(lst, '%b %Y') AS first_listed,
       CASE WHEN fl = lh THEN {q.money('fl')} ELSE {q.money('fl')} || ' – ' || {q.money('lh')} END AS latest,
       CASE WHEN ff = fh AND fl = lh AND ff <> 0
            THEN CASE WHEN p < 0 THEN '' ELSE '+' END || format('{{:.2f}}%', p) || ' from ' || {q.money('ff')}
            ELSE 'varies across ' || n_series || ' products' END AS change,
       coalesce(strftime(last_event_month, '%b %Y') || ' · ' || last_event_labels, 'none in view') AS last_event,
       {_EXEMPT_TEXT}
FROM pct g JOIN class c ON c.drug = g.drug AND c.form = g.form
LEFT JOIN latest_event e ON e.drug = g.drug AND e.form = g.form"""
)
def summary_cards(spark, folder):
    ends = _ends(spark, folder)
    listed, medicines = listed_items(spark, folder)
    return summary.summary_cards(ends, _in_view(spark, folder, ends), summary.exempt_codes(medicines, listed))
