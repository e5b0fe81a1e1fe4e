"""Price-list views of the benchmark tables (FIXTURES part B), for Spark and for SQL.

Every view reads its whole tables. The SQL text of a view is kept beside its
Spark form so that both say the same.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.functions.months import months_between
from pricetrail.functions.numbers import PRICE
from pricetrail.operators.events import price_events
from pricetrail.session import store
from pricetrail.sources.tables import load, load_spread

# The day the item of key 0 was first listed; later keys follow day by day.
FIRST_LISTING = date(1990, 1, 1)
START, END = date(1998, 5, 1), date(1998, 6, 1)
SIX_MONTHS = months_between(date(1998, 1, 1), END)
# What the snapshots hold at every scale; only the SQL needs them beforehand.
ALL_MONTHS = months_between(date(1995, 1, 1), date(2001, 11, 1))


def snap(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: a price list entry of its ship month."""
    line = load_spread(spark, folder, "lineitem")
    part, supplier = load(spark, folder, "part"), load(spark, folder, "supplier")
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .select(
            F.col("l_partkey").cast("string").alias("item_code"),
            F.col("p_name").alias("drug"),
            F.col("p_type").alias("form"),
            F.col("p_brand").alias("brand"),
            F.col("l_returnflag").alias("formulary"),
            F.col("l_linestatus").alias("program"),
            F.col("p_size").cast("string").alias("pack_qty"),
            F.col("s_name").alias("responsible"),
            F.concat_ws(", ", "p_type", F.col("p_size").cast("string")).alias("amt_pack"),
            F.trunc("l_shipdate", "MM").alias("snapshot_date"),
            F.date_add(F.lit(FIRST_LISTING), F.col("l_partkey").cast("int") % 1000).cast("string").alias("first_listed_date"),
            F.col("l_extendedprice").cast(PRICE).alias("aemp"),
            F.col("l_quantity").cast(PRICE).alias("coarse"),
            F.col("l_tax").cast(PRICE).alias("tax"),
            F.col("l_discount").cast(PRICE).alias("discount"),
        )
    )


SNAP = f"""
snap AS (
  SELECT CAST(l_partkey AS VARCHAR) AS item_code, p_name AS drug, p_type AS form, p_brand AS brand,
         l_returnflag AS formulary, l_linestatus AS program, CAST(p_size AS VARCHAR) AS pack_qty,
         s_name AS responsible, p_type || ', ' || CAST(p_size AS VARCHAR) AS amt_pack,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
         strftime(DATE '{FIRST_LISTING}' + CAST(l_partkey % 1000 AS INTEGER), '%Y-%m-%d') AS first_listed_date,
         CAST(l_extendedprice AS DECIMAL(18,6)) AS aemp, CAST(l_quantity AS DECIMAL(18,6)) AS coarse,
         CAST(l_tax AS DECIMAL(18,6)) AS tax, CAST(l_discount AS DECIMAL(18,6)) AS discount
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)"""


def coarse_snap(spark: SparkSession, folder: str, nulls: bool = False) -> DataFrame:
    """``snap`` priced by quantity and without suppliers: prices and variants repeat. NULLs on request."""
    rows = snap(spark, folder).withColumns(
        {"aemp": F.col("coarse"), "responsible": F.lit(None).cast("string")}
    )
    rows = rows.withColumns({"source_file": _source_file(), "amt_pack_program": F.concat_ws("_", "amt_pack", "program")})
    if nulls:
        rows = rows.withColumns(
            {
                "form": F.when(F.col("pack_qty") != "7", F.col("form")),
                "brand": F.when(~F.col("pack_qty").isin("7", "11"), F.col("brand")),
            }
        )
    return rows


def _source_file():
    return F.concat(F.lit("ex-manufacturer-prices-non-efc-"), F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit(".csv"))


def coarse_sql(nulls: bool = False) -> str:
    form = "CASE WHEN pack_qty <> '7' THEN form END" if nulls else "form"
    brand = "CASE WHEN pack_qty NOT IN ('7', '11') THEN brand END" if nulls else "brand"
    return f"""{SNAP},
rws AS (
  SELECT item_code, drug, {form} AS form, {brand} AS brand, formulary, program, pack_qty,
         CAST(NULL AS VARCHAR) AS responsible, amt_pack, snapshot_date, coarse AS aemp, tax, discount,
         'ex-manufacturer-prices-non-efc-' || strftime(snapshot_date, '%Y-%m-%d') || '.csv' AS source_file,
         amt_pack || '_' || program AS amt_pack_program
  FROM snap
)"""


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Last event of each (user, day) as the item's price of that schedule."""
    events = load(spark, folder, "events")
    part = load(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type"
    )
    last = events.groupBy("user_id", F.to_date("ts").alias("effective_date")).agg(
        F.max_by("value", F.struct("ts", "event_id")).cast(PRICE).alias("determined_price")
    )
    return last.join(part, last.user_id == part.p_partkey, "left").select(
        F.col("user_id").alias("li_item_id"),
        "effective_date",
        "determined_price",
        F.col("user_id").cast("string").alias("pbs_code"),
        F.col("p_name").alias("li_drug_name"),
        F.col("p_type").alias("li_form"),
        F.col("p_brand").alias("brand_name"),
        F.when(F.col("user_id") % 3 == 0, "60").when(F.col("user_id") % 3 == 1, "F1").otherwise("cdl").alias("formulary"),
    )


ITEMS = """
last_events AS (
  SELECT user_id, CAST(ts AS DATE) AS effective_date, CAST(value AS DECIMAL(18,6)) AS determined_price
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
        FROM events)
  WHERE rn = 1
),
items AS (
  SELECT user_id AS li_item_id, effective_date, determined_price, CAST(user_id AS VARCHAR) AS pbs_code,
         p_name AS li_drug_name, p_type AS li_form, p_brand AS brand_name,
         CASE user_id % 3 WHEN 0 THEN '60' WHEN 1 THEN 'F1' ELSE 'cdl' END AS formulary
  FROM last_events LEFT JOIN part ON user_id = p_partkey
)"""

# One code per branch of the label rules, chosen by event type and id.
_CODES = {
    "click": ["X_PD_FLOWON", "X_15_YR_F1", "COMBO_10_YR_F1"],
    "view": ["Y_APA_1", "Y_5_YR_F1", "Y_LEGIS_2"],
    "signup": ["Z_NB", "Z_COMBO_PD", "Z_OTHER"],
    "purchase": ["W_PD", "W_COMBO_NB", "W_APA_PD"],
}


def item_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a pricing event of its user's item. ``error`` events carry no code."""
    events = load(spark, folder, "events")
    code = F.lit(None).cast("string")
    for kind, codes in _CODES.items():
        for i, c in enumerate(codes):
            code = F.when((F.col("event_type") == kind) & (F.col("event_id") % 3 == i), c).otherwise(code)
    # Some events name an item that no schedule lists.
    item = F.when(F.col("event_id") % 97 == 0, -F.col("user_id") - 1).otherwise(F.col("user_id"))
    return events.select(
        item.alias("li_item_id"),
        F.to_date("ts").alias("effective_date"),
        code.alias("event_type_code"),
        F.get_json_object("props", "$.k").alias("percentage_applied"),
    )


def _code_case() -> str:
    arms = [
        f"WHEN event_type = '{kind}' AND event_id % 3 = {i} THEN '{c}'"
        for kind, codes in _CODES.items()
        for i, c in enumerate(codes)
    ]
    return "CASE " + " ".join(arms) + " END"


ITEM_EVENTS = f"""
item_events AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN -user_id - 1 ELSE user_id END AS li_item_id,
         CAST(ts AS DATE) AS effective_date, {_code_case()} AS event_type_code,
         json_extract_string(props, '$.k') AS percentage_applied
  FROM events
)"""

def label_case(c: str) -> str:
    """SQL of the event label rules on one column."""
    return f"""CASE WHEN contains({c}, 'PD_FLOWON') THEN {c} WHEN contains({c}, 'APA') THEN {c}
  WHEN contains({c}, '15_YR_F1') THEN '15-year anniversary'
  WHEN contains({c}, '10_YR_F1') THEN '10-year anniversary'
  WHEN contains({c}, '5_YR_F1') THEN '5-year anniversary'
  WHEN contains({c}, 'LEGIS') THEN '15-year anniversary (1.48%)'
  WHEN ends_with({c}, '_NB') THEN 'First new brand'
  WHEN ends_with({c}, '_PD') THEN 'Price disclosure' ELSE {c} END"""


PRICE_EVENTS = f"""{ITEMS},{ITEM_EVENTS},
dates AS (SELECT effective_date, lag(effective_date) OVER (ORDER BY effective_date) AS prev_date
          FROM (SELECT DISTINCT effective_date FROM items)),
price_events AS (
  SELECT e.li_item_id, cur.pbs_code, cur.li_drug_name, cur.brand_name, cur.formulary,
         e.effective_date AS event_date, e.event_type_code,
         {label_case('e.event_type_code')} AS event_label,
         e.event_type_code LIKE '%COMBO%' AS is_combination,
         CAST(e.percentage_applied AS DOUBLE) AS percentage_applied,
         prv.determined_price AS price_before, cur.determined_price AS price_after
  FROM item_events e LEFT JOIN dates d ON d.effective_date = e.effective_date
  LEFT JOIN items cur ON cur.li_item_id = e.li_item_id AND cur.effective_date = e.effective_date
  LEFT JOIN items prv ON prv.li_item_id = e.li_item_id AND prv.effective_date = d.prev_date
)"""


def dated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Pricing events moved onto the months of ``snap``: day n of the events is its month n."""
    found = price_events(item_events(spark, folder), store(items(spark, folder), "items"))
    return found.withColumn("event_date", F.add_months(F.lit(date(1995, 1, 1)), F.day("event_date") - 1))


DATED_EVENTS = f"""{PRICE_EVENTS},
dated_events AS (
  SELECT * REPLACE (CAST(DATE '1995-01-01' + to_months(CAST(day(event_date) - 1 AS INTEGER)) AS DATE) AS event_date)
  FROM price_events
)"""


def listed_items(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Yearly item lists of ``snap``, stored once, and their medicine table with exemption flags."""
    found = snap(spark, folder).select(
        F.col("item_code").alias("li_item_id"),
        F.trunc("snapshot_date", "YEAR").alias("effective_date"),
        F.concat(F.lit(" "), F.col("item_code")).alias("pbs_code"),
        "pack_qty", "brand", "form",
    ).distinct()
    found = store(found, "listed")
    size = F.col("pack_qty").cast("int")
    medicines = found.select(
        "li_item_id", "effective_date",
        F.when(size % 5 == 0, "TPUU").otherwise("MPUU").alias("concept_type_code"),
        F.when((F.col("form") == "ECONOMY") | (size % 2 == 0), "Y").otherwise("N").alias("exempt_ind"),
    )
    return found.select("li_item_id", "effective_date", "pbs_code"), medicines


LISTED = """
listed AS (
  SELECT DISTINCT item_code AS li_item_id, CAST(date_trunc('year', snapshot_date) AS DATE) AS effective_date,
         ' ' || item_code AS pbs_code, CAST(pack_qty AS INTEGER) AS size, form
  FROM snap
),
medicines AS (
  SELECT li_item_id, effective_date, CASE WHEN size % 5 = 0 THEN 'TPUU' ELSE 'MPUU' END AS concept_type_code,
         CASE WHEN form = 'ECONOMY' OR size % 2 = 0 THEN 'Y' ELSE 'N' END AS exempt_ind
  FROM listed
),
exempt AS (
  SELECT DISTINCT trim(i.pbs_code) AS code
  FROM medicines a JOIN listed i ON i.li_item_id = a.li_item_id AND i.effective_date = a.effective_date
  WHERE a.concept_type_code = 'MPUU' AND a.exempt_ind = 'Y'
    AND a.effective_date = (SELECT max(effective_date) FROM medicines)
)"""
