"""Text, number and label functions over whole tables."""

from pyspark.sql import functions as F

from pricetrail.functions import months, numbers, text
from pricetrail.operators import events as ev
from pricetrail.operators import series
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import ITEM_EVENTS, SNAP, item_events, label_case, snap
from pricetrail.plans.registry import query
from pricetrail.sources.tables import load, load_spread


@query(
    f"""SELECT doc_id, nullif({q.collapse('text')}, '') AS plain, {q.punct('text')} AS punctuated,
       coalesce({q.collapse('text')}, '') AS identifier, concat_ws('_', nullif(trim(lang), ''), nullif(trim(source), '')) AS joined
FROM documents"""
)
def normalize_identifiers(spark, folder):
    body = F.col("text")
    return load_spread(spark, folder, "documents").select(
        "doc_id",
        text.normalize_text(body).alias("plain"),
        text.normalize_punct(body).alias("punctuated"),
        text.wide_identifier(body).alias("identifier"),
        text.joined_label(F.col("lang"), F.col("source")).alias("joined"),
    )


@query(f"SELECT doc_id, {q.amt('text')} AS pack FROM documents")
def amt_normalize(spark, folder):
    return load_spread(spark, folder, "documents").select("doc_id", text.amt_pack(F.col("text")).alias("pack"))


_LOUD = "form || ' Tablets;  FILM COATED ' || pack_qty || '.5 mL, Capsules'"


@query(
    f"""WITH {SNAP}, named AS (SELECT DISTINCT item_code, drug, {_LOUD} AS form, brand, formulary, CAST(NULL AS VARCHAR) AS responsible, amt_pack FROM snap)
SELECT item_code, formulary, {q.shown('item_code', 'brand', 'form', 'formulary', 'amt_pack', 'responsible')} AS display_name,
       concat_ws('|', {q.canon('drug')}, {q.canon('form')}, {q.canon('brand')}, {q.canon('responsible')}, {q.canon('amt_pack')}) AS series_id
FROM named"""
)
def canon_series_key(spark, folder):
    loud = F.concat(F.col("form"), F.lit(" Tablets;  FILM COATED "), F.col("pack_qty"), F.lit(".5 mL, Capsules"))
    unknown = F.lit(None).cast("string")
    named = snap(spark, folder).withColumns({"form": loud, "responsible": unknown}).select(
        "item_code", "drug", "form", "brand", "formulary", "responsible", "amt_pack"
    ).distinct()
    shown = [F.col(c) for c in ("item_code", "brand", "form", "formulary", "amt_pack", "responsible")]
    keyed = [F.col(c) for c in ("drug", "form", "brand", "responsible", "amt_pack")]
    return named.select(
        "item_code", "formulary",
        text.display_name(shown).alias("display_name"), text.series_key(*keyed).alias("series_id"),
    )


_NUMBER = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number_sql(c: str, marks: str) -> str:
    bare = f"trim(regexp_replace({c}, '{marks}', '', 'g'))"
    return f"CAST(CASE WHEN regexp_matches({bare}, '{_NUMBER}') THEN TRY_CAST({bare} AS DOUBLE) END AS DECIMAL(18,6))"


@query(
    f"""WITH raw AS (
  SELECT l_orderkey, l_linenumber, CAST(l_discount AS VARCHAR) AS pct,
    CASE l_linenumber WHEN 1 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 2 THEN format('{{:,.2f}}', l_extendedprice) WHEN 3 THEN '$' || format('{{:,.2f}}', l_extendedprice)
      WHEN 4 THEN '  ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '. ' WHEN 5 THEN 'nan'
      WHEN 6 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'd' ELSE '' END AS price_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, price_text, {_number_sql('price_text', ',')} AS single_price,
       {_number_sql('price_text', '[,$]')} AS multi_price, CAST(pct AS DOUBLE) AS percentage FROM raw"""
)
def price_parse(spark, folder):
    n, price, qty = F.col("l_linenumber"), F.col("l_extendedprice"), F.col("l_quantity").cast("int").cast("string")
    grouped = F.format_number(price, 2)
    raw = load_spread(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("string").alias("pct"),
        F.when(n == 1, price.cast("decimal(18,2)").cast("string"))
        .when(n == 2, grouped)
        .when(n == 3, F.concat(F.lit("$"), grouped))
        .when(n == 4, F.concat(F.lit("  "), qty, F.lit(". ")))
        .when(n == 5, "nan")
        .when(n == 6, F.concat(qty, F.lit("d")))
        .otherwise("").alias("price_text"),
    )
    shown = F.col("price_text")
    return raw.select(
        "l_orderkey", "l_linenumber", "price_text",
        numbers.to_price(numbers.price_number(shown)).alias("single_price"),
        numbers.to_price(numbers.price_number(shown, currency_sign=True)).alias("multi_price"),
        F.col("pct").cast("double").alias("percentage"),
    )


@query(
    """WITH coded AS (
  SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '1' WHEN 1 THEN ' F1 ' WHEN 2 THEN '60' WHEN 3 THEN 'F2'
         WHEN 4 THEN 'cdl' WHEN 5 THEN '' ELSE p_brand END AS code FROM part)
SELECT p_partkey, CASE WHEN trim(code) IN ('1', 'F1') THEN 'F1' WHEN trim(code) IN ('60', 'F2') THEN 'F2'
       WHEN upper(trim(code)) = 'CDL' THEN 'CDL' ELSE nullif(trim(code), '') END AS formulary FROM coded"""
)
def formulary_normalize(spark, folder):
    k = F.col("p_partkey") % 7
    code = (
        F.when(k == 0, "1").when(k == 1, " F1 ").when(k == 2, "60").when(k == 3, "F2")
        .when(k == 4, "cdl").when(k == 5, "").otherwise(F.col("p_brand"))
    )
    return load(spark, folder, "part").select("p_partkey", text.formulary(code).alias("formulary"))


@query(
    f"""WITH {ITEM_EVENTS}
SELECT event_type_code, {label_case('event_type_code')} AS event_label, event_type_code LIKE '%COMBO%' AS is_combination,
       count(*) AS n FROM item_events GROUP BY ALL"""
)
def event_label(spark, folder):
    code = F.col("event_type_code")
    return (
        item_events(spark, folder)
        .groupBy(code)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "event_type_code", text.event_label(code).alias("event_label"),
            ev.is_combination(code).alias("is_combination"), "n",
        )
    )


@query(
    """SELECT o_orderkey, format('${:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))) AS price_label,
       CASE WHEN p < 0 THEN '' ELSE '+' END || format('{:.2f}%', p) AS signed_change, format('{:.2f}%', p) AS change
FROM (SELECT *, CAST(o_totalprice - 250000 AS DECIMAL(18,2)) AS p FROM orders)"""
)
def money_format(spark, folder):
    change = (F.col("o_totalprice") - 250000).cast("decimal(18,2)")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        numbers.money_text(F.col("o_totalprice").cast("decimal(18,2)")).alias("price_label"),
        numbers.percent_text(change, signed=True).alias("signed_change"),
        numbers.percent_text(change).alias("change"),
    )


@query(
    """SELECT o_orderkey, 'AEMP ' || strftime(o_orderdate, '%b %y') AS label,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month, strftime(o_orderdate, '%Y-%m') AS month_key,
       year(o_orderdate) || '-0' || ((month(o_orderdate) - 1) // 4 + 1) AS month_bucket,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS price_band FROM orders"""
)
def month_labels(spark, folder):
    day = F.to_date("o_orderdate")
    return load(spark, folder, "orders").withColumn("label", months.month_label(day)).select(
        "o_orderkey", "label",
        months.label_month(F.col("label")).alias("month"),
        months.month_key(day).alias("month_key"),
        months.four_month_bucket(day).alias("month_bucket"),
        numbers.price_band(F.col("o_totalprice")).alias("price_band"),
    )


_SEARCH = """CASE p_partkey % 5 WHEN 0 THEN 'C' || p_partkey || ', c' || (p_partkey + 1) || ' '
    WHEN 1 THEN 'c' || p_partkey || '  C' || (p_partkey + 2) WHEN 2 THEN ' C' || p_partkey || ' '
    WHEN 3 THEN 'C' || p_partkey || ';' || chr(10) || 'zz' ELSE 'C' || p_partkey || ' plus' END"""


@query(
    f"""WITH {SNAP},
searches AS (SELECT {_SEARCH} AS search FROM part),
words AS (SELECT search, list_filter(string_split_regex(lower(search), '\\s+'), lambda x: x <> '') AS w FROM searches),
tokens AS (
  SELECT search, CASE
    WHEN regexp_matches(search, '[,;\\n]') THEN list_filter(list_transform(string_split_regex(lower(search), '[,;\\n]+'), lambda x: trim(x)), lambda x: x <> '')
    WHEN len(w) > 1 AND len(list_filter(w, lambda x: NOT (regexp_full_match(x, '[a-z0-9]+') AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[0-9]')))) = 0 THEN w
    ELSE [lower(trim(search))] END AS codes FROM words),
codes AS (SELECT DISTINCT search, unnest(codes) AS code FROM tokens)
SELECT DISTINCT search, drug FROM codes JOIN (SELECT DISTINCT drug, 'c' || item_code AS code FROM snap) USING (code)"""
)
def code_search_tokens(spark, folder):
    key = F.col("p_partkey")
    c, k = F.concat(F.lit("C"), key), key % 5
    search = (
        F.when(k == 0, F.concat(c, F.lit(", c"), key + 1, F.lit(" ")))
        .when(k == 1, F.concat(F.lower(c), F.lit("  C"), key + 2))
        .when(k == 2, F.concat(F.lit(" "), c, F.lit(" ")))
        .when(k == 3, F.concat(c, F.lit(";\nzz")))
        .otherwise(F.concat(c, F.lit(" plus")))
    )
    searches = load(spark, folder, "part").select(search.alias("search"))
    pairs = snap(spark, folder).select("drug", F.concat(F.lit("C"), F.col("item_code")).alias("item_code"))
    return series.match_searches(searches, pairs)


@query(
    f"""WITH {SNAP}, pairs AS (SELECT DISTINCT drug, item_code FROM snap)
SELECT drug, drug || ' | ' || string_agg(item_code, ', ' ORDER BY item_code) AS search_label FROM pairs GROUP BY drug"""
)
def drug_code_list(spark, folder):
    return series.drug_codes(snap(spark, folder)).select("drug", "search_label")


@query(
    f"""WITH {SNAP}, pairs AS (SELECT DISTINCT drug, item_code FROM snap)
SELECT drug, count(*) AS n_codes FROM pairs GROUP BY drug HAVING bool_or(item_code IN ('7', '12', '150'))"""
)
def drug_search(spark, folder):
    found = series.matching_drugs(series.drug_codes(snap(spark, folder)), " 7; 12,\n150")
    return found.select("drug", F.size("item_codes").cast("bigint").alias("n_codes"))
