"""Archive bundles, pages and schedules."""

from pyspark.sql import functions as F

from pricetrail.operators import archive, series, sinks
from pricetrail.plans import sqltext as q
from pricetrail.plans.fixtures import ITEM_EVENTS, ITEMS, item_events, items
from pricetrail.plans.registry import query
from pricetrail.session import new_path
from pricetrail.sources import archive_files
from pricetrail.sources.tables import load


def _odd_id(number, tail=""):
    """``ORG7``, ``102.5``, 16-digit neighbours or a whole number, by the number itself."""
    return (
        F.when(number % 4 == 0, F.concat(F.lit("ORG"), number))
        .when(number % 4 == 1, F.concat(number, F.lit(".5")))
        .when(number % 4 == 2, (F.lit(9007199254740992) + number).cast("string"))
        .otherwise(F.concat(number, F.lit(tail)))
    )


def _bronze(spark, folder):
    """Items as archive text rows: schedule code and effective date beside them."""
    found = items(spark, folder)
    return found.select(
        F.col("li_item_id").cast("string").alias("li_item_id"),
        "pbs_code", "li_drug_name", "formulary",
        F.col("determined_price").cast("string").alias("determined_price"),
        F.date_format("effective_date", "yyyyMMdd").alias("schedule_code"),
        F.date_format("effective_date", "yyyy-MM-dd").alias("_effective_date"),
    )


@query(
    f"""WITH {ITEMS}, stored AS (
  SELECT *, strftime(effective_date, '%Y-%m-%d') AS _effective_date, day(effective_date) AS d FROM items)
SELECT CAST(li_item_id AS VARCHAR) AS li_item_id, pbs_code,
       CASE WHEN d = 5 THEN 'none' ELSE li_drug_name END AS li_drug_name, formulary,
       CAST(determined_price AS VARCHAR) AS determined_price, strftime(effective_date, '%Y%m%d') AS schedule_code,
       _effective_date, CASE WHEN d = 5 THEN 'yes' END AS corrected
FROM stored WHERE d <> 6"""
)
def archive_replace(spark, folder):
    """All schedules loaded, then two sent again: one corrected and wider, one empty."""
    bronze, path = _bronze(spark, folder), new_path(spark, "items")
    dates = [r[0] for r in bronze.select("_effective_date").distinct().collect()]
    sinks.replace_schedules(bronze, path, dates)
    resent = [d for d in dates if d.endswith(("-05", "-06"))]
    again = bronze.where(F.substring("_effective_date", 9, 2) == "05").withColumns(
        {"li_drug_name": F.lit("none"), "corrected": F.lit("yes")}
    )
    sinks.replace_schedules(again, path, resent)
    return sinks.read_archive(spark, path)


@query(
    f"""WITH {ITEMS}
SELECT CAST(li_item_id AS VARCHAR) AS li_item_id, pbs_code, li_drug_name, formulary,
       CAST(determined_price AS VARCHAR) AS determined_price, strftime(effective_date, '%Y%m%d') AS schedule_code,
       strftime(effective_date, '%Y-%m-%d') AS _effective_date
FROM items WHERE day(effective_date) <> 7"""
)
def archive_clear(spark, folder):
    """All schedules loaded, then one day sent again as a page without rows."""
    bronze, path, page = _bronze(spark, folder), new_path(spark, "items"), new_path(spark, "pages")
    dates = [r[0] for r in bronze.select("_effective_date").distinct().collect()]
    sinks.replace_schedules(bronze, path, dates)
    spark.createDataFrame([('{"_meta": {"total_records": 0}, "data": []}',)], "value string").write.text(page)
    for day in (d for d in dates if d.endswith("-07")):
        empty = archive_files.read_pages(spark, page, columns=["li_item_id", "pbs_code"])
        sinks.replace_schedules(sinks.stamp(empty, day.replace("-", ""), day), path, [day])
    kept = [*bronze.columns[:-1]]
    return sinks.read_archive(spark, path, kept).withColumn("_effective_date", F.col("_effective_date").cast("string"))


@query(
    f"""WITH {ITEMS}
SELECT li_item_id, effective_date, determined_price, pbs_code, coalesce(li_drug_name, 'n/a, "none"') AS li_drug_name, formulary
FROM items"""
)
def archive_csv(spark, folder):
    """Items written as an archive CSV with the word ``null`` for missing prices, and read back."""
    bronze, path = _bronze(spark, folder), new_path(spark, "bundle")
    shown = bronze.withColumns(
        {
            "li_drug_name": F.coalesce("li_drug_name", F.lit('n/a, "none"')),
            "organisation_id": F.lit("null"),
        }
    )
    shown.write.option("header", True).option("escape", '"').csv(path)
    typed = archive.typed_items(archive_files.read_bundle_csv(spark, path))
    return typed.where("organisation_id IS NULL").select(
        F.col("li_item_id").cast("bigint"), "effective_date", "determined_price", "pbs_code", "li_drug_name", "formulary"
    )


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, '202401' || (p_partkey % 3) AS _schedule_code,
       CASE WHEN p_partkey % 3 < 2 THEN '2024-01-0' || (p_partkey % 3 + 1) END AS _effective_date, true AS stamped FROM part"""
)
def stamped_rows(spark, folder):
    """Rows of three schedules, each marked on loading; the last one has no date."""
    rows = load(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name")
    marked = [
        sinks.stamp(rows.where(F.col("p_partkey") % 3 == i), f"202401{i}", f"2024-01-0{i + 1}" if i < 2 else None)
        for i in range(3)
    ]
    time = F.col("_downloaded_at_utc").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    return sinks.append_by_name(marked).withColumn("stamped", time).drop("_downloaded_at_utc")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, json_extract_string(props, '$.k') AS k,
       event_type = 'click' AS has_tag FROM events"""
)
def json_pages(spark, folder):
    """Events as landed pages of a thousand rows, read back. Nested keys differ by row."""
    path = new_path(spark, "pages")
    k = F.get_json_object("props", "$.k")
    detail = F.concat(
        F.lit('{"k": '), k, F.when(F.col("event_type") == "click", ', "tag": [1, {"a": "b"}]').otherwise(""), F.lit("}")
    )
    row = F.concat(
        F.lit('{"event_id": '), F.col("event_id"), F.lit(', "event_type": "'), F.col("event_type"),
        F.lit('", "_meta": 1, "change_detail": '), detail, F.lit("}"),
    )
    pages = load(spark, folder, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("page")).agg(
        F.concat_ws(", ", F.collect_list(row)).alias("rows")
    )
    pages.select(
        F.concat(F.lit('{"_meta": {"total_records": 1}, "_links": [], "data": ['), F.col("rows"), F.lit("]}"))
    ).write.text(path)
    rows = archive_files.read_pages(spark, path, multi_line=False)
    return rows.select(
        "event_id", "event_type",
        F.get_json_object("change_detail", "$.k").alias("k"),
        F.get_json_object("change_detail", "$.tag[1].a").isNotNull().alias("has_tag"),
    )


_SPOILT = "event_id % 50 = 49"


@query(
    f"""SELECT CASE WHEN NOT {_SPOILT} THEN event_id END AS event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'click' THEN 'b' END AS tag, CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS day FROM events"""
)
def json_pages_typed(spark, folder):
    """The same kind of pages read as variants, typed by path. Rows differ in shape; some ids are no numbers."""
    path = new_path(spark, "pages")
    click = F.col("event_type") == "click"
    row = F.to_json(F.struct(
        F.when(F.expr(_SPOILT), F.lit("none")).otherwise(F.col("event_id").cast("string")).alias("event_id"),
        "event_type",
        F.struct(
            F.get_json_object("props", "$.k").cast("long").alias("k"),
            F.when(click, F.array(F.struct(F.lit("b").alias("a")))).alias("tag"),
        ).alias("detail"),
        F.when(~click, F.date_format("ts", "yyyy-MM-dd")).alias("day"),
    ))
    pages = load(spark, folder, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("page")).agg(
        F.concat_ws(",", F.collect_list(row)).alias("rows")
    )
    pages.select(F.concat(F.lit('{"_links": [], "data": [null,'), F.col("rows"), F.lit("]}"))).write.text(path)
    rows = archive_files.read_variant_rows(spark, path, multi_line=False)
    return archive_files.typed_fields(rows, {
        "event_id": ("$.event_id", "bigint"), "event_type": ("$.event_type", "string"), "k": ("$.detail.k", "bigint"),
        "tag": ("$.detail.tag[0].a", "string"), "day": ("$.day", "date"),
    })


@query(
    f"""WITH {ITEMS},{ITEM_EVENTS}
SELECT 'item_events' AS table_name, count(*) AS n_rows, count(DISTINCT effective_date) AS n_schedules FROM item_events
UNION ALL SELECT 'items', count(*), count(DISTINCT effective_date) FROM items
UNION ALL SELECT 'labels', count(*), NULL FROM labels"""
)
def archive_contents(spark, folder):
    tables = {
        "items": items(spark, folder),
        "item_events": item_events(spark, folder),
        "labels": load(spark, folder, "labels"),
    }
    return archive.contents(tables, stamp="effective_date")


@query(
    f"""WITH {ITEMS}, s AS (SELECT DISTINCT strftime(effective_date, '%Y%m%d') AS schedule_code, effective_date FROM items)
SELECT 'latest' AS mode, * FROM s WHERE effective_date = (SELECT max(effective_date) FROM s)
UNION ALL SELECT 'one', * FROM s WHERE schedule_code = '20240110' UNION ALL SELECT 'all', * FROM s"""
)
def schedule_targets(spark, folder):
    schedules = items(spark, folder).select(
        F.date_format("effective_date", "yyyyMMdd").alias("schedule_code"), "effective_date"
    ).distinct()
    modes = {
        "latest": archive_files.target_schedules(schedules),
        "one": archive_files.target_schedules(schedules, code="20240110"),
        "all": archive_files.target_schedules(schedules, backfill=True),
    }
    return sinks.append_by_name([df.select(F.lit(m).alias("mode"), "*") for m, df in modes.items()])


@query(
    f"""WITH {ITEMS}
SELECT li_item_id, CAST(date_trunc('month', effective_date) AS DATE) AS month, determined_price, effective_date, pbs_code,
       formulary FROM (
  SELECT *, row_number() OVER (PARTITION BY li_item_id, date_trunc('month', effective_date) ORDER BY effective_date DESC) AS rn
  FROM items WHERE determined_price IS NOT NULL) WHERE rn = 1"""
)
def superseding_schedule(spark, folder):
    return archive.superseding(items(spark, folder)).select(
        "li_item_id", "month", "determined_price", "effective_date", "pbs_code", "formulary"
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_date,
       CASE WHEN s_acctbal >= 0 THEN s_name END AS responsible
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey"""
)
def org_join(spark, folder):
    """Supplier ids of four kinds: text, fractions, neighbouring long numbers, and whole numbers
    written ``12.0`` on one side and ``12`` on the other."""
    line = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.trunc("l_shipdate", "MM").alias("effective_date"),
        _odd_id(F.col("l_suppkey"), ".0").alias("organisation_id"),
    )
    supplier = load(spark, folder, "supplier").where("s_acctbal >= 0").select(
        _odd_id(F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name")
    )
    listed = load(spark, folder, "lineitem").select(
        _odd_id(F.col("l_suppkey")).alias("id"), F.trunc("l_shipdate", "MM").alias("effective_date")
    ).distinct()
    organisations = listed.join(supplier, "id")
    return archive.with_organisation(line, organisations).drop("organisation_id")


_LAST_OF_MONTH = """last_of_month AS (
  SELECT *, CAST(date_trunc('month', effective_date) AS DATE) AS month FROM (
    SELECT *, row_number() OVER (PARTITION BY li_item_id, date_trunc('month', effective_date) ORDER BY effective_date DESC) AS rn
    FROM items WHERE determined_price IS NOT NULL) WHERE rn = 1
)"""
_FORM = "CASE formulary WHEN '60' THEN 'F2' WHEN 'cdl' THEN 'CDL' ELSE formulary END"


@query(
    f"""WITH {ITEMS},{_LAST_OF_MONTH}, named AS (
  SELECT month, pbs_code AS item_code, coalesce(li_drug_name, '') AS drug, coalesce(li_form, '') AS form, coalesce(brand_name, '') AS brand,
         {_FORM} AS formulary, coalesce(CASE WHEN s_acctbal >= 0 THEN s_name END, '') AS responsible,
         strftime(DATE '2010-03-01' + CAST(li_item_id % 500 AS INTEGER), '%Y-%m-%d') AS first_listed_date, determined_price
  FROM last_of_month LEFT JOIN supplier ON s_suppkey = li_item_id
)
SELECT month, drug || ' · ' || {q.shown('item_code', 'brand', 'form', 'formulary', 'responsible')} AS display_name,
       CAST(determined_price AS DOUBLE) AS aemp, item_code, form, responsible, '' AS amt_pack, first_listed_date, drug,
       drug || '|' || concat_ws('|', {q.canon('drug')}, {q.canon('form')}, {q.canon('brand')}, {q.canon('responsible')}, '') AS series_id
FROM named"""
)
def archive_series(spark, folder):
    """Archive items to price series: the month's last schedule, organisation names, formulary rule, listing dates."""
    listed = items(spark, folder).withColumns({
        "organisation_id": F.concat(F.col("li_item_id"), F.lit(".0")),
        "first_listed_date": F.date_add(F.lit("2010-03-01").cast("date"), (F.col("li_item_id") % 500).cast("int")).cast("string"),
    })
    organisations = (
        listed.select("li_item_id", "effective_date").distinct()
        .join(load(spark, folder, "supplier").where("s_acctbal >= 0"), F.col("li_item_id") == F.col("s_suppkey"))
        .select(F.col("s_suppkey").cast("string").alias("organisation_id"), "effective_date", "s_name")
        .withColumnRenamed("s_name", "organisation_name")
    )
    return series.price_series(archive.price_rows(archive.superseding(listed), organisations))
