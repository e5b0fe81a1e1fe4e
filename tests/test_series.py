from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetrail.functions.months import in_months, months_between
from pricetrail.operators import movers, quality, series, sinks, summary, wide
from pricetrail.session import new_path
from pricetrail.sources.tables import canonical_wide, detect_roles, missing_tables, pick_column

SCHEMA = (
    "item_code string, drug string, form string, brand string, formulary string, responsible string, "
    "amt_pack string, snapshot_date date, aemp decimal(18,6), first_listed_date string"
)


def prices(spark, *cells):
    rows = [
        (code, drug, form, "b", "F1", None, "p", date(2025, m, 1), None if p is None else Decimal(str(p)), listed)
        for code, drug, form, m, p, listed in cells
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_change_points_keep_edges_and_both_sides_of_a_change(spark):
    df = prices(spark, *[("1", "d", "f", m, p, None) for m, p in enumerate([5, 5, 5, 6, 6, 6, 6, 5], start=1)])
    points = series.change_points(series.price_series(df))
    assert [r.month.month for r in points.orderBy("month").collect()] == [1, 3, 4, 7, 8]
    cut = series.change_points(series.price_series(df), sliced=True)
    assert sorted(map(str, cut.select(*sorted(cut.columns)).collect())) == sorted(
        map(str, points.select(*sorted(points.columns)).collect())
    )


def test_crowding_counts_from_zero(spark):
    df = prices(spark, *[(str(i), "d", f"f{i}", 1, 5, None) for i in range(4)])
    points = series.change_points(series.price_series(df))
    for sliced in (False, True):
        got = series.price_crowding(points, sliced=sliced).orderBy("series_id").collect()
        assert [(r.collision_rank, r.collision_size, r.label_side) for r in got] == [(i, 4, "top") for i in range(4)]


def test_series_of_picked_drugs_are_tagged_as_spelled(spark):
    df = prices(spark, ("1", "Abc", "f", 1, 5, None), ("2", "xyz", "f", 1, 5, None), ("3", "abc", "f", 1, None, None))
    got = series.price_series(df, ["ABC"]).collect()
    assert [(r.drug, r.display_name, r.series_id) for r in got] == [
        ("ABC", "ABC · 1 · b · f · F1 · p", "ABC|abc|f|b||p")
    ]
    assert series.in_range(series.price_series(df), picked=["xyz · 2 · b · f · F1 · p"]).count() == 1


def test_wide_and_back(spark):
    df = prices(
        spark, ("1", "d", "f", 1, 5, "2020-01-01"), ("1", "d", "f", 1, 6, "2020-01-01"), ("1", "d", "f", 3, 7, "2020-01-01"),
        ("2", "d", "f", 2, None, None), ("3", "e", "f", 2, 9, None),
    )
    months = months_between(date(2025, 1, 1), date(2025, 3, 1))
    table = wide.wide_mean(df, months)
    assert wide.month_columns(table) == ["AEMP Jan 25", "AEMP Feb 25", "AEMP Mar 25"]
    assert sorted(r["Item Code"] for r in table.collect()) == ["1", "3"]
    long = {(r["Item Code"], r.month.month): r.aemp for r in wide.wide_to_long(table).collect()}
    assert long == {("1", 1): 5.5, ("1", 3): 7.0, ("3", 2): 9.0}
    direct = {(r.item_code, r.month.month): r.aemp for r in series.price_series(df).collect()}
    assert direct == long
    first = {r["Item Code"]: r["AEMP Jan 25"] for r in wide.wide_first(df, months).collect()}
    assert first == {"1": 6, "3": None}
    cut = wide.export_range(table, drugs=["D"], first=date(2025, 1, 15), last=date(2025, 2, 2))
    assert cut.columns[-2:] == ["AEMP Jan 25", "AEMP Feb 25"] and cut.count() == 1
    assert wide.export_range(table, first=date(2030, 1, 1)).count() == 0
    out = new_path(spark, "csv")
    sinks.export_csv(table, out)
    assert spark.read.option("header", True).csv(out).count() == 2


def test_wide_takes_the_last_snapshot_of_the_month(spark):
    df = prices(spark, ("1", "d", "f", 1, 9, None)).withColumn("snapshot_date", F.lit(date(2025, 1, 1)))
    later = df.withColumns({"snapshot_date": F.lit(date(2025, 1, 20)), "aemp": F.lit(3).cast("decimal(18,6)")})
    got = wide.wide_first(df.unionByName(later), [date(2025, 1, 1)]).first()
    assert got["AEMP Jan 25"] == 3


def test_movers(spark):
    df = prices(
        spark, ("1", "d", "f", 1, 10, None), ("1", "d", "f", 1, 2, None), ("1", "d", "f", 2, 15, None),
        ("2", "d", "f", 1, 0, None), ("2", "d", "f", 2, 1, None), ("3", "d", "f", 1, 5, None), ("4", "e", "f", 1, 9, None),
        ("4", "e", "f", 2, 6, None),
    )
    a, b = date(2025, 1, 1), date(2025, 2, 1)
    up = movers.movers(df, a, b).collect()
    assert [(r.item_code, r.abs_change, r.pct_change) for r in up] == [("1", 3, 25), ("2", 1, None)]
    down = movers.movers(df, a, b, rising=False, drugs=["E"]).collect()
    assert [(r.abs_change, r.pct_change) for r in down] == [(3, Decimal("-33.33"))]
    text = movers.summary_text(movers.summary(movers.movers(df, a, b))).first()[0]
    assert text == "Summary: 2 items increased. Largest +$3.00, median +$2.00, total +$4.00."
    with pytest.raises(ValueError):
        movers.movers(df, b, a)
    assert [r.month for r in movers.latest_months(df).collect()] == [b, a]


def test_drug_search(spark):
    pairs = spark.createDataFrame([("A", "9X"), ("A", "1Y"), ("B", None), ("C", "2Z")], "drug string, item_code string")
    listed = series.drug_codes(pairs)
    labels = {r.drug: r.search_label for r in listed.collect()}
    assert labels == {"A": "A | 1Y, 9X", "B": "B", "C": "C | 2Z"}
    assert [r.drug for r in series.matching_drugs(listed, "9x, nope").collect()] == ["A"]
    assert series.matching_drugs(listed, " ").count() == 3


def test_summary_cards(spark):
    df = prices(
        spark, ("1", "d", "f", 1, 10, "2020-05-01"), ("1", "d", "f", 3, 11, "2020-05-01"),
        ("2", "d", "g", 1, 4, "junk"), ("3", "d", "g", 2, 5, None),
    ).withColumn("brand", F.col("item_code"))
    points = series.price_series(df)
    ev = spark.createDataFrame(
        [(" 1", date(2025, 2, 9), "B"), ("1", date(2025, 2, 1), "A"), ("1", date(2025, 1, 1), "Z"), ("9", date(2025, 3, 1), "Q"),
         ("1", date(2025, 12, 1), "late")],
        "pbs_code string, event_date date, event_label string",
    )
    view = summary.events_in_view(ev, points, date(2025, 1, 1), date(2025, 3, 1))
    marks = {r.month.month: (r.event_count, r.event_labels) for r in summary.event_markers(view).collect()}
    assert marks == {1: (1, "Z"), 2: (2, "A, B")}
    exempt = spark.createDataFrame([("1",), ("3",)], "code string")
    cards = {r.form: r for r in summary.summary_cards(summary.code_ends(points), view, exempt).collect()}
    f, g = cards["f"], cards["g"]
    assert (f["range"], f.first_listed, f.latest, f.change, f.last_event, f.exempt) == (
        "Jan 2025 – Mar 2025", "May 2020", "$11.00", "+10.00% from $10.00", "Feb 2025 · A, B", "Exempt (s84AH)",
    )
    assert (g.first_listed, g.latest, g.change, g.last_event, g.exempt) == (
        "unknown", "$4.00 – $5.00", "varies across 2 products", "none in view", "1 of 2 item codes exempt",
    )


def test_exempt_codes_look_at_the_latest_schedule_only(spark):
    old, new = date(2025, 1, 1), date(2025, 2, 1)
    amt = spark.createDataFrame(
        [("a", "MPUU", "Y", old), ("a", "MPUU", "N", new), ("b", "MPUU", "Y", new), ("c", "TPUU", "Y", new)],
        "li_item_id string, concept_type_code string, exempt_ind string, effective_date date",
    )
    items = spark.createDataFrame(
        [(i, d, i.upper()) for i in "abc" for d in (old, new)], "li_item_id string, effective_date date, pbs_code string"
    )
    assert [r.code for r in summary.exempt_codes(amt, items).collect()] == ["B"]


def test_profile_and_nulls(spark):
    df = spark.createDataFrame(
        [("d", "x", None), ("D", None, None), ("e", "y", None), ("e", "z", None), ("e", "w", None)],
        "drug string, sponsor string, nothing string",
    )
    got = {r.column_name: (float(r.fill_pct), r.samples) for r in quality.column_profile(df).collect()}
    assert got == {"drug": (100.0, "D | d | e"), "sponsor": (80.0, "w | x | y"), "nothing": (0.0, "EMPTY")}
    nulls = {r.column_name: (r.column_present, r.total_rows, r.null_rows) for r in
             quality.null_diagnostics(df, "d", ["sponsor", "absent"]).collect()}
    assert nulls == {"sponsor": (True, 2, 1), "absent": (False, 2, None)}


def test_adaptable_columns(spark, tmp_path):
    df = spark.createDataFrame([("1", "S")], "Item_Code_B string, Sponsor string")
    assert df.select(pick_column(df, "absent", "sponsor"), pick_column(df, "none")).first()[:] == ("S", None)
    renamed = canonical_wide(df)
    assert renamed.first()["Responsible Person"] == "S" and renamed.first()["Legal Instrument Form"] is None
    fact = spark.createDataFrame([], "product_line_id string, Snapshot date, aemp int")
    dim = spark.createDataFrame([], "PRODUCT_LINE_ID string")
    assert detect_roles({"dim": dim, "fact": fact}) == {
        "price_table": "fact", "date_column": "Snapshot", "price_column": "aemp",
        "line_table": "dim", "join_column": "product_line_id",
    }
    with pytest.raises(ValueError):
        detect_roles({"dim": dim})
    assert missing_tables(spark, str(tmp_path), ["items"]) == ["items"]


def test_month_ranges_open_only_their_folders(spark, tmp_path):
    rows = [("l", date(2024, m, 1), float(m), "b", "r", "p") for m in range(1, 7)]
    facts = spark.createDataFrame(
        rows, "product_line_id string, snapshot_date date, aemp double, brand_name string, responsible_person string, amt_trade_pack string"
    ).withColumn("aemp", F.col("aemp").cast("decimal(18,6)"))
    sinks.append_facts(facts, str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    few = in_months(stored, date(2024, 2, 1), date(2024, 3, 31))
    assert sorted(r.snapshot_date.month for r in few.collect()) == [2, 3]
    flat = stored.select("*", *[F.lit("x").alias(c) for c in movers.KEYS])
    for df in (few, movers.movers(flat, date(2024, 1, 1), date(2024, 2, 1))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_month" in plan or "PartitionFilters: [snapshot_month" in plan
        assert "PushedFilters: []" not in plan


def test_a_series_reads_its_prices_once(spark, tmp_path):
    prices(spark, ("1", "d", "f", 1, 5, None)).write.parquet(str(tmp_path / "p"))
    points = series.price_series(spark.read.parquet(str(tmp_path / "p")), ["D"])
    assert points._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
