from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetrail.operators import archive, events, sinks
from pricetrail.session import new_path
from pricetrail.sources import archive_files


def test_replace_clears_and_widens(spark):
    path = new_path(spark, "t")
    def load(rows, dates, schema="id string, _effective_date string"):
        sinks.replace_schedules(spark.createDataFrame(rows, schema), path, dates)
    load([("1", "2025-01-01"), ("2", "2025-01-01"), ("3", "2025-02-01"), ("4", "2025-03-01")],
         ["2025-01-01", "2025-02-01", "2025-03-01"])
    load([("9", "2025-01-01", "x")], ["2025-01-01", "2025-02-01"], "id string, _effective_date string, extra string")
    for columns in (None, ["id", "extra", "_effective_date"]):
        got = sinks.read_archive(spark, path, columns).select("id", "_effective_date", "extra")
        assert sorted(map(tuple, got.collect())) == [("4", "2025-03-01", None), ("9", "2025-01-01", "x")]


def test_bundle_csv(spark, tmp_path):
    (tmp_path / "amt-items.csv").write_text('a,b,c\n1,null,"x\ny"\n2,,"say ""hi"""\n')
    got = archive_files.read_bundle_csv(spark, str(tmp_path / "amt-items.csv")).orderBy("a").collect()
    assert [tuple(r) for r in got] == [("1", None, "x\ny"), ("2", "", 'say "hi"')]
    assert archive_files.table_name("amt-items") == "amt_items"


def test_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"_meta": {}, "data": [\n{"id": 1, "_meta": 2, "change_detail": {"x": 1}}, {"id": 2}]}')
    (tmp_path / "p2.json").write_text('{"_meta": {}, "data": [{"id": 3.50, "change_detail": {"y": ["é"]}, "new": "n"}]}')
    got = archive_files.read_pages(spark, str(tmp_path))
    assert set(got.columns) == {"id", "change_detail", "new"}
    rows = {r.id: (r.change_detail, r.new) for r in got.collect()}
    assert rows["1"] == ('{"x": 1}', None) and rows["2"] == (None, None)
    assert rows["3.50"] == ('{"y": ["é"]}', "n")


def test_organisation_ids_match_across_spellings(spark):
    items = spark.createDataFrame([("102.0", date(2025, 1, 1)), ("7", date(2025, 1, 1))], "organisation_id string, effective_date date")
    orgs = spark.createDataFrame([("102", "Acme", date(2025, 1, 1))], "organisation_id string, name string, effective_date date")
    got = {r.organisation_id: r.responsible for r in archive.with_organisation(items, orgs).collect()}
    assert got == {"102.0": "Acme", "7": None}
    bare = archive.with_organisation(items, orgs.drop("name"))
    assert [r.responsible for r in bare.collect()] == [None, None]


def test_later_schedule_of_a_month_wins(spark):
    items = spark.createDataFrame(
        [("a", date(2025, 12, 1), Decimal(1)), ("a", date(2025, 12, 10), Decimal(2)), ("a", date(2026, 1, 1), None)],
        "li_item_id string, effective_date date, determined_price decimal(18,6)",
    )
    assert [(r.month, r.determined_price) for r in archive.superseding(items).collect()] == [(date(2025, 12, 1), 2)]


def _items(spark, rows):
    return spark.createDataFrame(
        [(i, d, Decimal(p), f"P{i}", "drug", "brand", "F1") for i, d, p in rows],
        "li_item_id string, effective_date date, determined_price decimal(18,6), pbs_code string, "
        "li_drug_name string, brand_name string, formulary string",
    )


def test_price_before_is_the_previous_schedule_only(spark):
    d1, d2, d3, d4 = date(2025, 11, 1), date(2025, 12, 1), date(2025, 12, 10), date(2026, 1, 1)
    items = _items(spark, [("a", d1, 1), ("b", d2, 9), ("b", d3, 8), ("a", d3, 2), ("a", d4, 3)])
    source = spark.createDataFrame(
        [("a", d3, "X_NB", "1.5"), ("a", d4, None, None), ("b", d3, "COMBO_PD", "5"), ("zz", d3, "Q", "1")],
        "li_item_id string, effective_date date, event_type_code string, percentage_applied string",
    )
    derived = events.price_events(source, items)
    got = {(r.li_item_id, r.event_date): r for r in derived.collect()}
    assert got["a", d3].price_before is None and got["a", d3].price_after == 2
    assert got["a", d4].price_before == 2 and got["a", d4].event_label is None and got["a", d4].is_combination is None
    assert got["b", d3].price_before == 9 and got["b", d3].is_combination
    assert got["zz", d3].li_drug_name is None
    report = events.reconcile(source, derived).first()
    assert tuple(report) == (4, 4, True, 1)
    assert [(r.event_label, r.n) for r in events.events_per_label(derived).collect()][0][1] == 1


def test_contents_and_targets(spark):
    df = spark.createDataFrame([("1", "s1"), ("2", "s2"), ("3", "s2")], "id string, _schedule_code string")
    got = archive.contents({"items": df, "bare": df.drop("_schedule_code")}).collect()
    assert [tuple(r) for r in got] == [("bare", 3, None), ("items", 3, 2)]
    schedules = spark.createDataFrame([("10", "2025-01-01"), ("11", "2025-02-01")], "schedule_code string, effective_date string")
    def codes(**k):
        return [r.schedule_code for r in archive_files.target_schedules(schedules, **k).collect()]
    assert (codes(), codes(code="10"), codes(backfill=True)) == (["11"], ["10"], ["10", "11"])


def test_stamps(spark):
    df = sinks.stamp(spark.createDataFrame([("1",)], "id string"), 4664, None)
    r = df.first()
    assert (r._schedule_code, r._effective_date) == ("4664", None) and r._downloaded_at_utc.endswith("+00:00")
    assert sinks.build_stamp(spark).first().built_at is not None
    nested = spark.createDataFrame([({"k": "v"},)], "m map<string,string>")
    assert nested.select(archive_files.nested_text(F.col("m"))).first()[0] == '{"k":"v"}'
    assert archive_files.without_bookkeeping(spark.createDataFrame([(1, 2)], "id int, _links int")).columns == ["id"]


def _stored(spark, path):
    rows = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02"), ("3", "2024-01-02")], "a string, _effective_date string")
    sinks.replace_schedules(rows, path, ["2024-01-01", "2024-01-02"])
    return rows


def _kept(spark, path):
    return sorted(tuple(r) for r in sinks.read_archive(spark, path).select("a", "_effective_date").collect())


@pytest.mark.parametrize("kind", ["frame", "filter", "page"])
def test_an_empty_load_clears_its_date(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    rows = _stored(spark, path)
    if kind == "frame":
        empty = rows.limit(0)
    elif kind == "filter":
        rows.write.parquet(str(tmp_path / "rows"))
        empty = spark.read.parquet(str(tmp_path / "rows")).where("a = 'none'")
    else:
        (tmp_path / "page.json").write_text('{"data": []}')
        empty = sinks.stamp(archive_files.read_pages(spark, str(tmp_path / "page.json")), "1", "2024-01-02")
    for _ in range(2):
        sinks.replace_schedules(empty, path, ["2024-01-02"])
        assert _kept(spark, path) == [("1", "2024-01-01")]


@pytest.mark.parametrize("date", [None, "2024-01-03"])
def test_rows_of_unnamed_dates_are_an_error_and_change_nothing(spark, tmp_path, date):
    path = str(tmp_path / "t")
    rows = _stored(spark, path)
    stray = spark.createDataFrame([("9", date), ("8", "2024-01-01")], rows.schema)
    before = _kept(spark, path)
    with pytest.raises(ValueError, match="not named"):
        sinks.replace_schedules(stray, path, ["2024-01-01"])
    assert _kept(spark, path) == before


def test_organisation_ids_meet_as_text(spark):
    ids = ["ORG7", "102.5", "102.0", "9007199254740993", "9007199254740992", "1e2"]
    items = spark.createDataFrame([(i, "2024-01-01") for i in ids], "organisation_id string, effective_date string")
    names = spark.createDataFrame(
        [(i, "2024-01-01", f"name {i}") for i in ["ORG7", "102.5", "102", "9007199254740993", "9007199254740992", "100"]],
        "id string, effective_date string, name string",
    )
    got = {r.organisation_id: r.responsible for r in archive.with_organisation(items, names).collect()}
    assert got == {
        "ORG7": "name ORG7", "102.5": "name 102.5", "102.0": "name 102", "9007199254740993": "name 9007199254740993",
        "9007199254740992": "name 9007199254740992", "1e2": None,
    }
