"""How the work is done: what is read once, what is not shuffled, sorted or opened; with the rows it must give."""

import random
import statistics
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from pricetrail.operators import archive, events, ordering, quality, series, sinks, star, wide, winners
from pricetrail.session import new_path
from pricetrail.sources import archive_files, snapshots
from pricetrail.sources.layouts import SINGLE_PRICE
from pricetrail.streaming.pickup import pick_up, picked_up

HEADER = "Item Code,Legal Instrument Drug,Legal Instrument Form,Formulary,Program,Pack Quantity,AEMP"
STEM = "ex-manufacturer-prices-non-efc-"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plainly(rows):
    return sorted(map(str, rows))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


# Winners -------------------------------------------------------------------------------------


def odd_rows(seed):
    r = random.Random(seed)
    return [
        (r.choice(["a", "b", "c", None]), r.choice([1, 2, None]), r.choice([date(2025, 1, d) for d in (1, 2, 3)] + [None]),
         r.choice(["x", "y", "", None]), r.choice([1.0, None]))
        for _ in range(120)
    ]


WINNER_SCHEMA = "k string, m int, d date, t string, v double"


@pytest.mark.parametrize("seed", range(3))
def test_rows_that_disagree_keep_the_first(spark, seed):
    rows = odd_rows(seed)
    got = winners.agreed(spark.createDataFrame(rows, WINNER_SCHEMA), ["k", "m"], ["d", "t", "v"])
    groups = {}
    for k, m, *kept in rows:
        groups.setdefault((k, m), []).append(tuple(kept))
    want = [(*key, *min(kept, key=lambda row: tuple((x is not None, x if x is not None else 0) for x in row))) for key, kept in groups.items()]
    assert plainly(tuple(r) for r in got.collect()) == plainly(want)


@pytest.mark.parametrize("seed", range(3))
def test_the_latest_row_wins(spark, seed):
    rows = odd_rows(seed)
    got = winners.latest_of(spark.createDataFrame(rows, WINNER_SCHEMA), ["k", "m"], "d", ["t", "v"])
    groups = {}
    for k, m, *kept in rows:
        groups.setdefault((k, m), []).append(tuple(kept))
    want = [(*key, *max(kept, key=lambda row: tuple((x is not None, x if x is not None else 0) for x in row))) for key, kept in groups.items()]
    assert plainly(tuple(r) for r in got.collect()) == plainly(want)


def price_rows(spark, n=40):
    schema = (
        "snapshot_date date, aemp decimal(18,6), brand string, form string, item_code string, drug string, "
        "formulary string, program string, pack_qty string, source_file string, amt_pack_program string, responsible string, amt_pack string"
    )
    rows = [
        (date(2025, 1 + i % 6, 1), Decimal(i % 5), f"b{i % 3}", None if i % 7 == 0 else "" if i % 7 == 1 else "f", str(i % 4), "d", "F1", "GE", "30", f"f{i % 2}", "GE", "r", "p")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schema)


def test_winners_need_no_sorted_aggregate(spark, no_broadcast):
    rows = price_rows(spark)
    facts = star.monthly_facts(rows, SINGLE_PRICE)
    items = spark.createDataFrame([], "li_item_id string, effective_date date, determined_price decimal(18,6), pbs_code string")
    for df in (star.product_lines(rows, SINGLE_PRICE), facts, wide.latest_attributes(facts, ["brand_name"]), archive.superseding(items)):
        assert "SortAggregate" not in plan_of(df)
    # The rows of a batch are shuffled once and sorted once.
    plan = plan_of(facts)
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_null_and_empty_parts_are_one_line(spark):
    rows = price_rows(spark)
    lines = star.product_lines(rows, SINGLE_PRICE)
    assert lines.count() == lines.select("product_line_id").distinct().count()
    assert lines.where("attr_c = ''").count() == 0


# Buckets -------------------------------------------------------------------------------------


@pytest.mark.parametrize("by_month", [False, True])
def test_a_star_in_buckets_is_joined_without_a_shuffle(spark, no_broadcast, by_month):
    rows = price_rows(spark)
    names = []
    for name, df in (("lines", star.product_lines(rows, SINGLE_PRICE)), ("facts", star.monthly_facts(rows, SINGLE_PRICE))):
        path = new_path(spark, name)
        names.append(path.rsplit("/", 1)[-1].replace("-", "_"))
        months = by_month and name == "facts"
        half = F.col("product_line_id") < "8"
        for part in (df.where(half), df.where(~half)):  # two loads
            sinks.append_bucketed(part, names[-1], path, "product_line_id", 4, by_month=months)
    dim, facts = (spark.table(n) for n in names)
    prices = wide.line_prices(dim, facts)
    assert "Exchange" not in plan_of(prices)
    plain = wide.line_prices(star.product_lines(rows, SINGLE_PRICE), star.monthly_facts(rows, SINGLE_PRICE))
    assert "Exchange" in plan_of(plain)
    assert plainly(prices.select(plain.columns).collect()) == plainly(plain.collect())


# Folders -------------------------------------------------------------------------------------


def test_a_batch_of_events_opens_its_schedules_only(spark, tmp_path):
    days = [date(2025, 1, d) for d in range(1, 21)]
    items = [(i, d, Decimal(d.day + i), f"P{i}", "drug", "brand", "F1") for i in range(5) for d in days if (i + d.day) % 6]
    items = spark.createDataFrame(items, "li_item_id long, effective_date date, determined_price decimal(18,6), pbs_code string, li_drug_name string, brand_name string, formulary string")
    items.write.partitionBy("effective_date").parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    source = spark.createDataFrame(
        [(i, d, "X_NB", "1") for i in range(6) for d in [*days, date(2025, 3, 1)]], "li_item_id long, effective_date date, event_type_code string, percentage_applied string"
    )
    schedules = items.select("effective_date").distinct()
    since = date(2025, 1, 18)
    got = events.batch_price_events(source, stored, schedules, since)
    assert plan_of(got).count("dynamicpruning") >= 2
    whole = events.price_events(source, items).where(F.col("event_date") >= F.lit(since))
    assert plainly(got.collect()) == plainly(whole.collect())
    # What was opened: the scans count the folders that they read.
    opened = [
        node.metrics().get("numPartitions").get().value() for node in scans(got) if node.metrics().contains("numPartitions")
    ]
    assert sorted(opened)[-2:] == [3, 3]


def scans(df):
    """The scans of partitioned tables of a frame that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            found.append(node)
        if "QueryStage" in name:
            todo.append(node.plan())
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return found


# One pass ------------------------------------------------------------------------------------


def test_pages_are_opened_once(spark, tmp_path, monkeypatch):
    (tmp_path / "p.json").write_text('{"data": [{"b": 1, "_links": 2}, {"a": {"x": [1.50]}}, null]}\n{"data": null}\n{"other": 1}\n')
    calls, read = [], DataFrameReader.json
    monkeypatch.setattr(DataFrameReader, "json", lambda self, path: calls.append(path) or read(self, path))
    got = archive_files.read_pages(spark, str(tmp_path / "p.json"), multi_line=False)
    assert got.columns == ["a", "b"] and plainly(map(tuple, got.collect())) == plainly([(None, "1"), ('{"x": [1.50]}', None)])
    assert len(calls) == 1 and "FileScan json" not in plan_of(got)


def test_variant_rows(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"data": [{"id": 1, "detail": {"k": [7]}}, {"id": "x", "more": true}, null, 5]}\n{"data": 3}\n{"data": []}\n{}\n'
    )
    rows = archive_files.read_variant_rows(spark, str(tmp_path), multi_line=False)
    got = archive_files.typed_fields(rows, {"id": ("$.id", "bigint"), "k": ("$.detail.k[0]", "int"), "more": ("$.more", "boolean")})
    assert plainly(map(tuple, got.collect())) == plainly([(1, 7, None), (None, None, True), (None, None, None)])
    assert archive_files.variant_shape(rows.where("try_variant_get(row, '$', 'bigint') IS NULL")).first().shape.startswith("OBJECT<detail: OBJECT<k: ARRAY<BIGINT>>")


def jobs_of(spark, work):
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    work()
    spark.sparkContext.setJobGroup("others", "others")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_take_as_many_jobs_for_many_snapshots(spark, tmp_path):
    counts = []
    for many in (2, 20):
        folder = tmp_path / str(many)
        folder.mkdir()
        for i in range(many):
            header = HEADER if i % 2 else HEADER.replace("Pack Quantity", "Pack Qty") + ",Brand"
            (folder / f"{STEM}20{10 + i}-01-01.csv").write_text(f"\n{header}\n1A,d,f,F1,GE,30,{i},B\n")
        found = {}
        counts.append(jobs_of(spark, lambda: found.update(rows=snapshots.read_snapshots(spark, f"{folder}/*", SINGLE_PRICE)[0])))
        rows = found["rows"].collect()
        assert sorted((r.snapshot_date.year, r.aemp, r.pack_qty, r.brand) for r in rows) == [
            (2010 + i, str(i), "30", None if i % 2 else "B") for i in range(many)
        ]
    assert counts[0] == counts[1]


@pytest.mark.parametrize("line", ["a,b", 'a,"b,c",d', 'a,A,b', ",x,", '"he said ""x""",y', "one"])
def test_header_names_are_the_readers(spark, tmp_path, line):
    path = tmp_path / "h.csv"
    path.write_text(line + "\n1,2,3\n")
    want = spark.read.options(header=True, inferSchema=False, escape='"').csv(str(path)).columns
    assert list(snapshots.header_names(line)) == want


def test_first_lines_of_files_that_are_cut(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"\n  \nheader {i}\n" + "row\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = snapshots.first_lines(spark, [str(tmp_path / f"{i}.csv") for i in range(3)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.header for r in got) == ["header 0", "header 1", "header 2"]


def test_a_profile_reads_its_table_once(spark, tmp_path):
    r = random.Random(2)
    rows = [(i, r.choice(["é", "z", "", None]), None, r.random() if i % 3 else None) for i in range(1000)]
    spark.createDataFrame(rows, "a int, b string, c string, d double").repartition(7).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.column_profile(df)
    assert plan_of(report).count("FileScan") == 1
    got = {x.column_name: tuple(x)[1:] for x in report.collect()}
    for i, c in enumerate("abcd"):
        texts = [t[0] for t in df.select(F.col(c).cast("string")).collect() if t[0] is not None]
        shown = " | ".join(sorted(set(texts), key=str.encode)[:3]) or "EMPTY"
        assert got[c][0] == 1000 and float(got[c][1]) == round(len(texts) / 10, 1) and got[c][2] == shown
    nothing = quality.column_profile(df.where("a < 0")).collect()
    assert [tuple(x)[1:] for x in nothing] == [(0, None, "EMPTY")] * 4


# No sort, no Expand --------------------------------------------------------------------------


@pytest.mark.parametrize("fan", [2, 7, 4096])
@pytest.mark.parametrize("seed", range(4))
def test_middle_values(spark, fan, seed):
    r = random.Random(seed)
    values = [Decimal(r.randint(-500, 10 ** r.randint(1, 6))) / 100 for _ in range(r.choice([1, 2, 40, 41]))]
    values += values[:5] * r.randint(0, 3)
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)").groupBy("v").count()
    low, high = ordering.middle_values(df, "v", "count", fan)
    assert (low, high) == (statistics.median_low(values), statistics.median_high(values))
    assert ordering.middle_values(df.where("v IS NULL"), "v", "count", fan) == []


def test_a_matrix_is_unfolded_without_its_empty_cells(spark):
    months = [f"AEMP {m} 25" for m in ("Jan", "Feb", "Mar")]
    table = spark.createDataFrame([("1", None, 2.0, None), ("2", None, None, None)], "`Item Code` string, " + ", ".join(f"`{m}` double" for m in months))
    long = wide.wide_to_long(table)
    assert "Expand" not in plan_of(long) and "Generate" in plan_of(long)
    assert [(r["Item Code"], r.month, r.aemp) for r in long.collect()] == [("1", date(2025, 2, 1), 2.0)]
    assert wide.wide_to_long(table.select("Item Code")).count() == 0


# Pickup --------------------------------------------------------------------------------------


def test_pickup_goes_on_from_its_checkpoint(spark, tmp_path):
    landing, table, marks = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "marks")
    landing.mkdir()

    def land(day, *lines):
        (landing / f"{STEM}{day}.csv").write_text("\n".join([HEADER, *lines]) + "\n")

    def run():
        return pick_up(spark, str(landing), HEADER.split(","), SINGLE_PRICE, table, marks, files_at_once=1)

    land("2025-01-01", "1A,d,f,F1,GE,30,5", "1A,d,f,F1,GE,30,none", ",d,f,F1,GE,30,5")
    land("2025-02-01", '2B,"d ; e",f,F1,GE,30,"1,000.50"')
    assert run() == 4
    land("2025-03-01", "1A,d,f,F1,GE,30,7")
    assert run() == 1 and run() == 0
    rows = picked_up(spark, table)
    assert sorted((r.item_code, float(r.aemp), r.snapshot_date.month, r.snapshot_month) for r in rows.collect()) == [
        ("1A", 5.0, 1, "2025-01"), ("1A", 7.0, 3, "2025-03"), ("2B", 1000.5, 2, "2025-02")
    ]
    assert star.product_lines(rows, SINGLE_PRICE).count() == 3
    with pytest.raises(ValueError, match="aemp"):
        pick_up(spark, str(landing), HEADER.split(",")[:-1], SINGLE_PRICE, table, marks)


# Series and places ---------------------------------------------------------------------------


def odd_prices(spark, seed):
    r = random.Random(seed)
    spelt = ["Tablet film coated", "tablets, FILM  COATED", "tablet film-coated.", "none", "", None, "a|b", "Σας"]
    rows = [
        (r.choice(["1", "2", None]), r.choice(["Abc", "abc", "x|y", None]), r.choice(spelt), r.choice(["b", "NaN", "<NA>", "na", None]),
         r.choice(["F1", None]), r.choice(["c", None]), r.choice(["p", "b|c", None]), date(2025, r.randint(1, 12), r.randint(1, 28)),
         None if r.random() < 0.1 else Decimal(r.randint(1, 4)), r.choice(["2020-01-01", None]))
        for _ in range(600)
    ]
    return spark.createDataFrame(
        rows, "item_code string, drug string, form string, brand string, formulary string, responsible string, "
        "amt_pack string, snapshot_date date, aemp decimal(18,6), first_listed_date string"
    )


@pytest.mark.parametrize("drugs", [None, ["ABC", "abc", "nothing"]])
@pytest.mark.parametrize("seed", range(3))
def test_points_dealt_once_have_the_same_neighbours(spark, seed, drugs):
    df = odd_prices(spark, seed)
    want = series.change_points(series.price_series(df, drugs))
    got = series.series_changes(df, drugs)
    assert sorted(got.columns) == sorted(want.columns)
    assert plainly(got.select(want.columns).collect()) == plainly(want.collect())
    assert want.count() > 20


def test_points_dealt_once_cost_one_exchange_less(spark, no_broadcast):
    df = odd_prices(spark, 1)
    want, got = plan_of(series.change_points(series.price_series(df))), plan_of(series.series_changes(df))
    assert (want.count("Exchange"), got.count("Exchange")) == (3, 2)
    assert series.series_changes(df.limit(0)).count() == 0


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_places_of_a_hot_group_are_counted_across_ranges(spark, slices):
    r = random.Random(slices)
    rows = [("hot", None, i) for i in range(500)] + [(r.choice(["a", None, "z"]), r.choice([1, None]), 1000 + i) for i in range(200)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, j int, pos int")
    got = ordering.places(df, ["k", "j"], [F.col("pos").desc()], row_number="rn", group_size="n", slices=slices)
    assert got.columns == ["k", "j", "pos", "rn", "n"]
    groups = {}
    for k, j, pos in rows:
        groups.setdefault((k, j), []).append(pos)
    want = {p: (i, len(g)) for g in groups.values() for i, p in enumerate(sorted(g, reverse=True), start=1)}
    assert {x.pos: (x.rn, x.n) for x in got.collect()} == want
    assert ordering.places(df.limit(0), ["k"], [F.col("pos")], row_number="rn", group_size="n").count() == 0


def test_places_store_their_rows_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(ordering, "store", lambda df, name: stored.append(name) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, pos int")
    assert ordering.places(df, ["k"], [F.col("pos")], row_number="rn", group_size="n").count() == 2
    assert stored == ["slices"]
