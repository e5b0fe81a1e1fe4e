"""What is left on disk and carried through shuffles by tables as long as the input; with the rows it must give."""

import os
import random
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetrail.functions import text
from pricetrail.operators import movers, ordering, series, sinks, star, wide
from pricetrail.plans.wide import bucketed_star
from pricetrail.session import keep, new_path
from pricetrail.sources.layouts import SINGLE_PRICE

HASH = "0123456789abcdef" * 4
ODD_IDS = [HASH, HASH[::-1], HASH.upper(), HASH[:-1], HASH + "\n", "", "a", "\x01" + "é" * 16, "ß", None]


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


def price_rows(spark, seed=0, n=90):
    r = random.Random(seed)
    schema = (
        "snapshot_date date, aemp decimal(18,6), brand string, form string, item_code string, drug string, "
        "formulary string, program string, pack_qty string, source_file string, amt_pack_program string, responsible string, amt_pack string"
    )
    rows = [
        (date(2025, r.randint(1, 6), r.choice([1, 15])), r.choice([None, Decimal(1), Decimal(2), Decimal(3)]), r.choice(["b", "b  c", "", None]),
         r.choice(["f", "", None]), r.choice(["1", "2", " 2", None]), "d", "F1", r.choice(["GE", "S"]), "30", "f", "GE", r.choice(["r", None]), r.choice(["p, q", "p q"]))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, schema)


def star_rows(spark, seed=0):
    rows = price_rows(spark, seed)
    return keep(star.product_lines(rows, SINGLE_PRICE), "dim"), keep(star.monthly_facts(rows, SINGLE_PRICE), "facts")


# F1 ------------------------------------------------------------------------------------------


def test_packed_ids_stay_apart_and_come_back(spark):
    ids = spark.createDataFrame([(x,) for x in ODD_IDS], "id string").withColumn("packed", text.packed_id(F.col("id")))
    found = ids.select("id", text.unpacked_id(F.col("packed")).alias("back"), F.length("packed").alias("n"), "packed").collect()
    assert [r.back for r in found] == ODD_IDS
    assert len({None if r.packed is None else bytes(r.packed) for r in found}) == len(ODD_IDS)
    assert [r.n for r in found[:2]] == [33, 33]


def test_lines_are_shuffled_once_and_described_afterwards(spark, no_broadcast):
    plan = plan_of(star.product_lines(price_rows(spark), SINGLE_PRICE))
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("seed", range(2))
def test_a_matrix_of_all_months_reads_its_prices_once(spark, seed):
    dim, facts = star_rows(spark, seed)
    prices = wide.line_prices(dim, facts, packed=True)
    assert plainly(prices.collect()) == plainly(wide.line_prices(dim, facts).select(prices.columns).collect())
    got = wide.wide_first(prices)
    assert "Exchange" not in plan_of(got)
    want = {}
    for p in prices.collect():
        key, month = tuple(p[:7]), f"AEMP {p.snapshot_date:%b %y}"
        want.setdefault(key, {}).setdefault(month, {}).setdefault(p.snapshot_date, []).append(p.aemp)
    rows = []
    for key, months in want.items():
        last = {m: max((x for x in days[max(days)] if x is not None), default=None) for m, days in months.items()}
        if any(x is not None for x in last.values()):
            rows.append((*[k or "" for k in key], *[last.get(m) for m in got.columns[7:]]))
    assert plainly(tuple(r) for r in got.collect()) == plainly(rows)
    assert plainly(wide.wide_first(prices, [date(2025, m, 1) for m in range(1, 7)]).select(got.columns).collect()) == plainly(got.collect())


def test_the_latest_attributes_name_every_price_of_a_line(spark):
    dim = spark.createDataFrame([("a", "1", "d", "f", "F1"), ("b", "2", "d", None, "F1")], "product_line_id string, item_code_b string, name_a string, attr_c string, attr_f string")
    facts = spark.createDataFrame(
        [("a", date(2025, 1, 1), 1.0, "old", "r", "p"), ("a", date(2025, 2, 1), 2.0, "new", None, "p"), ("a", date(2025, 2, 1), 2.5, "neu", "r", "p"), ("c", date(2025, 1, 1), 3.0, "x", "r", "p"),
         (None, date(2025, 1, 1), 3.0, "x", "r", "p")],
        "product_line_id string, snapshot_date date, aemp double, brand_name string, responsible_person string, amt_trade_pack string",
    )
    for packed in (False, True):
        got = wide.line_prices(dim, facts, packed).select("item_code", "brand", "responsible", "snapshot_date", "aemp").collect()
        assert plainly(tuple(r) for r in got) == plainly([("1", "new", "", date(2025, 1, 1), 1.0), ("1", "new", "", date(2025, 2, 1), 2.0), ("1", "new", "", date(2025, 2, 1), 2.5)])


def test_facts_dealt_by_month_are_the_same_facts(spark, no_broadcast):
    rows = price_rows(spark)
    dealt, paths = star.monthly_facts(rows, SINGLE_PRICE, by_month=True), [new_path(spark, "facts") for _ in range(2)]
    assert plan_of(dealt).count("Exchange") == 1
    sinks.append_facts(dealt, paths[0], dealt=True)
    sinks.append_facts(star.monthly_facts(rows, SINGLE_PRICE), paths[1])
    assert plainly(spark.read.parquet(paths[0]).collect()) == plainly(spark.read.parquet(paths[1]).collect())


# F2 ------------------------------------------------------------------------------------------


def test_the_older_matrix_sends_neither_lines_nor_facts_to_all_tasks(spark):
    dim, facts = star_rows(spark)
    got = wide.wide_last(dim, facts, [date(2025, 1, 1), date(2025, 2, 1)])
    assert "Broadcast" not in plan_of(got)
    assert got.count() > 0


# F3 ------------------------------------------------------------------------------------------


def test_buckets_follow_the_size_the_session_is_set_for(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        dim, facts = bucketed_star(spark, price_rows(spark))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for df, want in ((dim, star.product_lines), (facts, star.monthly_facts)):
        assert "SelectedBucketsCount: 5 out of 5" in plan_of(df.groupBy("product_line_id").count())
        assert plainly(df.collect()) == plainly(want(price_rows(spark), SINGLE_PRICE).select(df.columns).collect())


def test_odd_ids_find_their_bucket(spark, no_broadcast):
    path = new_path(spark, "odd")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    sinks.append_bucketed(spark.createDataFrame([(x,) for x in ODD_IDS], "id string"), table, path, "id", 3)
    counted = spark.table(table).groupBy("id").count()
    assert "Exchange" not in plan_of(counted)
    assert sorted(map(str, (r.id for r in counted.collect()))) == sorted(map(str, ODD_IDS))


# F4, F5 --------------------------------------------------------------------------------------


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for x in folders for _, _, names in os.walk(x.getPath()) for f in names if f.startswith("shuffle_")}


def left_behind(spark, write):
    before = shuffle_files(spark)
    write()
    for _ in range(50):  # files go a moment after the write
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("seed", range(2))
def test_appended_lines_leave_no_shuffle_files(spark, seed):
    rows = price_rows(spark, seed)
    first, again = rows.where("snapshot_date < '2025-04-01'"), rows.where("snapshot_date >= '2025-03-01'")
    path = new_path(spark, "dim")
    assert not left_behind(spark, lambda: sinks.append_lines(star.product_lines(first, SINGLE_PRICE), path))
    stored = keep(spark.read.parquet(path), "stored")
    fresh = star.new_lines(again, stored, SINGLE_PRICE)
    assert "Broadcast" not in plan_of(fresh)
    assert not left_behind(spark, lambda: sinks.append_lines(fresh, path))
    got, want = spark.read.parquet(path), star.product_lines(rows, SINGLE_PRICE)
    assert plainly(got.select(want.columns).collect()) == plainly(want.collect())


@pytest.mark.parametrize("dealt", [False, True])
def test_appended_facts_leave_no_shuffle_files(spark, dealt):
    facts = star.monthly_facts(price_rows(spark), SINGLE_PRICE, by_month=dealt)
    assert not left_behind(spark, lambda: sinks.append_facts(facts, new_path(spark, "facts"), dealt))


def test_odd_ids_are_stored_as_they_are(spark):
    facts = spark.createDataFrame([(x, date(2025, 1, 1)) for x in ODD_IDS], "product_line_id string, snapshot_date date")
    sinks.append_facts(facts, path := new_path(spark, "odd"))
    assert sorted(map(str, (r[0] for r in spark.read.parquet(path).collect()))) == sorted(map(str, ODD_IDS))


# F6 ------------------------------------------------------------------------------------------


def test_variants_in_slices_are_not_joined_row_by_row(spark, no_broadcast):
    r = random.Random(5)
    rows = [("hot", None, i) for i in range(300)] + [(r.choice(["a", None]), r.choice(["x", "", None]), 1000 + i) for i in range(80)]
    df = spark.createDataFrame(rows, "k string, m string, pos int")
    cut = ordering.in_order(df, ["k", "m"], [F.col("pos").desc()], row_number="rn", sliced=True, slice_rows=40)
    assert "SortMergeJoin" not in plan_of(cut)
    plain = ordering.in_order(df, ["k", "m"], [F.col("pos").desc()], row_number="rn")
    assert cut.columns == plain.columns and plainly(cut.collect()) == plainly(plain.collect())


# F7, F8 --------------------------------------------------------------------------------------


@pytest.mark.parametrize("read", [movers.star_prices, series.line_listing])
def test_lines_are_not_sent_to_all_tasks(spark, read):
    dim, facts = star_rows(spark)
    assert "Broadcast" not in plan_of(read(dim, facts))
    assert read(dim, facts).count() == facts.count()


def test_a_listing_of_odd_ids_keeps_them_in_order(spark):
    dim = spark.createDataFrame([(x, f"i{n}") for n, x in enumerate(ODD_IDS)], "product_line_id string, item_code_b string")
    facts = spark.createDataFrame([(x, date(2025, m, 1), 1.0) for x in ODD_IDS for m in (2, 1)], "product_line_id string, snapshot_date date, aemp double")
    got = [(r.month.month, r.product_line_id, r.item_code) for r in series.line_listing(dim, facts).collect()]
    want = [(m, x, f"i{n}") for m in (1, 2) for n, x in enumerate(ODD_IDS) if x is not None]
    assert got == sorted(want, key=lambda r: (r[0], r[1].encode()))
