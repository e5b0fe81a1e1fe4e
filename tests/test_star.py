import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetrail.operators import sinks, star
from pricetrail.session import new_path
from pricetrail.sources.layouts import MULTI_PRICE, SINGLE_PRICE
from pricetrail.sources.snapshots import clean_snapshots, map_headers, read_snapshots

HEADER = "Item Code,Legal Instrument Drug,Legal Instrument Form,Formulary,Program,Pack Quantity,AEMP"


def rows(spark, *cells):
    """(day, price, brand, form) rows of one base."""
    schema = (
        "snapshot_date date, aemp decimal(18,6), brand string, form string, item_code string, drug string, "
        "formulary string, program string, pack_qty string, source_file string, amt_pack_program string"
    )
    full = [
        (date(2025, m, 1), None if p is None else Decimal(p), brand, form, "1A", "d", "F1", "GE", "30", f"f{m}", "GE")
        for m, p, brand, form in cells
    ]
    return spark.createDataFrame(full, schema)


def variants(dim):
    return {(r.variant_init_aemp, r.variant_signature_base, r.attr_c): r.variant_no for r in dim.collect()}


def test_price_that_returns_takes_its_old_line(spark):
    df = rows(spark, (1, 10, "b", "f"), (2, 12, "b", "f"), (3, 10, "b", "f"))
    assert sorted(variants(star.product_lines(df, SINGLE_PRICE)).values()) == [1, 2]
    facts = star.monthly_facts(df, SINGLE_PRICE).orderBy("snapshot_date").collect()
    assert facts[0].product_line_id == facts[2].product_line_id != facts[1].product_line_id


def test_higher_price_of_one_month_comes_first_and_is_logged(spark):
    df = rows(spark, (1, 10, "b", "f"), (1, 12, "b", "f"))
    assert {k[0]: v for k, v in variants(star.product_lines(df, SINGLE_PRICE)).items()} == {12: 1, 10: 2}
    logged = star.collisions(df, SINGLE_PRICE).collect()
    assert [(r.distinct_aemps, r.example_aemps) for r in logged] == [(2, "10.000000, 12.000000")]


def test_signature_breaks_ties(spark):
    df = rows(spark, (1, 10, "z", "f"), (1, 10, "a", "f"))
    found = variants(star.product_lines(df, SINGLE_PRICE))
    assert [n for (_, sig, _), n in sorted(found.items(), key=lambda x: x[0][1])] == [1, 2]


def test_null_form_matches_itself(spark):
    first = rows(spark, (1, 10, "b", None))
    dim = star.product_lines(first, SINGLE_PRICE)
    assert star.new_lines(rows(spark, (2, 10, "b", None)), dim, SINGLE_PRICE).count() == 0
    assert [r.variant_no for r in star.new_lines(rows(spark, (2, 11, "b", None)), dim, SINGLE_PRICE).collect()] == [2]


def test_null_prices_match_in_the_multi_price_layout(spark):
    df = rows(spark, (1, None, "b", "f"), (2, None, "b", "f"))
    assert star.product_lines(df, MULTI_PRICE).count() == 1
    assert star.monthly_facts(df, MULTI_PRICE).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_loading_by_month_equals_the_whole_history(spark, seed):
    rng = random.Random(seed)
    cells = [(rng.randint(1, 5), rng.randint(1, 6), rng.choice("ab"), rng.choice(["f", None])) for _ in range(60)]
    everything = rows(spark, *cells)
    dim_path, fact_path = new_path(spark, "dim"), new_path(spark, "fact")
    dim = star.product_lines(everything.where(F.lit(False)), SINGLE_PRICE)
    sinks.append_lines(dim, dim_path)
    sinks.append_facts(star.monthly_facts(everything.where(F.lit(False)), SINGLE_PRICE), fact_path)
    fact_schema = star.monthly_facts(everything, SINGLE_PRICE).schema
    for month in [1, 2, 3, 3, 4, 5]:
        batch = everything.where(F.month("snapshot_date") == month)
        stored = spark.read.schema(dim.schema).parquet(dim_path)
        facts = spark.read.schema(fact_schema).parquet(fact_path)
        dates = [r[0] for r in batch.select("snapshot_date").distinct().collect()]
        new_facts = star.new_facts(batch, facts, SINGLE_PRICE, dates)
        sinks.append_lines(star.new_lines(batch, stored, SINGLE_PRICE), dim_path)
        sinks.append_facts(new_facts, fact_path)
    assert variants(spark.read.parquet(dim_path)) == variants(star.product_lines(everything, SINGLE_PRICE))
    stored = spark.read.schema(fact_schema).parquet(fact_path).select("product_line_id", "snapshot_date")
    whole = star.monthly_facts(everything, SINGLE_PRICE).select("product_line_id", "snapshot_date")
    assert sorted(stored.collect()) == sorted(whole.collect())


def test_variants_of_a_hot_base_do_not_depend_on_the_plan(spark):
    df = rows(spark, *[(1 + i % 5, i % 40, "ab"[i % 2], "f") for i in range(200)])
    whole = variants(star.product_lines(df, SINGLE_PRICE))
    assert variants(star.product_lines(df, SINGLE_PRICE, sliced=True)) == whole


def test_conflicting_metrics_keep_one_row_and_name_the_rest(spark):
    df = rows(spark, (1, 10, "b", "f"), (1, 10, "b", "f"), (1, 10, "b", "f"))
    df = df.withColumn("pemp", (F.monotonically_increasing_id() % 2).cast("decimal(18,6)")).union(
        df.limit(1).withColumn("pemp", F.lit(7).cast("decimal(18,6)"))
    )
    assert star.monthly_facts(df, MULTI_PRICE).count() == 1
    kept = star.monthly_facts(df, MULTI_PRICE).first().pemp
    assert kept == df.agg(F.min("pemp")).first()[0]
    assert star.fact_conflicts(df, MULTI_PRICE).first().rows_dropped == df.select("pemp").distinct().count() - 1


def test_header_aliases():
    mapped, missing = map_headers(HEADER.replace("Pack Quantity", " Pack QTY ").split(","), SINGLE_PRICE)
    assert mapped["pack_qty"] == " Pack QTY " and not missing
    assert map_headers(["Item Code (new)", "Premium type"], MULTI_PRICE)[0] == {
        "item_code": "Item Code (new)", "premium_type": "Premium type",
    }


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_snapshot_files(spark, tmp_path):
    stem = "ex-manufacturer-prices-non-efc-"
    row = "1A,Drug  x,Tab; oral,F1,GE,30,"
    write(tmp_path, stem + "2025-01-01.csv", HEADER + ",Brand", row + '"1,234.50",B1', row + "nan,B2", ",d,f,F1,GE,1,5,B")
    write(tmp_path, stem + "2025-02-01.CSV", HEADER, row + "7", row + "$5.00", row + "1d", row)
    write(tmp_path, stem + "2025-03-01.csv", HEADER.replace(",AEMP", ""), "1A,d,f,F1,GE,30")
    write(tmp_path, stem + "2025-13-01.csv", HEADER, row + "9")
    write(tmp_path, stem + "latest.csv", HEADER, row + "9")
    raw, problems = read_snapshots(spark, f"{tmp_path}/{stem}*", SINGLE_PRICE)
    got = clean_snapshots(raw, SINGLE_PRICE).orderBy("snapshot_date").collect()
    assert [(r.snapshot_date, float(r.aemp), r.drug, r.form, r.brand, r.source_file) for r in got] == [
        (date(2025, 1, 1), 1234.5, "Drug x", "Tab, oral", "B1", stem + "2025-01-01.csv"),
        (date(2025, 2, 1), 7.0, "Drug x", "Tab, oral", None, stem + "2025-02-01.CSV"),
    ]
    assert [tuple(r) for r in problems.collect()] == [(stem + "2025-03-01.csv", "missing: aemp")]


def test_multi_price_files_keep_unpriced_rows(spark, tmp_path):
    header = HEADER + ",PEMP,DPMA,Premium,Premium type"
    write(tmp_path, "ex-manufacturer-prices-efc-2026-07-1.csv", header, "1A,d,f,F1,GE,30,,$1.50,\"2,000\",3,NA")
    raw, problems = read_snapshots(spark, f"{tmp_path}/*efc*", MULTI_PRICE)
    r = clean_snapshots(raw, MULTI_PRICE).first()
    assert (r.snapshot_date, r.aemp, r.pemp, r.dpma, r.premium, r.premium_type) == (
        date(2026, 7, 1), None, Decimal("1.5"), Decimal(2000), Decimal(3), None,
    )
    assert problems.count() == 0
