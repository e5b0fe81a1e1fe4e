import random

import pytest
from pyspark.sql import functions as F

from pricetrail.operators import ordering
from pricetrail.operators.movers import KEYS, summary


def _rows(seed):
    rng = random.Random(seed)
    rows = [("hot", i, rng.choice([None, 1, 2, 3])) for i in range(400)]
    rows += [(rng.choice(["a", "b", None]), 1000 + i, rng.choice([1, 2])) for i in range(120)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sliced", [False, True])
def test_positions_and_neighbours_do_not_depend_on_the_plan(spark, sliced):
    rows = _rows(sliced)
    df = spark.createDataFrame(rows, "k string, pos int, v int")
    got = ordering.in_order(
        df, ["k"], [F.col("pos").desc()], row_number="rn", group_size="n",
        previous={"before": "v"}, following={"after": "v"}, sliced=sliced, slice_rows=50,
    ).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want = {}
    for group in groups.values():
        group.sort(key=lambda r: -r[1])
        for i, (k, pos, v) in enumerate(group):
            before = group[i - 1][2] if i else None
            after = group[i + 1][2] if i + 1 < len(group) else None
            want[pos] = (k, v, i + 1, len(group), before, after)
    assert {r.pos: (r.k, r.v, r.rn, r.n, r.before, r.after) for r in got} == want


def test_hot_group_is_cut_into_slices(spark):
    df = spark.createDataFrame(_rows(1), "k string, pos int, v int")
    cut = ordering.in_order(df, ["k"], [F.col("pos")], row_number="rn", sliced=True, slice_rows=50)
    assert "__slice" in cut._jdf.queryExecution().optimizedPlan().toString()
    plain = ordering.in_order(df, ["k"], [F.col("pos")], row_number="rn")
    assert "__slice" not in plain._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n", [41, 40])
def test_median_by_counted_intervals_is_exact(spark, n):
    rng = random.Random(n)
    rows = [(str(i), "d", "f", None, None, round(rng.random() * 10, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in KEYS) + ", c double")
    df = df.withColumn("abs_change", F.col("c").cast("decimal(18,2)"))
    want = df.agg(F.median("abs_change").cast("decimal(18,6)")).first()[0]
    assert [r.median for r in summary(df, fan=7).collect()] == [want]
