"""Hard negatives against brute force; the curve, the bounds and the exact products by themselves."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.llm import hard_negatives as hn

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("key", T.StringType()), T.StructField("block", T.StringType()), T.StructField("id", T.StringType()),
])


def plain(rows, anchors_each, positives=5, negatives=5, low=80, high=100):
    ready = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        ready.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []

    def first(found, few):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:few]

    for at, (anchor, label, vector) in enumerate(ready):
        if anchor is None or anchor % anchors_each:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, k) for j, (i, k, v) in enumerate(ready) if j != at]
        for p, positive, _ in first([s for s in scored if s[2] == label], positives):
            fits = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p]
            out += [(anchor, positive, r + 1, i, p, s) for r, (s, i, _) in enumerate(first(fits, negatives))]
    return sorted(out, key=str)


def table(seed, n, dims, clusters):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    rows = []
    for i in range(n):
        v = centres[r.integers(clusters)] + 0.5 * r.normal(size=dims)
        v = (v / np.linalg.norm(v)).astype(np.float32).tolist()
        rows.append((i, v, int(r.integers(4)), "x", "x", "x"))
    rows += [rows[10]] * 3 + [(n + i, rows[3][1], i % 3, "x", "x", "x") for i in range(40)]  # repeated rows and ties
    rows += [(n + 50, None, 1, "", "", ""), (n + 51, rows[0][1], None, "", "", ""), (n + 52, [1.0, None], 1, "", "", ""),
             (n + 53, [float("nan")] * dims, 1, "", "", ""), (n + 54, [float("inf")] * dims, 1, "", "", ""), (None, rows[5][1], 1, "", "", ""),
             (n + 55, [], 1, "", "", ""), (n + 56, [0.5], 2, "", "", ""), (n + 57, rows[0][1] + [0.3], 2, "", "", ""), (n + 58, rows[1][1], 77, "", "", "")]
    return rows


@pytest.mark.parametrize("seed, dims, clusters, anchors_each, block, chunk, page", [
    (1, 6, 5, 10, 16, 8, 4), (2, 3, 1, 25, 1024, 1024, 64), (3, 12, 20, 50, 7, 3, 2),
])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, dims, clusters, anchors_each, block, chunk, page):
    monkeypatch.setattr(hn, "STRIPE", 2)
    rows = table(seed, 500, dims, clusters)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # blocks in several partitions
    ready = docs.select(
        F.col("vec_id").alias("id"), F.coalesce(hn.relabelled(F.col("vec_id"), F.col("label")), F.col("label")).alias("label"),
        hn.whole_numbers(F.col("embedding"), 256.0).alias("vector"),
    )
    try:
        got = hn.hard_negatives(ready, F.col("id") % anchors_each == 0, block_rows=block, chunk=chunk, page=page)
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, anchors_each)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_registered_form_and_empty_tables(spark):
    rows = table(4, 300, 8, 3)
    got = hn.mined(spark.createDataFrame(rows, SCHEMA), anchors_each=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, 20)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    assert hn.mined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mined(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0
    assert hn.mined(spark.createDataFrame([(1, None, 1, "", "", "")], SCHEMA)).count() == 0


def test_blocks_far_away_are_not_read(spark):
    """Of clusters that stand apart, an anchor reads the blocks of few."""
    r = np.random.default_rng(5)
    centres = 1000 * np.sign(r.normal(size=(16, 8)))
    rows = [(i, i % 2, (centres[i % 16] + r.integers(-20, 20, 8)).tolist()) for i in range(3200)]
    ready = spark.createDataFrame(rows, "id long, label long, vector array<double>").withColumn("anchor", F.col("id") % 100 == 0)
    stored = hn.blocks(ready, 5, block_rows=50)
    seeking = hn.chunks(
        hn.anchor_rows(stored).select("key", "id", "label", "vector", F.array("floor").alias("lows"), F.array(F.lit(float("inf"))).alias("highs")), 1
    )
    pairs = hn.needed(hn.pages(stored, 8), seeking, True).count()
    assert pairs < 0.3 * seeking.count() * stored.count()


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_only_neighbours_follow(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hn.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [100, 1 << 20, 1 << 30, 1 << 45])
def test_products_and_bounds_are_exact(size):
    r = random.Random(size)
    a, b = ([[float(r.randint(-size, size)) for _ in range(9)] for _ in range(6)] for _ in range(2))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    scores = hn.products(np.array(a), np.array(b))
    assert [[int(x) for x in row] for row in scores] == want
    low, high = np.array(b).min(axis=0)[None, :], np.array(b).max(axis=0)[None, :]
    least, most = hn.bounds(np.array(a), low, high)
    inside = [[min(max(x, hn.LEAST), hn.GREATEST) for x in row] for row in want]
    assert all(least[i, 0] <= min(inside[i]) and max(inside[i]) <= most[i, 0] for i in range(len(a)))
    assert (hn.unpacked(hn.packed(np.array(a)), 6) == np.array(a)).all()


def test_scores_beyond_long_do_not_break(spark):
    rows = [(i, i % 2, [float(1 << 40) * (i + 1)] * 4) for i in range(12)]
    ready = spark.createDataFrame(rows, "id long, label long, vector array<double>")
    got = hn.hard_negatives(ready, F.col("id") == 0).collect()
    assert got and all(r.positive_score > 0 for r in got)
