"""What the join asks of the driver: few steps to components, short expressions."""

import numpy as np
from pyspark.sql import functions as F

from pricetrail.llm import components, jaccard_join


def found(spark, pairs, known=None):
    got = components.components(spark.createDataFrame(pairs, "a long, b long"), known)
    return {r.node: r.component for r in got.collect() if r.node != r.component}


def plain(pairs):
    least = {x: x for p in pairs for x in p}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    return {x: low for x, low in least.items() if x != low}


def steps_of(monkeypatch):
    made, star = [], components._star
    monkeypatch.setattr(components, "_star", lambda edges, large: made.append(large) or star(edges, large))
    return made


def test_known_components_are_carried_on(spark):
    first = [(1, 9), (9, 8), (20, 21), (22, 21), (40, 41), (50, 50)]
    new = [(8, 22), (41, 60), (60, 61), (70, 71), (21, 20)]
    known = components.components(spark.createDataFrame(first, "a long, b long"))
    assert found(spark, new, known) == plain(first + new)
    assert found(spark, [], known) == plain(first)


def test_stars_take_no_step(spark, monkeypatch):
    made = steps_of(monkeypatch)
    star = [(1, n) for n in range(2, 30)] + [(n, 30) for n in range(31, 40)]
    assert found(spark, star) == plain(star)
    assert not made
    chain = [(n, n + 1) for n in range(40)]
    assert found(spark, chain) == plain(chain)
    assert made


def test_differing_bits_is_one_short_expression(spark):
    draw = np.random.default_rng(3)
    pairs = [(draw.bytes(128), draw.bytes(128)) for _ in range(20)] + [(b"\xff" * 128, b"\0" * 128), (b"\x80" * 128,) * 2]
    apart = jaccard_join._differing_bits("a", "b")
    got = spark.createDataFrame(pairs, "a binary, b binary").select("a", "b", apart.alias("apart")).collect()
    for r in got:
        bits = np.frombuffer(bytes(r.a), np.uint8) ^ np.frombuffer(bytes(r.b), np.uint8)
        assert r.apart == int(np.bitwise_count(bits).sum())
    assert str(spark.range(0).select(F.lit(b"").alias("a"), F.lit(b"").alias("b")).select(apart)._jdf.queryExecution().analyzed()).count("conv(") < 20
