import random

import numpy as np

from pricetrail.llm import hashing, jaccard_join


def corpus(seed, n):
    """Texts of frequent words, every one with some words of its own; the last two are near copies."""
    r = random.Random(seed)
    frequent = [f"common{i}" for i in range(20)]
    out = []
    for d in range(n):
        words = [r.choice(frequent) for _ in range(200)]
        for i, at in enumerate(r.sample(range(200), 50)):
            words[at] = f"own{d}x{i}"
        out.append(words)
    copy = out[-1][:]
    copy[100] = "exchanged"
    return [(i, " ".join(words)) for i, words in enumerate([*out, copy])]


def test_unrelated_texts_do_not_meet_where_counters_are_crowded(spark, monkeypatch):
    # 1,024 counters for some 50,000 shingles, as 2^22 are for those of some hundred million.
    monkeypatch.setattr(jaccard_join, "COUNTERS", 1 << 10)
    docs = spark.createDataFrame(corpus(3, 400), "doc_id long, text string").repartition(4)
    *_, alive, texts = jaccard_join._prepared(docs, 3, 90)
    kept = {r.doc for r in alive.collect()}
    assert {399, 400} <= kept and len(kept) < 20 and texts.count() == len(kept)
    classes = {r.doc_id: r.component_id for r in jaccard_join.classes(docs, 3, 90).collect()}
    assert classes == {i: min(i, 399) for i in range(401)}


def test_a_shared_member_counts_where_sizes_fit_and_it_leads_the_smaller(spark):
    # Prefixes in order of rarity; at 90 percent a set of 100 has 6 leads (95 are the overlap of two of its size) and 11 members.
    token = {"fits": 1, "far": 2, "late": 3, "one": 4}
    groups = [
        (10, 100, [token["fits"], 101, 102, 103, 104, 105, token["late"], 107, 108, 109, 110]),
        (11, 111, [token["far"], *range(201, 208), token["fits"], token["late"], token["one"], 210]),
        (12, 124, [*range(301, 313), token["far"], 314]),
    ]
    found = jaccard_join.shared_tokens(spark.createDataFrame(groups, "gid long, n long, prefix array<long>"), 90)
    # "late" is behind the leads of the smaller set, and 111 of 124 members are too few.
    assert sorted(map(tuple, found.collect())) == [(1, 10), (1, 11)]


def test_one_order_for_all_texts():
    r = np.random.default_rng(5)
    levels = r.integers(0, 200, (2, 1 << 10)).astype(np.uint8)
    words = hashing.word_hashes(" ".join(f"w{i % 37}" for i in range(300)).encode(), hashing.SPACED)[0]
    first, order = jaccard_join.rare_first(words[:200], 3, levels)
    second, other = jaccard_join.rare_first(words[50:], 3, levels)
    assert (first == hashing.shingles(words[:200], 3)).all() and sorted(order.tolist()) == list(range(len(first)))
    both = set(first.tolist()) & set(second.tolist())
    assert len(both) > 30
    assert [x for x in first[order].tolist() if x in both] == [x for x in second[other].tolist() if x in both]
    # Fewer words than a shingle has: one member of all.
    assert len(jaccard_join.rare_first(words[:2], 3, levels)[0]) == 1
