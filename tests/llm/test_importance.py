"""Importance resampling against a plain version, CRCs of composed runs against the library's."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from pricetrail.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_features(text, grams=1):
    words = WORD.findall((text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, grams=1, percent=10, least=20, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    corpus, wanted = collections.Counter(), collections.Counter()
    for _, text in docs:
        corpus.update(map(bucket, plain_features(text, grams)[1]))
    for text in target:
        wanted.update(map(bucket, plain_features(text, grams)[1]))
    s, t = sum(corpus.values()), sum(wanted.values())
    out = []
    for doc_id, text in docs:
        words, features = plain_features(text, grams)
        gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in map(bucket, features)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r, ranks.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("grams, words", [(1, 1 << 16), (1, 7), (3, 50), (2, 0)])
def test_resampling_of_odd_rows(spark, odd, plain, grams, words):
    target = [plain[5][1], "TA re mi", None, "", max((r[1] or "" for r in plain), key=len)[:5000], "naïve Ärger 中文 x" * 30]
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resampled(odd, wanted, grams=grams, words=words, percent=30)
    want = plain_resample([(r[0], r[1]) for r in plain], target, grams, 30)
    rows = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    # Rows that agree in all are ranked in any order.
    assert sorted((r[:5] for r in rows), key=str) == sorted((r[:5] for r in want), key=str)
    assert sorted(r[5:] + r[:5] for r in rows if r[5]) == sorted(r[5:] + r[:5] for r in want if r[5])


def test_empty_sides(spark, odd, empty, plain):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(empty, none).count() == 0
    assert importance.resampled(odd, none).count() == len(plain)
    assert importance.resampled(odd, none, percent=0).where("rank is not null").count() == 0
    everyone = importance.resampled(odd, none, percent=100, least_words=0)
    assert sorted(r["rank"] for r in everyone.collect()) == list(range(1, len(plain) + 1))


def test_payloads_come_in_order_for_any_dictionary():
    r = random.Random(8)
    vocabulary = ["a", "ab", "b", "ba", "é", "éa", "word", "x" * 200, "中文", "7up"]
    for _ in range(200):
        text = "".join(r.choice(vocabulary + [w.upper() for w in vocabulary]) + r.choice([" ", "  ", ", ", "-", "\x7f", "\n"]) for _ in range(r.randint(0, 30)))
        words = plain_features(text)[0]
        scanner = importance.Scanner(r.sample(vocabulary, r.randint(0, len(vocabulary))))
        crc, length = scanner.payloads(text)
        assert crc.tolist() == [zlib.crc32(w.encode()) for w in words]
        assert length.tolist() == [len(w.encode()) for w in words]
        want = [zlib.crc32(f.encode()) for f in plain_features(text, 4)[1]]
        assert importance.runs(crc, length, 4).tolist() == want


def test_the_dictionary_holds_the_most_frequent_words(spark, odd, plain):
    counts = collections.Counter(w for r in plain for w in plain_features(r[1])[0])
    for size in (0, 1, 40, 300, 1 << 16):
        least = min(n for n in range(2, max(counts.values()) + 2) if sum(c >= n for c in counts.values()) <= size)
        assert importance.dictionary(odd, size) == sorted(w for w, n in counts.items() if n >= least and len(w) <= importance.LONGEST)


def test_gains_are_floored():
    assert importance.gains(np.array([0, 9]), np.array([4, 0])).tolist() == [
        math.floor(1000 * math.log(5 * 11 / (1 * 6))), math.floor(1000 * math.log(1 * 11 / (10 * 6)))
    ]
