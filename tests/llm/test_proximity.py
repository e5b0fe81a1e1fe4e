"""Matches of benchmark windows as rows, against a plain version that looks everywhere."""

import collections
import random
import re

import xxhash

from pricetrail.llm import decontaminate

SLOP = decontaminate.SLOP


def words_of(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def term(word):
    h = xxhash.xxh64_intdigest(word.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_matches(docs, bench):
    """(doc_id, text, item_id, kind, from, start, length, off) by trying every pair of places."""
    texts = [words_of(t) for _, t in docs]
    counts = collections.Counter(w for ws in texts for w in ws)
    out = set()
    for item_id, item_text in bench:
        item = words_of(item_text)
        n = min(10, len(item))
        for at in range(len(item) - n + 1 if item else 0):
            window = item[at : at + n]
            known = sorted((counts[w], term(w), at + i) for i, w in enumerate(window) if counts[w])
            if item_id is None or len(known) < -(-n * 80 // 100):
                continue
            a, b = (x[2] for x in (known * 2)[:2]) if len(known) == 1 else (known[0][2], known[1][2])
            for (doc_id, text), ws in zip(docs, texts):
                for p in (i for i, w in enumerate(ws) if w == item[a]):
                    start = p - a + at
                    for off in range(-SLOP, SLOP + 1):
                        q = p - a + b + off
                        if not 0 <= q < len(ws) or ws[q] != item[b] or start < -SLOP:
                            continue
                        exact = start >= 0 and ws[start : start + n] == window
                        near = common(window, ws[max(start - SLOP, 0) : start + n + SLOP]) * 100 >= n * 80
                        if exact or near:
                            out.add((doc_id, text, str(item_id), "exact" if exact else "near", at, start, n, off))
    return out


def edited(r, words):
    words = list(words)
    for _ in range(r.randint(0, 5)):
        i = r.randrange(len(words))
        words[i : i + r.randint(0, 1)] = r.choice([["new"], [], ["two", "more"], ["The"]])
        words = words or ["none"]
    return " ".join(words)


def test_matches_are_those_of_a_plain_version(spark):
    r = random.Random(12)
    vocabulary = ["the", "of", "Red", "blue", "é1", "long", "way", "x9", "sun", "sea", "hill", "tree", "stone"]
    bench = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([0, 1, 2, 5, 10, 12, 16, 25])]
    bench += [(20, "absent " + bench[5][1]), (21, bench[4][1].upper()), (None, bench[4][1]), (22, None)]
    texts = [words_of(t) for _, t in bench if t]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 25))) + "; " + edited(r, r.choice(texts))) for i in range(50)]
    docs += [(50, None), (51, ""), (1, "same id, the other text"), docs[0], docs[0], (52, " ".join(texts[-4][1:]) + " end")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = plain_matches(docs, bench)
    got = [tuple(x) for x in decontaminate.matches(frame, items).collect()]
    assert collections.Counter(got) == collections.Counter((d, *rest) for d, _, *rest in found)
    assert {k for _, _, _, k, *_ in found} == {"exact", "near"}

    sequences = {str(i): tuple(words_of(t)) for i, t in bench if i is not None}
    want = []
    for doc_id, text in docs:
        kinds = {k: {sequences[i] for d, t, i, kind, *_ in found if (d, t, kind) == (doc_id, text, k)} for k in ("exact", "near")}
        want.append((doc_id, len(kinds["near"] - kinds["exact"])))
    report = decontaminate.report(frame, items).collect()
    assert sorted((x.doc_id, x.n_near) for x in report) == sorted(want)


def test_few_shared_words_are_no_proximity_match(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, "alpha x x beta and others"), (2, item.replace("gamma ", "gamma and ")), (3, " ".join(reversed(item.split())))]
    got = decontaminate.report(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    ).collect()
    assert {x.doc_id: x.n_near for x in got} == {1: 0, 2: 1, 3: 0}


def test_matches_of_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.matches(empty, items).count() == 0 and decontaminate.matches(odd, items.limit(0)).count() == 0
