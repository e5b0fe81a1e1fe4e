"""Chunk recipes against a plain grouping of the texts."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pricetrail.llm import chunk_recipes

BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_copies(rows):
    """(doc_id, keep_id, group_size, sha) of every (doc_id, text), and how many rows stay per group."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[BLANK.sub("", text or "")].append((doc_id, text or ""))
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep[0], len(own), sha) for i, _ in own]
    return sorted(out, key=str), len(groups)


def compare(docs, rows, **how):
    got = chunk_recipes.exact_copies(docs, **how).collect()
    want, groups = plain_copies(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups and len({r.text_sha256 for r in got if r.kept}) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_copies_of_odd_rows(odd, empty, plain):
    compare(odd, [(r[0], r[1]) for r in plain])
    assert chunk_recipes.exact_copies(empty).count() == 0 and chunk_recipes.without_copies(empty).count() == 0


def test_copies_that_differ_in_white_space_only(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcdéя中x.") for _ in range(n)) for n in (5, 300, 9000, 40_000)]
    rows = []
    for i in range(60):
        text = base[i % 4]
        at = sorted(r.randrange(len(text)) for _ in range(i % 5))
        for a in reversed(at):
            text = text[:a] + r.choice(" \t\n\x0b\f\r") + text[a:]
        rows.append((1000 - i, text))
    rows += [(1, base[2] + "x"), (2, base[2][:-1]), (3, "a b"), (4, "ab"), (5, "a b"), (6, "\x1fab"), (7, "AB")]
    rows += [(i, f"{i} and its own text") for i in range(2000, 3100)]  # so that groups of one are no hot ones
    compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows)


def test_clashing_identifiers_are_drawn_anew(spark):
    tried = set()

    def weak(content, attempt):
        tried.add(attempt)
        return (F.xxhash64(content) % 3, F.lit(0).cast("long")) if attempt < 2 else chunk_recipes.hashed(content, attempt)

    rows = [(i, f"text {i % 30} " * (i % 30)) for i in range(90)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"), rows, name=weak)
    assert tried == {0, 1, 2}


@pytest.mark.parametrize("least, most", [(2, 5), (16, 64), (256, 4096)])
def test_chunks_are_cut_by_content(spark, least, most):
    r = random.Random(least)
    middle = "".join(r.choice("abcdefghé中") for _ in range(30_000))
    texts = ["", "a", "é", middle, "zz" + middle, middle[:10_000] + "!" + middle[10_000:], "q" * 10_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x.doc_id: x.c for x in docs.select("doc_id", chunk_recipes.chunks(F.col("text"), least, most).alias("c")).collect()}
    for i, text in enumerate(texts):
        parts = [bytes.fromhex(c) for c in found[i]]
        assert b"".join(parts) == text.encode() and all(parts)
        assert all(least <= len(p) <= most for p in parts[:-1])
        for p in parts[:-1]:
            assert len(p) == most or (p[-2] & 15, p[-1] & 15) == (8, 3)
    if most < 4096:
        return
    # An insertion changes the chunks around it and no others.
    for other in (4, 5):
        assert len(set(found[3]) - set(found[other])) < 0.3 * len(found[3])


def test_texts_are_rebuilt_from_their_chunks(odd, plain):
    listed = chunk_recipes.recipes(odd)
    kept = chunk_recipes.chunk_store(odd)
    assert kept.count() == kept.select("a", "b").distinct().count()
    assert kept.agg(F.sum("uses")).first()[0] == listed.agg(F.sum(F.size("recipe"))).first()[0]
    texts = chunk_recipes.rebuilt(listed, kept)
    assert sorted(r.text for r in texts.collect()) == sorted(BLANK.sub("", r[1] or "") for r in plain)


def test_rows_that_stay_keep_their_columns(odd, plain):
    stay = chunk_recipes.without_copies(odd)
    assert stay.columns == odd.columns
    got = [tuple(r) for r in stay.collect()]
    assert collections.Counter(got) - collections.Counter(plain) == collections.Counter()
    assert sorted(BLANK.sub("", r[1] or "") for r in got) == sorted({BLANK.sub("", r[1] or "") for r in plain})
