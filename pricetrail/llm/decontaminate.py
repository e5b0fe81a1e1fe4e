"""Benchmark decontamination from a positional inverted index of the documents.

The index has a posting (term, document, position) for every document word that any benchmark
item uses, and one that marks where each document ends. It is made in one scan, where terms
become hashes and a join with the items' terms leaves the rest out; no posting is shuffled to write it.

A window is ten words in a row of an item, all of them if it has fewer. Its two rarest terms among those that the documents have, by
their postings' number, are looked up: the postings of the rarest one fix where the window would
lie, and those of the second, shifted by its distance, must agree, or stand up to SLOP places off. What is left after this intersection
is compared with the documents' texts. It is an exact match if the window's words are there, word by word. It is a proximity match if at least
NEAR_PERCENT of the window's words follow each other in its order (as a longest common subsequence) from SLOP words before its place
to SLOP words after. A passage that lacks one of the two rarest is not looked for. ``matches`` returns both kinds as rows.

Postings of a frequent term are rows of many tasks and are never gathered; only the windows found in one
document meet. Items of equal words are looked up once.

Defined cases: null text, and text without words, has no words, no hits, and as an item no windows; a
null item_id is left out of the items found; repeated rows are judged alike; documents of equal
id and different text are apart; texts of any length are read whole; terms equally rare are taken by hash, then by place;
further columns are left aside, and come through ``clean_documents`` as they are; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import lower_ascii, sent, store

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SLOP, NEAR_PERCENT = 10, 3, 80
NO_ID = -(1 << 63)
END = ""


def raw_words(text: Column) -> Column:
    """Words with A-Z as they are, which are lower-cased word by word."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lower_word(word: Column) -> Column:
    """``lower`` is right, and much faster, for words within ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(lower_ascii(word))


def words(text: Column) -> Column:
    return raw_words(lower_ascii(text))


def keyed(docs: DataFrame) -> DataFrame:
    """doc and version, which tell a document, and its text."""
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), "text",
    )


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """item, words, ids: the distinct word sequences of the items and who has them."""
    listed = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    return store(
        listed.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("item"), "words", "ids"),
        "bench-items",
    )


def item_terms(items: DataFrame) -> DataFrame:
    """item, n, at, term for every word of the items."""
    return items.select("item", F.size("words").alias("n"), F.posexplode("words").alias("at", "word")).select(
        "item", "n", "at", F.xxhash64("word").alias("term")
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (doc, version, term, at) of the given terms, with END after the last word."""
    wanted = terms.select("term").unionByName(
        docs.sparkSession.range(1).select(F.xxhash64(F.lit(END)).alias("term"))
    ).distinct().withColumnRenamed("term", "wanted")
    tokens = keyed(docs).select(
        "doc", "version", F.posexplode(F.concat(raw_words(F.col("text")), F.array(F.lit(END)))).alias("at", "word")
    )
    postings = tokens.select("doc", "version", F.xxhash64(lower_word(F.col("word"))).alias("term"), "at")
    return store(
        postings.join(wanted, F.col("term") == F.col("wanted")).drop("wanted"), "postings"
    )


def least_common(length: Column) -> Column:
    """The words that a proximity match shares with a window of ``length`` at least."""
    return F.ceil(length * NEAR_PERCENT / 100)


def windows(terms: DataFrame, index: DataFrame, slop: int = 0) -> DataFrame:
    """item, from, length and the two rarest (count, term, at) of every window that can occur, if ``slop`` allows in part."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("postings")).withColumnRenamed("term", "of")
    length = F.least(F.col("n"), F.lit(WINDOW))
    first, last = F.greatest(F.col("at") - length + 1, F.lit(0)), F.least(F.col("at"), F.col("n") - length)
    placed = (
        terms.join(counts, F.col("term") == F.col("of"))
        .withColumn("from", F.explode(F.sequence(first, last)))
        .groupBy("item", "from", length.alias("length"))
        .agg(F.array_sort(F.collect_list(F.struct("postings", "term", "at"))).alias("rarest"))
        .where(F.size("rarest") >= (least_common(F.col("length")) if slop else F.col("length")))  # else too few words are in any document
    )
    return placed.select(
        "item", "from", "length", F.col("rarest")[0].alias("a"), F.coalesce(F.get("rarest", F.lit(1)), F.col("rarest")[0]).alias("b")
    )


def occurrences(index: DataFrame, found: DataFrame, slop: int = 0) -> DataFrame:
    """doc, version, item, from, length, start, off: windows whose two rarest terms agree up to ``slop``."""
    pairs = store(
        found.groupBy("item", "length", F.col("a.term").alias("term_a"), F.col("a.at").alias("at_a"),
                      F.col("b.term").alias("term_b"), F.col("b.at").alias("at_b"))
        .agg(F.collect_list("from").alias("froms")),
        "bench-pairs",
    )
    rarest = index.join(pairs, F.col("term") == F.col("term_a")).select(
        "doc", "version", "item", "length", "froms", (F.col("at") - F.col("at_a")).alias("shift"), "term_b", "at_b",
    )
    second_terms = pairs.select(F.col("term_b").alias("second")).distinct()
    second = index.join(second_terms, F.col("term") == F.col("second"), "left_semi").select(
        F.col("doc").alias("doc_b"), F.col("version").alias("version_b"), "term", "at"
    )
    both = rarest.join(
        second,
        (F.col("doc") == F.col("doc_b")) & (F.col("version") == F.col("version_b")) & (F.col("term_b") == F.col("term"))
        & (F.abs(F.col("at") - F.col("at_b") - F.col("shift")) <= slop),
    )
    return both.select(
        "doc", "version", "item", "length", F.explode("froms").alias("from"), "shift",
        (F.col("at") - F.col("at_b") - F.col("shift")).alias("off"),
    ).withColumn("start", F.col("shift") + F.col("from")).where(F.col("start") >= -slop).drop("shift")


def common_in_order(window: Column, here: Column) -> Column:
    """Length of the longest common subsequence of two short arrays, row by row of its table."""
    def next_row(row: Column, word: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(here)), F.array(F.lit(0)),
            lambda new, j: F.array_append(
                new,
                F.when(F.get(here, j - 1) == word, F.get(row, j - 1) + 1).otherwise(F.greatest(F.get(row, j), F.get(new, j - 1))),
            ),
        )

    return F.aggregate(window, F.array_repeat(F.lit(0), F.size(here) + 1), next_row, lambda row: F.get(row, F.size(here)))


def compared(docs: DataFrame, candidates: DataFrame, items: DataFrame, slop: int = 0) -> DataFrame:
    """The candidates (doc, version, item, from, length, start, off) that match, and whether they are ``exact``."""
    per_doc = candidates.groupBy("doc", "version").agg(
        F.collect_set(F.struct("item", "from", "length", "start", "off")).alias("found")
    ).select(F.col("doc").alias("doc_f"), F.col("version").alias("version_f"), "found")
    # The texts of documents without a candidate stay where they are.
    with_any = candidates.select(F.col("doc").alias("doc_c"), F.col("version").alias("version_c")).distinct()
    asked = keyed(docs).join(
        sent(with_any), (F.col("doc") == F.col("doc_c")) & (F.col("version") == F.col("version_c")), "left_semi"
    )
    joined = asked.join(per_doc, (F.col("doc") == F.col("doc_f")) & (F.col("version") == F.col("version_f")))

    def stretch(all_words: Column, c: Column) -> Column:
        first = F.greatest(c["start"] - slop, F.lit(0))
        return F.slice(all_words, first + 1, c["start"] + c["length"] + slop - first)

    # The words are bound to a lambda's argument so that they are split once for a document.
    cut = F.transform(
        F.array(words(F.col("text"))),
        lambda all_words: F.transform(
            F.col("found"), lambda c: F.struct(c.alias("c"), stretch(all_words, c).alias("here"))
        ),
    )[0]
    each = joined.select("doc", "version", F.explode(cut).alias("m")).select("doc", "version", "m.c.*", "m.here")
    text = items.select(F.col("item").alias("item_t"), F.col("words"))
    window, before = F.slice("words", F.col("from") + 1, F.col("length")), F.least(F.col("start"), F.lit(slop))
    exact = (F.col("start") >= 0) & (F.slice("here", F.greatest(before, F.lit(0)) + 1, F.col("length")) == F.col("window"))
    placed = each.join(text, F.col("item") == F.col("item_t")).withColumn("window", window).withColumn("exact", exact)
    if not slop:
        return placed.where("exact").select("doc", "version", "item", "from", "length", "start", "off", "exact")
    least = least_common(F.col("length"))
    shared = F.size(F.filter("window", lambda w: F.array_contains("here", w)))
    near = F.when(shared >= least, common_in_order(F.col("window"), F.col("here")) >= least).otherwise(F.lit(False))
    return placed.where(F.col("exact") | near).select("doc", "version", "item", "from", "length", "start", "off", "exact")


def hit_words(spans: Column) -> Column:
    """Number of positions inside (start, end) spans that are sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans, zero,
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("hit"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
        lambda acc: acc["hit"],
    )


def found_windows(docs: DataFrame, index: DataFrame, items: DataFrame, terms: DataFrame, slop: int) -> DataFrame:
    """Stored exact matches, and with a ``slop`` proximity matches, of the items' windows."""
    candidates = store(occurrences(index, windows(terms, index, slop), slop), "bench-candidates")
    return store(compared(docs, candidates, items, slop), "bench-hits")


def matches(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, item_id, kind, from, start, length, off: a row for each match of an item's window in a document's text.

    ``from`` is the window's first word in the item and ``start`` its place in the document, both counted from 0; ``off`` is how far the
    second rarest word stands from its place. kind is ``exact`` or ``near``. Documents of equal id and text, and items of equal id and words, give their matches once.
    """
    items = distinct_items(benchmark)
    terms = item_terms(items)
    found = found_windows(docs, build_index(docs, terms), items, terms, slop)
    named = items.select(F.col("item").alias("item_i"), F.explode("ids").alias("item_id"))
    kind = F.when(F.col("exact"), F.lit("exact")).otherwise(F.lit("near"))
    return found.join(named, F.col("item") == F.col("item_i")).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "version", "item_id", kind.alias("kind"), "from", "start", "length", "off"
    ).distinct().drop("version")


def contamination(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc, version, n_words, n_hit, ids, n_near, a row for each distinct document.

    ``ids`` are the items with windows that occur; ``n_near`` counts the items, of different words, with proximity matches only (0 without ``slop``).
    """
    items = distinct_items(benchmark)
    terms = item_terms(items)
    index = build_index(docs, terms)
    ends = index.where(F.col("term") == F.xxhash64(F.lit(END)))
    found = found_windows(docs, index, items, terms, slop)
    span = F.when(F.col("exact"), F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    per_item = found.groupBy("doc", "version", "item").agg(F.collect_set(span).alias("spans")).join(
        items.select(F.col("item").alias("item_i"), "ids"), F.col("item") == F.col("item_i")
    )
    has = F.size("spans") > 0
    hits = per_item.groupBy("doc", "version").agg(
        hit_words(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans"))))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(has, F.col("ids")))))).alias("ids"),
        F.count_if(~has).alias("n_near"),
    )
    zero = F.lit(0).cast("long")
    return (
        ends.groupBy("doc", "version").agg(F.max("at").cast("long").alias("n_words"))
        .join(hits, ["doc", "version"], "left")
        .select(
            "doc", "version", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce("ids", F.array().cast("array<string>")).alias("ids"), F.coalesce("n_near", zero).alias("n_near"),
        )
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near for every row of ``docs``."""
    judged = contamination(docs, benchmark)
    rows = keyed(docs).select(F.col("doc").alias("d"), F.col("version").alias("v"))
    return rows.join(judged, (F.col("d") == F.col("doc")) & (F.col("v") == F.col("version"))).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns as they are."""
    hit = store(
        contamination(docs, benchmark, slop=0).where(F.col("n_hit") > 0).select("doc", "version"), "bench-contaminated"
    )
    key = F.struct(
        F.coalesce(docs["doc_id"], F.lit(NO_ID)), F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    )
    return docs.join(sent(hit), key == F.struct(hit["doc"], hit["version"]), "left_anti")
