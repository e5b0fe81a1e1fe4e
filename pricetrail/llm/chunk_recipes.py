"""Exact duplicates by content-defined chunk recipes.

A text without its white space is cut into chunks where its own bytes say so: after two bytes whose low
halves are fixed, LEAST to MOST bytes from the last cut. Equal texts are thus cut alike, and a passage that two
texts share is mostly cut alike in both. A chunk gets an identifier of 128 bits from its content; a recipe is the
ordered list of a text's identifiers, and texts are equal if their recipes are.

Identifiers are verified, not trusted: all distinct chunks travel once, partly combined before the shuffle, and
no identifier may stand for two contents; if one does, all are drawn anew with another seed. Recipes get an
identifier of their own, verified in the same way. From then on a document is two numbers: grouping, the choice of the row
that stays and the join back to the rows move no text, however long.

Groups are aggregated before the shuffle. Rows join their group in two ways: with the groups that hold at least
1 / HOT_SHARE of all rows, of which there are HOT_SHARE at most, by a broadcast, so that the largest groups are never
gathered; with the others by a shuffle.

Defined cases: null counts as empty, and all texts of white space alone are equal. Of equal texts the row with the most code
points stays, then the smallest doc_id, a null doc_id last; of rows that agree in all this exactly one. Very long texts
are one list of chunks in a row. Only doc_id and text are read, so other columns may have any name; ``without_copies``
returns them untouched. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import store

#: Bytes of a chunk; only the last one of a text may be shorter.
LEAST, MOST = 256, 4096
#: Low halves of the two bytes before a cut, in hexadecimal: one place in 256 on average.
CUT_AFTER = "83"
#: A group with at least this part of all rows is joined by a broadcast; there are so many at most.
HOT_SHARE = 1000
WHITE = " \t\n\x0b\f\r"

#: A chunk's or list's identifier from its content and the number of the attempt: two longs.
Naming = Callable[[Column, int], tuple[Column, Column]]


def hashed(content: Column, attempt: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * attempt), content), F.xxhash64(F.lit(2 * attempt + 1), content)


def without_white_space(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    """Over hexadecimal digits, two to a byte: up to a cut or the end; else ``most`` bytes; else what is left."""
    cut = "".join(f".{half}" for half in CUT_AFTER)
    return rf"(?:..){{{least},{most - 1}}}?(?:(?<={cut})|\z)|(?:..){{{most}}}|.+"


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text without white space, in hexadecimal."""
    digits = F.hex(text.cast("binary"))
    return F.regexp_extract_all(digits, F.lit(chunk_pattern(least, most)), F.lit(0))


def _clashes(contents: DataFrame) -> bool:
    """Whether some identifier (a, b) stands for several contents."""
    distinct = contents.groupBy("a", "b", "content").agg(F.count(F.lit(1)).alias("uses"))
    return not distinct.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()


def _pieces(docs: DataFrame, name: Naming, attempt: int) -> DataFrame:
    """(a, b, content) of every chunk of every document."""
    cut = docs.select(F.explode(chunks(without_white_space(F.col("text")))).alias("digits"))
    pieces = cut.select(F.unhex("digits").alias("content"))
    a, b = name(F.col("content"), attempt)
    return pieces.select(a.alias("a"), b.alias("b"), "content")


def _named(list_of: Column, name: Naming, attempt: int) -> Column:
    def one(digits: Column) -> Column:
        a, b = name(F.unhex(digits), attempt)
        return F.struct(a.alias("a"), b.alias("b"))

    return F.transform(list_of, one)


def recipes(docs: DataFrame, name: Naming = hashed) -> DataFrame:
    """Stored rows: row, doc_id, n_chars, text_sha256, recipe (verified identifiers in order), a and b (the recipe's own).

    ``row`` numbers the rows of ``docs``; it tells repeated rows apart.
    """
    attempt = 0
    while _clashes(_pieces(docs, name, attempt)):
        attempt += 1
    text = without_white_space(F.col("text"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(text, 256).alias("text_sha256"), _named(chunks(text), name, attempt).alias("recipe"),
    )
    rows = store(rows, "recipes")
    attempt = 0
    while True:
        a, b = name(F.to_json("recipe").cast("binary"), attempt)
        named = rows.withColumns({"a": a, "b": b})
        if not _clashes(named.select("a", "b", F.col("recipe").alias("content"))):
            return named
        attempt += 1


def chunk_store(docs: DataFrame, name: Naming = hashed) -> DataFrame:
    """Every distinct chunk once: a, b, content (bytes) and the number of its uses. The seed is that of ``recipes``."""
    attempt = 0
    while _clashes(_pieces(docs, name, attempt)):
        attempt += 1
    return _pieces(docs, name, attempt).groupBy("a", "b", "content").agg(F.count(F.lit(1)).alias("uses"))


def rebuilt(listed: DataFrame, chunks_of: DataFrame) -> DataFrame:
    """row and text (without white space) of stored recipes, from their chunks."""
    places = listed.select("row", F.posexplode_outer("recipe").alias("at", "id"))
    found = places.join(
        chunks_of.select(F.col("a").alias("ca"), F.col("b").alias("cb"), "content"),
        (F.col("id.a") == F.col("ca")) & (F.col("id.b") == F.col("cb")), "left",
    )
    parts = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", F.hex("content").alias("digits")))).alias("parts"))
    digits = F.array_join(F.transform("parts", lambda p: F.coalesce(p["digits"], F.lit(""))), "")
    return parts.select("row", F.decode(F.unhex(digits), "utf-8").alias("text"))


def _place() -> Column:
    """The smaller, the sooner a row stays: most code points, then the smallest doc_id, null last; one number of fixed width."""
    most, ids = F.lit((1 << 31) - 1).cast("decimal(10,0)"), F.lit(str(1 << 65)).cast("decimal(20,0)")
    by_id = F.coalesce(F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)"), F.lit(str(1 << 64)).cast("decimal(21,0)"))
    return ((most - F.col("n_chars").cast("decimal(10,0)")) * ids + by_id).cast("decimal(38,0)")


def exact_copies(docs: DataFrame, name: Naming = hashed) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, text_sha256, n_chars and n_chunks of every row of ``docs``."""
    rows = recipes(docs, name).withColumn("place", _place())
    groups = rows.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min_by("doc_id", "place").alias("keep_id"), F.min_by("row", "place").alias("keep_row"),
    )
    # Stored, so that of rows that agree in all the same one stays if a task is run again.
    groups = store(groups, "recipe-groups").withColumnsRenamed({"a": "ga", "b": "gb"})
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") * HOT_SHARE >= F.lit(total)
    own = (F.col("a") == F.col("ga")) & (F.col("b") == F.col("gb"))
    large = F.broadcast(groups.where(hot))  # HOT_SHARE rows at most
    met = rows.join(large, own).unionByName(rows.join(large, own, "left_anti").join(groups.where(~hot), own))
    return met.select(
        "row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256",
        "n_chars", F.size("recipe").alias("n_chunks"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; texts are joined with the few numbers of rows that go."""
    found = store(exact_copies(docs), "recipe-copies")
    key = [F.col("doc_id"), F.sha2(without_white_space(F.col("text")), 256), F.coalesce(F.char_length("text"), F.lit(0)).cast("long")]
    stays = found.groupBy("doc_id", "text_sha256", "n_chars").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")
    )
    carried = docs.select(F.struct(*docs.columns).alias("doc"), *[k.alias(n) for k, n in zip(key, ("i", "s", "n"))])
    same = F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("s") == F.col("text_sha256")) & (F.col("n") == F.col("n_chars"))
    plain = carried.join(stays.where(~F.col("kept") | (F.col("rows") > 1)), same, "left_anti")
    repeated = carried.join(stays.where(F.col("kept") & (F.col("rows") > 1)), same, "left_semi").dropDuplicates(["i", "s", "n"])
    return plain.unionByName(repeated).select("doc.*")
