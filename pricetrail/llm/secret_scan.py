"""Secrets in text, told from copied examples by who has them, and where.

Candidates are found by pattern. Their values are hashed, and for every hash the distinct owners (sources) and the distinct
repositories are counted over the whole corpus. A repository is what a column names, or else a text: equal texts are one, in
however many documents they lie. A value of several owners in several repositories is an example that was copied. Any other, which a single owner has in
however many repositories, or which a single repository carries to several owners that hold copies of it, is held to be live if it looks
random or has the form of an issued key. No count drops a value: it is one or the other. Live values are added as spans of kind ``live``; the spans of the
fixed patterns stay whatever the counts say.

Positions come from the text between matches: a match starts where the gaps and the matches
before it end. Texts are scanned once; what is stored are lengths and hashes, no secrets.

Defined cases: null text is empty and has no spans; a null source counts as an owner of its own, and so does a null repository; texts of any
length are scanned whole, and their matches are arrays of one row; matches of several kinds at one place each stay; repeated rows each keep their own spans and are one
repository; further columns are left aside; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import store

# What a candidate is, the group that holds its value, and its least length.
KINDS = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "issued": (r"(?:gh[oprsu]_|xox[abprs]-|glpat-|sk_live_|AIza)[A-Za-z0-9_-]+", 0, 20),
}
BASE = ["assign", "access", "hex"]
LEAST_LENGTH, LEAST_DISTINCT = 16, 8


def _looks_random(value: Column) -> Column:
    several = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return (F.char_length(value) >= LEAST_LENGTH) & several & mixed


def _candidates(text: Column, pattern: str, group: int) -> Column:
    """Gap before each match, its length and its value's length, hash and looks, in text order."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    zipped = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value")),
        lambda m: F.struct(
            m["gap"].alias("gap"), F.char_length(m["whole"]).alias("length"),
            F.char_length(m["value"]).alias("value_length"), F.xxhash64(m["value"]).alias("hash"),
            _looks_random(m["value"]).alias("random"),
        ),
    )
    return F.when(F.size(whole) > 0, F.filter(zipped, lambda m: m["length"].isNotNull()))


def find(docs: DataFrame, repository: str | None = None) -> DataFrame:
    """One stored row per document: row, doc_id, owner, repository and an array of candidates per kind.

    ``repository`` names the column that tells repositories apart; without it, texts do.
    """
    text = F.coalesce("text", F.lit(""))
    place = F.struct(F.col(repository).isNull(), F.col(repository)) if repository else text
    rows = docs.select("doc_id", F.col("source").alias("owner"), F.xxhash64(place).alias("repository"), text.alias("text"))
    return store(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
            *[_candidates(F.col("text"), p, g).alias(kind) for kind, (p, g, _) in KINDS.items()],
        ),
        "secret-candidates",
    )


def spans(found: DataFrame) -> DataFrame:
    """row, doc_id, owner, repository, kind, start, end, value_start, hash, random of every candidate that counts."""
    tagged = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("found")) for kind in KINDS])
    each = (
        found.where(F.coalesce(*KINDS).isNotNull())
        .select("row", "doc_id", "owner", "repository", F.explode(tagged).alias("t"))
        .select("row", "doc_id", "owner", "repository", "t.kind", F.posexplode("t.found").alias("at", "m"))
    )
    order = Window.partitionBy("row", "kind").orderBy("at")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("m.gap").over(upto) + F.coalesce(F.sum("m.length").over(before), F.lit(0))
    least = F.create_map(*[F.lit(x) for kind, (_, _, n) in KINDS.items() for x in (kind, n)])
    return (
        each.withColumn("start", start)
        .where(F.col("m.value_length") >= least[F.col("kind")])
        .select(
            "row", "doc_id", "owner", "repository", "kind", "start", (F.col("start") + F.col("m.length")).alias("end"),
            (F.col("start") + F.col("m.length") - F.col("m.value_length")).alias("value_start"),
            "m.hash", "m.random",
        )
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, owners, repositories: distinct ones, counted in steps so that no hash meets in one task."""
    none = F.lit(None)
    seen = F.array(
        F.struct(F.lit(True).alias("owns"), F.col("owner").alias("owner"), none.cast("long").alias("repository")),
        F.struct(F.lit(False).alias("owns"), none.cast("string").alias("owner"), F.col("repository").alias("repository")),
    )
    each = candidates.select("hash", F.inline(seen)).distinct()
    return each.groupBy("hash").agg(
        F.count_if(F.col("owns")).alias("owners"), F.count_if(~F.col("owns")).alias("repositories")
    )


def judged_spans(found: DataFrame) -> DataFrame:
    """Every span of ``found`` with its value's owners and repositories, ``example`` and ``live``."""
    placed = store(spans(found), "secret-spans")
    counts = ownership(placed).withColumnRenamed("hash", "of")
    example = (F.col("owners") > 1) & (F.col("repositories") > 1)
    return placed.join(counts, F.col("hash") == F.col("of")).drop("of").withColumn("example", example).withColumn(
        "live", (F.col("random") | (F.col("kind") == "issued")) & ~F.col("example")
    )


def scan(docs: DataFrame, repository: str | None = None) -> DataFrame:
    """One row per row of ``docs``: counts, the spans of the patterns and all spans."""
    found = find(docs, repository)
    judged = judged_spans(found)
    kinds = [*BASE, "live"]
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    own = F.when(F.col("kind") != "issued", F.struct(F.col("start"), rank.alias("rank"), F.col("end")))
    added = F.when(F.col("live"), F.struct(F.col("value_start").alias("start"), F.lit(len(kinds)).cast("long").alias("rank"), F.col("end")))
    per_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.count_if(F.col("example")).alias("n_example"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"),
        F.array_sort(F.collect_list(own)).alias("base"),
        F.array_sort(F.collect_set(added)).alias("added"),
    )
    names = F.array(*[F.lit(k) for k in kinds])

    def text(items: Column) -> Column:
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", F.element_at(names, s["rank"].cast("int")), s["start"], s["end"])), ","
        )

    shown = per_row.select(
        F.col("row").alias("of_row"), *[f"n_{k}" for k in BASE], "n_example",
        F.size("added").cast("long").alias("n_live"), "most_owners", "most_repositories",
        text(F.col("base")).alias("base_spans"),
        text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
    zero, none = F.lit(0).cast("long"), F.lit("")
    return found.select("row", "doc_id").join(shown, F.col("row") == F.col("of_row"), "left").select(
        "doc_id",
        *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex", "n_example", "n_live", "most_owners", "most_repositories")],
        F.sha2(F.coalesce("base_spans", none).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
    )
