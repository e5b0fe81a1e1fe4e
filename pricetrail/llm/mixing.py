"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight: -ln(u) / weight,
u being a hash of its id and text. Sorted by key, the documents of a source stand in the
order of a weighted sample without replacement. A source's target is met by as many
complete epochs as fit and then by the beginning of that order, up to the words that are
left of the target: the document there gives only part of its words. Where whole rows are asked
for (``mixed_documents``) it goes in if at least half of it is taken.

The order is never built. Words are summed in intervals of the key axis, and the interval in which the target is
reached is cut again until few rows are left; only these are sorted. What
leaves that step is one cut key per source, so documents are chosen by comparing their own
key with their source's cut, without moving texts.

Defined cases: null text has no words and size 0; a null source is a source of its own, last
in order; a source without words has target 0 and no copies; equal keys (repeated rows) are
taken or left together and share
a part evenly; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import carried, store, unit_interval

WORD = r"[^\x20\x09-\x0D]+"
#: An upper bound on the copies of a document: its source's target over its source's size.
MOST_EPOCHS = 3.0
#: Rows of one source sorted together, and intervals that its keys are counted in.
BUCKET_ROWS, FAN = 2_000, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, words: Column) -> Column:
    """1 for words of six characters on average, less the further from that; never 0."""
    mean = F.coalesce(F.char_length(text), F.lit(0)) / (words + 1)
    return F.lit(1.0) / (F.lit(1.0) + F.abs(mean - F.lit(6.0)))


def sample_key(doc_id: Column, text: Column, weight: Column, seed: int = 7) -> Column:
    """The smaller, the earlier in the sample."""
    return -F.log(unit_interval(doc_id, text, seed=seed)) / weight


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with its size in words and its key."""
    sized = docs.withColumn("size", word_count(F.col("text")))
    return sized.withColumn("key", sample_key(F.col("doc_id"), F.col("text"), quality_weight(F.col("text"), F.col("size"))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = MOST_EPOCHS) -> DataFrame:
    """Add each source's target to one row per source (source, source_size).

    Weights repeat along the sources in code point order, null last. The targets share the sum
    of all sizes; one above ``most`` times its source stops there and the others share the
    excess. Filling sources in the order of cap / weight shows which ones stop: a source
    stops if its cap is not above its share of what the stopped ones before it leave.
    """
    everything = Window.partitionBy(F.lit(0))
    listed = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    choice = F.array(*[F.lit(float(w)) for w in weights])
    zero = F.lit(0.0)
    ranked = (
        sizes.withColumn("place", F.row_number().over(listed))
        .withColumn("weight", F.get(choice, ((F.col("place") - 1) % len(weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(by_ratio), zero))
        .withColumn("share", F.col("left") / (F.col("all_weights") - F.coalesce(F.sum("weight").over(by_ratio), zero)))
        .withColumn("stops", F.col("ratio") <= F.col("share"))
    )
    open_weight = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    stopped = F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), zero)
    shared = (F.col("total") - stopped) * F.col("weight") / open_weight
    return ranked.select(
        *sizes.columns, F.when(F.col("stops"), F.col("cap")).otherwise(shared).alias("target")
    )


def plan_mix(rows: DataFrame) -> DataFrame:
    """One row per source from (source, size, key): source_size, target, epochs, cut, part.

    A document is taken ``epochs`` times, and once more if its key is below ``cut``; with
    that key it gives the share ``part`` of its words.
    ``rows`` are read several times: pass a stored table.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.try_divide("target", "source_size"))
    plan = targets(sizes).withColumn("epochs", F.coalesce(whole, F.lit(0)).cast("long"))
    rest = F.least(F.col("target") - F.col("epochs") * F.col("source_size"), F.col("source_size").cast("double"))
    plan = store(plan.withColumn("rest", rest), "mix-plan")
    cuts = _cut_keys(rows, plan.select(F.col("source").alias("of"), "rest").where("rest > 0"))
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "epochs", "cut", F.col("share").alias("part")
    )


def _cut_keys(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(of, cut, share): the key at which a source's ``rest`` of words is reached, and the share taken of the rows with it.

    Words are summed in FAN intervals between the least and the greatest key in question; the interval in which ``rest`` is reached
    is looked at again, between its own least and greatest key, until it has BUCKET_ROWS rows or one key. Only that
    many rows of a source are ever put in order, however its keys lie.
    """
    ends = rows.groupBy("source").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    spans = wanted.join(ends, F.col("of").eqNullSafe(F.col("source"))).select(
        "of", "rest", "low", "high", F.lit(0).cast("long").alias("below"), F.lit(1 << 62).alias("n")
    )
    spans = store(spans, "mix-spans")
    upto = Window.partitionBy("of").orderBy("at")
    before = F.col("below") + F.col("run") - F.col("part")

    def inside(of: DataFrame) -> DataFrame:
        own = F.col("source").eqNullSafe(F.col("of")) & F.col("key").between(F.col("low"), F.col("high"))
        return rows.join(of, own)

    open_span = (F.col("n") > BUCKET_ROWS) & (F.col("low") < F.col("high"))
    while not spans.where(open_span).isEmpty():
        place = F.floor(F.try_divide(F.col("key") - F.col("low"), F.col("high") - F.col("low")) * FAN)
        at = F.coalesce(F.least(place, F.lit(FAN - 1)), F.lit(0)).alias("at")
        sums = inside(spans.drop("n")).groupBy("of", "rest", "below", at).agg(
            F.sum("size").alias("part"), F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        hit = sums.withColumn("run", F.sum("part").over(upto)).where((before < F.col("rest")) & (before + F.col("part") >= F.col("rest")))
        spans = store(hit.select("of", "rest", "low", "high", before.alias("below"), "n"), "mix-spans")
    keys = inside(spans).groupBy("of", "rest", "below", "key").agg(F.sum("size").alias("part"))
    run = keys.withColumn("run", F.sum("part").over(Window.partitionBy("of").orderBy("key")))
    last = run.where((before < F.col("rest")) & (before + F.col("part") >= F.col("rest")))
    return last.select("of", F.col("key").alias("cut"), F.least((F.col("rest") - before) / F.col("part"), F.lit(1.0)).alias("share"))


def last_share(key: Column, cut: Column, part: Column) -> Column:
    """The share of a document that goes in after the complete epochs."""
    return F.when(key < cut, F.lit(1.0)).when(key == cut, part).otherwise(F.lit(0.0))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = store(with_keys(docs.select("doc_id", "text", "source")).drop("text"), "mix-rows")
    plan = store(plan_mix(rows), "mix-cuts").withColumnRenamed("source", "of")
    share = last_share(F.col("key"), F.col("cut"), F.col("part"))
    words = F.floor(share * F.col("size") + F.lit(1e-6)).cast("long")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") + share).alias("copies"), (F.col("epochs") * F.col("size") + words).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns as they are."""
    own = with_keys(docs.select("doc_id", "text", "source")).drop("text", "doc_id")
    plan = store(plan_mix(store(own, "mix-rows")), "mix-cuts").withColumnRenamed("source", "of")
    rows = with_keys(docs.select(carried(docs), "doc_id", "text", "source")).select("doc", "source", "key")
    times = F.col("epochs") + F.round(last_share(F.col("key"), F.col("cut"), F.col("part")))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("doc.*")
