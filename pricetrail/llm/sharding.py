"""K-d tree partitioning of documents into shards of near equal bytes.

A node of the tree is a set of documents and the number of leaves it shall have. Its widest
metadata dimension (range of its values over the range in the whole table) is cut at the
weighted median, or at the fraction that fits an odd number of leaves. All nodes of a level are cut
together: weights are summed per node and interval of the key axis, the interval with the
median is cut again, until what is left weighs next to nothing or is one text or row. So no node
is ever sorted or gathered; a pass moves at most ``FAN`` sums per node and task, and joins the rows, which keep their node
between levels, with one small table.

Keys are the dimension's values, then a hash of the text, then one of the id. Equal texts agree in all but the last, and intervals
end between texts, so copies stay in one shard. A group of equal texts that weighs more than
``WHOLE`` of a leaf is divided by the ids where a cut meets it, into 2^DOC_BITS parts at most.

Defined cases: null text has size 1 and is equal to the empty one; a table with
fewer rows than leaves leaves some shards empty; repeated rows stay together; very long texts are one row of their size;
an empty table gives no rows. Only doc_id and text are read, other columns may have any name; ``sharded_documents``
returns them untouched, and calls its own column shard with as many _ behind it as it takes to be new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import carried, slots, store, unsigned_crc32

#: Intervals a node's key axis is cut into in one pass.
FAN = 4096
#: Bits of a dimension's value, of the hash of the text behind it, and of the id's; together a positive long.
VALUE_BITS, TEXT_BITS, DOC_BITS = 32, 16, 14
TIE_BITS = TEXT_BITS + DOC_BITS
#: A cut is done when the interval that holds it weighs less than this share of its node.
NEAR = 0.0002
#: Equal texts stay together up to this share of a leaf.
WHOLE = 0.1
SLOT_ROWS = 50_000


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def metadata_columns() -> dict[str, Column]:
    """size, text_crc32, tie and the dimensions d0.. : length, bytes per character (a sign of the script), hash of the text.

    All dimensions come from the text alone, so that equal texts agree in them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    crc, length = unsigned_crc32(text), F.char_length(text).cast("long")
    per_char = F.floor(F.octet_length(text) * 1000 / F.greatest(length, F.lit(1))).cast("long")
    return {
        "size": text_bytes(text),
        "text_crc32": crc,
        "tie": F.shiftleft(F.pmod(F.xxhash64(text), F.lit(1 << TEXT_BITS)), DOC_BITS) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << DOC_BITS)),
        "d0": length,
        # Few values: the hash behind them tells texts of one script apart.
        "d1": F.shiftleft(per_char, 20) + F.shiftright(crc, 12),
        "d2": crc,
    }


def metadata(docs: DataFrame, *keep: Column) -> DataFrame:
    return docs.select(*keep, *[c.alias(n) for n, c in metadata_columns().items()])


def _key(dims: list[str]) -> Column:
    value = reduce(
        lambda rest, i: F.when(F.col("dim") == i, F.col(dims[i])).otherwise(rest),
        range(1, len(dims)), F.col(dims[0]),
    )
    return F.shiftleft(value, TIE_BITS) + F.col("tie")


def _open_nodes(split: DataFrame, dims: list[str], whole: dict[str, float]) -> DataFrame:
    """Per open node the dimension of the widest range, that range's key interval, and the weight wanted on the left."""
    bounds = split.groupBy("node", "leaves").agg(
        F.sum("size").alias("weight"),
        *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims],
    )
    widths = [
        F.struct(
            ((F.col(f"hi_{d}") - F.col(f"lo_{d}")) / F.lit(whole[d])).alias("width"),
            F.lit(-i).alias("rank"),
            F.shiftleft(F.col(f"lo_{d}"), TIE_BITS).alias("low"),
            F.shiftleft(F.col(f"hi_{d}") + 1, TIE_BITS).alias("high"),
        )
        for i, d in enumerate(dims)
    ]
    best = F.greatest(*widths) if len(widths) > 1 else widths[0]
    zero = F.lit(0).cast("long")
    return bounds.select("node", "leaves", "weight", best.alias("w")).select(
        F.col("node").alias("at"), F.col("leaves").alias("parts"), "weight", (-F.col("w.rank")).alias("dim"),
        F.col("w.low").alias("low"), F.col("w.high").alias("high"),
        (F.floor(F.col("leaves") / 2) / F.col("leaves") * F.col("weight")).alias("want"),
        zero.alias("below"), F.col("weight").alias("inside"), zero.alias("rows"),
    )


def _cuts(split: DataFrame, spans: DataFrame, dims: list[str]) -> DataFrame:
    """Stored (cut_node, cut_dim, cut_leaves, cut): keys below ``cut`` go left. ``spans`` has the open nodes."""
    one_text = F.lit(1 << DOC_BITS)
    wide = F.col("high") - F.col("low") > one_text
    fine = F.ceil((F.col("high") - F.col("low")) / FAN).cast("long")
    state = ["at", "parts", "weight", "dim", "low", "high", "want", "below"]
    before = F.col("below") + F.col("run") - F.col("part")
    upto = Window.partitionBy("at").orderBy("interval")
    while True:
        # Intervals of more than one text end between texts.
        stepped = spans.withColumn("step", F.when(wide, F.ceil(fine / one_text).cast("long") * one_text).otherwise(fine))
        met = split.join(F.broadcast(stepped), F.col("node") == F.col("at"))  # a row per open node, fewer than leaves
        keyed = met.withColumn("key", _key(dims)).where((F.col("key") >= F.col("low")) & (F.col("key") < F.col("high")))
        sums = keyed.groupBy(*state, "step", F.expr("(key - low) div step").alias("interval")).agg(
            F.sum("size").alias("part"), F.count(F.lit(1)).alias("n")
        )
        hit = sums.withColumn("run", F.sum("part").over(upto)).where(
            (before < F.col("want")) & (before + F.col("part") >= F.col("want"))
        )
        start = F.col("low") + F.col("interval") * F.col("step")
        spans = store(hit.select(
            "at", "parts", "weight", "dim", start.alias("low"), F.least(start + F.col("step"), F.col("high")).alias("high"),
            "want", before.alias("below"), F.col("part").alias("inside"), F.col("n").alias("rows"),
        ), "kd-spans")
        heavy = F.when(wide, F.col("inside") > F.col("weight") * NEAR).otherwise(F.col("inside") > F.col("weight") / F.col("parts") * WHOLE)
        if spans.where((F.col("high") - F.col("low") > 1) & (F.col("rows") > 1) & heavy).isEmpty():
            break
    near_end = F.col("want") - F.col("below") > F.col("inside") / 2
    cut = F.when(near_end, F.col("high")).otherwise(F.col("low"))
    return store(spans.select(
        F.col("at").alias("cut_node"), F.col("dim").alias("cut_dim"), F.col("parts").alias("cut_leaves"), cut.alias("cut")
    ), "kd-cuts")


def leaves_for(rows: DataFrame, target_bytes: int) -> int:
    total = rows.agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // target_bytes))


def _roots(rows: DataFrame, leaves: int) -> DataFrame:
    return rows.withColumns({"node": F.lit(0).cast("long"), "leaves": F.lit(leaves).cast("long")})


def kd_cuts(rows: DataFrame, dims: list[str], leaves: int) -> tuple[list[DataFrame], DataFrame]:
    """The cuts of each level for stored ``rows``, by which ``assign`` places others, and the rows in their last nodes.

    A node carries its first leaf as its number, so leaves come out as 0 .. leaves - 1.
    """
    span = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first()
    whole = {d: float(span[d] or 0) + 1.0 for d in dims}
    levels: list[DataFrame] = []
    placed = _roots(rows, leaves)
    while 1 << len(levels) < leaves:
        split = placed.where(F.col("leaves") > 1)
        levels.append(_cuts(split, store(_open_nodes(split, dims, whole), "kd-spans"), dims))
        placed = store(_descend(placed, levels[-1], dims), "kd-level")
    return levels, placed


def _descend(placed: DataFrame, cuts: DataFrame, dims: list[str]) -> DataFrame:
    half = F.floor(F.col("leaves") / 2).cast("long")
    joined = placed.join(F.broadcast(cuts), F.col("node") == F.col("cut_node"), "left").withColumn("dim", F.col("cut_dim"))
    stays = F.col("cut_node").isNull()
    goes_left = _key(dims) < F.col("cut")
    return joined.select(
        *[c for c in placed.columns if c not in ("node", "leaves")],
        F.when(stays | goes_left, F.col("node")).otherwise(F.col("node") + half).alias("node"),
        F.when(stays, F.col("leaves")).when(goes_left, half).otherwise(F.col("leaves") - half).alias("leaves"),
    )


def assign(rows: DataFrame, levels: list[DataFrame], dims: list[str], leaves: int) -> DataFrame:
    """``rows`` with ``node``, the number of their leaf."""
    return reduce(lambda placed, cuts: _descend(placed, cuts, dims), levels, _roots(rows, leaves)).drop("leaves")


DIMS = ["d0", "d1", "d2"]


def shard_documents(docs: DataFrame, leaves: int | None = 16, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot, the row's place in its shard."""
    rows = store(metadata(docs, F.col("doc_id")), "kd-rows")
    leaves = leaves or leaves_for(rows, target_bytes)
    _, leaf = kd_cuts(rows, DIMS, leaves)
    placed = leaf.withColumn("shard", F.col("node").cast("int"))
    parts = max(1, -(-rows.count() // SLOT_ROWS))
    numbered = slots(placed, "shard", ["doc_id", "text_crc32", "size"], F.xxhash64("doc_id", "text_crc32") % parts, "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")


def sharded_documents(docs: DataFrame, leaves: int = 16) -> DataFrame:
    """The rows of ``docs`` with their shard in a column of its own; no text is shuffled."""
    levels, _ = kd_cuts(store(metadata(docs), "kd-rows"), DIMS, leaves)
    placed = assign(metadata(docs, carried(docs)), levels, DIMS, leaves)
    name = "shard"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return placed.select("doc.*", F.col("node").cast("int").alias(name))
