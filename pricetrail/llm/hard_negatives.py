"""Hard negatives of embeddings, from Hilbert-ordered blocks with zone maps.

For an anchor row and each of its positives, the nearest rows of its own label, a window of scores is given by the
positive's score; the best rows of other labels inside the window are the hard negatives. A score is the inner
product of whole-number vectors, so it is exact.

Rows are sorted by label, then by their place on a Hilbert curve through the widest dimensions, and stored in
Parquet as blocks of neighbours. Every block carries a zone map: the least and the greatest value of each dimension, and of the
label. Interval arithmetic over a zone map bounds all scores that an anchor can have in the block, from below and above, and a
block is read for an anchor only if its label can be the wanted one and the bounds meet the anchor's windows. Zone maps
are compared before any vector is fetched. An anchor's own block, which holds its neighbours on the curve,
is looked through while blocks are built: its best positives there are a floor for the search among the others.

Anchors are a query set against all rows, in blocks: CHUNK anchors of neighbouring blocks make a chunk, zone maps are
dealt in pages, and pages meet chunks in stripes, so neither a task nor the driver ever holds all of either. A pair
of chunk and block that passes carries the anchors in need of the block to it. Of each pair only the best few rows per
anchor and window come out; a task keeps the best so far per chunk and sends nothing that is worse.

Defined cases: rows with a null label or vector, or a component that is null or not finite, take no part; a shorter
vector counts as filled up with zeros; a null id is never an anchor, comes after other ids of the same score and is
returned as null; rows of one id are rows each by itself; an anchor without another row of its label, or with a negative score for
its positive, gives no rows (such a window is empty); a score beyond the range of long counts as the end of that range, and
windows are exact for scores below 2^53 / 100. Only the named columns are read, so other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import store

#: Numbers of a block's vectors at most, and its rows; anchors of a chunk; zone maps of a page.
BLOCK_CELLS, BLOCK_ROWS, CHUNK, PAGE = 1 << 18, 1024, 1024, 64
#: Pages of a stripe, and chunks that meet it together.
STRIPE = 16
#: Dimensions of the Hilbert curve, and bits of each.
CURVE_DIMS, CURVE_BITS = 8, 7
#: Best rows that a task keeps before it hands them on.
KEPT_ROWS = 1_000_000
#: Places in a block are counted below this; a key is block * BLOCK_ROWS_MOST + place, block partition * BLOCKS_MOST + number.
BLOCK_ROWS_MOST, BLOCKS_MOST = 1 << 16, 1 << 24
NO_ID = (1 << 63) - 1
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


# Vectors -------------------------------------------------------------------------------------


def packed(vectors: np.ndarray) -> bytes:
    """Whole numbers in the smallest of three formats, its letter first."""
    most = float(np.abs(vectors).max(initial=0))
    kind = "h" if most < 1 << 15 else "i" if most < 1 << 31 else "d"
    return kind.encode() + vectors.astype(f"<{np.dtype(kind).str[1:]}").tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    kind = np.dtype(data[:1].decode()).newbyteorder("<")
    return np.frombuffer(data, kind, offset=1).reshape(rows, -1).astype(np.float64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; in whole numbers of any length where floats cannot hold them."""
    dims = min(left.shape[1], right.shape[1])
    left, right = left[:, :dims], right[:, :dims]
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * dims
    if most < 1 << 24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.float64)
    if most < 1 << 53:
        return left @ right.T
    whole = [[[int(x) for x in row] for row in side] for side in (left, right)]
    out = np.empty((len(left), len(right)), object)
    for i, a in enumerate(whole[0]):
        out[i] = [sum(x * y for x, y in zip(a, b)) for b in whole[1]]
    return out


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score of each anchor in each zone, within the range of long; all vectors of one length."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    ends = products(up, low) + products(down, high), products(up, high) + products(down, low)
    return np.clip(ends[0], LEAST, GREATEST), np.clip(ends[1], LEAST, GREATEST)


def filled(vectors: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, dims - vectors.shape[1]))) if vectors.shape[1] < dims else vectors


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Products, those beyond the range of long at its end."""
    found = products(anchors, rows)
    return np.clip(found, LEAST, GREATEST) if found.dtype == object else found


def best(scores: np.ndarray, ids: np.ndarray, few: int) -> np.ndarray:
    """Places of the ``few`` greatest scores, ties by the smaller id, in that order."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:few], np.int64)
    if len(scores) > 4 * few:
        cut = np.partition(scores, len(scores) - few)[len(scores) - few]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:few]]


# Blocks --------------------------------------------------------------------------------------


def whole_numbers(vectors: Column, scale: float) -> Column:
    """``floor(scale * x)`` of every component as a double that holds a whole number."""
    return F.transform(vectors, lambda x: _floored(F.lit(scale) * x.cast("double")))


def _floored(x: Column) -> Column:
    # Beyond 2^53 a double is whole already, and floor would return a long.
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def taking_part(rows: DataFrame) -> DataFrame:
    """Rows (id, label, vector) with a label and a vector of finite components."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))


def widest_dimensions(rows: DataFrame, how_many: int) -> list[tuple[int, float, float]]:
    """(dimension, low, high) of those with the greatest variance; low and high are two deviations from the mean."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total, squares = np.zeros(0), np.zeros(0), np.zeros(0)
        for frame in frames:
            for vector in frame["vector"]:
                v = np.asarray(vector, np.float64)
                if len(v) > len(n):
                    n, total, squares = (np.pad(x, (0, len(v) - len(x))) for x in (n, total, squares))
                n[: len(v)] += 1
                total[: len(v)] += v
                squares[: len(v)] += v * v
        if len(n):
            yield pd.DataFrame({"dim": np.arange(len(n)), "n": n, "total": total, "squares": squares})

    partial = rows.select("vector").mapInPandas(sums, "dim int, n double, total double, squares double")
    each = partial.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    mean = F.col("total") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0)))
    ranked = each.select("dim", mean.alias("mean"), F.coalesce(spread, F.lit(0.0)).alias("spread"))
    chosen = ranked.orderBy(F.desc("spread"), "dim").limit(how_many).collect()
    return [(r.dim, r["mean"] - 2 * r.spread, r["mean"] + 2 * r.spread) for r in chosen]


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2^bits, one point a row."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_place(vector: Column, dims: list[tuple[int, float, float]], bits: int = CURVE_BITS) -> Column:
    def place(vectors: pd.Series) -> pd.Series:
        if not dims or not len(vectors):
            return pd.Series(np.zeros(len(vectors), np.int64))
        points = np.zeros((len(vectors), len(dims)))
        for row, vector in enumerate(vectors):
            for at, (dim, _, _) in enumerate(dims):
                points[row, at] = vector[dim] if dim < len(vector) else 0.0
        low, high = (np.array([d[i] for d in dims]) for i in (1, 2))
        cells = np.clip((points - low) / np.where(high > low, high - low, 1.0), 0, 1) * ((1 << bits) - 1)
        return pd.Series(hilbert_keys(cells.astype(np.int64), bits))

    return F.pandas_udf(place, "long")(vector)


BLOCK = (
    "block long, rows int, ids binary, labels binary, vectors binary, anchors binary, floors binary, "
    "low binary, high binary, label_low long, label_high long, dims int"
)


def blocks(rows: DataFrame, positives: int, block_rows: int = BLOCK_ROWS, cells: int = BLOCK_CELLS) -> DataFrame:
    """Stored BLOCK rows of neighbours, from (id, label, vector, anchor)."""
    dims = widest_dimensions(rows, CURVE_DIMS)
    placed = rows.withColumn("place", curve_place(F.col("vector"), dims))
    # The id lets the range be cut inside any number of equal vectors.
    sorted_rows = placed.repartitionByRange("label", "place", "id").sortWithinPartitions("label", "place", "id")

    def one(block: int, ids: list, labels: list, vectors: list, marks: list) -> tuple:
        width = max(map(len, vectors), default=0)
        data = np.zeros((len(vectors), max(width, 1)))
        for row, vector in enumerate(vectors):
            data[row, : len(vector)] = vector
        named = np.array(ids, np.int64)
        kinds = np.array(labels, np.int64)
        marked = np.flatnonzero(marks)
        floors = np.full(len(marked), -np.inf)
        scores = scores_of(data[marked], data)
        for at, row in enumerate(marked):
            same = np.flatnonzero(kinds == kinds[row])
            same = same[same != row]
            if len(same) >= positives:
                own = scores[at, same]
                floors[at] = float(own[best(own, named[same], positives)[-1]])
        floors = np.nextafter(floors, -np.inf)
        return (
            block, len(named), named.tobytes(), kinds.tobytes(), packed(data), marked.astype(np.int32).tobytes(), floors.tobytes(),
            data.min(axis=0).tobytes(), data.max(axis=0).tobytes(), int(kinds.min()), int(kinds.max()), data.shape[1],
        )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in BLOCK.split(", ")]
        number = TaskContext.get().partitionId() * BLOCKS_MOST
        held: tuple[list, list, list, list] = ([], [], [], [])
        filled_cells = 0
        for frame in frames:
            for row in zip(frame["id"], frame["label"], frame["vector"], frame["anchor"]):
                if held[0] and (len(held[0]) >= block_rows or filled_cells + len(row[2]) > cells):
                    yield pd.DataFrame([one(number, *held)], columns=names)
                    number, filled_cells, held = number + 1, 0, ([], [], [], [])
                for part, value in zip(held, row):
                    part.append(value)
                filled_cells += len(row[2])
        if held[0]:
            yield pd.DataFrame([one(number, *held)], columns=names)

    return store(sorted_rows.select("id", "label", "vector", "anchor").mapInPandas(cut, BLOCK), "negatives-blocks")


# Anchors -------------------------------------------------------------------------------------

#: keys tell anchors apart: their block and place. lows and highs: the windows, ``windows`` of them per anchor.
CHUNKS = "chunk long, rows int, keys binary, ids binary, labels binary, vectors binary, lows binary, highs binary"


def anchor_rows(stored: DataFrame) -> DataFrame:
    """Stored (key, id, label, vector, floor) of every anchor, from blocks."""

    def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples():
                marked = np.frombuffer(b.anchors, np.int32).astype(np.int64)
                if len(marked):
                    vectors = unpacked(b.vectors, b.rows)[marked]
                    yield pd.DataFrame({
                        "key": b.block * BLOCK_ROWS_MOST + marked, "id": np.frombuffer(b.ids, np.int64)[marked],
                        "label": np.frombuffer(b.labels, np.int64)[marked], "vector": [packed(v[None, :]) for v in vectors],
                        "floor": np.frombuffer(b.floors, np.float64),
                    })

    with_anchors = stored.where(F.octet_length("anchors") > 0).select("block", "rows", "ids", "labels", "vectors", "anchors", "floors")
    return store(with_anchors.mapInPandas(take, "key long, id long, label long, vector binary, floor double"), "negatives-anchors")


def chunks(anchors: DataFrame, chunk: int) -> DataFrame:
    """Stored CHUNKS of neighbouring anchors, from (key, id, label, vector, lows, highs)."""

    def one(number: int, rows: list) -> pd.DataFrame:
        vectors = [unpacked(r[3], 1) for r in rows]
        dims = max(v.shape[1] for v in vectors)
        columns = list(zip(*rows))
        return pd.DataFrame([(
            number, len(rows), *[np.array(c, np.int64).tobytes() for c in columns[:3]],
            packed(np.concatenate([filled(v, dims) for v in vectors])),
            *[np.array(list(map(list, c)), np.float64).tobytes() for c in columns[4:]],
        )], columns=[c.split()[0] for c in CHUNKS.split(", ")])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId() * BLOCKS_MOST, []
        for frame in frames:
            for row in zip(*(frame[c] for c in ("key", "id", "label", "vector", "lows", "highs"))):
                held.append(row)
                if len(held) == chunk:
                    yield one(number, held)
                    number, held = number + 1, []
        if held:
            yield one(number, held)

    parts = max(1, -(-anchors.count() // (4 * chunk)))
    near = anchors.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return store(near.mapInPandas(cut, CHUNKS), "negatives-chunks")


# Zone maps -----------------------------------------------------------------------------------


def pages(stored: DataFrame, page: int) -> DataFrame:
    """Stored zone maps, ``page`` of them a row: no vector is read."""

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId() * BLOCKS_MOST, []

        def one() -> pd.DataFrame:
            dims = max(z.dims for z in held)
            low, high = (
                np.concatenate([filled(np.frombuffer(side, np.float64)[None, :], dims) for side in sides])
                for sides in ([z.low for z in held], [z.high for z in held])
            )
            # A zone of fewer dimensions holds zeros in the others.
            whole = [np.array([getattr(z, c) for z in held], np.int64).tobytes() for c in ("block", "label_low", "label_high")]
            return pd.DataFrame([(number, len(held), *whole, low.tobytes(), high.tobytes())], columns=names)

        names = ["page", "zones", "blocks", "label_lows", "label_highs", "lows_of", "highs_of"]
        for frame in frames:
            for zone in frame.itertuples():
                held.append(zone)
                if len(held) == page:
                    yield one()
                    number, held = number + 1, []
        if held:
            yield one()

    zones = stored.select("block", "low", "high", "label_low", "label_high", "dims")
    schema = "page long, zones int, blocks binary, label_lows binary, label_highs binary, lows_of binary, highs_of binary"
    return store(zones.mapInPandas(gather, schema), "negatives-pages")


NEED = "block_of long, chunk long, rows int, keys binary, ids binary, labels binary, vectors binary, lows binary, highs binary"


def needed(zones: DataFrame, anchors: DataFrame, same_label: bool) -> DataFrame:
    """NEED rows: for a block and a chunk the anchors whose windows the block's bounds meet.

    Pages and chunks are dealt to stripes and groups of STRIPE, and each page meets each chunk once.
    """
    stripes, groups = (max(1, -(-df.count() // STRIPE)) for df in (zones, anchors))

    def dealt(df: DataFrame, name: str, own: str, own_parts: int, other: str, other_parts: int) -> DataFrame:
        mine = F.pmod(F.xxhash64(name), F.lit(own_parts)).cast("int").alias(own)
        return df.select("*", mine, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))).alias(other))

    left = dealt(zones, "page", "stripe", stripes, "group", groups)
    right = dealt(anchors, "chunk", "group", groups, "stripe", stripes)

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in NEED.split(", ")]
        for frame in frames:
            for r in frame.itertuples():
                vectors = unpacked(r.vectors, r.rows)
                keys, ids, labels = (np.frombuffer(x, np.int64) for x in (r.keys, r.ids, r.labels))
                lows, highs = (np.frombuffer(x, np.float64).reshape(r.rows, -1) for x in (r.lows, r.highs))
                low, high = (np.frombuffer(x, np.float64).reshape(r.zones, -1) for x in (r.lows_of, r.highs_of))
                dims = max(low.shape[1], vectors.shape[1])
                least, most = bounds(filled(vectors, dims), filled(low, dims), filled(high, dims))
                first, last = (np.frombuffer(x, np.int64) for x in (r.label_lows, r.label_highs))
                inside = (labels[:, None] >= first) & (labels[:, None] <= last)
                can = inside if same_label else ~(inside & (first == last))
                meets = np.zeros(can.shape, bool)
                for w in range(lows.shape[1]):
                    meets |= ((most >= lows[:, w, None]) & (least <= highs[:, w, None])).astype(bool)
                needs = can & meets
                for at, block in enumerate(np.frombuffer(r.blocks, np.int64)):
                    own = np.flatnonzero(needs[:, at])
                    if len(own):
                        yield pd.DataFrame([(
                            block, r.chunk, len(own), keys[own].tobytes(), ids[own].tobytes(), labels[own].tobytes(),
                            packed(vectors[own]), lows[own].tobytes(), highs[own].tobytes(),
                        )], columns=names)

    return left.join(right, ["stripe", "group"]).drop("stripe", "group").mapInPandas(choose, NEED)


FOUND = "key long, anchor_id long, window int, id long, score long"


def searched(stored: DataFrame, need: DataFrame, same_label: bool, few: int) -> DataFrame:
    """FOUND rows: per anchor and window the ``few`` best rows of each task, those of the whole table among them."""
    data = stored.select("block", F.col("rows").alias("n"), F.col("ids").alias("row_ids"), F.col("labels").alias("row_labels"), F.col("vectors").alias("row_vectors"))
    met = need.join(data, F.col("block_of") == F.col("block")).drop("block_of")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pd.DataFrame]:
            if kept:
                sizes = [len(ids) for _, ids, _ in kept.values()]
                yield pd.DataFrame({
                    "key": np.repeat(np.array([k for k, _ in kept], np.int64), sizes),
                    "anchor_id": np.repeat(np.array([a for a, _, _ in kept.values()], np.int64), sizes),
                    "window": np.repeat(np.array([w for _, w in kept], np.int32), sizes),
                    "id": np.concatenate([ids for _, ids, _ in kept.values()]),
                    "score": np.concatenate([scores for _, _, scores in kept.values()]).astype(np.int64),
                })

        for frame in frames:
            for r in frame.itertuples():
                vectors, rows = unpacked(r.vectors, r.rows), unpacked(r.row_vectors, r.n)
                keys, ids, labels = (np.frombuffer(x, np.int64) for x in (r.keys, r.ids, r.labels))
                row_ids, row_labels = (np.frombuffer(x, np.int64) for x in (r.row_ids, r.row_labels))
                lows, highs = (np.frombuffer(x, np.float64).reshape(r.rows, -1) for x in (r.lows, r.highs))
                scores = scores_of(vectors, rows)
                wanted = (labels[:, None] == row_labels) == same_label
                for i in np.flatnonzero(keys // BLOCK_ROWS_MOST == r.block):
                    wanted[i, keys[i] % BLOCK_ROWS_MOST] = False
                for w in range(lows.shape[1]):
                    had = [kept.get((k, w)) for k in keys.tolist()]
                    # Once an anchor has its few, only what is as good as the last of them counts.
                    least = np.array([h[2][-1] if h and len(h[1]) == few else low for h, low in zip(had, lows[:, w])])
                    fits = (wanted & (scores >= least[:, None]) & (scores <= highs[:, w, None])).astype(bool)
                    for i in np.flatnonzero(fits.any(axis=1)):
                        at = np.flatnonzero(fits[i])
                        some_ids, some = row_ids[at], scores[i, at]
                        if had[i]:
                            some_ids, some = np.concatenate((had[i][1], some_ids)), np.concatenate((had[i][2], some))
                        pick = best(some, some_ids, few)
                        held += len(pick) - (len(had[i][1]) if had[i] else 0)
                        kept[int(keys[i]), w] = (int(ids[i]), some_ids[pick], some[pick])
                if held > KEPT_ROWS:
                    yield from out()
                    kept.clear()
                    held = 0
        yield from out()

    return met.mapInPandas(search, FOUND)


def first_few(found: DataFrame, few: int) -> DataFrame:
    """The best ``few`` rows of each anchor and window, with their ``place`` from 1."""
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= few)


# The operator --------------------------------------------------------------------------------


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100,
    block_rows: int = BLOCK_ROWS, chunk: int = CHUNK, page: int = PAGE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has id (long), label (long) and vector (whole numbers as doubles); ``anchor`` says which of its rows are anchors.
    A negative's score lies between ``low_percent`` and ``high_percent`` of the positive's.
    """
    if not 0 < block_rows <= BLOCK_ROWS_MOST:
        raise ValueError(f"a block has 1 to {BLOCK_ROWS_MOST} rows")
    ready = taking_part(rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce(anchor & F.col("id").isNotNull(), F.lit(False)).alias("anchor")))
    ready = ready.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    stored = blocks(ready, positives, block_rows)
    zones = pages(stored, page)
    anchors = anchor_rows(stored)
    open_end = F.array(F.lit(float("inf")))
    seeking = chunks(anchors.select("key", "id", "label", "vector", F.array("floor").alias("lows"), open_end.alias("highs")), chunk)
    near = first_few(searched(stored, needed(zones, seeking, True), True, positives), positives)
    near = store(near.select("key", "anchor_id", F.col("place").alias("place"), "id", "score"), "negatives-positives")
    # The windows of an anchor: the positives' scores times low and high, those that can hold anything.
    low, high = F.lit(low_percent) * F.col("score").cast("double") / 100, F.lit(high_percent) * F.col("score").cast("double") / 100
    sides = F.array_sort(F.collect_list(F.struct("place", low.alias("low"), high.alias("high"))))
    windows = near.groupBy("key").agg(sides.alias("w")).where(F.exists("w", lambda w: w["low"] <= w["high"]))

    def side(name: str, missing: float) -> Column:
        every = F.sequence(F.lit(1), F.lit(positives))
        return F.transform(every, lambda i: F.coalesce(F.get(F.filter("w", lambda w: w["place"] == i), 0)[name], F.lit(missing)))

    asked = anchors.join(windows.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select(
        "key", "id", "label", "vector", side("low", float("inf")).alias("lows"), side("high", float("-inf")).alias("highs")
    )
    looking = chunks(store(asked, "negatives-windows"), chunk)
    hard = first_few(searched(stored, needed(zones, looking, False), False, negatives), negatives)
    hard = hard.select(F.col("key").alias("k"), (F.col("window") + 1).alias("p"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("place").alias("rank"))

    def named(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(c)

    joined = near.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}).join(hard, (F.col("key") == F.col("k")) & (F.col("place") == F.col("p")))
    return joined.select("anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"), named("negative_id"), "positive_score", "negative_score")


def relabelled(vec_id: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """The label of the registered query: one further for every ``every``-th id, as if labelled wrongly."""
    return F.when(vec_id % every == 0, (label + 1) % labels).otherwise(label)


def mined(embeddings: DataFrame, scale: float = 256.0, anchors_each: int = 100) -> DataFrame:
    """``hard_negatives`` of (vec_id, embedding, label), every ``anchors_each``-th id an anchor."""
    label = F.col("label").cast("long")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"),
        F.coalesce(relabelled(F.col("vec_id").cast("long"), label), label).alias("label"),
        whole_numbers(F.col("embedding"), scale).alias("vector"),
    )
    return hard_negatives(rows, F.col("id") % anchors_each == 0)
