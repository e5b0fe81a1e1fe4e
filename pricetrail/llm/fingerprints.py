"""SimHash fingerprints, and all fingerprints within a Hamming radius by permuted block tables.

Every distinct word votes with its weight on each bit: up where the bit of its hash is set, down
where not. A word weighs more the longer it is (the frequent ones are short) and less than
in proportion to its count. The sign of the votes is the fingerprint.

Two fingerprints within radius r differ in at most one bit of some of r // 2 + 1 parts, and so agree in
two of that part's three blocks. Every two blocks of a part are a table, keyed by their bits (permuting them to the
front); fingerprints with equal keys are compared in numpy, a pair counting in its first common table only. Equal
fingerprints are one row with a count. A bucket larger than about ``TILE`` is cut into tiles compared two by
two, so no task holds it whole. ``near_counts`` emits counts only; ``near_copies`` gives the pairs of different
fingerprints and the documents of each.

Defined cases: null text is empty; a text without words has the fingerprint 0; documents of equal
id stand in text order; a null id comes before all others; the only document is its own next one; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import sent, store
from pricetrail.llm.hashing import LETTERED, mix, word_hashes

BITS = 256
#: Near copies at a Jaccard similarity of about 0.8 over five-word shingles lie within RADIUS bits, 99 of 100 of them (README);
#: within COPY_RADIUS only those that differ in hardly a word.
RADIUS, COPY_RADIUS = 27, 7
NEIGHBOURS, TILE, SIZED = 1024, 8192, 16
NO_ID = -(1 << 62)


def fingerprint(text: str) -> np.ndarray:
    """The fingerprint as BITS / 8 bytes."""
    words, lengths = word_hashes(text.encode("utf-8", "replace"), LETTERED)
    if not len(words):
        return np.zeros(BITS // 8, np.uint8)
    distinct, first, counts = np.unique(words, return_index=True, return_counts=True)
    weights = (1.0 + np.log(counts)) * np.minimum(lengths[first], 16)
    lanes = [mix(distinct + np.uint64(0x632BE59BD9B4E019 * (i + 1) & (1 << 64) - 1)) for i in range(BITS // 64)]
    bits = np.unpackbits(np.stack(lanes, axis=1).view(np.uint8), axis=1)
    votes = 2.0 * (weights.astype(np.float32) @ bits.astype(np.float32)) - np.float32(weights.sum())
    return np.packbits(votes > 0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - int(np.unpackbits(a ^ b).sum()) / BITS


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by the beginning of the following document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = (
    "place long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _follow(rows: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "text"], kind="stable")
    texts = list(rows["text"]) + list(guests["text"])
    prints = [fingerprint(t) for t in texts]
    out = []
    for i, doc_id in enumerate(rows["place"]):
        text, following = texts[i], texts[i + 1]
        new = edited(text, following)
        new_print = fingerprint(new)
        out.append((
            doc_id, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(),
            prints[i].tobytes().hex(), new_print.tobytes().hex(),
            likeness(prints[i], new_print), likeness(prints[i], prints[i + 1]),
        ))
    return pd.DataFrame(out, columns=[f.split()[0] for f in FIELDS.split(", ")])


def _next_buckets(places: DataFrame) -> DataFrame:
    """(bucket, first): the place that follows each bucket's last one; after the last comes the first of all.

    Buckets are put in order within groups of NEIGHBOURS and groups among themselves, so a
    task orders at most that many, or one row per NEIGHBOURS**2 documents.
    """
    buckets = places.groupBy("bucket").agg(F.min("place").alias("first"))
    buckets = store(buckets.withColumn("group", F.floor(F.col("bucket") / NEIGHBOURS)), "simhash-buckets")
    groups = buckets.groupBy("group").agg(F.min("first").alias("group_first"))
    all_groups = Window.partitionBy(F.lit(0))
    after = groups.select(
        F.col("group").alias("g"),
        F.coalesce(
            F.lead("group_first").over(all_groups.orderBy("group")), F.min("group_first").over(all_groups)
        ).alias("group_next"),
    )
    inside = F.lead("first").over(Window.partitionBy("group").orderBy("bucket"))
    return (
        buckets.withColumn("inside", inside)
        .join(after, F.col("group") == F.col("g"))
        .select("bucket", F.coalesce("inside", "group_next").alias("next_place"))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text: FIELDS, with doc_id for its place.

    Ids are cut into buckets of NEIGHBOURS neighbouring values. Texts are shuffled by bucket once;
    a bucket also gets the document that follows its last one.
    """
    rows = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(NO_ID)).alias("place"),
    ).withColumn("bucket", F.floor(F.col("place") / NEIGHBOURS))
    wanted = store(_next_buckets(rows.select("place", "bucket")), "simhash-next")
    guests = (
        rows.select("place", "text")
        .join(wanted.select(F.col("bucket"), F.col("next_place")), F.col("place") == F.col("next_place"))
        .groupBy("bucket").agg(F.min("text").alias("text"))
    )
    out = rows.groupBy("bucket").cogroup(guests.groupBy("bucket")).applyInPandas(_follow, FIELDS)
    return out.withColumn("place", F.when(F.col("place") != NO_ID, F.col("place"))).withColumnRenamed("place", "doc_id")


def _masks(radius: int) -> np.ndarray:
    """The bits that each table is keyed by, a row of BITS / 64 words per table.

    The bits are cut into radius // 2 + 1 parts, so that two fingerprints within the radius differ in
    at most one bit of some part; of the part's three blocks two are then equal.
    """
    parts = radius // 2 + 1
    rows = []
    for part in range(parts):
        low, high = part * BITS // parts, (part + 1) * BITS // parts
        for left_out in range(3):
            bits = np.zeros(BITS, np.uint8)
            bits[low:high] = 1
            bits[low + left_out * (high - low) // 3 : low + (left_out + 1) * (high - low) // 3] = 0
            rows.append(np.packbits(bits).view(np.uint64))
    return np.array(rows)


def _words(prints: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint64).reshape(-1, BITS // 64)


def _entries(known: DataFrame, masks: np.ndarray) -> DataFrame:
    """One row per fingerprint and table: key, table, fingerprint, copies."""

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = _words(frame["fingerprint"])
            for table, mask in enumerate(masks):
                key = np.full(len(words), table + 1, np.uint64)
                for word in (words & mask).T:
                    key = mix(key ^ mix(word + np.uint64(1)))
                yield pd.DataFrame({"key": key.view(np.int64), "table": np.full(len(words), table, np.int16), **frame})

    return known.select("fingerprint", "copies").mapInPandas(enter, "key long, table short, fingerprint binary, copies long")


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, ...]]:
    """Fingerprints as bytes and as words, copies, sides and tables of the runs of equal spot in sorted frames, each run whole."""
    rest: pd.DataFrame | None = None

    def cut(frame: pd.DataFrame, edges: np.ndarray):
        prints, words = frame["fingerprint"].to_numpy(), _words(frame["fingerprint"])
        copies, side, table = (frame[c].to_numpy() for c in ("copies", "side", "table"))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > 1:
                yield prints[a:b], words[a:b], copies[a:b], side[a:b], table[a:b]

    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        spots = frame["spot"].to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(spots[1:] != spots[:-1]) + 1))
        yield from cut(frame, edges)
        rest = frame.iloc[edges[-1] :]
    if rest is not None and len(rest) > 1:
        yield from cut(rest, np.array([0, len(rest)]))


def _found(words: np.ndarray, side: np.ndarray, radius: int, masks: np.ndarray, table: np.ndarray):
    """(i, j, bits) of a run's pairs within the radius that no table before the run's has."""
    left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        apart = np.zeros((len(some), len(right)), np.uint16)
        for word in words.T:
            apart += np.bitwise_count(word[some][:, None] ^ word[right][None, :])
        near = apart <= radius
        if not side.any():  # one tile with itself: each pair once
            near &= some[:, None] < right[None, :]
        x, y = np.nonzero(near)
        for cut in range(0, len(x), 1 << 14):
            i, j = some[x[cut : cut + (1 << 14)]], right[y[cut : cut + (1 << 14)]]
            apart_at = (words[i] ^ words[j])[:, None, :]
            first = (~((apart_at & masks[None]) != 0).any(axis=2)).argmax(axis=1)
            own = (first == table[i]) & (first == table[j])
            if own.any():
                yield i[own], j[own], apart[x[cut : cut + (1 << 14)], y[cut : cut + (1 << 14)]][own]


def _met(known: DataFrame, masks: np.ndarray) -> DataFrame:
    """Entries, sorted by the spot where they meet; side is 0 in a tile that meets itself, else -1 or 1.

    Only the number of tiles comes from counts of one fingerprint in SIZED, times SIZED; the rows are all there.
    """
    seen = known.where(F.pmod(F.xxhash64("fingerprint"), F.lit(SIZED)) == 0)
    sizes = _entries(seen, masks).groupBy("key").agg((F.count(F.lit(1)) * SIZED).alias("n")).where(F.col("n") > TILE)
    sizes = store(sizes.select(F.col("key").alias("k"), F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "simhash-sizes")
    tile = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("tiles")).cast("int")
    return (
        _entries(known, masks).join(sent(sizes), F.col("key") == F.col("k"), "left")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            F.when(F.col("tiles") == 1, F.col("key"))
            .otherwise(F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other"))).alias("spot"),
            "table", F.signum(F.col("tile") - F.col("other")).cast("byte").alias("side"), "fingerprint", "copies",
        )
        .repartition("spot").sortWithinPartitions("spot")
    )


def _known(prints: DataFrame) -> DataFrame:
    known = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"))
    return store(known.select(F.unhex("fingerprint").alias("fingerprint"), "copies"), "simhash-known")


def near_counts(prints: DataFrame, radius: int = COPY_RADIUS) -> DataFrame:
    """fingerprint, near: how many other documents lie within the radius, from one row per document.

    ``prints`` has fingerprints as hex in ``fingerprint``; fingerprints without neighbours are left out.
    """
    masks, known = _masks(radius), _known(prints)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for prints, words, copies, side, table in _runs(frames):
            near = np.zeros(len(prints), np.int64)
            for i, j, _ in _found(words, side, radius, masks, table):
                np.add.at(near, i, copies[j])
                np.add.at(near, j, copies[i])
            has = near > 0
            if has.any():
                yield pd.DataFrame({"fingerprint": prints[has], "near": near[has]})

    between = _met(known, masks).mapInPandas(count, "fingerprint binary, near long")
    same = known.where(F.col("copies") > 1).select("fingerprint", (F.col("copies") - 1).alias("near"))
    both = between.unionByName(same).groupBy("fingerprint").agg(F.sum("near").alias("near"))
    return both.select(F.lower(F.hex("fingerprint")).alias("fingerprint"), "near")


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b, bits: every two different fingerprints within the radius, as hex, a before b, each pair once.

    The documents of a fingerprint are the rows of ``prints`` that have it; equal ones are not paired.
    """
    masks, known = _masks(radius), _known(prints)

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for prints, words, _, side, table in _runs(frames):
            for i, j, bits in _found(words, side, radius, masks, table):
                yield pd.DataFrame({"x": prints[i], "y": prints[j], "bits": bits.astype(np.int32)})

    found = _met(known, masks).mapInPandas(pair, "x binary, y binary, bits int")
    x, y = F.lower(F.hex("x")), F.lower(F.hex("y"))
    return found.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "bits")


def near_copies(docs: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """``near_pairs`` of the texts, and the members: doc_id and fingerprint of every row of ``docs``."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "").tobytes().hex() for t in texts], dtype=object)

    members = store(docs.select("doc_id", of("text").alias("fingerprint")), "simhash-members")
    return near_pairs(members, radius), members


def fingerprints(docs: DataFrame) -> DataFrame:
    """``with_next`` and n_near, the other documents within RADIUS bits, for every row of ``docs``."""
    rows = store(with_next(docs), "simhash-rows")
    near = near_counts(rows.select("fingerprint"), RADIUS).withColumnRenamed("fingerprint", "of")
    return rows.join(near, F.col("fingerprint") == F.col("of"), "left").select(
        *rows.columns, F.coalesce("near", F.lit(0).cast("long")).alias("n_near")
    )
