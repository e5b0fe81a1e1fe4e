"""Documents joined by the Jaccard similarity of their word shingles: a grouped prefix join.

Two sets with Jaccard of at least t share a member of their prefixes, the first n - ceil(t n) + 1
members in any fixed order. The order here puts rare shingles first: by the least count among a shingle's own and its words',
then by the rarity of all its words, then by hash. Words and shingles are counted in counters of a fixed number, so that
these can be sent everywhere. A corpus has far more shingles than counters, so each of them is a crowd of
strangers; its words are few enough to be told apart, and no shingle is more frequent than its rarest word. A shingle that thousands
of documents share thus stands in nobody's prefix unless the documents are made of such, and unrelated documents seldom meet.

Equal sets are one. Sets with the same prefix and size are one group, and only groups meet in the join on
prefix members; pairs of groups go on if their sizes fit, and expand to their members. Members go on if
their parity sketches differ in no more bits than their sets may differ in members, which
loses none, and are then compared in full.

``links`` gives every link between different sets and the members of each set, ``linked`` the number of links per row.
``classes`` is a shortcut for when only components are asked for and a cluster of thousands of near copies must not become
pairs of all with all: before the join each set is linked with its nearest one among those with an equal
min-hash, a few times over; the join leaves out pairs that these verified links already connect. It still looks at every other pair that the prefixes allow, so no component is missed.
Only texts of sets that share anything with another one are compared, compressed until then.

Defined cases: null text and text without words has no shingles and is linked with nothing; a document with
fewer words than a shingle has one of all its words; rows of equal doc_id are one document, linked
by any of its texts; rows without doc_id are linked with nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import carried, sent, store
from pricetrail.llm.components import components
from pricetrail.llm.hashing import SPACED, mix, runs, shingles, word_hashes

#: Counters of words, and as many of shingles, for the order of shingles; how many travel in a row; steps to a doubled count.
COUNTERS, COUNTER_ROW, LEVELS = 1 << 22, 1 << 14, 7
#: Bits of a parity sketch; min-hashes of a set; sets compared with each other in one task at most.
PARITY_BITS, MIN_HASHES, TILE = 1024, 3, 4096
WORDS64 = PARITY_BITS // 64
#: Sets of more members than LONG fill those bits up, so they have a longer sketch as well.
LONG, LONG_BITS = 1500, 1 << 14
#: How often sets are linked with their nearest ones before the join; it has less to do after each.
NEAR_ROUNDS = 2
#: Runs of so many units are compared together with others; so many pairs at a time.
SHORT_RUN, PAIRS_AT_ONCE = 64, 1 << 15
#: Stands for a null doc_id, which pandas would turn all ids into floats for.
NO_ID = -(1 << 63)


def _words(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode("utf-8", "replace"), SPACED)[0]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return shingles(_words(text), size)


def _slot(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def rarity(docs: DataFrame, size: int) -> np.ndarray:
    """Two rows of levels, of the counters that words and shingles fell to: LEVELS more for every doubled count."""
    counted, per_row, steps = COUNTERS, min(COUNTERS, COUNTER_ROW), LEVELS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros((2, counted), np.uint32)
        for frame in frames:
            for at in range(0, len(frame), 2048):
                words = [_words(t) for t in frame["text"].iloc[at : at + 2048]]
                for total, found in zip(counters, (words, [shingles(w, size) for w in words])):
                    total += np.bincount(_slot(np.concatenate(found), counted), minlength=counted).astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=1).compress
        for row, part in enumerate(counters.reshape(-1, per_row)):
            if part.any():
                # Lowest bytes together, then the next: most counts have one.
                planes = part.astype("<u4").view(np.uint8).reshape(-1, 4).T
                yield pd.DataFrame({"row": [row], "counts": [pack(planes.tobytes())]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(per_row, np.uint64)
        for counts in group["counts"]:
            planes = np.frombuffer(unpack(counts), np.uint8).reshape(4, -1)
            total += np.ascontiguousarray(planes.T).view("<u4").ravel()
        levels = np.minimum(steps * np.log2(total + 1.0), 255).astype(np.uint8)
        packed = zstandard.ZstdCompressor(level=1).compress(levels.tobytes())
        return pd.DataFrame({"row": group["row"].iloc[:1], "counts": [packed]})

    schema = "row long, counts binary"
    summed = docs.select("text").mapInPandas(count, schema).groupBy("row").applyInPandas(add, schema)
    out = np.zeros((2, counted), np.uint8)
    rows = out.reshape(-1, per_row)
    for row, levels in summed.collect():
        rows[row] = np.frombuffer(zstandard.ZstdDecompressor().decompress(levels), np.uint8)
    return out


def rare_first(words: np.ndarray, size: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's set and the places of its members in the order of rarity. Equal shingles have equal words, so the order is one for all."""
    made = runs(words, size)
    found, at = np.unique(made, return_index=True)
    of_words = levels[0][_slot(words, levels.shape[1])].astype(np.int64)
    beside = [of_words[i : i + len(made)] for i in range(min(size, len(words)))]
    least = np.minimum(np.minimum.reduce(beside)[at], levels[1][_slot(found, levels.shape[1])])
    return found, np.argsort(least * (256 * size) + np.sum(beside, axis=0)[at], kind="stable")


def _parity(found: np.ndarray, bits: int) -> bytes:
    """For each of ``bits`` classes of hashes whether the set has an odd number of them."""
    of = (mix(found) >> np.uint64(65 - bits.bit_length())).astype(np.int64)
    return np.packbits(np.bincount(of, minlength=bits).astype(np.uint8) & 1).tobytes()


def least_overlap(total: np.ndarray | int, percent: int):
    """Shared members that two sets with ``total`` members between them need."""
    return -(-percent * total // (100 + percent))


PROFILE = "doc long, n long, digest binary, prefix array<long>, group binary, parity binary, wide binary, mins array<long>"


def profiles(docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """PROFILE of every row: its set's size and digest, prefix, group, sketch and min-hashes."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # 2 * COUNTERS bytes, whatever the input

    def one(text: str | None) -> tuple:
        words = _words(text)
        if not len(words):
            return 0, None, None, None, None, None, None
        found, order = rare_first(words, size, sent.value)
        n = len(found)
        prefix = found[order[: n - (percent * n + 99) // 100 + 1]]
        tie = blake2b(np.sort(prefix).tobytes() + n.to_bytes(8, "little"), digest_size=16).digest()
        parity = _parity(found, PARITY_BITS)
        wide = _parity(found, LONG_BITS) if n > LONG else None
        mins = [int(mix(found ^ np.uint64(i + 1)).min().view(np.int64)) for i in range(MIN_HASHES)]
        digest = blake2b(found.tobytes(), digest_size=16).digest()
        return n, digest, prefix.view(np.int64).tolist(), tie, parity, wide, mins

    def profile(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n", "digest", "prefix", "group", "parity", "wide", "mins"]
        for frame in frames:
            for at in range(0, len(frame), 512):
                some = frame.iloc[at : at + 512]
                table = pd.DataFrame([one(t) for t in some["text"]], columns=names)
                table.insert(0, "doc", some["doc"].array)
                yield table

    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text").mapInPandas(profile, PROFILE)


def _runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The runs of equal ``key`` in sorted frames, each whole."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        keys = frame[key].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1)) if len(keys) else np.zeros(1, int)
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a > 1:
                yield frame.iloc[a:b]
        rest = frame.iloc[starts[-1] :]
    if rest is not None and len(rest) > 1:
        yield rest


def _whole_runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Sorted frames, cut anew so that none ends inside a run of equal ``key``."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if len(frame):
            keys = frame[key].to_numpy()
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                yield frame.iloc[:last]
            rest = frame.iloc[last:]
    if rest is not None and len(rest):
        yield rest


def _far(sketch: np.ndarray, rows: slice | np.ndarray, others: slice | np.ndarray) -> np.ndarray:
    """Differing bits of the sketches of some rows and others."""
    left, right = sketch[rows], sketch[others]
    apart = np.zeros((len(left), len(right)), np.int32)
    for a, b in zip(left.T, right.T):
        apart += np.bitwise_count(a[:, None] ^ b[None, :])
    return apart


def _most_apart(total: np.ndarray, percent: int) -> np.ndarray:
    """Members that one of two linked sets may have and the other not, from the sum of their sizes."""
    return total - 2 * least_overlap(total, percent)


def _apart_enough(x: bytes | None, y: bytes | None, bound: int) -> bool:
    """Whether the long sketches of two sets, where both have one, show that they are not linked."""
    if x is None or y is None:
        return False
    return int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum()) > bound


def nearest(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): each set with its nearest one of another component among those of an equal min-hash.

    ``sets`` has doc, component, n, parity, mins. A bucket larger than TILE is dealt to tiles at random, other
    tiles for each min-hash.
    """
    keyed = sets.select("doc", "component", F.posexplode("mins").alias("i", "min")).select(
        "doc", "component", "i", F.xxhash64("i", "min").alias("bucket")
    )
    sizes = keyed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where(F.col("low") < F.col("high"))
    sizes = sizes.select(F.col("bucket").alias("of"), F.ceil(F.col("rows") / TILE).alias("tiles"))
    # Sketches join what is left: sets with company.
    dealt = keyed.join(sizes, F.col("bucket") == F.col("of")).select(
        F.xxhash64("bucket", F.pmod(F.xxhash64("doc", "i"), F.col("tiles"))).alias("key"), F.col("doc").alias("owner")
    )
    dealt = dealt.join(sets.select("doc", "component", "n", "parity", "wide"), F.col("owner") == F.col("doc")).drop("owner")

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(frames, "key"):
            doc, n, of = (run[c].to_numpy() for c in ("doc", "n", "component"))
            sketch = np.frombuffer(b"".join(run["parity"]), np.uint64).reshape(len(run), WORDS64)
            best = np.full(len(run), -1)
            for at in range(0, len(run), 256):
                some = slice(at, min(at + 256, len(run)))
                apart = _far(sketch, some, slice(None))
                total = n[some, None] + n[None, :]
                fits = (apart <= _most_apart(total, percent)) & (of[some, None] != of[None, :])
                apart[~fits] = PARITY_BITS + 1
                pick = apart.argmin(axis=1)
                best[some] = np.where(fits[np.arange(len(pick)), pick], pick, -1)
            wide = run["wide"].to_numpy()
            has = np.array([
                i for i in np.flatnonzero(best >= 0)
                if not _apart_enough(wide[i], wide[best[i]], int(_most_apart(n[i] + n[best[i]], percent)))
            ], np.int64)
            if len(has):
                yield pd.DataFrame({"a": np.minimum(doc[has], doc[best[has]]), "b": np.maximum(doc[has], doc[best[has]])})

    sorted_runs = dealt.repartition("key").sortWithinPartitions("key")
    return sorted_runs.mapInPandas(link, "a long, b long").distinct()


def shared_tokens(groups: DataFrame, percent: int) -> DataFrame:
    """Stored (token, gid): prefix members that a group shares with one of a size it may be linked with, from (gid, n, prefix).

    The first member in order that two linked sets share is among the first n - o + 1 of the smaller one, o being the
    overlap that two sets of its size n need; those members are its lead. Entries of a token follow each other by size, so an entry
    has company if the last lead before it is large enough for it, or if it is a lead and the next one is small enough.
    """
    leads = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + 1
    entries = groups.select("gid", "n", leads.alias("leads"), F.posexplode("prefix").alias("at", "token"))
    # One number for both, as all of these are shuffled: the size, below zero where the member is no lead.
    entries = entries.select("token", "gid", F.when(F.col("at") < F.col("leads"), F.col("n")).otherwise(-F.col("n")).alias("size"))
    n, lead = F.abs("size"), F.when(F.col("size") > 0, F.col("size"))
    by_size = Window.partitionBy("token").orderBy(n, "gid")
    before = F.max(lead).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    after = F.lead(n).over(by_size)
    met = entries.withColumns({"before": before, "after": after}).where(
        (F.col("before") * 100 >= n * percent) | (lead * 100 >= F.col("after") * percent)
    )
    return store(met.select("token", "gid"), "jaccard-tokens")


def _differing_bits(a: str, b: str) -> Column:
    """Differing bits of two binary columns, 48 at a time: one short expression, which plans hold and rewrite many times."""
    def part(name: str, i: Column) -> Column:
        return F.conv(F.hex(F.substring(name, i, F.lit(6))), 16, 10).cast("long")

    places = F.sequence(F.lit(1), F.lit(PARITY_BITS // 8), F.lit(6))
    return F.aggregate(places, F.lit(0), lambda bits, i: bits + F.bit_count(part(a, i).bitwiseXOR(part(b, i))))


def group_pairs(sets: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of all sets of different components that prefixes, sizes and sketches let through.

    ``sets`` has doc, gid, component, n, parity; a unit is a group's sets of one component, told by its
    first set's sketch and how far the others' are from it. Buckets larger than TILE are compared
    tile by tile.
    """
    heads = sets.groupBy("gid", "component").agg(
        F.min("doc").alias("head"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    first = sets.groupBy(F.col("doc").alias("head_doc")).agg(F.min("parity").alias("sketch"))
    heads = heads.join(first, F.col("head") == F.col("head_doc")).drop("head_doc")
    others = sets.select(F.col("gid").alias("g"), F.col("component").alias("c"), "parity").join(
        heads, (F.col("g") == F.col("gid")) & (F.col("c") == F.col("component")) & (F.col("parity") != F.col("sketch"))
    )
    reach = others.groupBy(F.col("head").alias("of")).agg(F.max(_differing_bits("parity", "sketch")).alias("reach"))
    units = store(
        heads.join(reach, F.col("head") == F.col("of"), "left").drop("of").withColumn("reach", F.coalesce("reach", F.lit(0))),
        "jaccard-units",
    )
    named = tokens.select("token", F.col("gid").alias("g")).join(
        units.select("gid", "component", "head"), F.col("g") == F.col("gid")
    ).select("token", "component", "head")
    mixed = named.groupBy("token").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where(F.col("low") < F.col("high"))
    mixed = mixed.select(F.col("token").alias("t"), F.ceil(F.col("rows") / TILE).cast("int").alias("tiles"))
    tiled = (
        named.join(mixed, F.col("token") == F.col("t"))
        .withColumn("tile", F.pmod(F.xxhash64("head"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            F.xxhash64("token", F.least("tile", "other"), F.greatest("tile", "other")).alias("key"),
            F.col("head").alias("owner"), (F.col("tile") > F.col("other")).alias("second"),
            (F.col("tile") == F.col("other")).alias("alone"),
        )
    )
    dealt = tiled.join(units, F.col("owner") == F.col("head")).select(
        "key", "second", "alone", "head", "component", "least", "most", "sketch", "reach"
    )

    def fitting(i: np.ndarray, j: np.ndarray, of: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        """Pairs of units, by their places, that sizes and sketches let through."""
        least, most, reach = of["least"], of["most"], of["reach"]
        met = of["alone"][i] | (of["second"][i] != of["second"][j])
        met &= of["component"][i] != of["component"][j]
        met &= (most[i] * 100 >= least[j] * percent) & (most[j] * 100 >= least[i] * percent)
        i, j = i[met], j[met]
        apart = np.bitwise_count(of["sketch"][i] ^ of["sketch"][j]).sum(axis=1, dtype=np.int64)
        near = apart <= _most_apart(most[i] + most[j], percent) + reach[i] + reach[j]
        a, b = of["head"][i[near]], of["head"][j[near]]
        if len(a):
            yield pd.DataFrame({"head_a": np.minimum(a, b), "head_b": np.maximum(a, b)}).drop_duplicates()

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _whole_runs(frames, "key"):
            of = {c: batch[c].to_numpy() for c in ("head", "least", "most", "component", "reach", "alone", "second")}
            of["sketch"] = np.frombuffer(b"".join(batch["sketch"]), np.uint64).reshape(len(batch), WORDS64)
            keys = batch["key"].to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
            lengths = np.diff(np.append(starts, len(keys)))
            # All pairs of all short runs at once, by their distance; long runs a stretch at a time.
            length_of = np.repeat(lengths, lengths)
            for d in range(1, min(SHORT_RUN, int(lengths.max()))):
                i = np.flatnonzero((keys[:-d] == keys[d:]) & (length_of[:-d] <= SHORT_RUN))
                for at in range(0, len(i), PAIRS_AT_ONCE):
                    some = i[at : at + PAIRS_AT_ONCE]
                    yield from fitting(some, some + d, of)
            for start, length in zip(starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist()):
                whole = np.arange(start, start + length)
                rows = max(1, PAIRS_AT_ONCE // length)
                for at in range(0, length, rows):
                    i = np.repeat(whole[at : at + rows], length)
                    j = np.tile(whole, len(i) // length)
                    yield from fitting(i[i < j], j[i < j], of)

    across = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(compare, "head_a long, head_b long").distinct()
    split = units.groupBy("gid").agg(F.min("head").alias("low"), F.max("head").alias("high")).where(F.col("low") < F.col("high"))
    split = split.select(F.col("gid").alias("g")).join(units.select("gid", "head"), F.col("g") == F.col("gid")).select("g", "head")
    within = split.withColumnRenamed("head", "head_a").join(
        split.select(F.col("g").alias("h"), F.col("head").alias("head_b")),
        (F.col("g") == F.col("h")) & (F.col("head_a") < F.col("head_b")),
    ).select("head_a", "head_b")
    pairs = store(across.unionByName(within).distinct(), "jaccard-groups")
    members = sets.select(F.col("gid").alias("g"), F.col("component").alias("c"), "doc", "n", "parity", "wide").join(
        units.select("gid", "component", "head"), (F.col("g") == F.col("gid")) & (F.col("c") == F.col("component"))
    ).select("head", "doc", "n", "parity", "wide")

    def side(name: str) -> DataFrame:
        return members.select(*[F.col(c).alias(f"{c}_{name}") for c in members.columns])

    expanded = pairs.withColumnsRenamed({"head_a": "x", "head_b": "y"}).join(
        side("a"), F.col("x") == F.col("head_a")).join(side("b"), F.col("y") == F.col("head_b"))
    total = F.col("n_a") + F.col("n_b")
    bound = total - 2 * F.ceil(F.lit(percent) * total / F.lit(100 + percent))
    close = expanded.where(_differing_bits("parity_a", "parity_b") <= bound).select(
        F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"), bound.alias("most"), "wide_a", "wide_b"
    ).where(F.col("a") < F.col("b"))

    def long_sketches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            close = [not _apart_enough(x, y, m) for x, y, m in zip(frame["wide_a"], frame["wide_b"], frame["most"])]
            yield frame.loc[np.array(close, bool), ["a", "b"]]

    return close.mapInPandas(long_sketches, "a long, b long").distinct()


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (doc, packed): the compressed texts of the wanted documents (w)."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for frame in frames:
            packed = [compress((t or "").encode("utf-8", "replace")) for t in frame["text"]]
            yield pd.DataFrame({"doc": frame["doc_id"].array, "packed": packed})

    texts = docs.select("doc_id", "text").join(sent(wanted), F.col("doc_id") == F.col("w")).select("doc_id", "text")
    return store(texts.mapInPandas(pack, "doc long, packed binary"), "jaccard-texts")


def verified(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored pairs (a, b) of documents whose shingle sets are similar enough, compared in full.

    Each pair asks for its two texts; what is shuffled are the texts asked for, by pair.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("w"), "a", "b")
    found = texts.join(sent(store(asked, "jaccard-asked")), F.col("doc") == F.col("w"))
    met = found.select(F.xxhash64("a", "b").alias("key"), "a", "b", "doc", "packed")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for run in _runs(frames, "key"):
            sets: dict[tuple[int, int], dict[int, list[np.ndarray]]] = {}
            for a, b, doc, packed in zip(run["a"], run["b"], run["doc"], run["packed"]):
                own = sets.setdefault((a, b), {}).setdefault(doc, [])
                own.append(shingle_set(unpack(packed).decode("utf-8"), size))
            good = [
                (a, b) for (a, b), own in sets.items()
                if any(_linked(x, y, percent) for x in own.get(a, []) for y in own.get(b, []))
            ]
            if good:
                yield pd.DataFrame(good, columns=["a", "b"])

    runs = met.repartition("key").sortWithinPartitions("key")
    return store(runs.mapInPandas(compare, "a long, b long"), "jaccard-links")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(x) + len(y) - len(np.union1d(x, y))
    return bool(both) and both >= least_overlap(len(x) + len(y), percent)


def _prepared(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored profiles of all rows; those that hold a set; heads of equal sets; prefix members of several groups;
    the sets that may have links at all; their texts."""
    rows = store(profiles(docs, size, percent, rarity(docs, size)), "jaccard-profiles")
    held = rows.where((F.col("n") > 0) & (F.col("doc") != NO_ID))
    heads = held.groupBy("digest").agg(F.min("doc").alias("head"), F.min("group").alias("group"))
    groups = heads.groupBy("group").agg(F.min("head").alias("gid"), F.count(F.lit(1)).alias("members"))
    heads = heads.join(groups.withColumnRenamed("group", "g"), F.col("group") == F.col("g"))
    heads = store(heads.select(F.col("digest").alias("of"), "head", "gid", "members"), "jaccard-heads")
    own = (F.col("digest") == F.col("of")) & (F.col("doc") == F.col("head"))
    sets = held.join(heads, own).dropDuplicates(["doc", "digest"])
    sets = store(sets.select("doc", "gid", "members", "n", "prefix", "parity", "wide", "mins"), "jaccard-sets")
    tokens = shared_tokens(sets.where(F.col("doc") == F.col("gid")).select("gid", "n", "prefix"), percent)
    # Only sets of a group with company, or a prefix member shared with one of a fitting size, can be linked at all.
    met = tokens.select(F.col("gid").alias("g")).distinct()
    alive = sets.join(met, F.col("gid") == F.col("g"), "left").where(F.col("g").isNotNull() | (F.col("members") > 1))
    alive = store(alive.select("doc", "gid", "n", "parity", "wide", "mins"), "jaccard-alive")
    texts = packed_texts(docs, store(alive.select(F.col("doc").alias("w")).distinct(), "jaccard-wanted"))
    return rows, held, heads, tokens, alive, texts


def by_row(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of id and text that tells different texts of one id apart; text; and the id itself as own_id."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", F.col("doc_id").alias("own_id"))


def links(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links, in two stored tables.

    Pairs (a, b) hold every two different shingle sets that are similar enough, each set named by the least row key of
    those that have it; members (doc_id, row, n_shingles, head) name the set of every row of ``docs``, a null head
    being no set. Rows with equal sets are linked through their common head.
    No pair is left out for being connected already, so a family of n different near copies has up to n * n / 2 pairs.
    """
    keyed = by_row(docs)
    rows, _, heads, tokens, alive, texts = _prepared(keyed, size, percent)
    # Every set is a component of its own, so that no pair counts as known.
    pairs = verified(texts, group_pairs(alive.withColumn("component", F.col("doc")), tokens, percent), size, percent)
    known = rows.groupBy("doc").agg(F.max("n").alias("n_shingles"), F.max("digest").alias("digest"))
    named = known.join(heads, F.col("digest") == F.col("of"), "left").select("doc", "n_shingles", "head")
    members = keyed.select(F.col("own_id").alias("doc_id"), F.col("doc_id").alias("row")).join(named, F.col("row") == F.col("doc"))
    return pairs, store(members.select("doc_id", "row", "n_shingles", "head"), "jaccard-members")


def linked(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles, class_row and n_links of every row of ``docs``, from ``links``.

    n_links counts the other different rows (id or text) whose set is equal or similar enough; class_row is the least
    row key among the heads of a class.
    """
    pairs, members = links(docs, size, percent)
    copies = store(
        members.where(F.col("head").isNotNull()).groupBy("head").agg(F.count_distinct("row").alias("copies")), "jaccard-copies"
    )
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(copies, F.col("b") == F.col("head")).groupBy("a").agg(F.sum("copies").alias("others"))
    counted = copies.join(others, F.col("head") == F.col("a"), "left").select(
        F.col("head").alias("h"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    joined = members.join(counted, F.col("head") == F.col("h"), "left").join(
        components(pairs), F.col("head") == F.col("node"), "left"
    )
    return joined.select(
        "doc_id", "row", "n_shingles", F.coalesce("component", "head", "row").alias("class_row"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    A shortcut to the components alone: links within a component that is known already are not looked for;
    ``links`` finds them all.
    """
    rows, held, heads, tokens, alive, texts = _prepared(docs, size, percent)

    def labelled(named: DataFrame) -> DataFrame:
        joined = alive.join(named, F.col("doc") == F.col("node"), "left").drop("node")
        return store(joined.withColumn("component", F.coalesce("component", "doc")), "jaccard-labelled")

    # The texts of one doc_id are one document: they join what each of them is linked with.
    parts = held.select("doc", "digest").join(heads, F.col("digest") == F.col("of"))
    of_one_id = store(
        parts.groupBy("doc").agg(F.min("head").alias("low"), F.max("head").alias("high")).where(F.col("low") < F.col("high"))
        .select(F.col("low").alias("a"), F.col("high").alias("b")),
        "jaccard-links",
    )
    named = components(of_one_id)
    tried = of_one_id.select("a", "b").limit(0)
    for _ in range(NEAR_ROUNDS):
        near = nearest(labelled(named), percent)
        near = store(near.join(tried, ["a", "b"], "left_anti"), "jaccard-near")
        named = components(verified(texts, near, size, percent), named)
        tried = tried.unionByName(near)
    rest = group_pairs(labelled(named), tokens, percent).join(tried, ["a", "b"], "left_anti")
    named = components(verified(texts, rest, size, percent), named)
    joined = (
        rows.select("doc", "n", "digest")
        .join(heads, F.col("digest") == F.col("of"), "left")
        .join(named, F.col("head") == F.col("node"), "left")
    )
    known = F.col("doc") != NO_ID
    return joined.select(
        F.when(known, F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("component", "head", "doc")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, all columns as they are: the smallest doc_id's, null last.

    Every text is judged by itself, also where several share a doc_id or have none. Rows that agree in id and text are one.
    """
    keyed = by_row(docs)
    found = classes(keyed.select("doc_id", "text"), size, percent).select(F.col("doc_id").alias("row"), "component_id")
    ids = keyed.groupBy(F.col("doc_id").alias("of")).agg(F.min("own_id").alias("own_id"), F.count(F.lit(1)).alias("rows"))
    per_row = store(found.distinct().join(ids, F.col("row") == F.col("of")).drop("of"), "jaccard-classes")
    # The smallest id of a class, and of its texts the one with the smallest key.
    least = per_row.groupBy("component_id").agg(F.min("own_id").alias("least_id"))
    same_class = F.col("component_id") == F.col("in_class")
    first = per_row.join(least.withColumnRenamed("component_id", "in_class"), same_class).where(F.col("own_id").eqNullSafe(F.col("least_id")))
    stays = store(first.groupBy("component_id").agg(F.min("row").alias("stays")).withColumnRenamed("component_id", "in_class"), "jaccard-first")
    judged = store(
        per_row.join(stays, same_class).where((F.col("row") != F.col("stays")) | (F.col("rows") > 1))
        .select(F.col("row").alias("w"), (F.col("row") == F.col("stays")).alias("first")), "jaccard-judged",
    )
    rows = docs.select(carried(docs), F.xxhash64("doc_id", "text").alias("row"))
    plain = rows.join(sent(judged.select("w")), F.col("row") == F.col("w"), "left_anti")
    repeated = rows.join(sent(judged.where("first").select("w")), F.col("row") == F.col("w"), "left_semi")
    return plain.unionByName(repeated.dropDuplicates(["row"])).select("doc.*")
