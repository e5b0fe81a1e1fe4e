"""Importance resampling towards a target text collection, with hashed runs of words counted by an automaton.

Documents are drawn by how much likelier their features are in the target than in the corpus. A feature is a run of 1 to
``grams`` words, its bucket the CRC32 of its bytes; bucket counts of both sides give every bucket a gain.

The CRCs come from an Aho-Corasick automaton whose words stand between two delimiters, so that only whole words
match. Each carries its CRC and its length. One scan over a text gives the payloads of its words in order; the CRC of a run
is composed of the payloads of its words: the CRC of what stands before, shifted by the next word's length, and
that word's own. No run is ever built as text.

The automaton holds the DICTIONARY words that the corpus has most often; that bounds its size on every executor. The other
words of a text are the gaps between matches; their payloads are computed on the spot, so every word counts alike.

The scan runs once: buckets are stored per document, and counting, scoring and drawing work on these. The draw needs
no sort of all documents: counts per score give the score at which the draw ends, only rows from there up are
put in order, in range slices.

Defined cases: null text has no words; a text without words has weight 0; the number of a null doc_id is drawn from
``<seed>:``, and it comes after other ids of the same score; repeated rows are drawn each by itself; an empty corpus
gives no rows; an empty target leaves all counts of it 0. Very long texts are scanned whole, very long words are never in
the dictionary. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import store
from pricetrail.operators.ordering import in_order

#: Words in the automaton, and characters of the longest one: some megabytes on every executor.
DICTIONARY, LONGEST = 1 << 16, 64
#: Steps of the counts' logarithm for each doubling.
LEVELS = 16
#: Different words that a task counts before it hands its counts on.
COUNTED = 200_000
BUCKETS = 10_000
#: Scores that are counted together in the first of the two looks for the end of the draw.
BAND = 1024

_KEPT = string.digits + string.ascii_lowercase
#: A-Z in lower case, other ASCII characters but digits and letters as a delimiter, all else as it is.
_TABLE = {c: " " for c in range(128) if chr(c) not in _KEPT} | {ord(c): c.lower() for c in string.ascii_uppercase}


def words_apart(text: str | None) -> str:
    """The words of a text with a space on either side of each."""
    return f" {(text or '').translate(_TABLE)} "


def dictionary(texts: DataFrame, size: int = DICTIONARY) -> list[str]:
    """All words of at least some count above one: the least count that no more than ``size`` words have.

    Driver and tasks see ``size`` words and some thousand counts, however many words there are.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for frame in frames:
            for text in frame["text"]:
                counts.update(words_apart(text).split(" "))
                if len(counts) > COUNTED:
                    yield from counted(counts)
                    counts = Counter()
        yield from counted(counts)

    def counted(counts: Counter[str]) -> Iterator[pd.DataFrame]:
        pairs = [(w, n) for w, n in counts.items() if 0 < len(w) <= LONGEST]
        if pairs:
            yield pd.DataFrame(pairs, columns=["word", "n"])

    parts = texts.select("text").mapInPandas(count, "word string, n long")
    counts = parts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counts = store(counts.withColumn("level", F.floor(F.log2("n") * LEVELS).cast("long")), "importance-words")
    # Few levels of the logarithm of the count; then the counts of the level in which there are too many words.
    level, above = _down_to(counts, "level", size)
    least, _ = _down_to(counts.where(F.col("level") == level), "n", size - above) if level is not None else (None, 0)
    chosen = F.lit(True) if level is None else F.col("level") > level
    if least is not None:
        chosen = chosen | ((F.col("level") == level) & (F.col("n") > least))
    return sorted(r.word for r in counts.where(chosen).select("word").collect())


def _down_to(counts: DataFrame, column: str, room: int) -> tuple[int | None, int]:
    """The greatest value from which on there are more rows than ``room``, or none; and the rows of greater values."""
    above = 0
    for value, n in sorted(((r.v, r.n) for r in counts.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        if above + n > room:
            return value, above
        above += n
    return None, above


def _shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs as they enter the CRC of a text that goes on for ``length`` bytes: times x^(8 length)."""
    out = crc.astype(np.uint32)
    power = _byte_later()
    rest = length.copy()
    while rest.any():
        odd = (rest & 1).astype(bool)
        out[odd] = _times(power, out[odd])
        rest >>= 1
        power = _times(power, power)
    return out


def _times(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A bit matrix, one column per bit, times each vector."""
    out = np.zeros(len(vectors), np.uint32)
    for bit in range(32):
        out ^= np.where((vectors >> np.uint32(bit)) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def _byte_later() -> np.ndarray:
    """The matrix that leads a CRC register over one zero byte."""
    units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        # 0xEDB88320 is the polynomial of CRC32 with its bits in reverse.
        units = np.where(units & np.uint32(1), (units >> np.uint32(1)) ^ np.uint32(0xEDB88320), units >> np.uint32(1))
    return units.astype(np.uint32)


class Scanner:
    """The dictionary's words between delimiters, with their payloads."""

    def __init__(self, words: list[str]):
        raw = [w.encode("utf-8", "replace") for w in words]
        self.crc = np.array([zlib.crc32(r) for r in raw], np.uint32)
        self.length = np.array([len(r) for r in raw], np.int64)
        self.spread = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton()
        for i, word in enumerate(words):
            self.automaton.add_word(f" {word} ", i)
        if words:
            self.automaton.make_automaton()

    def payloads(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length in bytes of every word of the text, in order."""
        apart = words_apart(text)
        found = list(self.automaton.iter(apart)) if len(self.crc) else []
        ends = np.fromiter((e for e, _ in found), np.int64, len(found))
        which = np.fromiter((w for _, w in found), np.int64, len(found))
        # A match begins and ends on a delimiter; one may end the word before and begin the next.
        starts = ends - self.spread[which] - 1
        since = np.concatenate(([0], ends))
        until = np.concatenate((starts, [len(apart) - 1]))
        gaps = np.flatnonzero(until - since > 1)
        at, others = [], []
        for gap in gaps:
            rest = apart[since[gap] : until[gap]].split(" ")
            for word in rest:
                if word:
                    at.append(gap)
                    others.append(word.encode("utf-8", "replace"))
        crc, length = self.crc[which], self.length[which]
        if others:
            crc = np.insert(crc, at, np.fromiter(map(zlib.crc32, others), np.uint32, len(others)))
            length = np.insert(length, at, np.fromiter(map(len, others), np.int64, len(others)))
        return crc, length


def runs(crc: np.ndarray, length: np.ndarray, grams: int) -> np.ndarray:
    """CRCs of all runs of 1 to ``grams`` adjacent words joined by a space, from the payloads of the words."""
    out, run = [crc], crc
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(1, np.int64)
    for n in range(2, grams + 1):
        if len(crc) < n:
            break
        before = run[:-1]
        spaced = _shift(before, np.broadcast_to(one, before.shape)) ^ space
        run = _shift(spaced, length[n - 1 :]) ^ crc[n - 1 :]
        out.append(run)
    return np.concatenate(out)


_scanners: dict[tuple[int, int], Scanner] = {}


def scanner_of(words: list[str]) -> Scanner:
    """The scanner for a dictionary; a worker keeps its last one."""
    key = (len(words), hash(tuple(words)))
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(words)
    return _scanners[key]


def with_buckets(docs: DataFrame, words: list[str], grams: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and the buckets of all features, repeats included, of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(words)  # DICTIONARY words of LONGEST characters at most

    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = scanner_of(sent.value)
        for some in texts:
            n_words, found = [], []
            for text in some:
                crc, length = scanner.payloads(text)
                n_words.append(len(crc))
                found.append((runs(crc, length, grams) % np.uint32(buckets)).astype(np.int32))
            yield pd.DataFrame({"n_words": n_words, "buckets": found})

    scanned = F.pandas_udf(scan, "n_words long, buckets array<int>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scanned("text").alias("s"))
    return rows.select("doc_id", "s.n_words", "s.buckets")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fell to each bucket; partly counted before the shuffle."""
    counts = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm, in thousandths, of how much likelier it is in the target."""
    all_corpus, all_target, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    likelier = (target + 1.0) * (all_corpus + buckets) / ((corpus + 1.0) * (all_target + buckets))
    return np.floor(1000 * np.log(likelier)).astype(np.int64)


def weigh(buckets: Column, gain: np.ndarray) -> Column:
    """The mean gain of a document's features, floored; 0 without features."""

    def mean(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in lists:
            sums = [(int(gain[b].sum()), len(b)) for b in some]
            yield pd.Series([total // n if n else 0 for total, n in sums], dtype="int64")

    return F.pandas_udf(mean, "long")(buckets)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _end_of_draw(rows: DataFrame, wanted: int) -> int | None:
    """The score of the last row drawn, from counts per score; bands of BAND scores are counted first."""

    def last(counts: DataFrame, above: int) -> tuple[int, int]:
        for value, n in sorted(((r.v, r.n) for r in counts.collect()), reverse=True):
            if above + n >= wanted:
                return value, above
            above += n
        raise ValueError("more rows are wanted than there are")

    if not wanted:
        return None
    by_band = rows.groupBy(F.floor(F.col("score") / BAND).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    band, above = last(by_band, 0)
    inside = rows.where((F.col("score") >= band * BAND) & (F.col("score") < (band + 1) * BAND))
    return last(inside.groupBy(F.col("score").alias("v")).agg(F.count(F.lit(1)).alias("n")), above)[0]


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, grams: int = 1,
    buckets: int = BUCKETS, seed: int = 2024, words: int = DICTIONARY,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``; rank is null where it is not drawn.

    Drawn are ``percent`` of the rows with ``least_words`` words or more, those of the highest scores.
    """
    known = dictionary(docs, words)
    corpus = store(with_buckets(docs, known, grams, buckets), "importance-buckets")
    wanted = with_buckets(target.select(F.lit(0).alias("doc_id"), "text"), known, grams, buckets)
    gain = gains(bucket_counts(corpus, buckets), bucket_counts(wanted, buckets))
    weighed = corpus.select(
        "doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), weigh(F.col("buckets"), gain).alias("weight")
    )
    scored = store(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    able = F.col("n_words") >= least_words
    eligible = scored.where(able)
    drawn = eligible.count() * percent // 100
    end = _end_of_draw(eligible, drawn)
    if end is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    first = able & (F.col("score") >= end)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    ranked = in_order(scored.where(first), [], order, row_number="rank", sliced=True)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~first).withColumn("rank", F.lit(None).cast("long")))
