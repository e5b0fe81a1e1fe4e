"""Quality scores from compression with a good and a bad dictionary.

Two zstandard dictionaries are built from labelled text, one of each class. A text that
resembles the good one compresses better with its dictionary, so the difference of the two
compressed sizes, over the square root of the length, says which class it is closer to. Texts are compressed in pieces
of ``PIECE_BYTES``, each with the dictionary alone before it, as a text's own history would
take the dictionary's place and the rest of a long text would count for nothing. A
logistic curve over that number and the inverse root length, fitted on labelled texts that the
dictionaries have not seen, makes it a probability.

The fit is bounded: at most ``DICTIONARY_TEXTS`` + ``CALIBRATION_TEXTS`` texts of a class,
the dictionaries being made from ``SAMPLE_CHARS`` characters of theirs, which are drawn from ``SAMPLE_PARTS`` places
over the whole text where it is longer. Scoring reads every text whole.

Defined cases: null text scores as an empty one, and an empty text has a score; a document
with contradicting labels is not learnt from; without labels of both classes nothing speaks
against a text and every score is 1; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICTIONARY_TEXTS, CALIBRATION_TEXTS, SAMPLE_CHARS, SAMPLE_PARTS = 1500, 2500, 8192, 8
DICTIONARY_BYTES, LEVEL, PIECE_BYTES = 1 << 18, 3, 1 << 15
KEEP_FROM = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]


def held_out(doc_id: Column) -> Column:
    """The fold no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:].ljust(8, b"\n")


def _sizer(content: bytes) -> Callable[[bytes], int]:
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content),
        write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    return lambda data: len(compressor.compress(data))


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of PIECE_BYTES at most, cut between characters; one empty piece of no data."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        to = at + PIECE_BYTES
        while data[to] & 0xC0 == 0x80:
            to -= 1
        yield data[at:to]
        at = to
    yield data[at:]


def _features(good: Callable[[bytes], int], bad: Callable[[bytes], int], texts: Iterable[str | None]) -> np.ndarray:
    out = []
    for text in texts:
        data = (text or "").encode("utf-8", "replace")
        apart = sum(bad(piece) - good(piece) for piece in _pieces(data))
        root = (len(data) + 100) ** 0.5
        out.append((apart / root, 10.0 / root, 1.0))
    return np.array(out, dtype=float).reshape(-1, 3)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton steps with a slight ridge, which keeps separable classes finite."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return w


def _drawn(text: Column) -> Column:
    """SAMPLE_CHARS characters of a text: all of a short one, else parts from its beginning to its end."""
    part = SAMPLE_CHARS // SAMPLE_PARTS
    room = F.char_length(text) - part
    places = [F.floor(room * i / (SAMPLE_PARTS - 1)).cast("int") + 1 for i in range(SAMPLE_PARTS)]
    spread = F.concat_ws("\n", *[F.substring(text, place, F.lit(part)) for place in places])
    return F.when(F.char_length(text) <= SAMPLE_CHARS, text).otherwise(spread)


def _sample(labels: DataFrame) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ids by hash order: good and bad ones for the dictionaries, then for the calibration."""
    agreed = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where(F.col("low") == F.col("high"))
    )
    parts = []
    for quality in (1, 0):
        of = agreed.where(F.col("low") == quality).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = [r[0] for r in of.select("doc_id").limit(DICTIONARY_TEXTS + CALIBRATION_TEXTS).collect()]
        cut = min(DICTIONARY_TEXTS, -(-len(ids) * 7 // 10))
        parts.append((ids[:cut], ids[cut:]))
    return parts[0][0], parts[1][0], parts[0][1], parts[1][1]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model learnt from the labels outside the held-out fold; None without both classes."""
    good, bad, good_later, bad_later = _sample(labels)
    if not (good and bad and good_later and bad_later):
        return None
    spark = docs.sparkSession
    uses = [(i, k) for k, ids in enumerate((good, bad, good_later, bad_later)) for i in ids]
    picked = F.broadcast(spark.createDataFrame(uses, "picked long, use int"))  # at most 8,000 rows
    texts = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("picked"))
    first = texts.where(F.col("use") < 2).select(
        "use", "doc_id", _drawn(F.coalesce("text", F.lit(""))).alias("text")
    ).orderBy("doc_id", "text").collect()
    of = [[r.text.encode("utf-8", "replace") for r in first if r.use == k and r.text] for k in (0, 1)]
    if not (of[0] and of[1]):
        return None
    content = _dictionary(of[0]), _dictionary(of[1])

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizers = _sizer(content[0]), _sizer(content[1])
        for frame in frames:
            x = _features(*sizers, frame["text"])
            yield pd.DataFrame({"use": frame["use"], "a": x[:, 0], "b": x[:, 1]})

    seen = texts.where(F.col("use") >= 2).select("use", "text").mapInPandas(features, "use int, a double, b double")
    rows = sorted(map(tuple, seen.collect()))
    if not {2, 3} <= {r[0] for r in rows}:
        return None
    table = np.array(rows, dtype=float)
    x = np.column_stack([table[:, 1], table[:, 2], np.ones(len(table))])
    return Model(*content, tuple(_logistic(x, (table[:, 0] == 2).astype(float))))


def score(text: Column, model: Model | None) -> Column:
    """Probability of label 1 for a text column."""
    if model is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizers = _sizer(model.good), _sizer(model.bad)
        weights = np.array(model.weights)
        for texts in batches:
            z = _features(*sizers, texts) @ weights
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))

    return probability(text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    model = fit(docs, labels)
    rated = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least ``KEEP_FROM``, all columns as they are."""
    return docs.where(score(docs["text"], fit(docs, labels)) >= KEEP_FROM)
