import random

import pytest
from pyspark.sql import types as T

#: Columns an operator might use itself; they are to come through or be left aside.
EXTRA = ["size", "shard", "key", "row", "doc", "node", "score", "start", "target", "bucket", "text_crc32", "__key", "rule"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in EXTRA],
    ]
)


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ta", "re", "mi", "so", "Lé", "n", "ku."]) for _ in range(r.randint(1, 5))) for _ in range(words))


def rows():
    """Copies, near copies, ties, repeated rows, nulls, empty and very long texts."""
    long = prose(9, 30_000)
    base = prose(1, 400).split(" ")
    out = [(i, prose(i, 20 + 7 * i), "en", f"src{i % 3}") for i in range(2, 40)]
    for i in range(40, 60):  # near copies: one word exchanged
        words = base[:]
        words[7 * (i - 40)] = f"changed{i}"
        out.append((i, " ".join(words), "fr", "src0"))
    out += [(i, " ".join(base), "de", "src1") for i in range(60, 70)]
    out += [(70, long, "en", "src2"), (71, long + " end", "en", None), (72, None, None, None), (73, "", "en", "src1"),
            (74, " \n\t ", None, "src9"), (75, "one", "es", "src9"), (76, "ONE", "es", "src9"), (77, "two words", "es", "src2"),
            (None, "text of no one", "en", "src1"), (None, None, None, None), (5, "same id, other text", "en", "src1"),
            (78, "a  b\n\nc \u2003d <|endoftext|> it's", "en", "src1"), (79, "<|endoftext|>", "en", "src1")]
    out += [out[0], out[0], out[1]]
    return [(*r, len(r[1]) if r[1] else None, *["x" for _ in EXTRA]) for r in out]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain():
    return rows()
