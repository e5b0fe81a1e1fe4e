"""Token ids in one compressed file per shard: a wavelet matrix with rank and select.

Ids of a shard are numbered by rank among those it uses. Their numbers' bits, highest first,
make up planes: each plane holds one bit of every id in the order that all higher bits have
sorted them into, zeros before ones. Counts of ones at every BLOCK bits give rank by a look-up and
a short count, and select by a search; so a file answers access to any position, the count
of an id before a position, and the position of its k-th occurrence, from the planes alone.
Planes are zstandard frames of their own and are opened when first asked for.

Documents are dealt to tasks in ranges of doc_id and sorted there. A task writes a file whenever it has
SHARD_IDS ids, so it holds no more than that and one batch, however many documents a range has. A file appears under its name
by a move after it is complete; a task that is run again writes the same file again.

Layout: MAGIC, the header's length (4 bytes), a JSON header, then compressed parts in the order the
header lists: ids, document ids, document lengths, and each plane with its block counts.

Defined cases: null text is empty and has the end id only; null doc_ids come first; rows of equal id stand in
text order; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import store
from pricetrail.llm.encoder import encoder
from pricetrail.session import new_path

MAGIC = b"WVLTMTX1"
BLOCK = 2048
STRETCH = 1 << 15
SHARD_IDS = 4_000_000
RANGE_BYTES = 8_000_000
END_ID = 0


def _frame(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _ranked(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of a packed plane."""
    ones = np.bitwise_count(bits).astype(np.uint32)
    per_block = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
    return np.concatenate((np.zeros(1, np.uint32), np.cumsum(per_block, dtype=np.uint32)))


def _dealt(order: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """The order with its zeros before its ones, a stretch at a time that stays in the processor's cache."""
    out, left, right = np.empty_like(order), 0, zeros
    for at in range(0, len(order), STRETCH):
        some, bits = order[at : at + STRETCH], ones[at : at + STRETCH]
        up = np.flatnonzero(bits)
        down = np.flatnonzero(~bits)
        some.take(down, out=out[left : left + len(down)], mode="clip")
        some.take(up, out=out[right : right + len(up)], mode="clip")
        left, right = left + len(down), right + len(up)
    return out


def _gathered(dealt: np.ndarray, ones: np.ndarray, zeros: int, bit: int) -> np.ndarray:
    """The order that ``_dealt`` was given, with ``bit`` set in its ones."""
    out, left, right = np.empty_like(dealt), 0, zeros
    for at in range(0, len(dealt), STRETCH):
        some, bits = out[at : at + STRETCH], ones[at : at + STRETCH]
        up = np.flatnonzero(bits)
        down = np.flatnonzero(~bits)
        some[down] = dealt[left : left + len(down)]
        some[up] = dealt[right : right + len(up)] | dealt.dtype.type(bit)
        left, right = left + len(down), right + len(up)
    return out


def pack(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of a shard. ``doc_ids`` are longs, the lowest one standing for null."""
    used = np.unique(ids) if len(ids) < 1 << 16 else np.flatnonzero(np.bincount(ids))
    depth = max(1, int(len(used) - 1).bit_length()) if len(used) else 0
    number = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.uint32)
    number[used] = np.arange(len(used))
    order = number[ids].astype(np.uint16 if depth <= 16 else np.uint32)
    parts = [_frame(used.astype("<u4")), _frame(doc_ids.astype("<i8")), _frame(lengths.astype("<i8"))]
    zeros = []
    for plane in range(depth - 1, -1, -1):
        ones = (order & order.dtype.type(1 << plane)).astype(bool)
        packed = np.packbits(ones)
        zeros.append(len(ones) - int(np.count_nonzero(ones)))
        parts += [_frame(packed), _frame(_ranked(packed).astype("<u4"))]
        order = _dealt(order, ones, zeros[-1])
    header = json.dumps({
        "ids": len(ids), "documents": len(doc_ids), "zeros": zeros, "parts": [len(p) for p in parts],
    }).encode()
    return MAGIC + len(header).to_bytes(4, "little") + header + b"".join(parts)


class TokenFile:
    """Reads one file's bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(data[8:12], "little")
        header = json.loads(data[12 : 12 + size])
        self.n, self.zeros = header["ids"], header["zeros"]
        at = 12 + size
        self._frames = []
        for length in header["parts"]:
            self._frames.append(memoryview(data)[at : at + length])
            at += length
        self._opened: dict[int, np.ndarray] = {}
        self.used = self._part(0, "<u4")
        self.doc_ids, self.lengths = self._part(1, "<i8"), self._part(2, "<i8")

    def _part(self, i: int, dtype: str) -> np.ndarray:
        if i not in self._opened:
            self._opened[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._frames[i]), dtype)
        return self._opened[i]

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        return self._part(3 + 2 * level, "u1"), self._part(4 + 2 * level, "<u4")

    def _bit(self, level: int, i: int) -> int:
        return int(self._plane(level)[0][i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        bits, counts = self._plane(level)
        block = i // BLOCK
        found = int(counts[block])
        found += int(np.bitwise_count(bits[block * BLOCK // 8 : i >> 3]).sum())
        return found + (int(bits[i >> 3]) >> (8 - (i & 7))).bit_count() if i & 7 else found

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        number = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = zeros + ones if bit else i - ones
            number = number << 1 | bit
        return int(self.used[number])

    def _walk(self, token: int, i: int) -> tuple[int, int, list[int]] | None:
        """The token's range start at the bottom, the end for the first ``i`` ids, and its bits."""
        number = int(np.searchsorted(self.used, token))
        if number >= len(self.used) or self.used[number] != token:
            return None
        start, path = 0, []
        for level, zeros in enumerate(self.zeros):
            bit = number >> (len(self.zeros) - 1 - level) & 1
            a, b = self._ones(level, start), self._ones(level, i)
            start, i = (zeros + a, zeros + b) if bit else (start - a, i - b)
            path.append(bit)
        return start, i, path

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` in positions start .. end."""
        upto, before = self._walk(token, self.n if end is None else end), self._walk(token, start)
        return upto[1] - before[1] if upto and before else 0

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0), or -1."""
        found = self._walk(token, self.n)
        if not found or not 0 <= k < found[1] - found[0]:
            return -1
        i = found[0] + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = found[2][level]
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        order = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self._plane(level)[0], count=self.n).view(bool)
            order = _gathered(order, ones, self.zeros[level], 1 << (len(self.zeros) - 1 - level))
        return self.used[order]


NO_ID = -(1 << 63)


def _write(folder: str, name: str, data: bytes) -> None:
    """The file under its name, by way of another name in the same folder."""
    store_of, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    store_of.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store_of.open_output_stream(part) as out:
        out.write(data)
    store_of.move(part, path)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files; one stored row (file, ids) per file, in order of ``file``."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        doc_ids: list[int] = []
        held = 0

        def close() -> pd.DataFrame:
            nonlocal ids, doc_ids, held, number
            name = f"{task:08d}-{number:06d}.tokens"
            lengths = np.array([len(x) for x in ids], np.int64)
            _write(folder, name, pack(np.concatenate(ids), np.array(doc_ids, np.int64), lengths))
            ids, doc_ids, number = [], [], number + 1
            total, held = held, 0
            return pd.DataFrame({"file": [name], "ids": [total]})

        tokens = encoder(tokenizer)
        for frame in frames:
            for of in range(0, len(frame), 256):
                some = frame.iloc[of : of + 256]
                for doc_id, found in zip(some["place"], tokens.encode(list(some["text"]))):
                    ids.append(np.append(found, found.dtype.type(end_id)))
                    doc_ids.append(int(doc_id))
                    held += len(found) + 1
                    if held >= SHARD_IDS:
                        yield close()
        if ids:
            yield close()

    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    ordered = rows.repartitionByRange(ranges, "place").sortWithinPartitions("place", "text")
    return store(ordered.mapInPandas(encode, "file string, ids long"), "token-files")


def read_files(spark, folder: str) -> DataFrame:
    """file, at, doc_id, before, n_tokens, ids_crc32 of every document, decoded from the files."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                file = TokenFile(content)
                raw = memoryview(file.ids().astype("<u4")).cast("B")
                ends = np.cumsum(file.lengths)
                starts = ends - file.lengths
                yield pd.DataFrame({
                    "file": path.rpartition("/")[2], "at": np.arange(len(ends)), "place": file.doc_ids,
                    "before": starts, "n_tokens": file.lengths,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())],
                })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    return files.select("path", "content").mapInPandas(
        decode, "file string, at long, place long, before long, n_tokens long, ids_crc32 long"
    )


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from files written to the shared folder."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    written = write_files(docs, folder, tokenizer)
    if written.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    before = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.select(F.col("file").alias("of"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("from"))
    return read_files(spark, folder).join(starts, F.col("file") == F.col("of")).select(
        F.when(F.col("place") != NO_ID, F.col("place")).alias("doc_id"),
        (F.col("from") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
    )
