"""Words and word shingles of Arrow text columns, as numpy arrays.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D`` (all of them ASCII, so
bytes and code points split alike). Null text has no words. Hashes are 64 bit and the same in every
process; two different words or shingles share one with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one step looks at; a longer single text is a step of its own.
STEP_BYTES = 2 << 20
#: Bytes of a batch on its way to a Python worker, and of a row group that a task holds while it writes.
BATCH_BYTES = 4 << 20
GROUP_BYTES = 16 << 20
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LONG_WORD = 64
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(0, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each of the 64 bits over all of them (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words of consecutive texts: text ``d`` has the words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[self.offsets])

    def is_space(self) -> np.ndarray:
        return _SPACE[self.data]

    def text(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()

    def hashes(self, lower: bool) -> np.ndarray:
        """A hash of each word; with ``lower``, A-Z count as a-z."""
        data = _LOWER[self.data] if lower else self.data
        size = self.end - self.start
        out = np.full(len(size), np.uint64(0x51_7C_C1_B7_27_22_0A_95))
        left = np.flatnonzero(size <= _LONG_WORD)
        for j in range(_LONG_WORD):
            left = left[size[left] > j]
            if not len(left):
                break
            out[left] = (out[left] ^ _BYTE[data[self.start[left] + j]]) * _STEP
        for i in np.flatnonzero(size > _LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(data[self.start[i]:self.end[i]].tobytes())
        return mix(out ^ size.astype(np.uint64))


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end[:-1] &= ~word[1:] | cut[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def windows(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash of every ``width`` consecutive word hashes (none, if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += hashes[j:j + n] * _PLACE[j]
    return mix(total)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of one text's word hashes; the whole sequence if it is shorter."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < SHINGLE:
        short = np.concatenate([hashes, np.full(SHINGLE - len(hashes), np.uint64(len(hashes)))])
        return windows(short)
    return np.unique(windows(hashes))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; null is empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, hi = offsets[0], offsets[-1]
    data, offsets = data[lo:hi], offsets - lo
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        if np.diff(offsets)[gone].any():
            return texts(column.fill_null(b""))
    return data, offsets


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of the batches, each with about STEP_BYTES of text or one longer text, and its words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = texts(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            lo, hi = offsets[at], offsets[to]
            yield batch.slice(at, to - at), split_words(data[lo:hi], offsets[at:to + 1] - lo)
            at = to


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark) -> None:
    """From now on the session's Arrow batches end at BATCH_BYTES; a number of rows doesn't bound texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """doc_id and the text's bytes; columns are named exactly, so extra ones don't matter."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def saved(df: DataFrame) -> DataFrame:
    """Cuts the lineage: a table written into the folder that all executors share, and read again."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    small_batches(df.sparkSession)
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark) -> str:
    """spark.checkpoint.dir; a scratch folder only where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        import tempfile
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named
