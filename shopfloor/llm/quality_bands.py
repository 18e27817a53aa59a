"""Quality rules by compression bands.

A text's zstandard ratio (compressed bytes / bytes), whole and for fixed chunks, tells repetitive
text (low) from text that can't be compressed, such as base64 or binary remains (high). What is normal
depends on the length: short texts compress badly and long ones better, so each length has limits of
its own, between prose and base64 in lines. A document is kept if its counts pass and both verdicts do.

What a ratio can't tell apart passes: below 200 bytes base64 is as dense as prose, and lists of hex keys
or UUIDs (about 0.51 to 0.60) are as dense as prose until about 20 KB, where prose gets below 0.5.

Cases: null and empty text have no words and are rejected by the counts; rows with null doc_id and
repeated rows are judged each for itself; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from shopfloor.llm.remembered import alone
from shopfloor.llm.text import SHINGLE, Words, id_and_bytes, mix, steps, windows


@dataclass(frozen=True)
class Bands:
    """(least bytes, lowest ratio, highest ratio) of whole texts by length, and the rule for chunks.

    The last chunk, if it is shorter, has the limits of whole texts of its length."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0), (64, 0.45, 2.0), (200, 0.40, 0.90), (350, 0.40, 0.83), (500, 0.36, 0.78),
        (1_000, 0.33, 0.72), (2_000, 0.32, 0.65), (5_000, 0.30, 0.56), (20_000, 0.27, 0.50))
    chunk_bytes: int = 1024
    chunk: tuple[float, float] = (0.33, 0.75)
    bad_chunks: float = 0.2

    def of(self, length: int) -> tuple[float, float]:
        return self.whole[bisect_right(self.whole, (length, 9e9)) - 1][1:]
    level: int = 3


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
    ("chunk_low", pa.float64()), ("chunk_high", pa.float64())])
DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, ratio double, chunk_low double, chunk_high double")

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def compression(text: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[float, float, float, bool]:
    """Ratio of the whole text, shares of its bytes in chunks below and above their band, and whether all
    is in the bands. An empty text has ratio 0 and is in the bands."""
    if not text:
        return 0.0, 0.0, 0.0, True
    ratio = len(zstd.compress(text)) / len(text)
    low, high = bands.of(len(text))
    view, size, below, above = memoryview(text), bands.chunk_bytes, 0, 0
    for i in range(0, len(text), size):
        chunk = view[i:i + size]
        least, most = bands.chunk if len(chunk) == size else bands.of(len(chunk))
        r = len(zstd.compress(chunk)) / len(chunk)
        below += len(chunk) * (r < least)
        above += len(chunk) * (r > most)
    below, above = below / len(text), above / len(text)
    return ratio, below, above, low <= ratio <= high and max(below, above) <= bands.bad_chunks


def repeated_words(w: Words) -> np.ndarray:
    """Per text: words inside any window of five words that occurs twice or more in it."""
    n = len(w.start)
    covered = np.zeros(n + 1, np.int64)
    if n >= SHINGLE:
        text = np.repeat(np.arange(len(w.n_words), dtype=np.uint64), w.n_words)
        window = windows(w.hashes(lower=False)) ^ mix(text[:n - SHINGLE + 1] + np.uint64(1))
        at = np.flatnonzero(text[:n - SHINGLE + 1] == text[SHINGLE - 1:])  # inside one text
        order = at[np.argsort(window[at], kind="stable")]
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        np.add.at(covered, order[twice], 1)
        np.add.at(covered, order[twice] + SHINGLE, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:n]) > 0)])
    return np.diff(inside[w.first])


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def judge(batches, bands: Bands):
    zstd = zstandard.ZstdCompressor(level=bands.level)
    for batch, w in steps(batches):
        texts = [w.text(d) for d in range(batch.num_rows)]
        found = [compression(t, bands, zstd) for t in texts]
        ratio, below, above, fine = (np.array(x) for x in zip(*found, strict=True))
        n_words, repeat = w.n_words, repeated_words(w)
        failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
        columns = [
            n_words, w.per_text(~w.is_space() & (w.data & 0xC0 != 0x80)), w.per_text(_SYMBOL[w.data]),
            np.array([duplicate_lines(t) for t in texts]), repeat, failed, ~failed & fine.astype(bool),
            ratio, below, above]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(SCHEMA)[1:], strict=True))],
            schema=SCHEMA)


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: counts, compression figures and the verdict ``kept``. No shuffle."""
    return id_and_bytes(docs).mapInArrow(lambda batches: judge(batches, bands), DDL)


def passing(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns as they were.

    The verdict is taken in the scan's own tasks, where a row and its verdict meet without a join."""
    schema, names = docs.schema, docs.columns

    def keep(batches):
        for batch in batches:
            both = pa.RecordBatch.from_arrays(
                [pa.nulls(batch.num_rows, pa.int64()), batch.column(names.index("text")).cast(pa.large_binary())],
                ["doc_id", "text"])
            kept = [v for out in judge(iter([both]), bands) for v in out.column("kept").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(alone(keep), schema)
