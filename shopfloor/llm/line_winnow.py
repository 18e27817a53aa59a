"""Line dedup by winnowing over line hashes.

A gram is the fewest lines in a row with NOISE words or more; a window the fewest with GUARANTEE words or
more, counted on from each line and back from each line. The lowest gram hash of each window is its
fingerprint, so two copies of any run of lines with GUARANTEE words have one in common, and each line of
the run is in a window of it. Every fingerprint is joined with the first place, by (doc_id, line), that has
it in an equal window; from there the match is extended line by line both ways, and the later run is
deleted. So exactly those lines go that are in a run of GUARANTEE words or more which an earlier place has,
and a line stays where it is first: nothing goes altogether.

The lines around a fingerprint that an extension can need travel with it (GUARANTEE words each way: the
next fingerprint of a longer run is nearer), so no document's lines are gathered for its copies. First
places come from an aggregation that combines before the shuffle and are written before they are joined,
so that adaptive execution can split a passage that very many documents have; they grow with the input, so
joins merge at every size.

Lines are compared without surrounding white space; blank lines don't count, and go with the deleted
line that they follow. Cases: null text stays null, empty text empty; null doc_id comes after all ids;
a document with fewer words than GUARANTEE is one window, which only equal documents share (with fewer than
NOISE it has none); rows with equal doc_id and text are one document and are treated alike; an empty table gives none;
extra columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.remembered import alone
from shopfloor.llm.text import saved

NOISE, GUARANTEE = 25, 50
LAST_ID = 2**63 - 1
_ROW = "__row"


def full_lines(text: bytes) -> list[bytes]:
    """The lines with a word, without surrounding white space."""
    return [x for line in text.split(b"\n") if (x := line.strip())]


def reach(words: list[int], least: int) -> list[int]:
    """For each line, the last of the fewest lines from it on with so many words; past the end if too few."""
    out, end, total = [], 0, 0
    for n in words:
        while total < least and end < len(words):
            total += words[end]
            end += 1
        out.append(end - 1 if total >= least else len(words))
        total -= n
    return out


def window_spans(words: list[int], guarantee: int) -> list[tuple[int, int]]:
    """(first line, last line) of the windows on from each line and back from each line."""
    n = len(words)
    on = [(i, end) for i, end in enumerate(reach(words, guarantee)) if end < n]
    back = [(n - 1 - end, n - 1 - i) for i, end in enumerate(reach(words[::-1], guarantee)) if end < n]
    return sorted({*on, *back}) or ([(0, n - 1)] if n else [])


def fingerprints(digests: list[bytes], words: list[int], noise: int, guarantee: int) -> list[tuple[int, int, int, int]]:
    """(gram hash, window hash, first line, last line) of the window minima; of equal ones the last."""
    n, packed = len(words), b"".join(digests)
    gram_end = reach(words, noise)
    grams = [xxhash.xxh3_64_intdigest(packed[8 * i:8 * (e + 1)]) - (1 << 63) if e < n else None
             for i, e in enumerate(gram_end)]
    chosen = []
    for start, end in window_spans(words, guarantee):
        best = None
        for j in range(start, end + 1):
            if gram_end[j] > end:
                break
            if best is None or grams[j] <= grams[best]:
                best = j
        if best is not None:
            window = xxhash.xxh3_64_intdigest(packed[8 * start:8 * (end + 1)], 1) - (1 << 63)
            chosen.append((grams[best], window, best, gram_end[best]))
    return chosen


def around(hashes: np.ndarray, words: list[int], first: int, last: int, least: int) -> tuple[list, list]:
    """Hashes of the lines before and after, nearest first, until they have so many words."""
    left, right = [], []
    at, total = first - 1, 0
    while at >= 0 and total < least:
        left.append(int(hashes[at]))
        total += words[at]
        at -= 1
    at, total = last + 1, 0
    while at < len(words) and total < least:
        right.append(int(hashes[at]))
        total += words[at]
        at += 1
    return left, right


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64("text").alias("content"), F.col("text").cast("binary").alias("text"))


def places(docs: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """(gram, window, id, content, first, last, left, right) of every window's fingerprint."""
    names = ["gram", "window", "id", "content", "first", "last", "left", "right"]

    def rows(batches):
        for batch in batches:
            ids, contents = batch.column("id").to_pylist(), batch.column("content").to_pylist()
            out: list[list] = [[] for _ in names]
            for d, text in enumerate(batch.column("text")):
                lines = full_lines(text.as_py() or b"")
                digests, words = [xxhash.xxh3_64_digest(x) for x in lines], [len(x.split()) for x in lines]
                hashes = np.frombuffer(b"".join(digests), np.int64)
                for gram, window, first, last in fingerprints(digests, words, noise, guarantee):
                    row = (gram, window, ids[d], contents[d], first, last, *around(hashes, words, first, last, guarantee))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    return _keyed(docs).mapInArrow(
        alone(rows), "gram long, window long, id long, content long, first int, last int, left array<long>, right array<long>")


def _same(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from the beginning."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def repeated_runs(docs: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """(id, content, first, last, from_id, from_first): runs of lines that repeat an earlier run."""
    place = F.struct("id", "content", "first")
    found = saved(places(docs, noise, guarantee))
    earliest = found.groupBy("gram", "window").agg(
        F.min(place).alias("low"), F.max(place).alias("high"),
        F.min_by(F.struct("id", "first", "left", "right"), place).alias("e"))
    earliest = saved(earliest.where("low < high").drop("high"))
    later = found.join(earliest.hint("merge"), ["gram", "window"]).where(place > F.col("low"))
    back, on = _same(F.col("left"), F.col("e.left")), _same(F.col("right"), F.col("e.right"))
    return later.select(
        "id", "content", (F.col("first") - back).alias("first"), (F.col("last") + on).alias("last"),
        F.col("e.id").alias("from_id"), (F.col("e.first") - back).alias("from_first"))


def cut(text: bytes, runs: list[dict]) -> tuple[bytes, int, int]:
    """The text without the runs; its lines with a word, and how many of them went."""
    lines = text.split(b"\n")
    full = [bool(line.strip()) for line in lines]
    n = sum(full)
    edge = np.zeros(n + 1, np.int64)
    for run in runs:
        edge[run["first"]] += 1
        edge[run["last"] + 1] -= 1
    gone = np.cumsum(edge[:n]) > 0
    kept, at, dropped = [], 0, False
    for line, is_full in zip(lines, full, strict=True):
        if is_full:
            dropped = bool(gone[at])
            at += 1
        if not dropped:
            kept.append(line)
    return b"\n".join(kept), n, int(gone.sum())


def without_repeats(docs: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """All rows of ``docs`` with their columns, the text cut, and n_lines and n_deleted as columns
    ``__n_lines`` and ``__n_deleted``."""
    runs = saved(repeated_runs(docs, noise, guarantee).groupBy("id", "content").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")))
    left = docs.select(F.struct("*").alias(_ROW), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64("text").alias("content"))
    joined = left.join(runs.hint("merge"), ["id", "content"], "left").select(f"{_ROW}.*", F.col("runs").alias("__runs"))
    text_at = docs.columns.index("text")

    def rows(batches):
        for batch in batches:
            columns = batch.columns[:-1]
            out = [cut(t.encode(), r or []) if t is not None else (None, 0, 0)
                   for t, r in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            columns[text_at] = pa.array([None if x[0] is None else x[0].decode() for x in out], batch.schema.field(text_at).type)
            columns += [pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "__n_lines", "__n_deleted"])

    schema = docs.select("*", F.lit(0).cast("long").alias("__n_lines"), F.lit(0).cast("long").alias("__n_deleted")).schema
    return joined.mapInArrow(alone(rows), schema)
