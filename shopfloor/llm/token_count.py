"""Token counts by heap-and-linked-list byte-pair merging.

A piece starts as one symbol a byte, in a doubly linked list. A heap holds the mergeable adjacent
pairs by rank, then place. The lowest is popped again and again, its two symbols become one and the
new neighbours' pairs are pushed. The count is the initial symbols minus the merges; no identifiers
are made. Pieces repeat, so each worker remembers the counts of a bounded number of them.

Cases: null text counts as empty (0 tokens); bytes that aren't UTF-8 count as U+FFFD; a special
token's string inside a text is one token; rows with null doc_id and repeated rows are counted each
for itself; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from shopfloor.llm.pretoken import split
from shopfloor.llm.text import id_and_bytes

REMEMBERED = 1_000_000


class Remembered(dict):
    """Results by piece; emptied when full. Long pieces hardly repeat and aren't kept."""

    def __init__(self, make, limit: int = REMEMBERED):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, piece: str):
        out = self.make(piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = out
        return out


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class MergeCounter:
    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: list[str] = ()):
        symbols = byte_symbols()
        self.first = [vocabulary[symbols[b]] for b in range(256)]
        #: (left << 32 | right) -> rank, and what each rank's merge makes
        self.rank = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocabulary[a + b] for a, b in merges]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.counts = Remembered(lambda piece: self.merged(piece.encode()))

    def merged(self, piece: bytes) -> int:
        """Symbols left of the piece when no pair can be merged any more."""
        symbol = [self.first[b] for b in piece]
        n, rank_of, made = len(symbol), self.rank.get, self.made
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [rank << 32 | i for i in range(n - 1)
                if (rank := rank_of(symbol[i] << 32 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j < 0 or symbol[i] < 0 or rank_of(symbol[i] << 32 | symbol[j]) != rank:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j] = made[rank], -1
            merges += 1
            left, right = before[i], after[j]
            after[i] = right
            if right >= 0:
                before[right] = i
                if (rank := rank_of(symbol[i] << 32 | symbol[right])) is not None:
                    heapq.heappush(heap, rank << 32 | i)
            if left >= 0 and (rank := rank_of(symbol[left] << 32 | symbol[i])) is not None:
                heapq.heappush(heap, rank << 32 | left)
        return n - merges

    def count(self, text: str) -> int:
        parts = [text] if self.special is None else self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, split(p))) for p in parts)


@lru_cache(maxsize=2)
def load(path: str) -> MergeCounter:
    """From a byte-level ``.json`` vocabulary; once a worker."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
    special = [t["content"] for t in file.get("added_tokens", []) if t["special"]]
    return MergeCounter(file["model"]["vocab"], merges, special)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every text. No shuffle.

    ``vocabulary``: the vocabulary file's path, the same on every executor."""
    def count(batches):
        counter = load(vocabulary)
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column("text")]
            strings = [t.decode("utf-8", "replace") for t in texts]
            tokens = [counter.count(t) for t in strings]
            sizes = [len(t.encode()) for t in strings]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_bytes(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
