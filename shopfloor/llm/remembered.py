"""What a worker remembers of strings that repeat, and what it gives back when a task ends.

A Python worker outlives its tasks and serves any operator of the session, beside the others and the JVM, so what
one operator has learnt would stay for the rest of the session."""

from __future__ import annotations

import ctypes

import pyarrow as pa

REMEMBERED_BYTES = 64 << 20
LONGEST_REMEMBERED = 64


class Remembered:
    """Bytes by short string, in at most about ``limit`` bytes: what wasn't asked for lately goes first."""

    def __init__(self, make, limit: int = REMEMBERED_BYTES):
        self.make, self.limit = make, limit // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def __getitem__(self, key: str) -> bytes:
        known = self.new.get(key)
        if known is not None:
            return known
        known = self.old.get(key)
        if known is None:
            known = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if self.size > self.limit:
                self.old, self.new, self.size = self.new, {}, 0
            self.new[key] = known
            self.size += 190 + len(key) * (1 if key.isascii() else 4) + len(known)
        return known


#: Cached loaders whose tables grow with use; only what has been imported in this worker.
LOADERS: list = []


def grows(loader):
    """Marks a cached loader as one that other operators' tasks empty."""
    LOADERS.append(loader)
    return loader


def alone(rows):
    """``rows`` of a task that uses none of the loaders: their tables go first, and what the task has freed at its end."""
    def run(batches):
        forget()
        try:
            yield from rows(batches)
        finally:
            give_back()
    return run


def forget() -> None:
    for loader in LOADERS:
        loader.cache_clear()


def give_back() -> None:
    """Freed memory goes to the system; the allocators would keep it for the worker's next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim is not None:
        trim(0)
