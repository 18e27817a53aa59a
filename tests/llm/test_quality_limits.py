"""The compression bands decide: texts that pass the counts are told apart by their ratios."""

import base64
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shopfloor.llm import quality_bands
from tests.conftest import SF01

RNG = random.Random(11)


def verdicts(texts):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.large_binary())], ["doc_id", "text"])
    return [r for out in quality_bands.judge(iter([batch]), quality_bands.Bands()) for r in out.to_pylist()]


def wrapped(n):
    return base64.encodebytes(RNG.randbytes(n))[:n]


def rows(n):
    lines = (f"{RNG.randrange(10**4)} buy cheap {RNG.randrange(10**4)} pills now {RNG.randrange(10**4)} here" for _ in range(n // 20))
    return "\n".join(lines).encode()[:n]


def keys(n):
    return "\n".join(RNG.randbytes(32).hex() for _ in range(n // 65 + 1)).encode()[:n]


@pytest.mark.parametrize("make, sizes", [
    (wrapped, (800, 1000, 1500, 2500, 8000, 30_000, 300_000)), (rows, (600, 1000, 2500, 8000, 30_000)), (keys, (21_000, 50_000, 300_000))])
def test_what_passes_the_counts_is_rejected_by_ratio(make, sizes):
    found = verdicts([make(n) for n in sizes])
    assert not any(r["base_failed"] for r in found) and not any(r["kept"] for r in found)


def clean():
    tables = [pq.read_table(f"{SF01}/{name}.parquet").to_pylist() for name in ("documents", "labels")]
    good = {r["doc_id"] for r in tables[1] if r["quality"] == 1}
    return [r["text"].encode() for r in tables[0] if r["doc_id"] in good and r["text"]]


def test_clean_texts_of_every_length_are_kept():
    texts = clean()
    long = max(texts, key=len)
    pieces = [" ".join(long.decode().split()[:n]).encode() for n in range(10, len(long.split()), 97)]
    found = verdicts(texts + pieces)
    assert len(texts) > 100 and len(pieces) > 10
    assert all(r["kept"] for r in found if not r["base_failed"])


def test_last_part_and_a_part_of_the_text_count():
    text = max(clean(), key=len)[:4096]
    tail, third = verdicts([text[:1024] + wrapped(1000), text + wrapped(2048)])
    assert tail["chunk_high"] == 1000 / 2024 and not tail["kept"]
    assert abs(third["chunk_high"] - 1 / 3) < 0.01 and not third["kept"]
