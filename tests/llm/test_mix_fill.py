"""Sources are filled to their targets past documents that don't fit, as a plain loop in order does it."""

import collections
import hashlib

import pyarrow.parquet as pq
import pytest

from shopfloor.llm import pareto_mix
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, source string"


def by_loop(got):
    """(source, doc_id) -> copies, from the targets of ``got``, whose ids are distinct."""
    copies = {}
    for source in {r["source"] for r in got}:
        rows = [r for r in got if r["source"] == source]
        target, own = rows[0]["target"], rows[0]["source_size"]
        expected = min(3.0, target / own) if own else 0.0
        whole = int(expected)
        p = expected - whole
        rest, order = target - whole * own, []
        for r in rows:
            copies[source, r["doc_id"]] = whole
            u = (int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            order += [(u, r["doc_id"], r["size"])] if p else []
        ends = []
        for go_on in (False, True):
            used, taken, over = 0, [], []
            for u, i, size in sorted(order):
                if used + size <= rest and (not over or go_on and size):
                    used += size
                    taken.append(i)
                else:
                    over.append((u, i, size))
            short = rest - used
            near = min(((abs(short - size), u, i) for u, i, size in over if abs(short - size) < short), default=None)
            ends.append((near[0] if near else short, go_on, [*taken, near[2]] if near else taken))
        for i in min(ends)[2]:
            copies[source, i] += 1
    return copies


@pytest.mark.parametrize("ranges", [2048, 3])
def test_one_very_long_document_leaves_no_gap(spark, monkeypatch, ranges):
    monkeypatch.setattr(pareto_mix, "RANGE_ROWS", ranges)
    rows = [(1000 * s + i, "w " * (1200 if i == s else 5 + 7 * i % 23), f"s{s}") for s in range(6) for i in range(150)]
    rows += [(9000 + i, "w " * (4 + i), None) for i in range(30)]
    got = pareto_mix.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["source"], r["doc_id"]): r["copies"] for r in got} == by_loop(got)
    taken = collections.Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    target = {r["source"]: r["target"] for r in got}
    small = sum(len(t.split()) for _, t, s in rows if s == "s0") - 1200  # words of a source without the long one
    own = {r["source"]: r["source_size"] for r in got}
    reach = [s for s in target if s and target[s] % own[s] <= small]
    assert len(reach) >= 2 and all(abs(taken[s] - target[s]) <= 28 for s in reach), (taken, target)


def test_given_sources_come_near_their_targets(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = pareto_mix.mix(docs).collect()
    assert len(got) == pq.read_table(f"{SF001}/documents.parquet").num_rows
    assert {(r["source"], r["doc_id"]): r["copies"] for r in got} == by_loop(got)
    mixed = collections.Counter(r["doc_id"] for r in pareto_mix.mixed(docs).collect())
    assert mixed == {r["doc_id"]: r["copies"] for r in got if r["copies"]}
    taken = sum(r["taken"] for r in got if r["source"] == "src19")
    target = next(r["target"] for r in got if r["source"] == "src19")
    assert abs(taken - target) < 0.05 * target
