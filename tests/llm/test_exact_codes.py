"""Prefix BPE against the library, the filter audit against a loop over documents, whitening against numpy."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopfloor.llm import filter_audit, prefix_bpe, queries, remembered, whitening
from tests.conftest import SF001
from tests.oracle_compare import compare

RNG = random.Random(11)
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made_texts():
    letters = "aeioutsrnhldcé日ü'"
    out = ["".join(RNG.choice(letters) for _ in range(RNG.randint(1, 30))) for _ in range(4000)]
    out += [c * n for c in "abeo-=!.#é日" for n in range(1, 60)]
    bits = ["<|endoftext|>", "<|startoftext|>", " ", "it's", "WE'LL", "<|", "|>", "\x1c", "\x85", "Σ", "ΑΣ", "ß", "İ",
            "\n", "é", "̣́", "̣᷶", "1234", " ", " ", "🙂", "</w>", "\U00010d50", "՘"]
    out += ["".join(RNG.choice(bits) for _ in range(12)) for _ in range(3000)]
    out += ["".join(chr(RNG.choice([RNG.randrange(0xD800), RNG.randrange(0xE000, 0x110000), RNG.randrange(0x300)]))
                    for _ in range(15)) for _ in range(4000)]
    return [*out, "", " \n", "x" * 30_000, "ab" * 20_000 + " " + "\U0001f642" * 5_000]


def test_prefix_encoder_equals_the_library(library):
    mine, texts = prefix_bpe.load(PATH), made_texts()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = mine.encode(text)
        assert list(ids) == want.ids, text
        decoded = library.decode(want.ids, skip_special_tokens=False)
        assert mine.decode(ids) == decoded
        digest = hashlib.sha256(" ".join(map(str, want.ids)).encode()).hexdigest()
        assert mine.digests(text) == (len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest())


def test_every_character_goes_the_library_s_way(library):
    mine = prefix_bpe.load(PATH)
    texts = [f"a{chr(c)}A1 {chr(c)}" for c in range(0, 0x30000) if not 0xD800 <= c < 0xE000]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(mine.encode(text)) == want.ids, text


def test_what_is_remembered_stays_bounded_and_right(library):
    mine = prefix_bpe.load(PATH)
    small = remembered.Remembered(lambda p: bytes(p, "utf-8"), limit=4000)
    for _ in range(5000):
        key = str(RNG.randrange(300))
        assert small[key] == key.encode()
    assert 190 * (len(small.new) + len(small.old)) < 5000
    mine.encoder.forget()
    assert list(mine.encode("hello again")) == library.encode("hello again", add_special_tokens=False).ids


def test_automaton_finds_every_suffix():
    strings = [tuple(RNG.choice(b"abc") for _ in range(RNG.randint(1, 7))) for _ in range(60)]
    automaton = prefix_bpe.SuffixAutomaton(strings)
    parts = {s[i:j] for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for part in parts:
        state = automaton.find(part)
        assert automaton.size[automaton.link[state]] < len(part) <= automaton.size[state]
        ends = {(k, i + len(part)) for k, s in enumerate(strings) for i in range(len(s)) if s[i:i + len(part)] == part}
        for n in range(1, len(part)):  # the states on the links are those with more ends
            suffix = part[n:]
            more = {(k, i + len(suffix)) for k, s in enumerate(strings) for i in range(len(s)) if s[i:i + len(suffix)] == suffix}
            assert (automaton.find(suffix) == state) == (more == ends)


ROWS = [
    (1, "Word " * 300, "en"), (2, "Word " * 300, "en"), (2, "Word " * 300, "de"), (3, None, None), (4, "", ""),
    (None, "", "en"), (None, "Word " * 300, "en"), (5, "a b c # d", "fr"), (6, "a b c # d", "en"),
    (7, " ".join(f"w{i}" for i in range(250)), "en"), (8, " ".join(f"W{i}" for i in range(250)), "en"),
    (8, "other", "en"), (9, "x y é\x0bz\x1cq" * 90, "fr"), (10, " ".join(f"v{i}" for i in range(70_000)), "en"),
    (11, "\t\n ", "xx"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (5, 1, 1), (5, 0, 0), (7, None, 1), (8, 1, None), (None, 1, 1), (10, 1, 0)]


def loop_audit(rows, labels):
    quality = collections.defaultdict(lambda: [0, 0])
    for doc, good, toxic in labels:
        if doc is not None:
            quality[doc] = [max(quality[doc][0], good == 1), max(quality[doc][1], toxic == 1)]
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    judged = collections.defaultdict(list)
    for doc, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": doc is not None and doc > first[text]}
        judged[lang or ""].append(({f for f in fails if fails[f]}, *(quality[doc] if doc is not None else (0, 0))))
    out = []
    for part, docs in judged.items():
        by_filter = collections.Counter()
        made = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                by_filter[f] += len(gone)
                left = [d for d in left if f not in d[0]]
                made.append([part, "".join(order), step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                             sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone), f])
        out += [[*m[:-1], by_filter[m[-1]]] for m in made]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit_equals_a_loop(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, lang string, n long, part string")
    labels = spark.createDataFrame([(*r, 7) for r in LABELS], "doc_id long, quality int, toxic int, mask int")
    got = sorted([r[c] for c in AUDIT] for r in filter_audit.audit(docs.repartition(5), labels).collect())
    assert got == loop_audit(ROWS, LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    bare = filter_audit.audit(docs, labels.limit(0))
    assert bare.count() == 600 * 5 and bare.agg(F.sum("good_lost")).first()[0] == 0


def test_filter_audit_with_own_filters(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "bb", "x"), (3, "a", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = filter_audit.audit(docs, labels, {"S": F.length("text") < 2}).collect()
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in out}
    assert got == {("SE", 1): (1, 2, 0, 3), ("SE", 2): (1, 0, 1, 1), ("ES", 1): (2, 1, 0, 1), ("ES", 2): (1, 1, 1, 3)}


def test_filter_audit_equals_its_sql(spark):
    assert all(compare(spark, ["op12_filter_audit"], SF001, verbose=False).values())


def test_solver_equals_numpy():
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    base = np.linalg.qr(rng.normal(size=(300, 40)))[0]
    base = np.linalg.qr(base - base.mean(0))[0]
    close = np.r_[10 + np.arange(8) * 1e-12, 3 + np.arange(12) * 1e-8, np.ones(20)]
    zero = rng.normal(size=(200, 40))
    zero[:, 4], zero[:, 9] = 0, zero[:, 8]
    for rows in (rng.normal(size=(500, 40)), rng.normal(size=(500, 40)) * np.logspace(0, -6, 40), base @ np.diag(close) @ turn,
                 rng.normal(size=(90, 4)) @ rng.normal(size=(4, 40)), rng.normal(size=(6, 40)), zero, np.diag(np.arange(1.0, 41)),
                 rng.normal(size=(9, 1)), np.eye(40)):
        rows = rows - rows.mean(0)
        values, vectors, trace = whitening.principal(whitening.triangle(rows), len(rows))
        covariance = rows.T @ rows / len(rows)
        want = np.linalg.eigvalsh(covariance)[::-1]
        k = len(values)
        assert k == min(32, (want > 1e-13 * want[0]).sum())
        assert np.allclose(values, want[:k], rtol=1e-10) and abs(trace / want.sum() - 1) < 1e-10
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-9
        assert np.abs(covariance @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert whitening.principal(np.zeros((3, 3)), 5)[0].size == 0


def test_dqds_is_accurate_for_small_values():
    q, e = [1.0, 1e-8, 1e-12, 1e-16], [1e-3, 1e-9, 1e-20]
    from fractions import Fraction
    b = np.zeros((4, 4))
    b[range(4), range(4)] = np.sqrt(q)
    b[range(3), range(1, 4)] = np.sqrt(e)
    product = Fraction(1)
    for x in q:
        product *= Fraction(x)
    found = whitening.dqds(q, e)
    got = Fraction(1)
    for x in found:
        got *= Fraction(x)
    assert abs(float(got / product) - 1) < 1e-13  # the determinant, which small values decide as much as large ones


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(700, 12)).astype(np.float32) * np.linspace(3, 0.5, 12).astype(np.float32)
    points[100:400] = points[5]
    rows = [(i if i % 50 else None, [float(x) for x in p]) for i, p in enumerate(points)]
    odd = [(3000, None), (3100, []), (3200, [float("nan")] * 12), (3300, [1.0, None] * 6), (3400, [1.0] * 5),
           (3500, [float("-inf")] * 12), (3600, [1e30] * 12)]
    extra = [(4000, [0.0] * 12), (1, rows[1][1])]
    df = spark.createDataFrame(rows + odd + extra, "vec_id long, embedding array<float>").withColumn("n", F.lit(1))
    got = whitening.whiten(df.repartition(7)).collect()
    x = np.floor(np.array([r[1] for r in rows + extra]) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(0)]
    away = x - x.mean(0)
    covariance = away.T @ away / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = away @ (vectors / np.sqrt(values))
    want = collections.defaultdict(list)
    for (vec, _), own, line in zip(rows + extra, x.tolist(), white, strict=True):
        deviation = sum((n * a - s)**2 for a, s in zip(own, sums, strict=True))
        for c in range(12):
            want[vec, c + 1, deviation].append(abs(line[c]))
    mine = collections.defaultdict(list)
    for r in got:
        mine[r["vec_id"], r["component"], r["deviation"]].append(abs(r["whitened"]))
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
        assert 0 <= r["identity_error"] < 1e-9
    assert mine.keys() == want.keys()
    assert all(np.allclose(sorted(mine[k]), sorted(want[k]), rtol=1e-6, atol=1e-9) for k in want)


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(df).count() == 0 and whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(50)], "vec_id long, embedding array<double>")
    out = whitening.whiten(line).collect()
    assert len(out) == 50 and abs(out[0]["explained"] - 1) < 1e-12


def test_sums_are_exact_and_large_deviations_null():
    n, sums = 3, [2**53 + 7, -5]
    x = np.array([[2**51, 4], [2**40 + 1, -9], [2**53 + 7 - 2**51 - 2**40 - 1, 0]], np.int64)
    want = [sum((n * int(a) - s)**2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert whitening.deviations(x, n, sums) == [w if w < 2**63 else None for w in want]
    near = np.array([[2**20, 3], [2**20 + 5, 4], [2**20 - 5, 5]], np.int64)
    total = [int(v) for v in near.sum(0)]
    assert whitening.deviations(near, 3, total) == [sum((3 * int(a) - s)**2 for a, s in zip(r, total, strict=True)) for r in near]


def test_new_queries_are_registered():
    assert {"op11_prefix_bpe", "op12_filter_audit", "op13_whitening"} <= queries.QUERIES.keys()
