"""A fitted chain's scores, recomputed in plain Python; features of long runs and other scripts."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from shopfloor.llm import classifier_chain as cc

RNG = random.Random(31)
SEPARATED = "\u00a0\u00ab\u00bb\u2014\u2019\u201c\u2026\u3000\u3001\u3002\u300c\u300d\uff01\uff0c\uff1a\uff1f"


def pieces(text):
    """Bytes of the words, and of the overlapping pieces of long ones, lower case."""
    words = re.findall(f"[^\\x00-@\\[-`{{-\\x7f{SEPARATED}]+", text)
    for word in words:
        word = "".join(c.lower() if c.isascii() else c for c in word).encode()
        yield word[:cc.LONGEST]
        at = cc.LONGEST // 2
        while at + cc.LONGEST // 2 < len(word):
            yield word[at:at + cc.LONGEST]
            at += cc.LONGEST // 2


def hashes(piece):
    out = cc.features(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]))[1]
    return set(out.tolist())


def made():
    texts = ["".join(RNG.choice("abcdeäß日本語" + SEPARATED + " ,.") for _ in range(RNG.randint(0, 120))) for _ in range(300)]
    return [*texts, "x" * 500, "日本語" * 200, "", "a" * 24, "a" * 25, "b" * 36 + "c" * 37]


def test_features_see_all_of_every_word():
    for text in made():
        data = text.encode()
        got = set(cc.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1].tolist()) if data else set()
        assert got == {h for p in pieces(text) for h in hashes(p)}, text
    data = ("日本語" * 50 + "悪" * 12 + "日本語" * 50).encode()  # a word deep inside a paragraph without spaces
    plain = ("日本語" * 104).encode()
    seen = [set(cc.features(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[1].tolist()) for d in (data, plain)]
    assert seen[0] - seen[1]


def test_scores_are_the_chain_s(spark):
    def text(bad):
        words = ["".join(RNG.choice("abcdefgh") for _ in range(5)) for _ in range(30)]
        return " ".join([*words, *(["grobian"] if bad else [])])
    rows = [(i, text(i % 4 == 0)) for i in range(400)] + [(None, "grobian"), (900, None), (3, text(False))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    chains = [cc.train(d, labels, cc.label_categories()) for d in (docs, docs.orderBy(F.desc("text")))]
    assert all(np.array_equal(a, b) for a, b in zip(chains[0].weights, chains[1].weights))  # whatever the order of rows
    chain, number = chains[0], {h: i for i, h in enumerate(chains[0].known.hashes.tolist())}
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, round(r["p_low_quality"], 9), round(r["p_toxic"], 9), r["low_quality"], r["toxic"])
                 for r in cc.score(docs, chain).collect())
    want = []
    for doc, t in rows:
        found = {number[h] for p in pieces(t or "") for h in hashes(p) if h in number}
        odds = []
        for w in chain.weights:
            odds.append(w[0] + sum(w[1 + f] for f in found) + sum(a * b for a, b in zip(w[1 + len(number):], odds)))
        p = [round(1 / (1 + math.exp(-x)), 9) for x in odds]
        want.append((doc is None, doc or 0, *p, *(bool(x > t) for x, t in zip(odds, chain.thresholds))))
    assert got == sorted(want)
