"""Line dedup against brute force over all places; searches with repeated rows; archives with many revisits."""

import collections
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from shopfloor.llm import arc_warc, line_winnow, multi_index

RNG = random.Random(21)


def line(n):
    return " ".join("".join(RNG.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def brute_deleted(docs, noise, guarantee):
    """Numbers of the full lines of each document that are in a run of ``guarantee`` words an earlier place has."""
    lines = {i: [x.strip() for x in (t or "").split("\n") if x.strip()] for i, t in docs}
    order = sorted(lines)
    gone = collections.defaultdict(set)
    for d in order:
        mine = lines[d]
        for i in range(len(mine)):
            for e in order:
                if e > d:
                    break
                other = lines[e]
                for j in range(len(other)):
                    if (e, j) >= (d, i):
                        break
                    k = words = 0
                    while i + k < len(mine) and j + k < len(other) and mine[i + k] == other[j + k]:
                        words += len(mine[i + k].split())
                        k += 1
                    whole = i == j == 0 and k == len(mine) == len(other) and words >= noise
                    if words >= guarantee or whole:
                        gone[d] |= set(range(i, i + k))
    return {d: gone[d] for d in order}


def test_every_repeated_line_goes_and_no_other(spark):
    for seed in range(3):
        RNG.seed(seed)
        stock = [line(RNG.choice([1, 4, 9, 15, 26, 55])) for _ in range(14)]
        docs = [(1, line(55)), (2, None), (3, "")]
        w, t = docs[0][1], line(20)
        docs += [(4, f"{w}\n{t}"), (5, f"{w}\n{t}"), (6, f"{t}\n{w}\n{t}"), (7, f" {w} \n\n{t}\n"), (8, line(24)), (9, line(30))]
        docs += [(10, docs[-2][1]), (11, docs[-2][1] + "\n"), (12, docs[-2][1] + "\n" + line(3))]
        for i in range(40):
            at = RNG.randrange(10)
            run = stock[at:at + RNG.randint(1, 5)]
            docs.append((20 + i, "\n".join([line(RNG.randint(1, 30)) for _ in range(RNG.randint(0, 2))] + run * RNG.choice([1, 1, 1, 2])
                                           + [line(RNG.randint(1, 30)) for _ in range(RNG.randint(0, 2))])))
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        want = brute_deleted(docs, line_winnow.NOISE, line_winnow.GUARANTEE)
        for r in line_winnow.without_repeats(df).collect():
            text = dict(docs)[r["doc_id"]]
            full = [x for x in (text or "").split("\n") if x.strip()]
            kept = [x.strip() for i, x in enumerate(full) if i not in want[r["doc_id"]]]
            assert [x.strip() for x in (r["text"] or "").split("\n") if x.strip()] == kept, (seed, r["doc_id"])
            assert (r["__n_lines"], r["__n_deleted"]) == (len(full), len(want[r["doc_id"]]))


def test_windows_reach_every_line():
    for _ in range(300):
        words = [RNG.randint(1, 40) for _ in range(RNG.randint(1, 12))]
        covered = {i for a, b in line_winnow.window_spans(words, 50) for i in range(a, b + 1)}
        assert covered == set(range(len(words)))


def test_repeated_rows_and_ids_of_queries(spark):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(300, 8)).tolist()
    rows = [(i, p) for i, p in enumerate(points)]
    rows += [(100, points[100]), (100, points[100]), (200, points[7]), (None, points[100])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = multi_index.search(df, F.col("vec_id") % 100 == 0, share=1.0).collect()
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))

    def nearest(query, own):
        away = sorted((round(float(np.sqrt(((np.array(v) - np.array(query))**2).sum())), 9), i)
                      for k, (i, v) in enumerate(rows) if k != own and i is not None)
        return [(rank, i, score) for rank, (score, i) in enumerate(away[:10], 1)]

    assert found[0] == nearest(points[0], 0)
    assert found[100] == nearest(points[100], 100)  # one query of three equal rows: the other two come first
    assert [x[:2] for x in found[100][:2]] == [(1, 100), (2, 100)]
    assert sorted(found[200]) == sorted(nearest(points[200], 200) + nearest(points[7], 302))  # two queries under one id


def test_many_revisits_of_one_page(spark):
    common, rare = "<p>" + "c" * 3000, "<p>" + "r" * 1200
    rows = [(i, f"http://x/{i}", common if i % 3 == 0 else rare if i in (50, 70) else f"<p>{i}" * (400 if i % 2 else 3))
            for i in range(300)] + [(None, "http://y", common), (None, None, None)]
    out = arc_warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = {common: 297, rare: 70}.get(html)
        refers = None if refers == page else refers
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in columns) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_archive_joins_have_no_null_keys_or_digests(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, "u", "a" * 2000), (2, "u", "a" * 2000)], "page_id long, url string, html string")
        plan = arc_warc.archive_round_trip(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin(\(skew=\w+\))? \[refers", plan) and "isnotnull(refers" in plan
