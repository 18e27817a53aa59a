"""Each operator against brute force or a round trip, over the cases its docstring names."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shopfloor.llm import arc_warc, bpe_transducer, classifier_chain, jaccard_tiles, line_winnow
from shopfloor.llm import multi_index, pareto_mix, preference, pretoken, quality_bands, queries, token_count
from shopfloor.llm.components import components
from tests.conftest import SF001
from tests.oracle_compare import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(7)


def prose(n):
    return " ".join("".join(RNG.choice("aeioubcdst") for _ in range(RNG.randint(2, 8))) for _ in range(n))


BASE = "\n".join(prose(30) for _ in range(4))
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.replace("a", "e", 1), "en", "b"),
    (4, None, None, None), (5, "", "en", "b"), (6, "one two", "en", None), (7, "one two", "de", "c"),
    (8, " \t\n\x0b ", "en", "c"), (9, prose(40) + "\n" + BASE.split("\n")[1] + "\n" + BASE.split("\n")[2], "fr", "c"),
    (None, BASE, "en", "c"), (None, prose(60), "en", "a"), (10, "spam " * 500, "en", "b"),
    (11, base64.b64encode(RNG.randbytes(6000)).decode(), "en", "a"), (12, "日本語 é🙂 don't 'll <|endoftext|> 123  x\n\n y", "ja", "b"),
    (13, prose(20_000), "en", "a"), (14, "x" * 50_000, "en", "c"),
] + [(20 + i, prose(RNG.randint(5, 300)), "en", "abc"[i % 3]) for i in range(20)]
SCHEMA = "doc_id long, text string, lang string, source string, size long, target double, set_id string"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with every awkward case, and extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, -1, 0.5, "x") for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_by(df, *names):
    return sorted(([r[n] for n in names] for r in df.collect()), key=repr)


def test_quality_counts_and_bands(docs, none):
    def counts(text):
        words = WORD.findall(text or "")
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        often = collections.Counter(grams)
        inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                len(lines) - len(set(lines)), len(inside), failed]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = quality_bands.quality(docs)
    assert rows_by(out, "doc_id", *names) == sorted(([r[0], *counts(r[1])] for r in ROWS), key=repr)
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert 1 in kept and 13 in kept and not kept & {4, 5, 6, 8, 10, 11, 14}
    passed = quality_bands.passing(docs)
    assert passed.schema == docs.schema and passed.count() == out.where("kept").count()
    assert quality_bands.quality(none).count() == 0 and quality_bands.passing(none).count() == 0


def test_line_dedup_deletes_exactly_what_an_earlier_place_has(docs, none):
    out = line_winnow.without_repeats(docs)
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() == len(ROWS)
    got = {(r["doc_id"], r["__n_lines"]): r for r in out.collect()}
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[1] == BASE and text[2] == "" and text[4] is None and text[5] == ""
    assert text[9].count("\n") == 0 and got[9, 3]["__n_deleted"] == 2
    assert text[13] == ROWS[15][1]
    assert line_winnow.without_repeats(none).count() == 0
    runs = [{"first": 1, "last": 2}]
    assert line_winnow.cut(b"a\nb\n\nc\n \nd", runs) == (b"a\nd", 4, 2)


def test_winnowing_finds_every_repeated_run():
    for _ in range(200):
        shared = [prose(RNG.randint(1, 60)).encode() for _ in range(RNG.randint(1, 6))]
        if sum(len(x.split()) for x in shared) < 50:
            continue
        prints = []
        for _ in range(2):
            lines = [prose(RNG.randint(1, 60)).encode() for _ in range(3)] + shared + [prose(3).encode()] * 2
            digests = [hashlib.blake2b(x, digest_size=8).digest() for x in lines]
            prints.append({g for g, *_ in line_winnow.fingerprints(digests, [len(x.split()) for x in lines], 25, 50)})
        assert prints[0] & prints[1]


def test_search_recall_and_edge_cases(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1500, 16))
    points[700:1200] = points[5]  # one very common vector
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    odd = [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [1.0, None] * 8),
           (3400, [1.0] * 5), (None, [1.0] * 16), (3500, [float("inf")] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = multi_index.search(df, F.col("vec_id") % 100 == 0).collect()
    found = total = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((points - points[q])**2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(1500), d))[:10]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r["score"] == d[r["vec_id"]] for r in mine)
        found += len({r["vec_id"] for r in mine} & set(best.tolist()))
        total += 10
    assert found / total >= 0.9 and max(r["query_id"] for r in got) < 1500
    assert multi_index.search(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert multi_index.search(few, F.col("vec_id") == 0).count() == 2


@pytest.fixture(scope="module")
def texts():
    out = [r[1] or "" for r in ROWS]
    alphabet = "ab cdé日本語🙂\n\t  '123=- ̀ñS"
    out += ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 60))) for _ in range(500)]
    out += ["".join(RNG.choice(["it's", "we'll", "'", " 'd", "the", "tion", "<|endoftext|>"]) for _ in range(20)) for _ in range(100)]
    return out + [RNG.randbytes(80).decode("utf-8", "replace") for _ in range(200)]


def test_token_counts_equal_the_library(docs, none, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    mine = token_count.load(path)
    assert [mine.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    out = token_count.token_counts(docs, path)
    want = [[r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)] for r in ROWS]
    assert rows_by(out, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in out.collect())
    assert token_count.token_counts(none, path).count() == 0


def test_transducer_equals_the_library_and_decodes(docs, none, texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert pretoken.PATTERN == public_tokenizers.PATTERN
    codec = bpe_transducer.load(path)
    for t in texts:
        assert list(codec.encode(t)) == library.encode_ordinary(t)
        assert b"".join(codec.decode(codec.encode(t), block=3)) == t.encode()
    small = bpe_transducer.Transducer(ranks, max_bytes=20_000)  # the table is emptied again and again
    assert all(small.encode(p.encode()) == library.encode_ordinary(p) for p in pretoken.split(" ".join(texts[20:60])))
    long = "".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))  # and within one piece
    assert small.encode(long.encode()) == library.encode_ordinary(long) and small.bytes < 40_000
    rows = []
    for r in ROWS:
        ids = np.array(library.encode_ordinary(r[1] or ""), "<u4")
        rows.append([r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()])
    out = bpe_transducer.round_trip(docs, path)
    assert rows_by(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(rows, key=repr)
    assert bpe_transducer.round_trip(none, path).count() == 0
    assert [len(r["ids"]) for r in bpe_transducer.encode_column(docs.where("doc_id = 6"), path).collect()] == [2]


def test_utf8_stream_mends_like_the_standard():
    for _ in range(5000):
        raw = bytes(RNG.choice([RNG.randrange(256), 0xE3, 0x81, 0xF0, 0x9F, 0x41, 0xED, 0xA0]) for _ in range(RNG.randint(0, 9)))
        stream = bpe_transducer.Utf8Stream()
        out = b"".join(stream.feed(raw[i:i + 2]) for i in range(0, len(raw), 2)) + stream.finish()
        assert out == raw.decode("utf-8", "replace").encode()


def test_preferences(spark, monkeypatch):
    turns = [("user", "q"), ("assistant", "a"), ("user", None), ("assistant", "b")]
    pairs = [(1, turns, [*turns[:3], ("assistant", "c")]), (2, turns, turns), (3, turns, turns[:2]), (4, turns, None),
             (5, [], turns), (6, turns, [("system", "s")])]
    kind = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(pairs, f"pair_id long, chosen {kind}, rejected {kind}")
    out = {r["pair_id"]: r for r in preference.format_preferences(df).collect()}
    assert [out[i]["status"] for i in range(1, 7)] == ["ok", "identical", "empty", "unpaired", "unpaired", "ok"]
    assert [out[i]["n_prefix"] for i in (1, 2, 3, 6)] == [3, 4, 2, 0]
    assert out[1]["prompt"].endswith("<|im_start|>user\n<|im_end|>\n") and out[6]["prompt"] == ""
    for i in (1, 3, 6):
        for side in ("chosen", "rejected"):
            assert sum(p["chars"] for p in out[i][f"{side}_mask"]) == len(out[i][side])
    trained, at = [], 0
    for p in out[6]["chosen_mask"]:
        trained += [out[6]["chosen"][at:at + p["chars"]]] if p["train"] else []
        at += p["chars"]
    assert trained == ["a<|im_end|>", "b<|im_end|>"]
    talk = [(1, 0, "user", "q"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (2, None, None, None),
            (2, 1, "assistant", "y"), (None, 0, "assistant", "z"), (3, 0, "user", "w")]
    made = preference.swapped_replies(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))
    assert {r["pair_id"]: r["rejected"] and r["rejected"][-1]["text"] for r in made.collect()} == {1: "y", 2: None, 3: None}
    assert {r["pair_id"]: r["chosen"] is None for r in made.collect()} == {1: False, 2: False, 3: True}
    gaps = [(i * i * 10**9, "r%d" % i if i % 3 else None) for i in range(1, 60)]
    talk = [(c, 0, "user", "q") for c, _ in gaps] + [(c, 1, "assistant", r) for c, r in gaps if r]
    monkeypatch.setattr(preference, "RANGE_ROWS", 7)
    made = preference.swapped_replies(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))
    replies = [(c, r) for c, r in gaps if r]
    want = {c: None for c, _ in gaps} | {c: after for (c, _), (_, after) in zip(replies, replies[1:])}
    assert {r["pair_id"]: r["rejected"] and r["rejected"][-1]["text"] for r in made.collect()} == want
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.format_preferences(preference.swapped_replies(empty)).count() == 0


def test_arc_versions_and_archives():
    pages = [(i, f"http://x.example/{i} a", RNG.randbytes(300)) for i in range(40)]
    blobs = list(arc_warc.arc_archives(pages, "0.arc.gz", limit=3000))
    assert len(blobs) > 3
    read = [[r for r in arc_warc.read_arc(b + b"\n")] for b in blobs]
    assert [len(r[1].fields) for r in read[:2]] == [5, 10]
    assert [arc_warc.http_parts(r.content)[2] for rs in read for r in rs[1:]] == [p[2] for p in pages]
    plain = b"filedesc://x 0.0.0.0 20200101 text/plain 14\n1 0 t\nURL ...\n\nhttp://a b 1.2.3.4 19990102030405 text/html 3\nabc\n"
    record = list(arc_warc.read_arc(plain))[1]
    assert record.fields["url"] == "http://a b" and record.content == b"abc"
    assert arc_warc.timestamp("19990102030405") == "1999-01-02T03:04:05Z"
    for broken in (plain.replace(b"text/html 3", b"text/html 300"), plain.replace(b"1 0 t", b"7 0 t"), blobs[0][:-9]):
        with pytest.raises(ValueError):
            list(arc_warc.read_arc(broken))


def test_archive_round_trip(spark):
    big = "<p>" + "é" * 600
    rows = [(1, "http://a", big), (2, None, big), (2, None, big), (3, "http://c", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (None, "u", big), (None, "u", "n" * 2000), (None, "v", "n" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    out = rows_by(arc_warc.archive_round_trip(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and page != 2
        want.append([page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None])
    assert out == sorted(want, key=repr)
    assert arc_warc.archive_round_trip(df.limit(0)).count() == 0


def brute_components(rows):
    sets = []
    for r in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    lowest = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return sorted(([r[0], len(s), lowest[g]] for r, s, g in zip(rows, sets, group)), key=repr)


def test_jaccard_join(spark, docs, none):
    out = jaccard_tiles.similar_documents(docs)
    assert rows_by(out, "doc_id", "n_shingles", "component_id") == brute_components(ROWS)
    kept = jaccard_tiles.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 4, 5, 6, 8}
    assert not {r["doc_id"] for r in kept.collect()} & {2, 3, 7}
    assert jaccard_tiles.similar_documents(none).count() == 0
    base, rows = prose(120).split(" "), []
    for i in range(60):  # a chain and a crowd of near copies around the limit
        words = list(base)
        for _ in range(RNG.randint(0, 5)):
            words[RNG.randrange(len(words))] = prose(1)
        rows.append((i, " ".join(words)))
    got = jaccard_tiles.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_by(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_bound_never_cuts_a_similar_pair():
    rng = np.random.default_rng(1)
    for n in (3, 40, 700, 5000):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[:int(n * 0.8)], rng.integers(0, 2**63, n // 3).astype(np.uint64)]))
        apart = len(np.setxor1d(x, y))
        assert jaccard_tiles.differing_bits(jaccard_tiles.fine_signature(x), jaccard_tiles.fine_signature(y)) <= apart


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 105), (105, 103), (103, 100), (200, 200)]
    out = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(31)} | {i: 100 for i in (100, 103, 105)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chain_on_held_out_rows(spark, none):
    def text(toxic):
        words = prose(80).split(" ")
        if toxic:
            words.insert(RNG.randrange(80), RNG.choice(["grobian", "grobiane,", "Scoundrel."]))
        return " ".join(words)
    rows = [(i, text(i % 5 == 0)) for i in range(1200)] + [(None, "x"), (2000, None), (2001, "")]
    labels = [(i, int(i % 5 != 0 and i % 2), int(i % 5 == 0)) for i in range(600)] + [(5, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("x"))
    chain = classifier_chain.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                                   classifier_chain.label_categories())
    out = classifier_chain.score(docs, chain).collect()
    assert len(out) == len(rows)
    held = [(r["toxic"], r["doc_id"] % 5 == 0) for r in out if r["doc_id"] is not None and 600 <= r["doc_id"] < 1200]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert len(chain.weights[1]) == 1 + len(chain.known.hashes) + 1  # the first category's log odds come last
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    unknown = classifier_chain.train(docs, empty, classifier_chain.label_categories())
    assert not any(r["toxic"] for r in classifier_chain.score(docs, unknown).collect())
    assert classifier_chain.score(none, chain).count() == 0


def test_mix(docs, none):
    out = pareto_mix.mix(docs)
    got = out.collect()
    assert rows_by(out, "doc_id", "size") == sorted(([r[0], len(WORD.findall(r[1] or ""))] for r in ROWS), key=repr)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in got)
    target = {r["source"]: r["target"] for r in got}
    own = {r["source"]: r["source_size"] for r in got}
    assert abs(sum(target.values()) - sum(own.values())) < 1e-6 * sum(own.values())
    assert all(target[s] <= 3 * own[s] + 1e-6 for s in own)
    mixed = pareto_mix.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert pareto_mix.mix(none).count() == 0 and pareto_mix.mixed(none).count() == 0


def test_ranges_don_t_change_the_sample(docs, monkeypatch):
    want = rows_by(pareto_mix.mix(docs), "doc_id", "size", "taken")
    monkeypatch.setattr(pareto_mix, "RANGE_ROWS", 2)
    assert rows_by(pareto_mix.mix(docs), "doc_id", "size", "taken") == want


def test_queries_equal_their_sql(spark):
    res = compare(spark, list(queries.SQL), SF001, verbose=False)
    assert all(res.values()), res


def test_pipeline_stages(spark, docs):
    """Every stage against brute force on its own input."""
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, "")
    ids = {r["doc_id"] for r in quality_bands.quality(docs).where("kept").collect()}
    assert good.schema == docs.schema and {r["doc_id"] for r in good.collect()} == ids
    cut = stages["line dedup"](spark, good, "")
    assert cut.columns == docs.columns and 2 not in {r["doc_id"] for r in cut.collect()}
    near = stages["n-gram Jaccard join"](spark, cut, "")
    lowest = {c for _, _, c in brute_components([(r["doc_id"], r["text"]) for r in cut.collect()])}
    assert {r["doc_id"] for r in near.collect()} == lowest
    mixed = stages["mixing sources to target weights"](spark, near, "")
    copies = {r["doc_id"]: r["copies"] for r in pareto_mix.mix(near).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == copies
    last = stages["byte-level BPE encoding and decoding"](spark, mixed, "")
    assert sorted(r["decoded_sha256"] for r in last.collect()) == sorted(
        hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in mixed.collect())
