"""Rows are told apart by their texts: repeated rows, copies with null ids, one id with two texts."""

import random

import pytest

from shopfloor.llm import jaccard_tiles

SCHEMA = "doc_id long, text string, tags map<string,int>"
RNG = random.Random(5)


def prose(n):
    return " ".join("".join(RNG.choice("abcdefgh") for _ in range(7)) for _ in range(n))


A, B, C, D, E = (prose(60) for _ in range(5))
ROWS = [(1, A), (1, A), (1, A.upper()), (2, A), (2, B), (3, C), (3, C), (None, D), (None, D), (None, D.title()),
        (None, C), (4, E), (5, None), (5, None), (6, ""), (None, " "), (7, "one two"), (None, "one two")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, {"k": 1}) for r in ROWS], SCHEMA).repartition(4).cache()


def test_one_row_of_each_group_stays(docs):
    kept = jaccard_tiles.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    of_d = [r for r in got if r[0] is None and r[1] and r[1].lower() == D]
    assert len(of_d) == 1
    assert sorted((r for r in got if r not in of_d), key=repr) == sorted(
        [(1, A.upper()), (2, B), (3, C), (4, E), (5, None), (5, None), (6, ""), (None, " "), (7, "one two")], key=repr)


def nearly(text, n=1):
    """The text with its last n words changed."""
    words = text.split(" ")
    return " ".join(words[:-n] + [prose(1) for _ in range(n)])


def test_links_follow_texts_not_ids(spark):
    x, y, z = prose(90), prose(90), prose(90)
    bridge = nearly(z, 4)
    rows = [(1, y, {}), (1, x, {}), (2, nearly(x), {}), (7, nearly(x, 2), {}),  # one id with two texts
            (None, nearly(y), {}), (9, nearly(y, 2), {}),  # a text with null ids alone
            (None, bridge, {}), (20, z, {}), (30, nearly(bridge, 6), {}),  # which links two others
            (None, "no other text is like this one of eleven words here", {})]
    for order in (rows, rows[::-1]):
        out = jaccard_tiles.similar_documents(spark.createDataFrame(order, SCHEMA).repartition(5)).collect()
        got = sorted(((r["doc_id"], r["component_id"]) for r in out), key=repr)
        assert got == sorted([(1, 1), (1, 1), (2, 1), (7, 1), (None, 1), (9, 1), (None, 20), (20, 20), (30, 20),
                              (None, None)], key=repr)
    kept = jaccard_tiles.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(kept) == 4 and {r["doc_id"] for r in kept} == {1, 20, None}


def test_tiles_are_divided_and_banded(spark, monkeypatch):
    """A passage that many otherwise different documents share, in small blocks, loses no link."""
    monkeypatch.setattr(jaccard_tiles, "TILE_ROWS", 4)
    passage, rows = prose(40), []
    for i in range(40):
        rows.append((i, passage + " " + prose(RNG.randint(2, 60)), {}))
    rows += [(100 + i, rows[i][1] + " " + prose(2), {}) for i in range(0, 40, 3)]
    got = jaccard_tiles.similar_documents(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_shingles", "component_id")
    from tests.llm.test_operators import brute_components
    assert sorted((list(r) for r in got.collect()), key=repr) == brute_components(rows)


def test_texts_are_fetched_in_one_python_step(spark):
    from shopfloor.llm import jaccard_tiles
    from shopfloor.llm.text import saved
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (3, None), (4, "A b c d e f")], "doc_id long, text string")
    sets = saved(jaccard_tiles.describe(docs).where("set_id is not null").select("doc_id", "set_id"))
    found = jaccard_tiles._texts_of(docs, sets.where("doc_id = 2").select("set_id"))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r.set_id, bytes(r.text)) for r in found.join(sets, "set_id").select("set_id", "text").collect()] == [
        (sets.where("doc_id = 2").first().set_id, b"g h i j k l")]
