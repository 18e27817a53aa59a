"""How filters act on each other when they are applied in a row: an audit over all orders.

Each document's failures are a mask, one bit a filter; what an order of filters does to a document follows
from its mask alone. So Spark counts documents by part and mask (with their labels as weights), and the
rest is algebra on small matrices: M has 0 where a mask fails a filter and infinity elsewhere, P the place
of each filter in each order (the inverse permutation). The min-plus product min over filters of P + M
is the step at which an order removes a mask (infinity: never). Scattering the weights by that step gives
what each step removes; a filter's redundant removals are the masks that fail it and have gone before.

No text and no group travels to one task: texts become digests, equal texts meet by (digest, smallest
doc_id), and rows are combined before each shuffle. A part's table has at most one row a mask.

Cases: null and empty texts are equal empty texts; a null part counts as the empty string; a row with null
doc_id is never a duplicate nor makes one, and has no labels; repeated rows count each, and equal texts
under one doc_id aren't duplicates of each other; of several labels of a doc_id any that is 1 counts; a
label that is null is not 1; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.text import saved

#: A text's words are the longest runs without these.
SPACE = r"[\x20\x09-\x0D]+"
DUPLICATE = "E"
WEIGHTS = ("n", "good", "toxic")


def text_filters() -> dict[str, Column]:
    """Failure conditions on ``text`` and ``words`` by letter, but for duplicates, which need the whole table."""
    n, size = F.size("words"), F.length("text")
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * n,
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > 3 * size,
        "D": F.col("text").rlike("[#$%&*|]"),
    }


def masked(docs: DataFrame, filters: dict[str, Column], part: str = "lang") -> DataFrame:
    """doc_id, part, mask (bit i: fails the i-th filter), digest and n (so many rows are alike)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    rows = rows.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    return rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))


def with_duplicates(rows: DataFrame, bit: int) -> DataFrame:
    """Sets the bit of rows whose digest a smaller doc_id has, too; the digest goes."""
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    found = known.join(first, ["digest", "doc_id"], "left").withColumn(
        "mask", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + bit))
    columns = ["doc_id", "part", "mask", "n"]
    return found.select(*columns).union(rows.where("doc_id is null").select(*columns))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` and whether their documents are labelled good (quality 1) and toxic (1)."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return named.unionByName(nameless).fillna(False, ["good", "toxic"])


def counted(rows: DataFrame) -> DataFrame:
    """part, mask and the three weights: documents, good ones, toxic ones."""
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def removal_steps(orders: np.ndarray, masks: np.ndarray, n_filters: int) -> np.ndarray:
    """[order, mask] -> step (from 1; infinity: never), the min-plus product of the position matrix [order,
    filter] and the mask matrix [filter, mask]."""
    position = np.argsort(orders, axis=1) + 1.0  # the inverse permutations
    mask = np.where(masks[None, :] >> np.arange(n_filters)[:, None] & 1, 0.0, np.inf)
    steps = np.full((len(orders), len(masks)), np.inf)
    for f in range(n_filters):
        np.minimum(steps, position[:, f, None] + mask[f][None, :], out=steps)
    return steps


def audit_part(masks: np.ndarray, weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """By order and step: what is kept, removed, redundant and so on. ``weights`` [3, mask] as in WEIGHTS."""
    n_orders, k = orders.shape
    steps = removal_steps(orders, masks, k)
    gone = np.isfinite(steps)
    which, mask = np.nonzero(gone)
    at = (which, steps[gone].astype(np.int64) - 1)
    removed, good, toxic = np.zeros((3, n_orders, k), np.int64)
    for sums, weight in zip((removed, good, toxic), weights, strict=True):
        np.add.at(sums, at, weight[mask])
    redundant, by_filter = np.zeros((n_orders, k), np.int64), np.zeros(k, np.int64)
    fails = masks[None, :] >> np.arange(k)[:, None] & 1
    for step in range(k):
        f = orders[:, step]
        redundant[:, step] = ((steps < step + 1) * fails[f] * weights[0]).sum(1)
        np.add.at(by_filter, f, removed[:, step])
    alone = np.array([weights[0][masks == 1 << f].sum() for f in range(k)], np.int64)
    return {"kept": weights[0].sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": redundant,
            "unique_fails": alone[orders], "good_lost": good, "toxic_lost": toxic, "shapley": by_filter[orders]}


def audited(counts: DataFrame, letters: str) -> DataFrame:
    """A row per part, order of the filters (``letters``) and step."""
    orders = np.array(list(permutations(range(len(letters)))), np.int64)
    names = ["".join(letters[f] for f in order) for order in orders]
    k = len(letters)
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def audit(table: pa.Table) -> pa.Table:
        masks = table.column("mask").to_numpy().astype(np.int64)
        weights = np.array([table.column(w).to_numpy() for w in WEIGHTS], np.int64)
        found = audit_part(masks, weights, orders)
        n = len(names) * k
        return pa.table([pa.array([table.column("part")[0].as_py()] * n, pa.string()),
                         pa.array(np.repeat(np.array(names, object), k), pa.string()),
                         pa.array(np.tile(np.arange(1, k + 1), len(names)), pa.int32()),
                         *(pa.array(found[c].ravel(), pa.int64()) for c in columns)],
                        ["part", "filter_order", "step", *columns])

    return counts.groupBy("part").applyInArrow(
        audit, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: str = "lang") -> DataFrame:
    """Every order of the filters and of the duplicate filter, by part: part, filter_order, step and the counts.

    ``filters``: failure conditions on ``text`` and its ``words`` by letter; k filters have
    k! orders, so they should be few."""
    filters = text_filters() if filters is None else filters
    rows = saved(masked(docs, filters, part))
    rows = with_labels(with_duplicates(rows, 1 << len(filters)), labels)
    return audited(counted(rows), "".join(filters) + DUPLICATE)


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    map {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
         'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
         'D': regexp_matches(text, '[#$%&*|]'),
         'E': t.doc_id > min(t.doc_id) OVER (PARTITION BY text)} AS fails
  FROM texts t LEFT JOIN marks m USING (doc_id)),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT o.filter_order || l.f FROM orders o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) l
  WHERE NOT contains(o.filter_order, l.f)),
steps AS (SELECT filter_order, s.step, substr(filter_order, s.step, 1) AS f, substr(filter_order, 1, s.step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s WHERE length(filter_order) = 5),
judged AS (
  SELECT m.part, m.n, m.good, m.toxic, s.filter_order, s.step, s.f, coalesce(m.fails[s.f], false) AS bad,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: contains(s.earlier, x) AND coalesce(m.fails[x], false))) > 0 AS gone,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: x <> s.f AND coalesce(m.fails[x], false))) = 0 AS others_pass
  FROM masks m, steps s),
sums AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bad AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bad AND others_pass THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bad AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bad AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM sums
"""
