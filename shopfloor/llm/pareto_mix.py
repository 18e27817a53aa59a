"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by its weight, at most CAP times its own words; what is cut off
goes to the others by weight until none is above. A document's expected copies are target / words of
its source, times its rate if a rate column is named. The whole copies are certain. The rest is its
inclusion probability p for one copy more: documents are ranked by (u / (1 - u)) / (p / (1 - p)), with
u drawn from a digest of the id, and taken in this order; one whose words don't fit into what the target
leaves is passed over and the next ones are tried, to the last. Of those passed over one more is taken
if that comes nearer to the target. Where ending at the first that doesn't fit, with one more of the
others, comes nearer than going on, the order ends there. With ``fill=False`` the order always ends at the first that doesn't
fit, which misses the target by up to half of the longest document.

DataFrame functions only. Ranking doesn't gather a source: keys are cut into ranges of about
RANGE_ROWS documents, sums by range find the one in which the target is reached, and only that one is
sorted; going on after it is the same again over the ranges behind and the documents that still fit, in
as many rounds as it takes. The table of sources (one row each, from an aggregation) is ranked in one window.

Cases: null text has no words; null is a source of its own, the last; null doc_id ranks as the smallest
id; rows with equal id, source and size are taken or left together; words that don't exist make empty
targets; an empty table gives none; extra columns are kept by ``mixed``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.text import saved

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
RANGE_ROWS = 2048
NO_ID = -(2**63)
_PREFIX = "__mix_"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    marks = F.regexp_replace(text, f"{space}*+{word}++{space}*+", "x")
    return F.when(text.rlike(word), F.length(marks)).otherwise(F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number inside (0, 1) from the id, the same in every run."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string"))), 1, 13), 16, 10)
    return (digits.cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, documents, target: one row a source."""
    exact = "decimal(38,0)"
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    chosen = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", chosen.cast("long")).withColumn("limit", F.col("source_size") * cap)
    # From the lowest limit a weight on: a source stops at its limit if the share that those before
    # it have left is above. After the first that doesn't, none does.
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, on = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    sources = sources.withColumns({
        "all": F.sum("source_size").over(every),
        "gone": F.coalesce(F.sum("limit").over(before), F.lit(0)),
        "left": F.sum("weight").over(on)})
    stops = F.col("limit").cast(exact) * F.col("left") <= (F.col("all") - F.col("gone")).cast(exact) * F.col("weight")
    sources = sources.withColumn("stops", stops)
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(every)
    shared = F.col("all") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("limit"))).over(every), F.lit(0))
    sources = sources.withColumns({"free": free, "shared": shared})
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(
        (F.col("shared") * F.col("weight")).cast("double") / F.col("free"))
    return sources.select("source", "source_size", "documents", target.alias("target"))


def _keyed(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Adds copies expected and certain, the ranking key's place in (0, 1) and its range."""
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["of"])).drop("of")
    expected = F.when(F.col("weighted") > 0, F.least(F.lit(float(CAP)), F.col("target") / F.col("weighted") * F.col("rate")))
    rows = rows.withColumn("expected", F.coalesce(expected, F.lit(0.0)))
    rows = rows.withColumn("whole", F.floor("expected"))
    rows = rows.withColumn("p", F.col("expected") - F.col("whole"))
    u, usual = uniform(F.col("id"), seed), F.col("usual") / (1 - F.col("usual"))
    key = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("key", F.when((F.col("p") > 0) & (F.col("usual") > 0), key))
    # usual: the probability at rate 1, with which the places are even
    rows = rows.withColumn("place", F.col("key") * usual / (1 + F.col("key") * usual))
    return rows.withColumn("range", F.floor(F.col("place") * F.col("ranges")))


def _after(limit: str) -> Column:
    """Whether a row ranks after the last one taken in the range."""
    place, at, size = F.col(f"{limit}.place"), F.col(f"{limit}.id"), F.col(f"{limit}.size")
    return (F.col("place") > place) | (F.col("place") == place) & (
        (F.col("id") > at) | (F.col("id") == at) & (F.col("size") > size))


def _filled(left: DataFrame, state: DataFrame) -> DataFrame:
    """Those of ``left`` that are taken if each one that fits is, in order: of, id, size, place, words.

    ``state`` has of, rest, used and done, the last range that was gone through. A round takes all that
    fit up to the range in which they no longer do, and goes through that one row by row. The driver
    gets one row a round."""
    rounds = []
    while True:
        now = left.join(state.withColumnRenamed("of", "s"), F.col("of").eqNullSafe(F.col("s"))).drop("s").where(
            "range > done and used + words <= rest")
        upto = F.col("used") + F.sum("words").over(Window.partitionBy("of").orderBy("range"))
        by_range = now.groupBy("of", "range", "rest", "used").agg(F.sum("words").alias("words")).withColumn("upto", upto)
        reached = saved(by_range.groupBy("of", "rest", "used").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.col("range"))).alias("at"),
            F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("before")))
        if reached.isEmpty():
            break
        ends = reached.select(F.col("of").alias("s"), "at", F.coalesce("before", "used").alias("before"))
        now = now.join(ends, F.col("of").eqNullSafe(F.col("s"))).drop("s")
        unit = F.struct("place", "id", "size", "words")
        start = F.struct(F.col("before").alias("used"),
                         F.array().cast("array<struct<place:double,id:long,size:long,words:long>>").alias("taken"))

        def step(done: Column, x: Column) -> Column:
            more = F.struct((done["used"] + x["words"]).alias("used"), F.concat(done["taken"], F.array(x)).alias("taken"))
            return F.when(more["used"] <= F.col("rest"), more).otherwise(done)

        inside = now.where("range = at").groupBy("of", "rest", "before").agg(F.sort_array(F.collect_list(unit)).alias("units"))
        inside = inside.select("of", F.explode(F.aggregate("units", start, step)["taken"]).alias("unit"))
        whole = now.where("at is null or range < at").select("of", unit.alias("unit"))
        rounds.append(saved(whole.union(inside).select("of", "unit.*")))
        sums = rounds[-1].groupBy(F.col("of").alias("s")).agg(F.sum("words").alias("words"))
        state = reached.where("at is not null").join(sums, F.col("of").eqNullSafe(F.col("s"))).select(
            "of", "rest", (F.col("used") + F.col("words")).alias("used"), F.col("at").alias("done"))
    none = left.where(F.lit(False)).select("of", "place", "id", "size", "words")
    return reduce(DataFrame.union, rounds, none)


def _nearest(limits: DataFrame, left_out: DataFrame) -> DataFrame:
    """of, last, limit, the row of ``left_out`` that comes nearer to the target (more) and how far from it
    the source ends (away)."""
    short = F.col("rest") - F.col("used")
    away = F.abs(short - F.col("words"))
    nearer = left_out.where(away < short).groupBy(F.col("of").alias("s")).agg(
        F.min(F.struct(away.alias("away"), "place", "id", "size")).alias("more"))
    return limits.join(nearer, F.col("of").eqNullSafe(F.col("s")), "left").select(
        "of", "last", "limit", "more", F.coalesce("more.away", short).alias("away"))


def decide(sizes: DataFrame, weights=WEIGHTS, seed: str = SEED,
           fill: bool = True) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """What rows of (source, id, size, rate) need to know: (sources, limits), both a row a source, and
    the rows (of, id, size, place) that are taken after the first that didn't fit."""
    plain = targets(sizes, weights)
    weighted = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rate")).alias("weighted"))
    weighted = weighted.withColumnRenamed("source", "of")
    sources = plain.join(weighted, plain["source"].eqNullSafe(weighted["of"])).drop("of")
    usual = F.coalesce(F.least(F.lit(float(CAP)), F.col("target") / F.nullif(F.col("weighted"), F.lit(0.0))), F.lit(0.0))
    sources = saved(sources.withColumnRenamed("source", "of").withColumns({
        "usual": usual - F.floor(usual),
        "ranges": F.ceil(F.col("documents") / RANGE_ROWS)}))

    units = sizes.groupBy("source", "id", "size", "rate").agg(F.count(F.lit(1)).alias("rows"))
    units = saved(_keyed(units, sources, seed).withColumn("words", F.col("size") * F.col("rows")).select(
        "source", "id", "size", "words", "target", "whole", "place", "range", "key"))
    rest = units.groupBy("source").agg((F.max("target") - F.sum(F.col("whole") * F.col("words"))).alias("rest"))
    rest = rest.withColumnRenamed("source", "of")
    by_range = units.where("key is not null").groupBy("source", "range").agg(F.sum("words").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
    by_range = by_range.withColumn("upto", upto)
    reached = by_range.join(rest, by_range["source"].eqNullSafe(rest["of"])).where("upto > rest").groupBy("of").agg(
        F.min("range").alias("last"), F.min_by(F.col("upto") - F.col("words"), "range").alias("before"))
    reached = rest.withColumnRenamed("of", "source").join(
        reached, F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("source", "of")

    inside = units.where("key is not null").join(
        reached, units["source"].eqNullSafe(reached["of"]) & (F.col("range") == F.col("last"))).drop("of")
    running = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("place", "id", "size"))
    fits = inside.withColumn("upto", running).where("upto <= rest").groupBy("source").agg(
        F.max(F.struct("place", "id", "size")).alias("limit"), F.max("upto").alias("taken"))
    limits = reached.join(fits.withColumnRenamed("source", "s"), F.col("of").eqNullSafe(F.col("s")), "left").select(
        "of", "rest", "last", "limit", F.coalesce("taken", "before").alias("used"))
    limits = saved(limits)

    left_out = units.where("key is not null").join(limits, units["source"].eqNullSafe(limits["of"])).where(
        F.col("last").isNotNull() & ~_chosen())
    filled = None
    if fill:
        left = saved(left_out.where("words > 0 and used + words <= rest").groupBy("of", "range", "place", "id", "size").agg(
            F.sum("words").alias("words")))
        every = saved(_filled(left, limits.select("of", "rest", "used", F.lit(-1).cast("long").alias("done"))))
        sums = every.groupBy(F.col("of").alias("s")).agg(F.sum("words").alias("more"))
        full = limits.join(sums, F.col("of").eqNullSafe(F.col("s")), "left").select(
            "of", "rest", "last", "limit", (F.col("used") + F.coalesce("more", F.lit(0))).alias("used"))
        f, u = every.alias("f"), left_out.drop("rest", "last", "limit", "used").alias("u")
        over = u.join(f, [F.col("u.of").eqNullSafe(F.col("f.of")), *(F.col(f"u.{c}") == F.col(f"f.{c}") for c in ("id", "size", "place"))],
                      "left_anti")
        stop, full = _nearest(limits, left_out).alias("a"), _nearest(full, over.join(
            full.withColumnRenamed("of", "s"), F.col("of").eqNullSafe(F.col("s"))).drop("s")).alias("b")
        both = stop.join(full, F.col("a.of").eqNullSafe(F.col("b.of")))
        better = F.coalesce(F.col("b.away") < F.col("a.away"), F.lit(False))
        limits = saved(both.select("a.of", "a.last", "a.limit", better.alias("better"),
                                   F.when(better, F.col("b.more")).otherwise(F.col("a.more")).alias("more")))
        filled = saved(every.join(limits.where("better").select(F.col("of").alias("s")), F.col("of").eqNullSafe(F.col("s"))).drop("s"))
        return sources, limits.drop("better"), filled
    return sources, saved(_nearest(limits, left_out).drop("away")), filled


def _chosen() -> Column:
    """Whether a row with a key is among those taken in order."""
    in_last = (F.col("range") == F.col("last")) & F.col("limit").isNotNull() & ~F.coalesce(_after("limit"), F.lit(False))
    return F.col("last").isNull() | (F.col("range") < F.col("last")) | in_last


def _with_copies(rows: DataFrame, sources: DataFrame, limits: DataFrame, filled: DataFrame | None, seed: str) -> DataFrame:
    rows = _keyed(rows, sources, seed).withColumn("filled", F.lit(False))
    if filled is not None:
        f, same = filled.alias("f"), [F.col(f"r.{c}") == F.col(f"f.{c}") for c in ("id", "size", "place")]
        rows = rows.alias("r").join(f, [F.col("r.source").eqNullSafe(F.col("f.of")), *same], "left").select(
            *(F.col(f"r.{c}") for c in rows.columns if c != "filled"), F.col("f.words").isNotNull().alias("filled"))
    rows = rows.join(limits, rows["source"].eqNullSafe(limits["of"])).drop("of")
    more = F.coalesce((F.col("id") == F.col("more.id")) & (F.col("size") == F.col("more.size"))
                      & (F.col("place") == F.col("more.place")), F.lit(False))
    extra = F.col("key").isNotNull() & (_chosen() | F.col("filled") | more)
    return rows.withColumn("copies", (F.col("whole") + extra.cast("long")).cast("long"))


def _parts(docs: DataFrame, rate: str | None) -> dict[str, Column]:
    return {"source": F.col("source"), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
            "size": word_count(F.col("text")), "rate": F.col(rate).cast("double") if rate else F.lit(1.0)}


def mix(docs: DataFrame, weights=WEIGHTS, seed: str = SEED, rate: str | None = None, fill: bool = True) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (words with repeats) of every document."""
    sizes = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              *(c.alias(name) for name, c in _parts(docs, rate).items())))
    sources, limits, filled = decide(sizes, weights, seed, fill)
    rows = _with_copies(sizes, sources, limits, filled, seed)
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, seed: str = SEED, rate: str | None = None, fill: bool = True) -> DataFrame:
    """The mix: rows of ``docs``, all columns, each as often as it is taken."""
    sizes = saved(docs.select(*(c.alias(name) for name, c in _parts(docs, rate).items())))
    sources, limits, filled = decide(sizes, weights, seed, fill)
    rows = docs.select(F.struct("*").alias(f"{_PREFIX}row"), *(c.alias(name) for name, c in _parts(docs, rate).items()))
    rows = _with_copies(rows, sources, limits, filled, seed).where("copies > 0")
    rows = rows.select(f"{_PREFIX}row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*(F.col(f"{_PREFIX}row")[name].alias(name) for name in docs.columns))


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, COALESCE(doc_id, -9223372036854775808) AS id,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         3 * source_size AS lim, SUM(source_size) OVER () AS total FROM s),
c AS (SELECT *, COALESCE(SUM(lim) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
         SUM(weight) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight FROM w),
t AS (SELECT *, lim * rest_weight <= (total - gone) * weight AS stops FROM c),
g AS (SELECT source, source_size, CASE WHEN stops THEN CAST(lim AS DOUBLE) ELSE
         CAST((total - COALESCE(SUM(CASE WHEN stops THEN lim END) OVER (), 0)) * weight AS DOUBLE)
         / CAST(SUM(CASE WHEN NOT stops THEN weight END) OVER () AS DOUBLE) END AS target FROM t),
e AS (SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN LEAST(3e0, g.target / CAST(g.source_size AS DOUBLE) * 1e0) ELSE 0e0 END AS expected,
         (CAST(CAST('0x' || substr(md5('mix:' || CAST(id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 5e-1) / 4503599627370496e0 AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, CAST(floor(expected) AS BIGINT) AS whole, expected - floor(expected) AS p FROM e),
k AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) * (p / (1 - p)) / (1 + (u / (1 - u)) / (p / (1 - p)) * (p / (1 - p))) END AS place FROM p),
r AS (SELECT *, target - SUM(whole * size) OVER (PARTITION BY source) AS rest,
         DENSE_RANK() OVER (ORDER BY source NULLS LAST) AS grp FROM k),
units AS (SELECT grp, place, id, size, MAX(rest) AS rest, SUM(size) AS words,
            ROW_NUMBER() OVER (PARTITION BY grp ORDER BY place, id, size) AS nth FROM r WHERE place IS NOT NULL GROUP BY grp, place, id, size),
-- in order: stopped is whether one before it didn't fit, taken whether it fits itself
walk AS (
  SELECT grp, nth, words <= rest AS taken, FALSE AS stopped, CASE WHEN words <= rest THEN words ELSE 0 END AS used,
         words > rest AS past FROM units WHERE nth = 1
  UNION ALL
  SELECT u.grp, u.nth, w.used + u.words <= u.rest AND (u.words > 0 OR NOT w.past), w.past,
         CASE WHEN w.used + u.words <= u.rest THEN w.used + u.words ELSE w.used END, w.past OR w.used + u.words > u.rest
  FROM walk w JOIN units u ON u.grp = w.grp AND u.nth = w.nth + 1),
walked AS (SELECT u.*, w.taken, w.taken AND NOT w.stopped AS in_front, w.used FROM units u JOIN walk w USING (grp, nth)),
sums AS (SELECT *, rest - COALESCE(MAX(CASE WHEN in_front THEN used END) OVER (PARTITION BY grp), 0) AS short_front,
           rest - MAX(used) OVER (PARTITION BY grp) AS short_on FROM walked),
near AS (SELECT *,
  CASE WHEN NOT in_front AND abs(short_front - words) < short_front THEN abs(short_front - words) END AS away_front,
  CASE WHEN NOT taken AND abs(short_on - words) < short_on THEN abs(short_on - words) END AS away_on FROM sums),
ends AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY away_front NULLS LAST, place, id, size) AS nth_front,
  ROW_NUMBER() OVER (PARTITION BY grp ORDER BY away_on NULLS LAST, place, id, size) AS nth_on,
  COALESCE(MIN(away_on) OVER (PARTITION BY grp), short_on) < COALESCE(MIN(away_front) OVER (PARTITION BY grp), short_front) AS goes_on FROM near),
extra AS (SELECT grp, id, size, place,
  CASE WHEN goes_on THEN taken OR (away_on IS NOT NULL AND nth_on = 1)
       ELSE in_front OR (away_front IS NOT NULL AND nth_front = 1) END AS more FROM ends)
SELECT r.doc_id, r.source, r.size, r.source_size, r.target, CAST(r.whole + COALESCE(CAST(e.more AS BIGINT), 0) AS BIGINT) AS copies,
       CAST((r.whole + COALESCE(CAST(e.more AS BIGINT), 0)) * r.size AS BIGINT) AS taken
FROM r LEFT JOIN extra e ON e.grp = r.grp AND e.id = r.id AND e.size = r.size AND e.place = r.place
"""
