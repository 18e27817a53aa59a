"""Jaccard join of documents' word shingles: size-banded tiles, bitmap bounds, exact intersection.

Two sets with a Jaccard similarity of t or more share one of their rarest (1 - t) n + 1 shingles and
differ in size by a factor of 1 / t at most. So every set enters the tiles of its rarest shingles, each a
shingle and a size band, and is compared in those of its own band and of the bands below that a similar
set can be in; a tile above TILE_ROWS is divided into blocks, which its visitors all go through. Each set has a signature of 512 bits, the parities of its
shingles' hashes: bits in which two signatures differ count shingles that are in one set alone, so the
intersection can't be above (n + m - differing bits) / 2. Pairs that this bound leaves are compared
exactly, as sorted arrays.

What grows with the data stays in tables. Documents of equal sets are one set from the start. First
each set is compared with its tiles' first set; what is linked then has a label, and only pairs of sets
with different labels remain in a tile, so that groups of near copies aren't compared all with all. The
order of rarity comes from counts of all shingles in COUNTERS classes; any order gives the same links.

Cases: null and empty texts have no shingles and link with nothing; shorter texts than a shingle are
one shingle; a null doc_id is never the smallest of its group (null only if all are), but its text links
like any other; repeated rows give a row each, and so do several texts under one id, each in the group of
its own text; an empty table gives none; other columns are left out. Shingles and sets are told apart by
64 bit hashes; texts are fetched by their set, so ids play no part in what links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shopfloor.llm.components import components
from shopfloor.llm.remembered import alone
from shopfloor.llm.text import id_and_bytes, saved, shingle_set, split_words, steps, texts

COUNTERS = 1 << 16
BITS = 512
SIGNATURE = [f"s{i}" for i in range(BITS // 64)]
FILTER_BITS = 1 << 24
SEEN_SETS = 100_000
TILE_ROWS = 512


def _class(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(48)).astype(np.int64)


def _set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def signature(shingles: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parities of how many shingles fall on each bit; ``bits`` is a power of two."""
    place = ((shingles >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def fine_signature(shingles: np.ndarray) -> bytes:
    return signature(shingles, max(BITS, 1 << (len(shingles) - 1).bit_length())).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Of two signatures; the longer is folded, which adds up the parities of its halves."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(batches):
    """(doc ids, shingle sets) of the batches' texts, slice by slice."""
    for batch, w in steps(batches):
        hashes = w.hashes(lower=True)
        yield batch.column("doc_id"), [shingle_set(hashes[a:b]) for a, b in zip(w.first, w.first[1:], strict=False)]


def describe(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, n, set_id, signature) and, at the end of each task, a row for each
    counter class (``class`` not null) with its count in n."""
    names = ["class", "doc_id", "n", "set_id", "fine", *SIGNATURE]

    def rows(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for ids, sets in _sets(batches):
            for s in sets:
                counts += np.bincount(_class(s), minlength=COUNTERS) if len(s) > COUNTERS else 0
                if len(s) <= COUNTERS:
                    np.add.at(counts, _class(s), 1)
            signatures = np.array([signature(s) for s in sets]).reshape(len(sets), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(sets), pa.int32()), ids, pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([fine_signature(s) if len(s) else None for s in sets], pa.binary()),
                 *(pa.array(signatures[:, i], pa.int64()) for i in range(signatures.shape[1]))], names)
        used = np.flatnonzero(counts)
        gone = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), gone, pa.array(counts[used], pa.int64()), gone,
             pa.nulls(len(used), pa.binary()), *[gone] * len(SIGNATURE)], names)

    ddl = "class int, doc_id long, n long, set_id long, fine binary, " + ", ".join(f"{s} long" for s in SIGNATURE)
    return id_and_bytes(docs).mapInArrow(alone(rows), ddl)


def rarity(described: DataFrame) -> np.ndarray:
    """Each class's rank by its count in all documents. The driver gets at most COUNTERS rows."""
    counts = np.zeros(COUNTERS, np.int64)
    for row in described.where("class is not null").groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[row["class"]] = row["n"]
    return np.argsort(np.argsort(counts, kind="stable")).astype(np.uint16)


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefixes(docs: DataFrame, ranks: np.ndarray, percent: int) -> DataFrame:
    """(shingle, set_id) of each set's rarest shingles, as many as a similar set can't all lack."""
    order = docs.sparkSession.sparkContext.broadcast(ranks)

    def rows(batches):
        seen = Seen()
        for _, sets in _sets(batches):
            shingles, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for s in sets:
                if not len(s) or not seen.new(key := _set_id(s)):
                    continue
                first = np.argsort(order.value[_class(s)], kind="stable")[:prefix_size(len(s), percent)]
                shingles.append(s[first])
                owners.append(np.full(len(first), key))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64)),
                                              pa.array(np.concatenate(owners))], ["shingle", "set_id"])

    return id_and_bytes(docs).mapInArrow(alone(rows), "shingle long, set_id long")


def may_link(a: str, b: str, percent: int) -> Column:
    """Size band and bitmap bound of two sets, with columns prefixed ``a`` and ``b``."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SIGNATURE[1:]),
                F.bit_count(F.col(f"{a}.{SIGNATURE[0]}").bitwiseXOR(F.col(f"{b}.{SIGNATURE[0]}"))))
    common = F.floor((n + m - apart) / 2)
    in_band = (100 * n >= percent * m) & (100 * m >= percent * n)
    return in_band & (100 * common >= percent * (n + m - common))


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of set ids that both bounds leave."""
    x, y = sets.alias("x"), sets.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.set_id")).join(y, F.col("b") == F.col("y.set_id"))
    both = both.where(may_link("x", "y", percent)).select(
        "a", "b", F.col("x.n").alias("n"), F.col("y.n").alias("m"), F.col("x.fine").alias("f"), F.col("y.fine").alias("g"))

    def bound(batches):
        for batch in batches:
            keep = []
            for i, (n, m, f, g) in enumerate(zip(*(batch.column(c).to_pylist() for c in "nmfg"), strict=True)):
                common = (n + m - differing_bits(f, g)) // 2
                if 100 * common >= percent * (n + m - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int32()))

    return saved(both.mapInArrow(alone(bound), "a long, b long"))


def _described_sets(described: DataFrame) -> DataFrame:
    """One row a set: set_id, n, signatures and its smallest doc_id."""
    return described.where("set_id is not null").groupBy("set_id").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("doc_id"), F.first("fine").alias("fine"), *(F.first(s).alias(s) for s in SIGNATURE))


class Seen:
    """Set ids a task has had lately, to leave out most repetitions; a bounded number."""

    def __init__(self):
        self.ids: set[int] = set()

    def new(self, key: int) -> bool:
        if key in self.ids:
            return False
        if len(self.ids) >= SEEN_SETS:
            self.ids.clear()
        self.ids.add(key)
        return True


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id and a text of each of the set ids in ``wanted``, which are distinct.

    A filter of FILTER_BITS bits, whatever the number of sets, keeps most other texts from being shuffled."""
    spot = F.pmod("set_id", F.lit(FILTER_BITS)) + 1  # a set's id is a hash, so its low bits spread
    maps = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect()
    every = np.zeros((FILTER_BITS // 32768 + 1, 4096), np.uint8)
    for row in maps:
        every[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    bits = docs.sparkSession.sparkContext.broadcast(every)

    def tagged(batches):
        seen = Seen()
        for batch, w in steps(batches):
            hashes = w.hashes(lower=True)
            sets = [shingle_set(hashes[a:b]) for a, b in zip(w.first, w.first[1:], strict=False)]
            keys = np.array([_set_id(s) for s in sets], np.int64)
            at = [i for i in np.flatnonzero(likely(keys)) if len(sets[i]) and seen.new(int(keys[i]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at], pa.int64()), batch.column("text").take(pa.array(at, pa.int32()))], ["set_id", "text"])

    def likely(keys):
        at = keys % FILTER_BITS
        part, position = at // 32768 + 1, at % 32768  # as bitmap_bucket_number counts
        return bits.value[part, position // 8] >> (position % 8).astype(np.uint8) & 1

    # One Python step a task: a worker that a second one needs stays, with its memory, for later stages.
    rows = id_and_bytes(docs).mapInArrow(alone(tagged), "set_id long, text binary")
    return rows.join(wanted.hint("merge"), "set_id").dropDuplicates(["set_id"])


def _verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) of the pairs of set ids whose sets are similar, by intersecting sorted arrays."""
    wanted = saved(pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct())
    found = saved(_texts_of(docs, wanted))
    both = pairs.join(found.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(found.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")

    def compare(batches):
        last = (None, None)  # rows with one a follow each other
        for batch in batches:
            a, b, keep = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            left, right = batch.column("text_a"), batch.column("text_b")
            for i in range(batch.num_rows):
                if last[0] != a[i]:
                    last = (a[i], _set_of(left.slice(i, 1)))
                x, y = last[1], _set_of(right.slice(i, 1))
                common = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()),
                                              pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return saved(both.select("a", "b", "text_a", "text_b").mapInArrow(alone(compare), "a long, b long"))


def _set_of(text: pa.Array) -> np.ndarray:
    return shingle_set(split_words(*texts(text)).hashes(lower=True))


def band(n: Column, percent: int) -> Column:
    """Size band; sets in bands more than one apart differ by more than the factor 100 / percent."""
    return F.floor(F.log(n) / F.log(F.lit(100.0 / percent))).cast("int")


def _unlike_pairs(marked: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the sets that share a tile, have different labels and pass both bounds.

    ``marked``: shingle, set_id, label, n and signatures of sets in tiles with more than one label."""
    marked = marked.withColumn("band", band(F.col("n"), percent))
    blocks = saved(marked.groupBy("shingle", "band").agg(
        F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("blocks")))
    tiles = marked.join(blocks, ["shingle", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int")).drop("blocks")
    least = F.ceil(F.col("n") * percent / 100)
    visits = marked.withColumn("band", F.explode(F.sequence(band(least, percent), F.col("band"))))
    visits = visits.join(blocks, ["shingle", "band"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    x, y = tiles.alias("x"), visits.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("shingle", "band", "block")]
    smaller = F.struct("x.n", "x.set_id") < F.struct("y.n", "y.set_id")
    pairs = x.join(y, [*same, smaller, F.col("x.label") != F.col("y.label"), may_link("x", "y", percent)])
    return pairs.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()


def _grouped(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n and set_id of each document (null without words); and of each set its root (a set_id that
    stands for the group) and the smallest doc_id of the group. Both are written tables.

    Tables on either side of a join on a key that may be common are written first, so that the join reads
    plain shuffles, which adaptive execution can split; those that grow with the input are merged at every
    size."""
    described = saved(describe(docs))
    rows = saved(prefixes(docs, rarity(described), percent))
    described = described.where("class is null")
    sets = saved(_described_sets(described))

    first = rows.groupBy("shingle").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last"))
    first = saved(first.where("first < last").select("shingle", "first"))
    tiles = saved(rows.join(first.hint("merge"), "shingle").select("shingle", "set_id", "first").distinct())
    pairs = tiles.where("first <> set_id").select(
        F.least("first", "set_id").alias("a"), F.greatest("first", "set_id").alias("b")).distinct()
    links = _verified(docs, _bounded(pairs, sets, percent), percent)
    labels = saved(components(links))

    # Pairs of a tile that have no label in common yet.
    marked = tiles.join(labels, tiles["set_id"] == labels["node"], "left").select(
        "shingle", "set_id", F.coalesce("label", "set_id").alias("label"))
    mixed = saved(marked.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                  .where("low < high").select("shingle"))
    marked = saved(marked.join(mixed, "shingle").join(sets.drop("fine", "doc_id"), "set_id"))
    pairs = _unlike_pairs(marked, percent).join(links, ["a", "b"], "left_anti")
    more = _verified(docs, _bounded(pairs, sets, percent), percent)
    labels = saved(components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more)))

    rooted = sets.select("set_id", "doc_id").join(labels, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "doc_id", F.coalesce("label", "set_id").alias("root"))
    lowest = saved(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    by_set = saved(rooted.join(lowest, "root").select("set_id", "root", "component_id"))
    return described.select("doc_id", F.col("n").alias("n_shingles"), "set_id"), by_set


def similar_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, set_id and component_id (smallest doc_id that links reach) of each document."""
    described, by_set = _grouped(docs, percent)
    columns = ["doc_id", "n_shingles", "set_id", "component_id"]
    return described.where("set_id is not null").join(by_set.hint("merge"), "set_id").select(*columns).union(
        described.where("set_id is null").withColumn("component_id", F.col("doc_id")).select(*columns))


def _with_set_id(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their set_id as ``__set``; null without words."""
    names = docs.columns

    def rows(batches):
        for batch in batches:
            both = pa.RecordBatch.from_arrays(
                [pa.nulls(batch.num_rows, pa.int64()), batch.column(names.index("text")).cast(pa.large_binary())],
                ["doc_id", "text"])
            ids = [_set_id(s) if len(s) else None for _, sets in _sets(iter([both])) for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], [*names, "__set"])

    return docs.mapInArrow(alone(rows), StructType([*docs.schema.fields, StructField("__set", LongType())]))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that represent their group, all columns as they were: of each group one row,
    that with the smallest doc_id (null last) and, of one id's texts, the smallest set_id.

    Documents without words all stay. Of several rows with the chosen id and set, the one with the least
    values stays; rows are told apart by their text, not by their id."""
    described, by_set = _grouped(docs, percent)
    counted = described.where("set_id is not null").groupBy("doc_id", "set_id").agg(F.count(F.lit(1)).alias("rows"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_id", "rows")
    chosen = saved(counted.join(by_set, "set_id").groupBy("root").agg(F.min(key).alias("k")).select(
        F.col("k.set_id").alias("__chosen"), F.col("k.doc_id").alias("__id"), F.col("k.rows").alias("__rows")))
    # Documents without words have no set: they are dealt out by their ids, and match nothing.
    tagged = _with_set_id(docs).withColumn("__key", F.coalesce("__set", F.xxhash64("doc_id")))
    kept = tagged.join(chosen.hint("merge"), (F.col("__key") == F.col("__chosen")) & F.col("__set").isNotNull()
                       & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    kept = kept.where("__set is null or __chosen is not null")
    if chosen.where("__rows > 1").isEmpty():
        return kept.select(*docs.columns)
    kept, whole = saved(kept), F.struct(*docs.columns)
    values = [f.name for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    several = kept.where("__rows > 1").groupBy("__set").agg(
        F.min_by(whole, F.struct(*values)).alias("row")).select("row.*")
    return kept.where("__set is null or __rows = 1").select(*docs.columns).union(several)
