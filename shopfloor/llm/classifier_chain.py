"""Toxicity by a classifier chain.

The categories are predicted one after another by linear (logistic) models; each model also gets the
log odds that the earlier ones predict. For training, these come from folds that a model hasn't seen, so
the later models learn from predictions as good as those they will get.

Features are words and the beginnings of words of four to six bytes, lower case, known by 64 bit
hashes; of words longer than LONGEST bytes (in scripts without spaces) pieces that overlap by half stand
for the word, so that all of it counts. Punctuation of any script separates. Those that tell a category apart best (chi square over the sample) are kept, FEATURES in all.

The models are fitted on the driver on a sample of at most SAMPLE_ROWS labelled rows, those with the
lowest hash of the id; features are counted by Spark over the whole texts of the sample. Every document
is scored whole, without a shuffle.

Cases: null and empty texts have no features and get the models' base rates; labels that are null are
left out, and of several for a document the highest counts; of several texts under one id the smallest is
the sample's; without labels of both kinds a category's
probability is the share of its label (0 without any); rows with null doc_id and repeated rows are
scored each for itself; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.text import STEP_BYTES, id_and_bytes, mix, saved, texts

SAMPLE_ROWS = 8192
FEATURES = 1024
LEAST_DOCUMENTS = 5
FOLDS = 5
PREFIXES = (4, 5, 6)
LONGEST = 24
RIDGE, ROUNDS = 1e-3, 150

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Characters above ASCII that separate words, by their first bytes and ranges of the last. Fixed values.
_SEPARATORS = (
    ((0xC2,), ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF))),  # Latin-1 signs but for letters
    ((0xE2, 0x80), ((0x80, 0xBF),)), ((0xE2, 0x81), ((0x80, 0xAF),)),  # general punctuation
    ((0xE3, 0x80), ((0x80, 0x84), (0x88, 0xBF))),  # CJK punctuation
    ((0xEF, 0xBC), ((0x80, 0x8F), (0x9A, 0xA0), (0xBB, 0xBF))), ((0xEF, 0xBD), ((0x80, 0x80), (0x9B, 0xA5))),  # full width
)
_BYTE = np.random.default_rng(20240301).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters."""
    letter = _LETTER[data]
    wide = np.flatnonzero(data >= 0xC2)
    for head, ranges in _SEPARATORS:
        size = len(head) + 1
        at = wide[wide + size <= len(data)]
        for k, byte in enumerate(head):
            at = at[data[at + k] == byte]
        last = data[at + size - 1]
        at = at[np.any([(last >= lo) & (last <= hi) for lo, hi in ranges], axis=0)]
        for k in range(size):
            letter[at + k] = False
    return letter


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every letter run and its beginnings, as numbers and hashes; with repeats.

    Of runs longer than LONGEST bytes there is a piece of that length from every half of it on."""
    letter = letters(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start, end = letter.copy(), letter.copy()
    start[1:] &= ~letter[:-1] | cut[1:-1]
    end[:-1] &= ~letter[1:] | cut[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    half = LONGEST // 2
    more = np.maximum(0, -(-(end - start - LONGEST) // half))
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    start, end = np.concatenate([start, np.repeat(start, more) + nth * half]), np.concatenate([end, np.repeat(end, more)])
    text = np.searchsorted(offsets, start, "right") - 1
    low = _LOWER[data]
    size = np.minimum(end - start, LONGEST)
    state, left = np.zeros(len(start), np.uint64), np.arange(len(start))
    owners, hashes = [], []
    for j in range(LONGEST):
        left = left[size[left] > j]
        if not len(left):
            break
        state[left] = (state[left] ^ _BYTE[low[start[left] + j]]) * _STEP
        if j + 1 in PREFIXES:
            owners.append(text[left])
            hashes.append(mix(state[left] + np.uint64(1)))
    return np.concatenate([text, *owners]), np.concatenate([mix(state), *hashes])


def _slices(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = texts(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            to = min(max(int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, "right")) - 1, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


class Known:
    """The features kept, by number."""

    def __init__(self, hashes: Sequence[int]):
        self.hashes = np.sort(np.array(hashes, np.int64).view(np.uint64))
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature number) without repeats."""
        likely = self.low[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        text, hashes = text[likely], hashes[likely]
        at = np.searchsorted(self.hashes, hashes)
        here = at < len(self.hashes)
        here[here] = self.hashes[at[here]] == hashes[here]
        pairs = np.unique(text[here] * len(self.hashes) + at[here])
        return pairs // max(1, len(self.hashes)), pairs % max(1, len(self.hashes))


@dataclass
class Chain:
    """Weights of each category's model: base, features, then the log odds of the categories before."""

    categories: tuple[str, ...]
    known: Known
    weights: list[np.ndarray]
    thresholds: list[float]

    def log_odds(self, n: int, text: np.ndarray, feature: np.ndarray) -> np.ndarray:
        out = np.zeros((n, len(self.weights)))
        for c, w in enumerate(self.weights):
            sums = np.bincount(text, w[1 + feature], n) if len(text) else np.zeros(n)
            out[:, c] = w[0] + sums + out[:, :c] @ w[1 + len(self.known.hashes):]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; the classes weigh alike."""
    share = y.mean() if len(y) else 0.0
    w = np.zeros(x.shape[1] + 1)
    if share in (0.0, 1.0):
        w[0] = np.log((share + 1e-6) / (1 - share + 1e-6))
        return w
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    lipschitz = 0.25 * (weight @ (1 + (x * x).sum(1))) + RIDGE
    ahead, moment = w.copy(), 1.0
    for _ in range(ROUNDS):
        error = (sigmoid(ahead[0] + x @ ahead[1:]) - y) * weight
        gradient = np.concatenate([[error.sum()], error @ x + RIDGE * ahead[1:]])
        step = ahead - gradient / lipschitz
        following = (1 + np.sqrt(1 + 4 * moment**2)) / 2
        ahead, w, moment = step + (moment - 1) / following * (step - w), step, following
    w[0] += np.log(share / (1 - share))  # back from even classes to those of the sample
    return w


def best_threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """The log odds above which F1 is best, in the middle of the gap there."""
    order = np.argsort(-odds, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    i = int(np.argmax(f1)) if len(y) else 0
    if not len(y) or not y.sum():
        return 0.0
    return float((odds[order[i]] + odds[order[min(i + 1, len(y) - 1)]]) / 2)


def fit_chain(x: np.ndarray, labels: np.ndarray, categories: tuple[str, ...], known: Known) -> Chain:
    fold = np.random.default_rng(5).permutation(len(x)) % FOLDS
    weights, thresholds, unseen = [], [], np.zeros((len(x), len(categories)))
    for c in range(len(categories)):
        full = np.concatenate([x, unseen[:, :c]], axis=1)
        for f in range(FOLDS):
            w = fit_logistic(full[fold != f], labels[fold != f, c])
            unseen[fold == f, c] = w[0] + full[fold == f] @ w[1:]
        thresholds.append(best_threshold(unseen[:, c], labels[:, c]))
        weights.append(fit_logistic(full, labels[:, c]))
    return Chain(categories, known, weights, thresholds)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], rows: int = SAMPLE_ROWS) -> Chain:
    """``categories``: name -> expression on ``labels`` that is 1 or 0, in the order of the chain."""
    names = tuple(categories)
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.cast("double").alias(f"y{i}") for i, c in enumerate(categories.values())))
    labelled = labelled.dropna().groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))))
    # at most ``rows`` rows of a few numbers each
    sample = F.broadcast(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    ys = [f"y{i}" for i in range(len(names))]
    sample = saved(id_and_bytes(docs).join(sample, "doc_id").groupBy("doc_id", *ys).agg(F.min("text").alias("text")))

    def every(batches):
        for batch, data, offsets in _slices(batches):
            text, hashes = features(data, offsets)
            pairs = np.unique(np.rec.fromarrays([text, hashes]))
            text, hashes = pairs["f0"], pairs["f1"].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), *(batch.column(y).take(pa.array(text)) for y in ys)], ["feature", *ys])

    found = sample.mapInArrow(every, "feature long, " + ", ".join(f"{y} double" for y in ys))
    found = saved(found.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys)).where(
        F.col("n") >= LEAST_DOCUMENTS))
    all_rows = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys)).first()
    chosen: set[int] = set()
    for y in ys:
        total, positive = float(all_rows["n"]), float(all_rows[y] or 0)
        if 0 < positive < total:
            a, n = F.col(y), F.col("n")
            chi = F.pow(a * total - n * positive, 2) / (n * (total - n + 0.5) * positive * (total - positive))
            top = found.orderBy(F.desc(chi), "feature").limit(FEATURES // len(names)).collect()
            chosen.update(r["feature"] for r in top)
    known = Known(sorted(chosen))

    def kept(batches):
        for batch, data, offsets in _slices(batches):
            text, feature = known.find(*features(data, offsets))
            first = np.searchsorted(text, np.arange(batch.num_rows + 1))
            lists = [feature[a:b].astype(np.int32) for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(y) for y in ys), pa.array(lists, pa.list_(pa.int32()))],
                ["doc_id", *ys, "features"])

    rows_ = sample.mapInArrow(kept, "doc_id long, " + ", ".join(f"{y} double" for y in ys) + ", features array<int>")
    rows_ = sorted(rows_.collect(), key=lambda r: r["doc_id"])
    x = np.zeros((len(rows_), len(known.hashes)), np.float32)
    for i, r in enumerate(rows_):
        x[i, r["features"]] = 1
    y = np.array([[r[c] for c in ys] for r in rows_]).reshape(len(rows_), len(ys))
    return fit_chain(x, y, names, known)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, and for each category p_<name> and the verdict <name>."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    columns = ["doc_id", *(f"p_{c}" for c in chain.categories), *chain.categories]

    def rows(batches):
        chain = shared.value
        for batch, data, offsets in _slices(batches):
            odds = chain.log_odds(batch.num_rows, *chain.known.find(*features(data, offsets)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(sigmoid(odds[:, c])) for c in range(odds.shape[1])),
                 *(pa.array(odds[:, c] > t) for c, t in enumerate(chain.thresholds))], columns)

    return id_and_bytes(docs).mapInArrow(
        rows, "doc_id long, " + ", ".join([*(f"p_{c} double" for c in chain.categories), *(f"{c} boolean" for c in chain.categories)]))


def label_categories() -> dict[str, Column]:
    """The chain over the columns of ``labels``: low quality, then toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
