"""A quality classifier: random-indexing word vectors, pooled per document, and a small network.

Random indexing: every word has a fixed sparse index vector (``SPARKS`` entries of +1 or -1
at places drawn from its hash), and a word's vector is the sum of the index vectors of the
words up to ``WINDOW`` places away, over all texts, brought to unit length. Words are runs of
letters and digits, or runs of other signs, cases kept.

A document's features are the mean and the deviation of its words' vectors, how alike the
index vectors of neighbouring words are, the share of words without a vector, and the
logarithm of its length. A two-layer network, trained in numpy on labelled documents, turns
them into a probability, whose temperature is set on a fifth of the sample kept back.

How it runs: the classifier is fitted on a bounded sample, the labelled training documents
that come first by a hash of their id, whole, as long as they are no more than ``SAMPLE`` and
``SAMPLE_CHARS`` characters. The words found in ``LEAST`` or more of them are the words that
it knows; so their number is bounded by the sample, not by the corpus. Their vectors are
learnt from all texts, training or not (no labels are used): one pass adds up, in each task,
the index vectors around each known word, whatever the words around it are, and the tasks'
sums are added in a tree, a few at a time. A second pass pools and scores. The vectors are
broadcast, ``4 D`` bytes a known word; texts are never shuffled.

Defined cases: a null text is an empty one; a text without words has zero features and the
score these give; repeated rows each get theirs; labels of one document that contradict each
other, and null ones, are left out; a null doc_id is never held out and never labelled; without
labels of both kinds the score of all is the share of label 1, half if there is none; an
empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import settle

D = 32
SPARKS = 2
WINDOW = 2
LEAST = 5
SAMPLE = 10_000
SAMPLE_CHARS = 1 << 26
HIDDEN = 24
ROUNDS = 60
THRESHOLD = 0.7
#: Characters that a task reads at once, but for a longer text.
BLOCK_CHARS = 1 << 21
#: Arrays that are added up in one place.
FAN = 8
WIDTH = 2 * D + WINDOW + 2
_WORD = re.compile(r"\w+|[^\w\s]+")


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, SPARKS) places and signs."""
    place, sign = [], []
    for s in range(SPARKS):
        bits = hashes >> np.uint64(16 * s)
        place.append((bits & np.uint64(D - 1)).astype(np.int64))
        sign.append(1 - 2 * ((bits >> np.uint64(8)) & np.uint64(1)).astype(np.int64))
    return np.stack(place, 1), np.stack(sign, 1)


def _alike(a: np.ndarray, b: np.ndarray, place: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The inner products of the index vectors of words a and words b."""
    out = np.zeros(len(a), np.int64)
    for i in range(SPARKS):
        for j in range(SPARKS):
            out += np.where(place[a, i] == place[b, j], sign[a, i] * sign[b, j], 0)
    return out


@dataclass
class Block:
    """The words of some texts: which word stands where, the words' index vectors, and their numbers among the known ones."""

    sizes: np.ndarray
    flat: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    sign: np.ndarray
    known: np.ndarray  # -1: not known


def split(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def read_block(texts: list[str | None], words: dict[str, int]) -> Block:
    ids: defaultdict[str, int] = defaultdict()
    ids.default_factory = ids.__len__
    found = [split(t) for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter(map(ids.__getitem__, chain.from_iterable(found)), np.int32, int(sizes.sum()))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in ids), np.uint64, len(ids))
    known = np.fromiter((words.get(w, -1) for w in ids), np.int64, len(ids))
    return Block(sizes, flat, np.repeat(np.arange(len(texts)), sizes), *index_vectors(hashes), known)


def around(block: Block, n_words: int) -> np.ndarray:
    """(known words, D): the sum of the index vectors around each, within a text."""
    total = np.zeros(n_words * D)
    for far in range(1, WINDOW + 1):
        near = block.doc[far:] == block.doc[:-far]
        a, b = block.flat[:-far][near], block.flat[far:][near]
        for one, other in ((a, b), (b, a)):
            at = block.known[one]
            has = at >= 0
            for s in range(SPARKS):
                cell = at[has] * D + block.place[other[has], s]
                total += np.bincount(cell, block.sign[other[has], s], n_words * D)
    return total.reshape(n_words, D).astype(np.int64)


def pool(block: Block, vectors: np.ndarray) -> np.ndarray:
    """(texts, WIDTH): the features of each text."""
    m = len(block.sizes)
    out = np.zeros((m, WIDTH))
    size = np.maximum(1, block.sizes)
    at = block.known[block.flat]
    has = at >= 0
    bag, count = np.unique(block.doc[has] * max(1, len(vectors)) + at[has], return_counts=True)
    doc, own = bag // max(1, len(vectors)), vectors[bag % max(1, len(vectors))].astype(np.float64)
    n = np.bincount(doc, count, m)
    some, cuts = n > 0, np.searchsorted(doc, np.flatnonzero(n))
    if len(cuts):
        weighed = own * count[:, None]
        mean = np.add.reduceat(weighed, cuts) / n[some, None]
        out[some, :D] = mean
        out[some, D : 2 * D] = np.sqrt(np.maximum(0.0, np.add.reduceat(weighed * own, cuts) / n[some, None] - mean**2))
    for far in range(1, WINDOW + 1):
        near = block.doc[far:] == block.doc[:-far]
        products = _alike(block.flat[:-far][near], block.flat[far:][near], block.place, block.sign)
        total = np.bincount(block.doc[far:][near], products, m)
        out[:, 2 * D + far - 1] = total / (SPARKS * np.maximum(1, block.sizes - far))
    out[:, -2] = np.where(block.sizes > 0, 1 - n / size, 0)
    out[:, -1] = np.log1p(block.sizes)
    return out


def _cut(texts: list[str | None]) -> Iterator[slice]:
    """Slices of about ``BLOCK_CHARS`` characters."""
    begin, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= BLOCK_CHARS:
            yield slice(begin, i + 1)
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """text and y of the labelled training documents that come first by a hash of their id, in this order (no), one row of each."""
    told = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id")
    agreed = told.agg(F.min("quality").alias("low"), F.max("quality").alias("y")).filter("low = y").select("doc_id", "y")
    mine = docs.filter(~held_out())
    length = F.coalesce(F.char_length("text"), F.lit(0))
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    # Lengths alone go to meet the labels; texts only those of the sample.
    sizes = mine.select("doc_id", length.alias("n")).join(agreed, "doc_id").groupBy("doc_id").agg(F.min("n").alias("n"), F.min("y").alias("y"))
    first = sizes.orderBy(*order).limit(size).collect()  # ``size`` rows at most
    ends = np.cumsum([r.n for r in first])
    chosen = [(i, r.doc_id, r.y) for i, (r, end) in enumerate(zip(first, ends, strict=True)) if end <= chars]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = F.broadcast(docs.sparkSession.createDataFrame(chosen, f"no int, doc_id {kind}, y int"))  # as few
    shortest = F.min(F.struct(length, F.coalesce("text", F.lit("")).alias("text")))["text"]
    return settle(mine.join(ids, "doc_id").groupBy("no").agg(shortest.alias("text"), F.min("y").alias("y")))


def known_words(sampled: DataFrame, least: int = LEAST) -> list[str]:
    """The words found in at least ``least`` texts of the sample."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for t in batch.column(0).to_pylist() for w in set(split(t))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    counted = sampled.select("text").mapInArrow(each, "word string").groupBy("word").count()
    return sorted(r.word for r in counted.filter(F.col("count") >= least).select("word").collect())


def _packed(sums: np.ndarray) -> bytes:
    """Most sums are small: short in bytes, high bytes together."""
    return zlib.compress(np.ascontiguousarray(sums.astype("<i8").reshape(-1, 1).view(np.uint8).T).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def word_vectors(docs: DataFrame, words: list[str]) -> np.ndarray:
    """Unit vectors of the known words, from all texts."""
    n = len(words)
    if not n:
        return np.zeros((0, D), np.float32)
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, D), np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for cut in _cut(texts):
                total += around(read_block(texts[cut], shared.value), n)
        yield pa.RecordBatch.from_arrays([pa.array([_packed(total)], pa.binary())], ["sums"])

    shares = docs.select("text").mapInArrow(run, "sums binary").rdd.map(lambda r: bytes(r[0]))
    depth = max(2, int(np.ceil(np.log(max(2, shares.getNumPartitions())) / np.log(FAN))))
    sums = _unpacked(shares.treeReduce(lambda a, b: _packed(_unpacked(a) + _unpacked(b)), depth=depth)).reshape(n, D)
    return (sums / np.maximum(1e-9, np.linalg.norm(sums, axis=1, keepdims=True))).astype(np.float32)


@dataclass
class Net:
    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -700, 700)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray) -> Net:
    """The network for features x and labels y (0 or 1); every fifth row sets its temperature."""
    share = float(y.mean()) if len(y) else 0.5
    back = np.arange(len(y)) % 5 == 4
    fx, fy = x[~back], y[~back]
    if not len(fy) or fy.min() == fy.max():
        return Net(np.zeros(1), np.ones(1), np.zeros((1, 1)), np.zeros(1), np.zeros(1), 0.0, constant=share)
    drawn = np.random.default_rng(12)
    net = Net(
        fx.mean(0), fx.std(0) + 1e-3, drawn.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN), drawn.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), float(np.log((fy.mean() + 1e-3) / (1 - fy.mean() + 1e-3))),
    )
    scaled = (fx - net.centre) / net.spread
    moving = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.w1, net.b1, net.w2, np.zeros(1))]
    step = 0
    for _ in range(ROUNDS):
        order = drawn.permutation(len(fy))
        for at in range(0, len(fy), 64):
            pick = order[at : at + 64]
            h = np.tanh(scaled[pick] @ net.w1 + net.b1)
            gap = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -700, 700))) - fy[pick]) / len(pick)
            inner = np.outer(gap, net.w2) * (1 - h * h)
            grads = [scaled[pick].T @ inner + 1e-4 * net.w1, inner.sum(0), h.T @ gap + 1e-4 * net.w2, np.array([gap.sum()])]
            step += 1
            moves = []
            for (m, s), g in zip(moving, grads, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                moves.append(0.003 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8))
            net.w1 -= moves[0]
            net.b1 -= moves[1]
            net.w2 -= moves[2]
            net.b2 -= float(moves[3][0])
    if back.any():
        z = net.logits(x[back])
        net.temperature = float(min(np.geomspace(0.25, 16, 97), key=lambda t: _loss(z / t, y[back])))
    return net


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learnt from the labels of those not held out."""
    sampled = sample(docs, labels)
    words = known_words(sampled)
    vectors = word_vectors(docs, words)
    model = docs.sparkSession.sparkContext.broadcast(({w: i for i, w in enumerate(words)}, vectors))

    @F.pandas_udf("binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series([f.tobytes() for cut in _cut(texts) for f in pool(read_block(texts[cut], model.value[0]), model.value[1])], dtype=object)

    rows = sampled.select("no", "y", features("text").alias("f")).collect()  # ``SAMPLE`` rows at most
    rows.sort(key=lambda r: r.no)
    net = train(np.array([np.frombuffer(r.f) for r in rows]).reshape(-1, WIDTH), np.array([r.y for r in rows], np.float64))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            found = [net.score(pool(read_block(texts[cut], model.value[0]), model.value[1])) for cut in _cut(texts)]
            yield pd.Series(np.concatenate([*found, np.zeros(0)]))

    scored = docs.select("doc_id", held_out().alias("held_out"), run(F.coalesce("text", F.lit(""))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
