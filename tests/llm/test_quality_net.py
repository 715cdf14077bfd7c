"""The quality classifier: features against plain Python, held-out labels, and defined cases."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from rowtide.llm import quality_net as net
from rowtide.llm.queries import op12_quality_classifier

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block string, features string, word long, score int"
CLASH = ("en", "s", 1, "b", "f", 2, 3)
TEXTS = ["the cat sat on the mat, the cat!", "a a a a a a b", "", None, " \n\t", "dog ### cat ### the ### mat", "the the", "Ünï 😀 cat the mat on, on"] * 4


def index_vector(word: str) -> np.ndarray:
    h, out = xxhash.xxh64_intdigest(word.encode()), np.zeros(net.D)
    for s in range(net.SPARKS):
        bits = h >> (16 * s)
        out[bits % net.D] += -1 if (bits >> 8) & 1 else 1
    return out


def slots(word: str) -> np.ndarray:
    """Each entry of an index vector on its own: two in one place don't cancel when words are compared."""
    h, out = xxhash.xxh64_intdigest(word.encode()), np.zeros((net.SPARKS, net.D))
    for s in range(net.SPARKS):
        bits = h >> (16 * s)
        out[s, bits % net.D] = -1 if (bits >> 8) & 1 else 1
    return out


def features_by_hand(texts: list[str | None], known: set[str]) -> list[np.ndarray]:
    split = [re.findall(r"\w+|[^\w\s]+", t or "") for t in texts]
    sums = {w: np.zeros(net.D) for w in known}
    for t in split:
        for i, w in enumerate(t):
            for j in range(max(0, i - net.WINDOW), min(len(t), i + net.WINDOW + 1)):
                if i != j and w in sums:
                    sums[w] = sums[w] + index_vector(t[j])
    vectors = {w: v / max(np.linalg.norm(v), 1e-9) for w, v in sums.items()}
    out = []
    for t in split:
        f = np.zeros(net.WIDTH)
        own = np.array([vectors[w] for w in t if w in vectors])
        if len(own):
            f[: net.D], f[net.D : 2 * net.D] = own.mean(0), own.std(0)
        for far in range(1, net.WINDOW + 1):
            products = [slots(a) @ slots(b).T for a, b in zip(t, t[far:])]  # noqa: B905
            f[2 * net.D + far - 1] = sum(p.sum() for p in products) / (net.SPARKS * max(1, len(t) - far))
        if t:
            f[-2:] = 1 - len(own) / len(t), np.log1p(len(t))
        out.append(f)
    return out


@pytest.mark.parametrize("chars", [1 << 21, 40])
def test_features(spark, monkeypatch, chars):
    monkeypatch.setattr(net, "BLOCK_CHARS", chars)
    known = ["the", "cat", "mat", "a", "on", "###", "nowhere"]
    docs = spark.createDataFrame([(i, t, *CLASH) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    vectors = net.word_vectors(docs, known)
    got = np.concatenate([net.pool(net.read_block(TEXTS[cut], {w: i for i, w in enumerate(known)}), vectors) for cut in net._cut(TEXTS)])
    np.testing.assert_allclose(got, features_by_hand(TEXTS, set(known)), atol=1e-5)


def test_sample_is_whole_bounded_and_of_training_documents(spark):
    docs = spark.createDataFrame([(i, f"{i} " * (i + 1), *CLASH) for i in range(80)] + [(3, "3 " * 50, *CLASH)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    rows = net.sample(docs, labels).orderBy("no").collect()
    ids = [int(r.text.split()[0]) for r in rows]
    assert sorted(ids) == [i for i in range(80) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert all(r.text == f"{i} " * (i + 1) and r.y == i % 2 for i, r in zip(ids, rows, strict=True))
    assert [r.text for r in net.sample(docs, labels, size=7).orderBy("no").collect()] == [r.text for r in rows[:7]]
    some = net.sample(docs, labels, chars=500).collect()
    assert 0 < sum(len(r.text) for r in some) <= 500


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = op12_quality_classifier(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_temperature():
    """Labels that follow the features by chance alone: the score is near the chance, not near 0 or 1."""
    drawn = np.random.default_rng(0)
    x = drawn.normal(size=(1500, net.WIDTH))
    y = (drawn.random(1500) < 0.7).astype(float)
    fitted = net.train(x, y)
    assert fitted.temperature > 1.5
    fresh = fitted.score(drawn.normal(size=(4000, net.WIDTH)))
    sure = net.Net(**{**vars(fitted), "temperature": 1.0}).score(drawn.normal(size=(4000, net.WIDTH)))
    assert abs(fresh.mean() - 0.7) < 0.15 and fresh.std() < sure.std()


def test_defined_cases(spark):
    docs = [(i, t, *CLASH) for i, t in enumerate(TEXTS)] + [(None, "the cat", *CLASH), (0, "the cat again", *CLASH), (0, "the cat again", *CLASH)]
    frame = spark.createDataFrame(docs, SCHEMA)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score int")
    out = net.rate(frame, labels([]))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.schema["doc_id"].dataType == frame.schema["doc_id"].dataType
    rows = out.collect()
    assert len(rows) == len(docs) and {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {0}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    # One kind of label, a contradiction, nulls and other numbers: all that is left is 1.
    some = [(1, 1, 0, 0), (3, 1, 0, 0), (4, 1, 0, 0), (4, 0, 0, 0), (5, None, 0, 0), (None, 0, 0, 0), (7, 5, 0, 0)]
    assert {r.score for r in net.rate(frame, labels(some)).collect()} == {1.0}
    both = [(i, int(i % 8 != 1), 0, 0) for i in range(len(TEXTS))]
    again = [net.rate(frame.repartition(p), labels(both)).orderBy("doc_id", "score").collect() for p in (1, 4)]
    assert [(r.doc_id, r.predicted) for r in again[0]] == [(r.doc_id, r.predicted) for r in again[1]]
    np.testing.assert_allclose([r.score for r in again[0]], [r.score for r in again[1]], rtol=1e-3)
    none = net.rate(spark.createDataFrame([], SCHEMA), labels(both))
    assert none.columns == out.columns and none.count() == 0


def test_a_very_long_text(spark):
    rows = [(i, "the cat sat, " * 5 if i else "the cat sat, " * 200_000, *CLASH) for i in range(4)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert net.rate(spark.createDataFrame(rows, SCHEMA).coalesce(1), labels).count() == 4
