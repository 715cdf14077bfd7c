"""The pipeline's near copies against brute force on edited copies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowtide.llm import near_copies


def _shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def _edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        at = rng.randrange(len(w))
        w[at : at + rng.randint(0, 2)] = [f"new{rng.randrange(10**6)}"] * rng.randint(0, 1)
    return w


def _cases(rng):
    texts = []
    for size, copies in [(30, 12), (90, 40), (150, 40), (400, 25), (2500, 4)]:
        for _ in range(2):
            base = [f"w{rng.randrange(3000)}" for _ in range(size)]
            for _ in range(copies):
                texts.append(_edited(rng, base, rng.randint(0, max(1, size // 35))))
                if rng.random() < 0.2:  # copies of copies
                    base = texts[-1]
    texts += [["Just", "three", "words"], ["just", "three", "words"], ["other", "three", "words"], [], []]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def _wanted(texts):
    sets, up = [_shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in range(len(texts))}


@pytest.mark.parametrize("dense", [2, 16])
def test_components_equal_brute_force(spark, dense):
    texts = _cases(random.Random(dense))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_copies.near_duplicates(d, dense=dense).collect()}
    want = _wanted(texts)
    assert got == want
    assert 10 < len(set(want.values())) < len(texts) // 2


def test_stage_drops_edited_copies(spark):
    rng = random.Random(7)
    rows, stay = [], set()
    for k in range(20):
        base = [f"w{rng.randrange(5000)}" for _ in range(100)]
        rows.append((2 * k, " ".join(base)))
        rows.append((2 * k + 1, " ".join([*base[:50], "changed", *base[51:]])))  # similarity 91 / 101
        stay.add(2 * k)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_deduplication(spark, d, "").collect()} == stay


def test_a_shared_passage(spark):
    """Texts of which a passage is two thirds meet in many bands without being near copies, but for a few that are."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(200)]
    texts = []
    for i in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 120))]
        texts.append([*own[:30], *passage, *own[30:]])
        if i % 10 == 0:
            texts.append(_edited(rng, texts[-1], 3))
    texts += [[*passage, f"end{i}"] for i in range(20)]
    texts = [" ".join(t) for t in texts]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_copies.near_duplicates(d, dense=4).collect()}
    want = _wanted(texts)
    assert got == want and len(set(want.values())) == 61


def test_defined_cases(spark):
    kind = "doc_id long, text string, fp long, node long, place string, s string, n int, label int"
    clash = (1, 2, "p", "s", 3, 4)
    rows = [(5, None), (3, ""), (9, " \n"), (7, "a b"), (7, "a b"), (None, "A  b"), (None, "only here and without an id"), (1, "x " * 30_000), (2, "x " * 30_001)]
    d = spark.createDataFrame([r + clash for r in rows], kind)
    out = near_copies.near_duplicates(d, keep=("n",))
    assert out.columns == ["doc_id", "n", "fp", "component_id"]
    got = sorted(((r.doc_id, r.component_id) for r in out.collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (7, 7), (7, 7), (None, 7), (None, None), (1, 1), (2, 1)], key=str)
    assert near_copies.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_simhash_gives_candidates_and_they_are_verified(spark):
    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    close = base[:1000] + ["other"] + base[1001:]
    far = [f"v{rng.randrange(10**6)}" for _ in range(2000)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([base, close, far])], "doc_id long, text string")
    s = d.select("doc_id", near_copies.signatures(near_copies.shingle_hashes(F.col("text"))).alias("s"))
    nodes = s.select("doc_id", "s.*")
    fp = {r.doc_id: r.fp for r in nodes.collect()}
    assert {(r.a, r.b) for r in near_copies.simhash_candidates(nodes).collect()} == {tuple(sorted([fp[0], fp[1]]))}
    # Without a place in which they meet, SimHash alone joins the first two; a third of the same fingerprint is no copy.
    nodes = nodes.join(d, "doc_id").select(
        "fp", "n", F.array().cast("array<long>").alias("places"), F.xxhash64("text").alias("own"), F.lit(5).cast("long").alias("bits")
    )
    found = near_copies.links(nodes, d.select(F.xxhash64("text").alias("own"), F.col("text").alias("t")))
    assert {(r.a, r.b) for r in found.collect()} <= {tuple(sorted([fp[0], fp[1]]))}
