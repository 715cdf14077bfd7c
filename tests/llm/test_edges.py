"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

from __future__ import annotations

import pytest

import corpus_pipeline
from rowtide.llm import ann, bpe, langid, line_dedup, lm, packing, pii, quality, secret_scan, simhash
from rowtide.llm.common import tokenizer_file

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "doc string, version string, h string, key string, value string, pos int, fp string, __m string, round int"
)
LONG = " ".join(f"word{i % 997} of line {i}" for i in range(20_000)) + "\n" + "x" * 50_000
SHARED = "this line stands on many sites"
TEXTS = [None, "", " \t\n", "one", "one two", LONG, "a b c\n\na b c\n", f"{SHARED}\nown line number one here", "ß Ünï — 😀 é \x1f"]
ROWS = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None) for i, t in enumerate(TEXTS)]
ROWS += [(100 + i, f"  {SHARED}\t\nsome more words {i} to read", "en", f"site{i}", 5) for i in range(7)]
ROWS += [ROWS[7], ROWS[7], (None, "no id at all here", None, None, None), (None, None, None, None, None)]
CLASH = ("d", "v", "h", "k", "x", 1, "f", "m", 3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + CLASH for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(3, 1, 0), (4, 0, 0), (4, 1, 0), (7, None, None), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int"
    )


def pairs(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def test_line_dedup(docs, none):
    out = line_dedup.remove_boilerplate(docs, counts=("a", "b"))
    assert out.columns == [*docs.columns, "a", "b"]
    assert out.count() == len(ROWS)
    got = [(r.doc_id, r.text, r.b) for r in out.collect()]
    texts = {i: t for i, t, _ in got if i is not None}
    # Eight sites and the null one: it stays where it comes first, in all rows of that document.
    assert texts[7] == TEXTS[7] and [b for i, _, b in got if i == 7] == [0, 0, 0]
    assert all(texts[100 + i] == f"some more words {i} to read" for i in range(7))
    assert all(texts[i] == TEXTS[i] for i in range(9))
    assert line_dedup.remove_boilerplate(none).count() == 0
    assert line_dedup.line_report(docs).count() == len(ROWS)


def test_line_dedup_near_threshold(spark):
    rows = [(i * 10 + s, f"line number {i} says it all", f"site{s}") for i in range(2, 8) for s in range(i)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(d, log_k=4).collect()}  # rough sketches, exact counts near 5
    assert got == {i * 10 + s: int(i >= 5 and s > 0) for i in range(2, 8) for s in range(i)}


def test_quality(docs, none, labels):
    out = quality.judge(docs, labels)
    assert out.count() == len(ROWS)
    got = {r.doc_id: r for r in out.collect()}
    assert (got[5].n_words, got[5].kept, got[0].n_words, got[0].word_chars, got[2].n_words) == (80001, True, 0, 0, 0)
    assert (got[6].n_dup_lines, got[6].n_words, got[6].n_repeat_words) == (1, 6, 0)
    assert got[3].base_failed and not got[3].kept
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {5}
    assert quality.judge(none, labels).count() == 0 and quality.judge(docs, labels.limit(0)).count() == len(ROWS)


def test_secrets(docs, none):
    out = secret_scan.find_secrets(docs)
    assert out.columns == [*docs.columns, "secrets"] and out.count() == len(ROWS)
    assert pairs(secret_scan.mask_secrets(docs), "doc_id", "text") == pairs(docs, "doc_id", "text")
    assert secret_scan.secret_report(none).count() == 0


def test_pii(docs, none):
    out = pii.replace_personal(docs, count="n")
    assert out.columns == [*docs.columns, "n"]
    assert pairs(out, "doc_id", "text") == pairs(docs, "doc_id", "text")
    assert pii.replace_personal(none).count() == 0


def test_simhash(docs, none):
    got = simhash.fingerprint_report(docs).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint == by[2].fingerprint == "0" * 16
    assert by[0].component_id == by[2].component_id == 0
    assert [r.component_id for r in got if r.doc_id == 7] == [7, 7, 7]
    assert simhash.fingerprint_report(none).count() == 0
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    ids = [r.doc_id for r in one.collect()]
    assert ids.count(7) == 1 and 1 not in ids and ids.count(0) == 1


def test_bpe(docs, none):
    path = tokenizer_file("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(docs, path), path)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in out.collect())
    assert bpe.round_trip(docs, path).count() == len(ROWS) and bpe.round_trip(none, path).count() == 0


def test_packing(docs, none):
    path = tokenizer_file("word_bpe_49k.json")
    out = packing.packed_documents(docs, path).collect()
    assert sum(r.piece == 0 for r in out) == len(ROWS)
    assert [r.length for r in out if r.doc_id == 1] == [1]
    seen = {}
    for r in out:
        seen.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seen.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.packed_documents(none, path).count() == 0


def test_langid(docs, none):
    out = langid.identify(docs).collect()
    assert len(out) == len(ROWS)
    assert {r.lang_pred for r in out if r.doc_id in (0, 1, 2)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.identify(none).count() == 0
    model = langid.train({})
    assert langid.classify(docs, model).filter("lang_pred != 'und'").count() == 0


def test_langid_tie(spark):
    model = langid.train({"b": ["same text"], "a": ["same text"]})
    d = spark.createDataFrame([("same",), ("123 !",)], "text string")
    assert [tuple(r) for r in langid.classify(d, model).collect()] == [("same", "a", 0.5), ("123 !", "und", 0.0)]


def test_lm(docs, none):
    out = lm.score(docs).collect()
    assert len(out) == len(ROWS)
    assert {r.n_tokens for r in out if r.doc_id in (0, 1, 2)} == {1}
    assert all(r.score < 0 and r.base_score < 0 for r in out)
    assert lm.score(none).count() == 0


def test_ann(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 9)] + [(1, [1.0, 1.0]), (20, [2.0, 1.0])]
    rows += [(30, None), (31, [0.0, 0.0]), (32, [None, 1.0]), (33, [float("nan"), 1.0]), (34, [float("inf"), 1.0]), (None, [1.0, 1.0]), (35, [1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(d, d.filter("vec_id in (1, 30, 31)")).collect()
    assert {r.query_id for r in got} == {1}
    best = sorted((r.rank, r.vec_id, r.score) for r in got)
    # Nine rows take part; all others are found, ties by id.
    assert best == [(1, 2, 1.0), (2, 20, 1.0)] + [(i, i, float(i - 1)) for i in range(3, 9)]
    assert ann.search(d.limit(0), d.limit(0)).count() == 0


def test_pipeline(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {5}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
