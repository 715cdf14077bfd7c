"""The Merkle manifest against a tree built by hand in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from rowtide.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx int, block int, tree string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text) -> str:
    doc_id, _, lang, source, n_chars = row
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[told(v) for v in (doc_id, source, lang, n_chars, text)])


def path(digests: list[str], at: int) -> tuple[str, list[tuple[str, str]]]:
    """The top of a tree, and on the way from one leaf to it what stands left and right."""
    beside = []
    while len(digests) > 1:
        begin = at // 16 * 16
        run = digests[begin : begin + 16]
        beside.append(("".join(run[: at - begin]), "".join(run[at - begin + 1 :])))
        digests = [h(*digests[i : i + 16]) for i in range(0, len(digests), 16)]
        at //= 16
    return digests[0], beside


def by_hand(rows) -> list[tuple]:
    order = lambda v: (v is not None, v if v is not None else 0)
    sources: dict = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    named = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(((order(r[0]), leaf_of(r, r[1]), r) for r in sources[s]), key=lambda x: x[:2]) for s in named}
    subroots = [path([leaf for _, leaf, _ in members[s]], 0)[0] for s in named]
    out = []
    for k, s in enumerate(named):
        leaves = [leaf for _, leaf, _ in members[s]]
        root, above = path(subroots, k)
        for at, (_, leaf, r) in enumerate(members[s]):
            subroot, below = path(leaves, at)
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            fold = leaf_of(r, text)
            for left, right in below + above:
                fold = h(left, fold, right)
            out.append((r[0], leaf, subroot, root, h(*[x for pair in below + above for x in pair]), fold, fold == root))
    return sorted(out, key=repr)


def check(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], SCHEMA).repartition(parts)
    out = merkle.manifest(frame)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == by_hand(rows)


def test_many_sources_and_sizes(spark):
    sizes = {"hot": 600, "one": 1, "two": 2, "run": 16, "more": 17, "Ünï": 3, "": 5, None: 33}
    sizes |= {f"s{i:02d}": 1 for i in range(20)}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 7
            rows.append((i, f"Text Number {i} é" if i % 3 else None, "en" if i % 2 else None, s, i * 10 if i % 5 else None))
    rows += [(None, "No Id", "en", "two", 1), (14, "Again The Same Id", None, "hot", None), (14, "", None, "hot", None)]
    rows += [rows[0]] * 40  # repeated rows
    check(spark, rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_one_source(spark, n):
    check(spark, [(i, f"A{i}", "en", "only", 2) for i in range(n)])


def test_two_single_rows(spark):
    check(spark, [(1, "A", "en", "a", 1), (2, "B" * 100_000, "en", "b", 1)])


def test_empty(spark):
    out = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert out.columns == COLUMNS and out.count() == 0


def test_blocks_split_a_source(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    check(spark, [(i, f"A{i}", "en", "hot" if i % 3 else "cold", 2) for i in range(1, 900)])


def test_row_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(spark.createDataFrame([(1, "A", None, None, None, "", 0, 0, "")], SCHEMA)).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
