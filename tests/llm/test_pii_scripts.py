"""Surrogates in every script, and rounds that end."""

from __future__ import annotations

import re

import pytest

from rowtide.llm import pii


def replaced(spark, *texts):
    rows = pii.replace_personal(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    return [r.text for r in rows]


def test_addresses_in_any_script(spark):
    texts = ["write to 李雷@例子.中国 now", "an 김철수@예시.한국", "דוד@דוגמה.ישראל", "ไทย@ตัวอย่าง.ไทย", "ⴰⴱ@ⴳⴷ.org", "½@½½.½½", "_@-.--"]
    got = replaced(spark, *texts)
    for old, new in zip(texts[:5], got[:5], strict=True):
        local, host = re.search(r"(\S+)@(\S+)", old).groups()
        mine, theirs = re.search(r"(\S+)@(\S+)", new).groups()
        assert mine != local and theirs.split(".")[0] != host.split(".")[0]
        assert len(mine) == len(local) and theirs.split(".")[-1] == host.split(".")[-1]
        assert old.replace(f"{local}@{host}", "") == new.replace(f"{mine}@{theirs}", "")
    assert all("一" <= c <= "龥" for c in re.search(r"(\S+)@", got[0]).group(1))
    assert all("가" <= c <= "힣" for c in re.search(r"(\S+)@", got[1]).group(1))
    assert got[5] != texts[5]


def test_more_short_addresses_than_letters(spark):
    """All one-letter addresses of a domain: letters are added once the short ones have run out."""
    texts = [f"{c}@firm.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, *texts)
    assert len(set(got)) == len(texts) and not set(got) & set(texts)


def test_names_beyond_the_pool(spark, monkeypatch):
    monkeypatch.setitem(pii._SYLLABLES, "latin", (["ba", "be"], ("n", "a", "er")))
    names = ["".join(c).capitalize() for c in [f"{a}{b}" for a in ("ka", "ke", "ki", "ko", "ku", "la", "le", "li") for b in ("ma", "me", "mi", "mo")]]
    got = replaced(spark, *[f"Mr {n} came" for n in names])
    assert len(set(got)) == len(names) and not set(got) & {f"Mr {n} came" for n in names}


def test_no_room_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 3)
    monkeypatch.setattr(pii, "_ip", lambda seed: pii.F.lit("200.0.0.1"))
    with pytest.raises(RuntimeError, match="ip"):
        replaced(spark, "at 10.0.0.1 and 10.0.0.2")
