"""Trigram queries derived from expressions: no match may escape them."""

from __future__ import annotations

import random
import re
from re import _constants as op
from re import _parser as parser

import pytest

from rowtide.llm import secret_scan
from rowtide.llm.regex_trigrams import trigram_query, trigrams
from rowtide.llm.secret_scan import RULES, Rule


def drawn(items, draw: random.Random, fold: bool = False) -> str:
    """A text that the parsed expression matches."""
    out = []
    for kind, value in items:
        if kind is op.LITERAL:
            out.append(draw.choice([chr(value).lower(), chr(value).upper()]) if fold and value < 128 else chr(value))
        elif kind is op.IN:
            codes = [c for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1))]
            out.append(chr(draw.choice(codes)))
        elif kind is op.SUBPATTERN:
            out.append(drawn(value[3], draw, fold or bool(value[1] & re.I)))
        elif kind is op.BRANCH:
            out.append(drawn(draw.choice(value[1]), draw, fold))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, sub = value
            out += [drawn(sub, draw, fold) for _ in range(draw.randint(low, min(int(high), low + 4)))]
        else:
            raise AssertionError(kind)
    return "".join(out)


def met(query, text: str) -> bool:
    held = trigrams(text)
    return all(any(way <= held for way in clause) for clause in query)


MORE = (
    r"ab?c{2}d|x(yz|zy)+w", r"(foo|ba[rz])-[0-9]{4}", r"(?i:Key)[a-z]*(id|name)x", r"(a+|bcd)efg", r"(abc[0-9]+|defg)hij",
    r"a{5}", r"(ab){2,3}", r"(?i:straße)[0-9]", r"[ÄÖ]ngström",
)


@pytest.mark.parametrize("pattern", [r.pattern for r in RULES] + list(MORE))
def test_every_match_meets_its_query(pattern):
    draw, query = random.Random(pattern), trigram_query(pattern)
    for _ in range(400):
        t = drawn(parser.parse(pattern), draw)
        assert re.search(pattern, t) and met(query, t)


def test_queries():
    names = lambda pattern: [{frozenset(w) for w in c} for c in trigram_query(pattern)]
    sets = lambda *words: {trigrams(w) for w in words}
    assert names("abc.*DEF") == [sets("abc"), sets("def")]
    assert names("(one|three)s?") == [sets("one", "three")]
    assert names("api_?key") == [sets("apikey", "api_key")]
    assert names("x[0-9a-f]+y") == [] and names("(abc|[0-9]+)") == [] and names("(abc)?") == [] and names("") == []
    assert names("ab(?=x)c") == [sets("abc")] and names(r"(a)bc\1xyz") == [sets("abc"), sets("xyz")]
    assert names("(ab[0-9]+cde|fgh)") == [sets("cde", "fgh")]


def test_scan_finds_drawn_matches(spark):
    draw = random.Random(3)
    rows = [f"x {drawn(parser.parse(r.pattern), draw)} y" for r in RULES for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    for r in secret_scan.find_secrets(docs).collect():
        for i, rule in enumerate(RULES):
            group, least = rule.least
            want = [m.span() for m in re.finditer(rule.pattern, r.text) if len(m[group]) >= least]
            assert [(s.start, s.end) for s in r.secrets if s.kind_no == i] == want


def test_many_rules(spark):
    """More trigrams than one mask has bits, rules without any among them."""
    rules = tuple(Rule(f"k{i}", f"name{i:03d}secret[0-9]+") for i in range(60)) + (Rule("digits", "[0-9]{9}"),)
    assert len(secret_scan.vocabulary(rules)) > 2 * secret_scan.MASK
    texts = ["name007secret12 name039secret4", "name007 secret12", "name0999secret1 123456789", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in secret_scan.find_secrets(docs, rules=rules).collect()}
    assert got == {0: [("k7", 0, 15), ("k39", 16, 30)], 1: [], 2: [("digits", 16, 25)], 3: [], 4: []}
    only = secret_scan.find_secrets(docs, rules=rules[-1:]).collect()
    assert sum(len(r.secrets) for r in only) == 1
