"""Boolean trigram queries from regular expressions.

The parsed expression is walked from left to right. Where only a few texts are possible
(literals, small classes, optional parts, alternatives, fixed repetitions) the walk keeps all
of them; anything else is a gap. What stands between two gaps is one of a known set of texts,
so a match holds all trigrams of one of them: a clause. A query is all its clauses. A-Z are folded
to lower case, as the index folds the texts, so that flags that ignore the case of ASCII letters
change nothing.

Defined cases: an expression of which no three letters are certain has the empty query, which
says nothing; a part that is not understood (back references, negated classes, categories) is
a gap, and look-around has no width, so a query never asks for more than a match must hold.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser as parser

#: Texts that a stretch may have, and members that a class may have, before it is cut or a gap.
TEXTS, MEMBERS = 256, 16

#: Sets of trigrams, one of which a match holds in full.
Clause = frozenset[frozenset[str]]
_FOLD = {c: c + 32 for c in range(65, 91)}
_EMPTY = frozenset([""])


def trigrams(text: str) -> frozenset[str]:
    """The trigrams of a text with A-Z in lower case."""
    low = text.translate(_FOLD)
    return frozenset(low[i : i + 3] for i in range(len(low) - 2))


def _folded(codes) -> frozenset[str]:
    return frozenset(chr(c).translate(_FOLD) for c in codes)


def _least(ways) -> Clause | None:
    """The ways without those that hold another; None if one of them asks for nothing."""
    ways = set(ways)
    if not all(ways):
        return None
    return frozenset(w for w in ways if not any(o < w for o in ways))


class _Walk:
    """The clauses so far, and the texts possible since the last gap."""

    def __init__(self):
        self.clauses, self.run = [], _EMPTY
        self.exact = True  # no gap and no cut yet: the run is all that matches

    def cut(self) -> None:
        clause = _least(trigrams(t) for t in self.run)
        if clause:
            self.clauses.append(clause)
        self.run, self.exact = _EMPTY, False

    def add(self, texts: frozenset[str]) -> None:
        if len(self.run) * len(texts) > TEXTS:
            self.cut()
        if len(texts) > TEXTS:
            self.cut()
            return
        self.run = frozenset(a + b for a, b in product(self.run, texts))

    def absorb(self, part: _Walk) -> None:
        """Goes on with a part that has been walked by itself."""
        if part.exact:
            self.add(part.run)
        else:
            self.cut()
            self.clauses += part.clauses

    def sub(self, items) -> _Walk:
        part = _Walk()
        part.walk(items)
        return part

    def walk(self, items) -> None:
        for kind, value in items:
            self.step(kind, value)

    def step(self, kind, value) -> None:
        if kind is op.LITERAL:
            self.add(_folded([value]))
        elif kind is op.IN:
            members = self.members(value)
            self.cut() if members is None else self.add(members)
        elif kind is op.SUBPATTERN:
            self.absorb(self.sub(value[-1]))
        elif kind is op.ATOMIC_GROUP:
            self.absorb(self.sub(value))
        elif kind is op.BRANCH:
            self.branch([self.sub(items) for items in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            self.repeat(*value)
        elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):
            self.cut()

    def members(self, items) -> frozenset[str] | None:
        codes: list[int] = []
        for kind, value in items:
            if kind is op.LITERAL:
                codes.append(value)
            elif kind is op.RANGE and value[1] - value[0] < 4 * MEMBERS:
                codes += range(value[0], value[1] + 1)
            else:
                return None
        found = _folded(codes)
        return found if len(found) <= MEMBERS else None

    def branch(self, parts: list[_Walk]) -> None:
        if all(p.exact for p in parts):
            self.add(frozenset().union(*[p.run for p in parts]))
            return
        self.cut()
        ways = []
        for p in parts:
            p.cut()
            # The clause with the fewest ways tells most; an alternative without one leaves nothing certain.
            ways.append(min(p.clauses, key=len, default=frozenset([frozenset()])))
        clause = _least(w for c in ways for w in c)
        if clause:
            self.clauses.append(clause)

    def repeat(self, low: int, high, items) -> None:
        part = self.sub(items)
        if low == 0 and high == 1 and part.exact:
            self.add(part.run | _EMPTY)
        elif low == 0:
            self.cut()
        else:
            turns = min(low, 3)  # three turns of a letter are a trigram; more tell nothing new
            for _ in range(turns):
                self.absorb(part)
            if not part.exact or turns != low or high != low:
                self.cut()


def trigram_query(pattern: str) -> tuple[Clause, ...]:
    """The clauses that every match of ``pattern`` meets; empty if nothing is certain."""
    whole = _Walk()
    whole.walk(parser.parse(pattern))
    whole.cut()
    return tuple(dict.fromkeys(whole.clauses))
