"""Language identification by cross-parsing entropy.

For each language, a suffix automaton is built of labelled text. A text is parsed, for
each language, into the longest phrases that occur in that language's text; the fewer
phrases, the closer the languages. A phrase costs about the logarithm of the training
length in bits, so the counts are normalised by it, and the least cost wins.

The automata are trained on a bounded sample: of each language, documents in the order of
a hash of their id until ``CHARS`` characters are reached, at most ``DOCS`` documents. All
else covers all texts, whole. Every letter of the samples has a number of its own, however many
there are. An automaton has at most 3 x ``CHARS`` transitions; they are laid into one list, each
state's shifted to where they hit no other's, so a step is a look-up at the state's shift plus the
letter, and a cell that belongs to another state means that the next phrase begins. Many texts are parsed
side by side, in lower case, whatever stands between letters as one space. Long texts are cut into
blocks of ``BLOCK`` characters that are parsed side by side too, and again from the state in which
the block before them ended until no block begins in another state than it was parsed from: the
result is that of one parse from the first character to the last.

Defined cases: a null text or one without a letter is ``und`` with score 0; a null label
is no training; a tie goes to the language that comes first by name; a letter that a
language's sample lacks is a phrase of its own; with no labelled text at all everything is
``und``; repeated rows are alike; an empty table gives an empty table. The score is the
winner's share when costs are read as bits per character, softened by ``SHARPNESS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DOCS = 200
CHARS = 30_000
BLOCK = 4096
#: Texts and blocks parsed side by side.
SIDE = 4096
SHARPNESS = 8.0
UNKNOWN = "und"
_SPACE = 1
_OWNER = 32


@dataclass
class Model:
    """The languages, their automata one after another, and the number of each code point's letter."""

    langs: list[str]
    letter: np.ndarray  # code point -> number; 0: a letter of no sample, 1: no letter
    shift: np.ndarray  # state -> where its transitions begin
    cells: np.ndarray  # the state that a cell belongs to, or -1, above the next state
    root: np.ndarray  # first state of each language; its transitions are in ``begin`` alone
    begin: np.ndarray  # (languages, letters): state behind the letter from the root; the root where the sample lacks it
    bits: np.ndarray  # cost of a phrase


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """The transitions of each state of the text's suffix automaton, letter -> state."""
    moves, length, link, last = [{}], [0], [-1], 0
    for c in codes.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 != length[q]:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = q = twin
            link[new] = q
        last = new
    return moves


def lay_out(moves: list[dict[int, int]], letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Shifts and cells: states with many transitions first, each shifted until all its cells are free.

    The root has none, so that it is left by a restart and every restart begins a phrase.
    """
    room = 1 << max(10, (2 * sum(map(len, moves))).bit_length())
    cells, shift = np.full(room + letters, -1, np.int64), np.zeros(len(moves), np.int32)
    taken = bytearray(room + letters)
    at = 0
    for state in sorted(range(1, len(moves)), key=lambda s: (-len(moves[s]), s)):
        own = moves[state]
        while any(taken[at + c] for c in own):
            at = (at * 5 + 1) % room  # passes through every number below a power of two
        shift[state] = at
        for c, to in own.items():
            taken[at + c] = 1
            cells[at + c] = (state << _OWNER) + to
        at = (at * 5 + 1) % room
    return shift, cells


def _columns(letter: np.ndarray, text: str) -> np.ndarray:
    """The columns of a text's letters, with one space for what stands between them."""
    c = letter[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    keep = c != _SPACE
    keep[1:] |= c[:-1] != _SPACE
    return c[keep]


def train(samples: dict[str, list[str]], chars: int = CHARS) -> Model:
    """A model of the sample texts of each language."""
    langs = sorted(samples)
    joined = ["\n".join(samples[g]) for g in langs]
    seen = sorted({c for t in joined for c in t.lower() if c.isalpha()})
    letter = np.full(0x110000, _SPACE, np.int32)
    letter[[c for c in range(0x110000) if chr(c).isalpha()]] = 0
    letter[[ord(c) for c in seen]] = np.arange(2, len(seen) + 2)
    letters, states, room = len(seen) + 2, 0, 0
    shifts, cells, bits = [], [], []
    root, begin = np.zeros(len(langs), np.int32), np.zeros((len(langs), letters), np.int32)
    for g, t in enumerate(joined):
        codes = _columns(letter, t)[:chars]
        moves = suffix_automaton(codes)
        shift, cell = lay_out(moves, letters)
        root[g] = begin[g] = states
        for c, to in moves[0].items():
            begin[g, c] = states + to
        shifts.append(shift + np.int32(room))
        cells.append(np.where(cell < 0, cell, cell + (states << _OWNER) + states))
        bits.append(np.log2(max(2, len(codes))))
        states, room = states + len(moves), room + len(cell)
    joint = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return Model(langs, letter, joint(shifts, np.int32), joint(cells, np.int64), root, begin, np.array(bits))


def _parse(model: Model, columns: np.ndarray, live: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per language, the phrases that begin in each block (a column, longest first), and the state behind it."""
    state, begun = state.copy(), np.zeros(state.shape, np.int64)
    for j in range(len(columns)):
        n = live[j]
        old, c = state[:, :n], columns[j, :n]
        cell = model.cells[model.shift[old] + c]
        goes = (cell >> _OWNER) == old
        begun[:, :n] += ~goes
        state[:, :n] = np.where(goes, cell.astype(np.int32), model.begin[:, c])
    return begun, state


def _side_by_side(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks, longest first, as columns, and how many of them are longer than each place."""
    lengths = np.array([len(c) for c in blocks])
    columns = np.zeros((int(lengths[0]), len(blocks)), np.int32)
    for k, c in enumerate(blocks):
        columns[: len(c), k] = c
    return columns, np.searchsorted(-lengths, -np.arange(len(columns)), "left")


def phrases(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages) phrases, and the number of characters of each text."""
    coded = [_columns(model.letter, t) for t in texts]
    size = np.array([len(c) for c in coded], np.int64)
    out = np.zeros((len(texts), len(model.langs)), np.int64)
    blocks = [(i, c[a : a + BLOCK]) for i, c in enumerate(coded) for a in range(0, len(c), BLOCK)]
    owner = np.array([i for i, _ in blocks], np.int64)
    goes_on = np.array([k > 0 and owner[k] == owner[k - 1] for k in range(len(blocks))], bool)
    longest = np.array(sorted(range(len(blocks)), key=lambda k: -len(blocks[k][1])), np.int64)
    start = np.repeat(model.root[:, None], len(blocks), 1)
    counts, end = np.zeros(start.shape, np.int64), start.copy()
    todo = np.ones(len(blocks), bool)
    while todo.any():
        some = longest[todo[longest]]
        for at in range(0, len(some), SIDE):
            part = some[at : at + SIDE]
            counts[:, part], end[:, part] = _parse(model, *_side_by_side([blocks[k][1] for k in part]), start[:, part])
        # Another pass for blocks that begin in another state than they were parsed from; the first of them is final then.
        comes = np.where(goes_on, np.roll(end, 1, 1), model.root[:, None])
        todo, start = (comes != start).any(0), comes
    for g in range(len(model.langs)):
        np.add.at(out[:, g], owner, counts[g])
    return out, size


def predict(model: Model, texts: list[str | None]) -> pd.DataFrame:
    """lang_pred and score of each text."""
    known = [t if t is not None and any(map(str.isalpha, t)) else "" for t in texts]
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model.langs:
        counts, size = phrases(model, known)
        cost = counts * model.bits / np.maximum(size, 1)[:, None]
        best = cost.argmin(1)
        weight = np.exp2(-SHARPNESS * (cost - cost.min(1, keepdims=True)))
        share = 1 / weight.sum(1)
        for i, t in enumerate(known):
            if t:
                langs[i], scores[i] = model.langs[best[i]], share[i]
    return pd.DataFrame({"lang_pred": langs, "score": scores})


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, docs_each: int = DOCS) -> dict[str, list[str]]:
    """Of each language, the documents that come first by a hash of their id; ``docs_each`` at most."""
    order = Window.partitionBy("lang").orderBy("h", "t")
    rows = (
        docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
        .select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
        .withColumn("n", F.row_number().over(order))  # cut to the first few in each task before the shuffle
        .filter(F.col("n") <= docs_each)
        .select("lang", "n", F.substring("text", 1, CHARS).alias("text"))
        .collect()
    )
    found: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        found.setdefault(str(r["lang"]), []).append((r["n"], r["text"]))
    return {g: [t for _, t in sorted(x)] for g, x in found.items()}


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a language: 3 x CHARS transitions at most, in two to four times as many cells

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield predict(shared.value, [t if isinstance(t, str) else None for t in texts.tolist()])

    return docs.withColumn("__p", run(F.col(f"`{text}`"))).select(*docs.columns, "__p.*")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score, learnt from the documents that aren't held out."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = train(sample(slim.filter(~held_out()), "doc_id", "text", "lang"))
    marked = slim.select("doc_id", "text", held_out().alias("held_out"))
    return classify(marked, model).select("doc_id", "held_out", "lang_pred", "score")
