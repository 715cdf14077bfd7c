"""Byte-pair encoding of distinct words along a trie, and decoding.

Texts are parted into words as the tokenizer does. All words of a batch that a worker has
not met are put in order: a sorted list is its trie in depth-first order, since a word
shares with the one before it exactly the nodes of their common prefix. The walk keeps,
for each byte of the path, the last token of that prefix's encoding. The last token of a
prefix is the one token that ends there and stands as it is after the last token of the
rest (two tokens stand if merging their joint bytes gives them back). The tokens that end
at a node are known from the longest end of its path that starts any token, which is
carried from node to node like the last tokens. So each node is worked out once for all
words below it, and an encoding is read backwards, last token by last token. Memory is bounded by a batch and by the words a worker keeps.

Defined cases: a null text is empty; an empty text has no tokens; special tokens in a text
are recognised as the tokenizer does; rows are independent, so repeated rows, null ids
and other columns pass through; an empty table gives an empty table. Decoding replaces
bytes that are not UTF-8 with U+FFFD; ids outside the vocabulary are an error.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the byte-level tokenizer parts a text into words (a fixed value of the format).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts that are ASCII throughout.
ASCII_WORDS = re.compile(WORDS.replace(r"^\s\p{L}\p{N}", r"^\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]"), re.ASCII)
CACHE_WORDS = 500_000
CACHE_PAIRS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieEncoder:
    """Encodes and decodes with the vocabulary of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        model = file["model"]
        self.token: dict[bytes, int] = {raw(t): i for t, i in model["vocab"].items()}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: t for t, i in self.token.items()} | {i: s.encode() for s, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int]] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        for n, (a, b) in enumerate(pairs):
            pair = (self.token[raw(a)], self.token[raw(b)])
            self.rank.setdefault(pair, n)
            self.merged.setdefault(pair, self.token[raw(a) + raw(b)])
            self.made_of.setdefault(self.merged[pair], pair)
        #: States of a path: the longest of its ends that starts a token, and the tokens that end there with their lengths.
        self.starts = {t[:n] for t in self.token for n in range(len(t) + 1)}
        self.ends: list[bytes] = [b""]
        self.tokens_at: list[list[tuple[int, int]]] = [[]]
        self.state_of: dict[bytes, int] = {b"": 0}
        self.next_state: dict[int, int] = {}
        self.words = regex.compile(WORDS)
        specials = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({specials})") if specials else None
        self.stands_memo: dict[tuple[int, int], bool] = {}
        self.whole_memo: dict[int, bool] = {}
        #: Of each word: its ids, these as text, and their bytes.
        self.known: dict[str, tuple[tuple[int, ...], str, bytes]] = {}

    def merge(self, data: bytes) -> list[int]:
        """The encoding by its definition: the pair of lowest rank is merged first."""
        ids = [self.token[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min(range(len(ids) - 1), key=lambda i: self.rank.get((ids[i], ids[i + 1]), 1 << 30))
            pair = (ids[best], ids[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    out.append(self.merged[pair])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _edge(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """The pieces that lie at one end of a token while it is built, last first, and the rank at which each goes."""
        known = self.edges[side].get(token)
        if known is None:
            pieces, gone = [token], [1 << 30]
            while (made := self.made_of.get(pieces[-1])) is not None:
                gone.append(self.rank[made])
                pieces.append(made[side])
            known = self.edges[side][token] = (pieces, gone)
        return known

    def _stands(self, a: int, b: int) -> bool:
        """Whether merging the joint bytes of two tokens gives them back.

        Each is built by its own merges, in order of rank, unless a merge across the border
        comes first: one of the last piece of ``a`` with the first of ``b``, while both are
        there, whose rank is below those of the merges that take them away. (Of two equal
        merges the left one comes first.)
        """
        known = self.stands_memo.get((a, b))
        if known is None:
            (left, left_gone), (right, right_gone) = self._edge(a, 1), self._edge(b, 0)
            i, j, known, rank = len(left) - 1, len(right) - 1, True, self.rank
            while True:
                r = rank.get((left[i], right[j]))
                if r is not None and r < left_gone[i] and r <= right_gone[j]:
                    known = False
                    break
                if i == j == 0:
                    break
                if left_gone[i] <= right_gone[j]:
                    i -= 1
                else:
                    j -= 1
            if len(self.stands_memo) > CACHE_PAIRS:
                self.stands_memo.clear()
            self.stands_memo[(a, b)] = known
        return known

    def _whole(self, a: int) -> bool:
        known = self.whole_memo.get(a)
        if known is None:
            known = self.whole_memo[a] = self.merge(self.bytes_of[a]) == [a]
        return known

    def _step(self, state: int, byte: int) -> int:
        """The state behind one more byte; there are as many as starts of tokens, made when first met."""
        end = self.ends[state] + bytes((byte,))
        while end not in self.starts:
            end = end[1:]
        new = self.state_of.get(end)
        if new is None:
            new = self.state_of[end] = len(self.ends)
            self.ends.append(end)
            tails = [end[i:] for i in range(len(end))]
            self.tokens_at.append([(self.token[t], len(t)) for t in tails if t in self.token])
        self.next_state[state << 8 | byte] = new
        return new

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Each of the distinct words with its ids, by one walk along their trie."""
        stands, memo, tokens_at, next_state = self._stands, self.stands_memo, self.tokens_at, self.next_state
        path, last, size, states = b"", [-1], [0], [0]  # at each depth: the last token, its length, and the state
        for word in sorted(words):  # letters in order are their bytes in order
            data = word.encode("utf-8", "surrogatepass")
            most = min(len(path), len(data))
            differ = int.from_bytes(path[:most], "big") ^ int.from_bytes(data[:most], "big")
            shared = most - (differ.bit_length() + 7) // 8
            del last[shared + 1 :], size[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(data) + 1):
                byte = data[end - 1]
                at = next_state.get(state << 8 | byte)
                state = self._step(state, byte) if at is None else at
                states.append(state)
                for t, n in tokens_at[state]:
                    if n == end:
                        fits = self._whole(t)
                    else:
                        fits = memo.get((last[end - n], t))
                        if fits is None:
                            fits = stands(last[end - n], t)
                    if fits:
                        last.append(t)
                        size.append(n)
                        break
            path = data
            ids, at = [], len(data)
            while at:
                ids.append(last[at])
                at -= size[at]
            yield word, tuple(reversed(ids))

    def parts(self, text: str) -> list[str]:
        """Words and special tokens, in order."""
        words = ASCII_WORDS if text.isascii() else self.words
        if self.split is None or "<" not in text:
            return words.findall(text)
        out = []
        for i, part in enumerate(self.split.split(text)):
            out += [part] if i % 2 else words.findall(part)
        return out

    def learn(self, parted: list[list[str]]) -> None:
        """Encodes all words of these texts that are not known yet, together."""
        met = set().union(*parted)
        new = {w for w in met if w not in self.known}
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = met
        for s in new & self.special.keys():
            self.known[s] = ((self.special[s],), str(self.special[s]), s.encode())
            new.discard(s)
        gc.disable()  # nothing made here refers back to itself, and what is kept would be gone through again and again
        try:
            for word, ids in self.encode_words(list(new)):
                self.known[word] = (ids, ",".join(map(str, ids)), self.decode_bytes(ids))
        finally:
            gc.enable()

    def decode_bytes(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_KEPT: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One encoder per worker and file."""
    if path not in _KEPT:
        _KEPT[path] = TrieEncoder(path)
    return _KEPT[path]


def _runs(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """Consecutive texts of about that many characters together."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        enc, out = encoder(path), []
        for part in _runs(texts.tolist()):
            parted = [enc.parts(t) for t in part]
            enc.learn(parted)
            out += [[i for w in words for i in enc.known[w][0]] for words in parted]
        return pd.Series(out, dtype=object)

    return docs.withColumn(ids, run(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def decode(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text of the ids; a null stays null."""

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        enc = encoder(path)
        return pd.Series([None if r is None else enc.decode(np.asarray(r).tolist()) for r in rows], dtype=object)

    return coded.withColumn(text, run(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids as text and of the decoded text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        enc, out = encoder(path), []
        for part in _runs(texts.tolist()):
            parted = [enc.parts(t) for t in part]
            enc.learn(parted)
            known = enc.known
            for words in parted:
                hits = [known[w] for w in words]
                listed = ",".join([h[1] for h in hits])
                # Decoding joins the bytes of the ids; those of a word's ids were joined once.
                decoded = b"".join([h[2] for h in hits]).decode("utf-8", "replace")
                out.append((sum([len(h[0]) for h in hits]), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    own = docs.select(F.col(doc_id).alias("doc_id"), run(F.coalesce(F.col(text), F.lit(""))).alias("r"))
    return own.select("doc_id", "r.*")
