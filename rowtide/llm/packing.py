"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

Documents become token pieces of at most ``max_len``. The plan looks at nothing but how
many pieces there are of each length (``max_len`` numbers, however many documents):

1. patterns of two or three lengths that fill a sequence exactly are enumerated, and
   non-negative least squares fits to each how often it is repeated so that together they
   use up the histogram;
2. the fit is rounded down, as far as pieces last;
3. what is left is packed best-fit decreasing, all pieces of one length at a time.

The plan is a table of intervals (length, ranks from-to, first sequence, offset); its size
depends on ``max_len`` only, so it is broadcast. Each piece takes the interval that its
rank among the pieces of its length falls into. Ranks are counted within salted groups
and shifted by the sizes of the groups before, so that a length shared by most pieces is
no hot group.

Defined cases: a null text is empty; an empty text is the end token alone; equal pieces of
repeated rows are placed apart; a null doc_id is placed like any other; an empty table
gives an empty table. Tokens of a text are those of its words one after another: the
tokenizer parts words at white space and nothing it does looks across.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.bpe import byte_letters
from rowtide.llm.common import settle

_BYTE_LETTERS = {b: letter for letter, b in byte_letters().items()}
MAX_LEN = 4096
END_ID = 1
#: Ranks are counted in groups of about this many pieces.
RANK_GROUP = 500_000
#: Words whose tokens a worker keeps; it starts anew beyond.
CACHE_WORDS = 1_200_000
#: Small letters that neither folding nor composing changes: a-z, and those of Latin-1 and Cyrillic.
_SMALL = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf]|\xd0[\xb0-\xbf]|\xd1[\x80-\x8f])"
_LETTERS = re.compile(_SMALL + rb"+")
#: Signs that are words of their own to the tokenizer where they end a word after a letter or digit.
_SIGNS = b".,!?:;#*$%&|"
_KEPT: dict[str, tuple[object, dict[bytes, bytes]]] = {}


def _learn(tokenizer, known: dict[bytes, bytes], new: list[bytes]) -> None:
    """Adds the ids of these words; a word with signs behind it is put together from both.

    A word of small letters is one word to the tokenizer too and nothing of it is folded, so
    its bytes, in the letters that stand for them, go to the model itself.
    """
    parts = {}
    for w in new:
        stem = w.rstrip(_SIGNS)
        if len(stem) < len(w) and (stem[-1:].isalnum() or _LETTERS.fullmatch(stem[-2:])):
            parts[w] = (stem, w[len(stem) :])
    whole = dict.fromkeys(w for w in new if w not in parts)
    whole.update(dict.fromkeys(x for pair in parts.values() for x in pair))
    model, ask = tokenizer.model, []
    for w in whole:
        if w in known:
            continue
        if _LETTERS.fullmatch(w):
            ids = [t.id for t in model.tokenize(w.decode("latin-1").translate(_BYTE_LETTERS))]
            known[w] = struct.pack(f"<{len(ids)}I", *ids)
        else:
            ask.append(w)
    for at in range(0, len(ask), 20_000):
        part = ask[at : at + 20_000]
        texts = [w.decode("utf-8", "surrogatepass") for w in part]
        for w, e in zip(part, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)
    for w, (stem, signs) in parts.items():
        known[w] = known[stem] + known[signs]


def _token_bytes(path: str, texts: list[str]) -> Iterator[bytes]:
    """The ids of each text as little-endian 32-bit numbers; every distinct word is encoded once.

    The tokenizer folds case, so A-Z is folded first, except where a text may hold the name
    of a special token.
    """
    if path not in _KEPT:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _KEPT[path] = (tokenizer, {})
    tokenizer, known = _KEPT[path]
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        found = (raw if b"<|" in raw else raw.lower()).split()
        own = {w: known.get(w) for w in dict.fromkeys(found)}
        new = [w for w, ids in own.items() if ids is None]
        if len(known) + 2 * len(new) > CACHE_WORDS:
            known.clear()
        if new:
            _learn(tokenizer, known, new)
            own.update((w, known[w]) for w in new)
        yield b"".join(map(own.__getitem__, found))


def pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_len: int = MAX_LEN, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces."""
    end = np.asarray([end_id], "<u4").tobytes()
    width = 4 * max_len

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            rows = []
            for i, ids in enumerate(_token_bytes(path, batch["text"].tolist())):
                ids += end
                rows += [(i, n, at // 4, len(p := ids[at : at + width]) // 4, zlib.crc32(p)) for n, at in enumerate(range(0, len(ids), width))]
            out = pd.DataFrame(rows, columns=["i", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = batch["doc_id"].array[out["i"].to_numpy(np.int64)]
            yield out[["doc_id", "piece", "start", "length", "ids_crc32"]]

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Ids travel as text, so that a null among them doesn't turn numbers into fractions.
    return slim.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long"
    ).withColumn("doc_id", F.col("doc_id").cast(kind))


def _patterns(counts: np.ndarray, stride: int = 48) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence; triples are taken every ``stride`` steps."""
    full = len(counts) - 1
    a = np.arange((full + 1) // 2, full)
    found = [np.stack([a, full - a, np.zeros_like(a)], 1)]
    for a in range((full + 2) // 3, full - 1):
        low, high = (full - a + 1) // 2, min(a, full - a - 1)
        b = np.arange(low + (-low + 7 * a) % stride, high + 1, stride)
        found.append(np.stack([np.full_like(b, a), b, full - a - b], 1))
    rows = np.concatenate(found)
    return rows[((counts[rows] > 0) | (rows == 0)).all(1)]


def fit_patterns(counts: np.ndarray, rows: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats of each pattern so that their lengths meet the histogram."""
    goal = counts.astype(float)
    goal[0] = 0

    def use(x: np.ndarray) -> np.ndarray:
        total = np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), len(goal))
        total[0] = 0
        return total

    # The step is one over a bound on the largest eigenvalue: row sums of A'A.
    often = np.bincount(rows.ravel(), minlength=len(goal)).astype(float)
    often[0] = 0
    step = 1 / max(1.0, often[rows].sum(1).max())
    x = np.zeros(len(rows))
    y, t = x, 1.0
    for _ in range(rounds):
        gap = use(y) - goal
        gap[0] = 0
        z = np.maximum(0, y - step * gap[rows].sum(1))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = z + (t - 1) / t_next * (z - x)
        x, t = z, t_next
    return x


def plan(counts: np.ndarray, stride: int = 48) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Intervals (length, rank from, rank to, first sequence, offset) and the number of sequences.

    ``counts[n]`` is the number of pieces of length n; ``len(counts) - 1`` fills a sequence.
    """
    full = len(counts) - 1
    left, used = counts.astype(np.int64).copy(), np.zeros(full + 1, np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        r = int(used[length])
        out.append((length, r, r + n, first, offset))
        used[length] += n
        left[length] -= n

    if left[full]:
        n = int(left[full])
        place(full, n, 0, 0)
        sequences = n
    rows = _patterns(left, stride)
    if len(rows):
        repeats = np.floor(fit_patterns(left, rows) + 1e-9).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            if not repeats[k]:
                break
            lengths = [int(n) for n in rows[k] if n]
            n = int(min(repeats[k], *(left[v] // lengths.count(v) for v in lengths)))
            if n > 0:
                offset = 0
                for v in lengths:
                    place(v, n, sequences, offset)
                    offset += v
                sequences += n
    # Best fit decreasing. room: free places -> groups (first sequence, how many); spaces: its keys in order.
    room: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def free(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                room[space] = []
                insort(spaces, space)
            room[space].append((first, n))

    for length in range(full - 1, 0, -1):
        while left[length]:
            c = int(left[length])
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space], spaces[at]
            else:
                space, first, n = full, sequences, -(-c // (full // length))
                sequences += n
            each = space // length
            whole = min(n, c // each)
            for j in range(each):
                if whole:
                    place(length, whole, first, full - space + j * length)
            free(space - each * length, first, whole)
            rest = c - whole * each if whole < n else 0
            if rest:
                for j in range(rest):
                    place(length, 1, first + whole, full - space + j * length)
                free(space - rest * length, first + whole, 1)
                whole += 1
            free(space, first + whole, n - whole)
    return out, sequences


def pack(parts: DataFrame, max_len: int = MAX_LEN, rank_group: int = RANK_GROUP, stride: int = 48) -> DataFrame:
    """``parts`` (settled: doc_id, piece, length) with sequence_id and offset."""
    spark = parts.sparkSession
    counts = np.zeros(max_len + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():  # max_len rows at most
        counts[length] = n
    intervals, _ = plan(counts, stride)
    table = spark.createDataFrame(
        pd.DataFrame(intervals, columns=["length", "r0", "r1", "first", "at"], dtype="int64"),
        "length long, r0 long, r1 long, first long, at long",
    )
    salts = int(max(1, -(-counts.max() // rank_group)))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length",
        "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("r", F.row_number().over(inside) - 1)
    if salts > 1:
        ranked = ranked.join(before, ["length", "salt"]).withColumn("r", F.col("r") + F.col("before")).drop("before")
    place = (F.col("r") >= F.col("r0")) & (F.col("r") < F.col("r1"))
    # Bounded by max_len, not by the documents: at most a few intervals for each pattern and each length.
    joined = ranked.join(F.broadcast(table.withColumnRenamed("length", "l")), (F.col("length") == F.col("l")) & place)
    return joined.select(
        *parts.columns, (F.col("first") + F.col("r") - F.col("r0")).alias("sequence_id"), F.col("at").alias("offset")
    )


def packed_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document, and where it lies."""
    return pack(settle(pieces(docs, path, doc_id, text)))
