"""Near copies by the similarity of their word shingles.

Texts are near copies if the Jaccard similarity of their sets of 5-word shingles is at
least 0.8, and documents take the smallest doc_id they can reach by such links. Texts with
equal sets are one node, so copies cost nothing.

Candidates come from SimHash first: a fingerprint of the same shingles, by majority of
their bits, and those within 3 bits, as ``simhash.links`` finds them. That reaches the
closest copies only (at a similarity of 0.8 some ten bits differ), so it is joined by
min-hashes: ``BANDS`` bands of ``ROWS`` of them. Two texts meet in a
band if they agree in all its rows, so a pair of similarity s is missed with a chance of
(1 - s^ROWS)^BANDS: 3 in a million at 0.8, 3 in a hundred million million at 0.9. Each
candidate pair is verified on the whole sets.

Where over ``DENSE`` texts meet (a large group of near copies, or texts that share a
passage), pairs would grow with the square of the group. There, each text is first compared
with the least that it meets, and texts that this connects need no comparison among each
other. Those outside the place's largest component then meet, of all that they aren't
connected with yet, only whom they can be similar to: two sets of n shingles with a
similarity of 0.8 share one of the n / 5 + 1 rarest shingles of each, and enough of what
comes after it. That is exact, so no link is left out, and a passage that many texts share
brings none of them together, as its shingles are the frequent ones.

Defined cases: a null or empty text has an empty set, the same as any other empty one;
fewer than five words are one shingle; a null doc_id takes part but names no component
unless all of the component's are null; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from rowtide.llm import simhash
from rowtide.llm.common import let, lower_ascii, settle, text_of, words
from rowtide.llm.components import components

SHINGLE = 5
SIMILAR = Fraction(4, 5)
BANDS = 32
ROWS = 5
#: Above this many texts in a place, the least of them first instead of all pairs.
DENSE = 16
#: Cells in which the frequency of shingles is counted.
CELLS = 1 << 18
_DRAWN = np.random.default_rng(10).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64, endpoint=False)
_FLIP, _TIMES = _DRAWN[0], _DRAWN[1] | np.uint64(1)
_FOLD = np.random.default_rng(11).integers(0, 1 << 64, (BANDS, ROWS + 1), np.uint64, endpoint=False) | np.uint64(1)


def shingle_hashes(text: Column) -> Column:
    """XXH64 of every 5-word shingle, repeats included; of all words if there are fewer."""

    def hashed(w: Column) -> Column:
        behind = [F.slice(w, k + 1, F.greatest(F.lit(0), F.size(w) - k)) for k in range(1, SHINGLE)]
        runs = F.slice(F.arrays_zip(w, *behind), F.lit(1), F.greatest(F.lit(0), F.size(w) - (SHINGLE - 1)))
        return (
            F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(F.size(w) < SHINGLE, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.transform(runs, lambda x: F.xxhash64(x)))
        )

    return let(words(lower_ascii(text)), hashed)


def signature(hashes: np.ndarray) -> tuple[int, int, np.ndarray]:
    """A hash of the set, its size, and the place of the set in each band."""
    u = np.unique(np.ascontiguousarray(hashes, np.int64)).view(np.uint64)
    key = int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)
    if not len(u):
        return key, 0, np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(u), 2048):  # a piece at a time: memory stays small for any length
        least = np.minimum(least, ((u[None, at : at + 2048] ^ _FLIP) * _TIMES).min(1))
    place = _FOLD[:, ROWS].copy()
    for r in range(ROWS):
        place = (place ^ least.reshape(BANDS, ROWS)[:, r]) * _FOLD[:, r]
        place ^= place >> np.uint64(31)
    return key, len(u), place.view(np.int64)


@F.pandas_udf(StructType().add("fp", LongType()).add("n", IntegerType()).add("places", ArrayType(LongType())).add("bits", LongType()))
def signatures(hashes: pd.Series) -> pd.DataFrame:
    """``signature`` of each list, and its SimHash fingerprint: the bits that over half of its distinct hashes have."""
    told = pd.DataFrame([signature(h) for h in hashes], columns=["fp", "n", "places"])
    return told.assign(bits=[simhash.majority(np.unique(h)) for h in hashes])


def _comparable(n: Column, other: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    up, down = SIMILAR.numerator, SIMILAR.denominator
    return F.least(n, other).cast("long") * down >= F.greatest(n, other).cast("long") * up


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets, (node, s), are similar."""
    left, right = sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - both
    similar = both * SIMILAR.denominator >= union * SIMILAR.numerator
    return pairs.join(left, "a").join(right, "b").filter(similar).select("a", "b")


def prefixes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, size, at, g): the rarest shingles of each node's set, floor(size / 5) + 1 of them.

    Rarity is that among ``nodes``, counted in ``CELLS`` cells of shingle hashes. Shingles that
    share a cell are taken for equally frequent; any order that is the same for all sets finds
    all pairs, this one keeps frequent shingles out of the prefixes.
    """
    own = sets.join(nodes, "node").select("node", "s")
    cell = F.pmod(F.col("g"), F.lit(CELLS)).cast("int")
    counted = own.select(F.explode("s").alias("g")).groupBy(cell.alias("cell")).count().toPandas()  # ``CELLS`` rows at most
    often = np.zeros(CELLS, np.int64)
    often[counted["cell"]] = counted["count"]
    shared = nodes.sparkSession.sparkContext.broadcast(often)

    @F.pandas_udf(ArrayType(LongType()))
    def rarest(sets: pd.Series) -> pd.Series:
        def of(s: np.ndarray) -> np.ndarray:
            g = np.asarray(s, np.int64)
            order = np.lexsort((g, shared.value[g % CELLS]))
            return g[order[: len(g) * (SIMILAR.denominator - SIMILAR.numerator) // SIMILAR.denominator + 1]]

        return pd.Series([of(s) for s in sets], dtype=object)

    first = own.select("node", F.size("s").alias("size"), rarest("s").alias("r"))
    return first.select("node", "size", F.posexplode("r").alias("at", "g"))


def simhash_candidates(nodes: DataFrame) -> DataFrame:
    """(a, b): sets whose SimHash fingerprints are within 3 bits, and whose sizes let them be similar.

    Of the sets under one fingerprint each meets the least, which also stands for them all among
    other fingerprints; sets that this leaves apart still meet by their min-hashes.
    """
    least = nodes.groupBy("bits").agg(F.min(F.struct("fp", "n")).alias("first"))
    near = simhash.links(least.select(F.col("bits").alias("fp")))
    one, other = (least.select(F.col("bits").alias(side), F.col("first").alias(f"first_{side}")) for side in ("a", "b"))
    across = near.join(one, "a").join(other, "b").select(F.col("first_a").alias("x"), F.col("first_b").alias("y"))
    under = nodes.join(least, "bits").select(F.col("first").alias("x"), F.struct("fp", "n").alias("y"))
    both = across.unionByName(under).filter((F.col("x.fp") != F.col("y.fp")) & _comparable(F.col("x.n"), F.col("y.n")))
    return both.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()


def links(nodes: DataFrame, texts: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): links enough to connect all near copies. ``nodes``: fp, n, places, bits, own; ``texts``: own, t."""
    close = settle(simhash_candidates(nodes))
    stored = nodes.select(F.col("fp").alias("node"), "n", F.explode("places").alias("place"))
    met = stored.groupBy("place").agg(F.count("*").alias("members")).filter("members > 1")
    shared = settle(stored.join(met, "place").withColumn("many", F.col("members") > dense).select("place", "node", "n", "many"))
    ends = close.select(F.explode(F.array("a", "b")).alias("node"))
    members = settle(shared.select("node").unionByName(ends).distinct())
    # One text of each set that meets another.
    wanted = nodes.select(F.col("fp").alias("node"), "own").join(members, "node")
    one = texts.join(wanted, "own").groupBy("node").agg(F.min("t").alias("t"))
    sets = settle(one.select("node", F.array_distinct(shingle_hashes(text_of("t"))).alias("s")))
    few, many = shared.filter(~F.col("many")).select("place", "node", "n"), shared.filter("many")
    other = few.select("place", F.col("node").alias("b"), F.col("n").alias("nb"))
    pairs = few.join(other, "place").filter((F.col("node") < F.col("b")) & _comparable(F.col("n"), F.col("nb")))
    least = many.groupBy("place").agg(F.min(F.struct("node", "n")).alias("first"))
    stars = many.join(least, "place").filter((F.col("node") != F.col("first.node")) & _comparable(F.col("n"), F.col("first.n")))
    first = pairs.select(F.col("node").alias("a"), "b").unionByName(stars.select(F.col("first.node").alias("a"), F.col("node").alias("b")))
    found = settle(verified(first.unionByName(close).distinct(), sets))
    if many.isEmpty():
        return found
    # Places of many: who isn't connected with most of the others meets all that it isn't connected with.
    label = settle(components(found, members.withColumn("label", F.col("node"))))
    told = many.select("place", "node", "n").join(label, "node")
    groups = told.groupBy("place", "label").agg(F.count("*").alias("k"))
    mixed = groups.groupBy("place").agg(F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("labels")).filter("labels > 1")
    told = settle(told.join(mixed.select("place", F.col("most.label").alias("most")), "place"))
    own = told.groupBy("node").agg(F.any_value("label").alias("label"), F.max(F.col("label") != F.col("most")).alias("apart"))
    rare = settle(prefixes(own.select("node"), sets).join(own, "node"))
    apart = rare.filter("apart").select("g", "node", "size", "at", "label")
    other = rare.select("g", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("at").alias("at_b"), F.col("label").alias("of"))
    up, down = SIMILAR.numerator, SIMILAR.denominator
    # Shared at most: this shingle and, if it is the first that they share, what is left behind it in each.
    shared = F.least(F.col("size") - F.col("at"), F.col("size_b") - F.col("at_b")).cast("long")
    enough = shared * (up + down) >= (F.col("size") + F.col("size_b")).cast("long") * up
    rest = apart.join(other, "g").filter((F.col("label") != F.col("of")) & _comparable(F.col("size"), F.col("size_b")) & enough)
    rest = rest.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    # What is connected already is so by one link a text.
    joined = label.filter(F.col("node") != F.col("label")).select(F.col("label").alias("a"), F.col("node").alias("b"))
    return joined.unionByName(verified(rest, sets))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), dense: int = DENSE
) -> DataFrame:
    """doc_id, fp (a hash of the set of shingles), component_id, and the columns of ``keep``."""
    slim = docs.select(*dict.fromkeys([doc_id, *keep]), F.xxhash64(text).alias("__own"), signatures(shingle_hashes(text_of(text))).alias("__s"))
    kept = [F.col(f"`{c}`") for c in dict.fromkeys([doc_id, *keep])]
    marked = settle(slim.select(*kept, "__own", F.col("__s.fp").alias("fp"), F.col("__s.n").alias("__n"), F.col("__s.places").alias("__places"), F.col("__s.bits").alias("__bits")))
    nodes = settle(
        marked.groupBy("fp").agg(F.min(doc_id).alias("least"), F.min("__own").alias("own"), F.any_value("__n").alias("n"), F.any_value("__places").alias("places"), F.any_value("__bits").alias("bits"))
    )
    texts = docs.select(F.xxhash64(text).alias("own"), F.col(text).alias("t"))
    grouped = components(links(nodes, texts, dense), nodes.select(F.col("fp").alias("node"), F.col("least").alias("label")))
    reach = grouped.select(F.col("node").alias("__fp"), F.col("label").alias("component_id"))
    return marked.drop("__own", "__n", "__places", "__bits").join(reach, marked["fp"] == reach["__fp"]).drop("__fp")
