"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its 3-word shingle hashes have it.
Fingerprints that differ in 3 bits or fewer are linked, and documents take the smallest
doc_id they can reach. Equal fingerprints are one node, so copies cost nothing.

Every fingerprint is stored under its two 32-bit halves. Of two fingerprints within 3
bits, one half differs in at most one bit (pigeonhole), so looking up the ball of radius
1 around each half finds every link; as a differing bit is clear on one side, only clear
bits are flipped, about 17 lookups a half. Matches are verified on the whole 64 bits.

Where over ``DENSE`` fingerprints share a half (a large group of near copies), pairs would
grow with the square of the group. There, links are found through midpoints: in a bucket
whose members agree in a half, two members are within 3 bits exactly if some value of the
other half is within 1 of one and within 2 of the other; for lookups with a flipped bit, 2
bits, within 1 of both. All that meet at such a value are connected to the least of them:
561 rows a member, no pairs, and the same components. Components then come from repeated
neighbour minima with shortcuts, settled after each round.

Defined cases: a null or empty text has no words and fingerprint 0, linked like any other;
one or two words are one shingle; repeated rows each get their row; a null doc_id takes
part but names no component unless all of the component's are null; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rowtide.llm.common import let, lower_ascii, settle, text_of, words
from rowtide.llm.components import components

SHINGLE = 3
MAX_BITS = 3
#: Above this many fingerprints in a bucket, midpoints instead of pairs.
DENSE = 16


def shingle_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of every shingle, repeats included; of all words if there are fewer."""
    first = lambda x, gap: F.slice(x, gap + 1, F.greatest(F.lit(0), F.size(x) - gap))
    joined = lambda a, b: F.concat_ws(" ", a, b)

    def hashed(w: Column) -> Column:
        triples = F.zip_with(F.zip_with(w, first(w, 1), joined), first(w, 2), lambda a, b: F.xxhash64(joined(a, b)))
        return (
            F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(F.size(w) < SHINGLE, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.slice(triples, 1, F.greatest(F.lit(0), F.size(w) - (SHINGLE - 1))))
        )

    return let(words(lower_ascii(text)), hashed)


def majority(hashes: np.ndarray) -> int:
    """A long whose bits are those set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    raw, total = np.ascontiguousarray(hashes, np.int64).view(np.uint8).reshape(n, 8), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # a piece at a time: memory stays small for any length
        total += np.unpackbits(raw[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def majority_bits(hashes: pd.Series) -> pd.Series:
    return pd.Series([majority(h) for h in hashes], dtype=np.int64)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fp``, the text left out."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(*others, shingle_hashes(text_of(text)).alias("__h")).select(*others, majority_bits("__h").alias("fp"))


def _halves(fp: Column) -> Column:
    low, high = fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)
    return F.array(
        F.struct(F.lit(0).alias("seg"), low.alias("key"), high.alias("rest")),
        F.struct(F.lit(1).alias("seg"), high.alias("key"), low.alias("rest")),
    )


def _rest(seg: Column, fp: Column) -> Column:
    """The other half than the one that ``seg`` numbers."""
    return F.when(seg == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(0xFFFFFFFF)))


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _ball(value: Column, radius: int) -> Column:
    """All 32-bit values within that many bits, with the number of them."""
    bits = [1 << i for i in range(32)]
    flips = [(0, 0)] + [(b, 1) for b in bits]
    if radius > 1:
        flips += [(bits[i] | bits[j], 2) for i in range(32) for j in range(i)]
    table = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(d).alias("d")) for m, d in flips])
    return F.transform(table, lambda x: F.struct(value.bitwiseXOR(x["m"]).alias("mid"), x["d"].alias("d")))


def links(nodes: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): links enough to connect whatever fingerprints are within 3 bits; ``nodes`` has distinct ``fp``."""
    stored = nodes.select("fp", F.explode(_halves(F.col("fp"))).alias("s")).select("fp", "s.*")
    crowd = stored.groupBy("seg", "key").agg(F.count("*").alias("n"))
    stored = settle(stored.join(crowd.filter(F.col("n") > dense), ["seg", "key"], "left").withColumn("hot", F.col("n").isNotNull()).drop("n"))
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    probes = stored.select(
        "seg",
        F.explode(F.transform(F.filter(bits, lambda b: F.col("key").bitwiseAND(b) == 0), lambda b: F.col("key") + b)).alias("key"),
        "fp",
    )
    # Most lookups find nobody: those that do are told once, for buckets of few and of many.
    taken = stored.groupBy("seg", "key").agg(F.max("hot").alias("hot"))
    probes = settle(probes.join(taken, ["seg", "key"])).withColumn("rest", _rest(F.col("seg"), F.col("fp")))
    other = stored.select("seg", "key", F.col("fp").alias("other"), F.col("rest").alias("other_rest"), "hot")
    # Buckets of few: pairs, verified within the join.
    few = other.filter(~F.col("hot"))
    same = (
        stored.filter(~F.col("hot"))
        .select("seg", "key", "fp", "rest")
        .join(few, ["seg", "key"])
        .filter((F.col("fp") < F.col("other")) & (_apart(F.col("rest"), F.col("other_rest")) <= MAX_BITS))
    )
    flipped = probes.filter(~F.col("hot")).drop("hot").join(few, ["seg", "key"]).filter(_apart(F.col("rest"), F.col("other_rest")) <= MAX_BITS - 1)
    pairs = same.select("fp", "other").unionByName(flipped.select("fp", "other"))
    # Buckets of many: whoever meets at a midpoint is connected to the least there.
    many = stored.filter("hot").select("seg", "key", "fp", "rest")
    inside = many.select("seg", "key", "fp", F.explode(_ball(F.col("rest"), 2)).alias("x")).select("seg", "key", "fp", "x.mid", "x.d")
    looking = probes.filter("hot").select(
        "seg", "key", "fp", F.explode(_ball(F.col("rest"), 1)).alias("x")
    ).select("seg", "key", "fp", "x.mid", F.lit(1).alias("d"), F.lit(True).alias("probe"))
    inside = inside.withColumn("probe", F.lit(False))
    place = ["seg", "key", "mid"]
    own = ~F.col("probe")
    least = (
        inside.unionByName(looking)
        .groupBy(*place)
        .agg(
            F.min(F.when(own & (F.col("d") <= 1), F.col("fp"))).alias("near"),
            F.count(F.when(own, 1)).alias("n_own"),
            F.count(F.when(~own, 1)).alias("n_probe"),
        )
        # Someone within 1 must be there, and someone else to meet.
        .filter(F.col("near").isNotNull() & (F.col("n_own") + F.col("n_probe") > 1))
        .select(*place, "near")
    )
    met = inside.select(*place, "fp").unionByName(looking.select(*place, "fp")).join(least, place)
    stars = met.filter(F.col("fp") != F.col("near")).select("fp", F.col("near").alias("other")).distinct()
    return pairs.unionByName(stars).select(F.col("fp").alias("a"), F.col("other").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (a long), component_id, and the columns of ``keep``."""
    marked = settle(fingerprints(docs.select(*dict.fromkeys([doc_id, *keep]), text), text))
    nodes = settle(marked.groupBy("fp").agg(F.min(doc_id).alias("least")))
    grouped = components(links(nodes), nodes.select(F.col("fp").alias("node"), F.col("least").alias("label")))
    reach = grouped.select(F.col("node").alias("__fp"), F.col("label").alias("component_id"))
    return marked.join(reach, marked["fp"] == reach["__fp"]).drop("__fp")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    done = near_duplicates(docs.select("doc_id", "text"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", near=near_duplicates) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, as ``near`` tells it, one row of each.

    Among several texts under that id the one of least hash stays; among repeated rows any.
    """
    own = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("t"))
    grouped = settle(near(own, "doc", "t", ("version",)))
    # A null id comes last, so that it stays only where there is no other.
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "version"))
    alone = F.when(F.col("component_id").isNull(), F.col("fp"))
    stay = grouped.groupBy("component_id", alone.alias("alone")).agg(first.alias("s"))
    stay = stay.select(F.col("s.doc").alias("__doc"), F.col("s.version").alias("__version"))
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("__version"))
    kept = docs.alias("d").join(stay, same, "left_semi")
    if grouped.groupBy("doc", "version").count().filter("count > 1").isEmpty():
        return kept
    return kept.withColumn("__version", F.xxhash64(text)).dropDuplicates([doc_id, "__version"]).drop("__version")
