"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: vectors are centred, turned to their principal axes and rotated so that signs lose
least (iterative quantization); the signs are 64 bits at most. The rotation and the search
radius are learnt from a bounded sample of ``SAMPLE`` rows, taken by a hash of the id; the
radius is the Hamming distance within which ``COVER`` of the sample's true neighbours lie.

Index: every row's code is split into substrings of 8 bits, each row standing in one
bucket for each substring. If two codes are within R bits, some substring is within R / m
(pigeonhole), so a query looks into every bucket in that ball around each of its
substrings, and so meets every code within R. A pair met in several buckets counts in the
first. Pairs are verified on whole codes, then ranked by the exact distance of the
original vectors, each bucket keeping no more than the ``k`` best of each query.

Neighbouring buckets share a group of about ``BUCKET`` rows; a larger group is split by a
hash of the id, and the queries that look into it go to each piece; queries are dealt
likewise. So no group grows with the data,
no pairs leave a group beyond the k best, and a common vector makes more groups, not a
larger one.

Defined cases: vectors that are null, zero, of another length than most of the sample, or
hold null or non-finite components take no part, neither do rows without an id; a row
repeated with the same id and vector counts once; rows of the query's id are its own; ties
go to the smaller id; a query with fewer than k rows within the radius is searched
again with all rows in reach; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from rowtide.llm.common import settle

K = 10
SAMPLE = 20_000
PROBES = 300
COVER = 0.97
BITS = 8
BUCKET = 20_000
QUERIES = 2_000


@dataclass
class Codes:
    """How vectors become codes, and how far to look."""

    dim: int
    mean: np.ndarray
    turn: np.ndarray  # (dim, bits)
    radius: int

    @property
    def parts(self) -> int:
        return max(1, -(-self.turn.shape[1] // BITS))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        signs = ((vectors - self.mean) @ self.turn) > 0
        padded = np.zeros((len(signs), 64), bool)
        padded[:, : signs.shape[1]] = signs
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64).ravel()


def learn(vectors: np.ndarray, k: int = K, rounds: int = 40) -> Codes:
    """Codes fitted to a sample of vectors, one in each row."""
    n, dim = vectors.shape
    bits = min(dim, 64)
    mean = vectors.mean(0)
    centred = vectors - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    flat = centred @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))
    for _ in range(rounds):
        signs = np.where(flat @ turn > 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(signs.T @ flat)
        turn = (u @ w).T
    codes = Codes(dim, mean, axes @ turn, 0)
    all_codes = codes.of(vectors)
    apart = []
    for i in range(0, n, max(1, n // PROBES)):
        d = ((vectors - vectors[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, n - 1)]
        apart.append(np.bitwise_count(all_codes[near] ^ all_codes[i]))
    found = np.concatenate(apart) if apart else np.zeros(0)
    codes.radius = int(np.quantile(found, COVER, method="higher")) if len(found) else bits
    return codes


def _usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return (
        rows.select(F.col(vec_id).alias("vec_id"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.coalesce(fine & some, F.lit(False)))
        .dropDuplicates(["vec_id", "v"])
    )


def _nearest_in(part: int, codes: np.ndarray, ids: np.ndarray, v: np.ndarray, q_codes, q_ids, q_v, radius: int, near: int, k: int):
    """The k nearest of each query among the rows first met in this part, as (query, id, distance).

    Rows are put in order of their substring, so that each bucket is a run of them; queries
    of one substring probe the same buckets and are verified together.
    """
    sub = lambda c, p: (c >> np.uint64(BITS * p)) & np.uint64((1 << BITS) - 1)
    own, out = sub(codes, part), []
    order = np.argsort(own, kind="stable")
    buckets, start = np.unique(own[order], return_index=True)
    end = np.append(start[1:], len(order))
    asked = sub(q_codes, part)
    for value in np.unique(asked):
        hit_buckets = np.flatnonzero(np.bitwise_count(buckets ^ value) <= near)
        if not len(hit_buckets):
            continue
        rows = np.concatenate([order[start[b] : end[b]] for b in hit_buckets])
        same = np.flatnonzero(asked == value)
        for at in range(0, len(same), 64):
            qs = same[at : at + 64]
            differ = q_codes[qs, None] ^ codes[None, rows]
            ok = np.bitwise_count(differ) <= radius
            for p in range(part):
                ok &= np.bitwise_count(sub(differ, p)) > near
            for q, line in zip(qs, ok, strict=True):
                hit = rows[line]
                hit = hit[ids[hit] != q_ids[q]]
                if len(hit):
                    d = np.sqrt(((v[hit] - q_v[q]) ** 2).sum(1))
                    if len(hit) > k:
                        short = d <= np.partition(d, k - 1)[k - 1]
                        hit, d = hit[short], d[short]
                    best = np.lexsort((ids[hit], d))[:k]
                    out.append((np.full(len(best), q_ids[q]), ids[hit][best], d[best]))
    return out


def search(
    rows: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, bucket: int = BUCKET
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's nearest rows."""
    spark = rows.sparkSession
    usable = settle(_usable(rows, vec_id, vector))
    seekers = _usable(queries, vec_id, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    drawn = usable.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "vec_id").limit(SAMPLE).select("v").collect()
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = np.array([len(r[0]) for r in drawn])
    dim = int(np.bincount(sizes).argmax())
    codes = learn(np.array([r[0] for r, n in zip(drawn, sizes, strict=True) if n == dim]), k)
    shared = spark.sparkContext.broadcast(codes)  # dim x 64 numbers

    @F.pandas_udf(LongType())
    def code_of(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="int64")
        return pd.Series(shared.value.of(np.stack(vectors.to_numpy())).view(np.int64))

    coded = settle(usable.filter(F.size("v") == dim).withColumn("code", code_of("v")))
    asked = settle(seekers.filter(F.size("v") == dim).withColumn("code", code_of("v")))
    whole = (1 << BITS * codes.parts) - 1
    found = settle(_look_up(coded, asked, codes.parts, codes.radius, k, bucket))
    # Queries that found fewer than k rows look at everything, if there is more.
    wanted = min(k, coded.select("vec_id").distinct().count() - 1)
    enough = found.groupBy("query_id").count().filter(F.col("count") >= wanted).select(F.col("query_id").alias("vec_id"))
    short = settle(asked.join(enough, "vec_id", "left_anti"))
    if not short.isEmpty():
        again = _look_up(coded, short, 1, whole.bit_length(), k, bucket)
        found = found.join(enough.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").unionByName(again)
    return found


def _look_up(coded: DataFrame, asked: DataFrame, parts: int, radius: int, k: int, bucket: int) -> DataFrame:
    """The ranked rows within the radius of each query, found through the buckets of its substrings."""
    near, last = min(BITS, radius // parts), (1 << BITS) - 1
    n_rows = coded.count()
    # Buckets of neighbouring values share a group: as many groups as keep it near ``bucket`` rows.
    shift = max(0, BITS - max(0, -(-n_rows // bucket) - 1).bit_length())
    sub = lambda p: F.shiftrightunsigned("code", p * BITS).bitwiseAND(F.lit(last)).cast("int")
    split = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), sub(p).alias("value")) for p in range(parts)])).alias("s")
    # Large groups are split; their sizes are parts x 256 rows at most.
    sizes = coded.select(split).select("s.part", F.shiftright("s.value", shift).alias("shard")).groupBy("part", "shard").count().collect()
    large = {r["part"] * (last + 1) + r["shard"]: n for r in sizes if (n := -(-r["count"] // bucket)) > 1}
    pieces = F.lit(1)
    if large:
        by_shard = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
        pieces = F.coalesce(F.try_element_at(by_shard, F.col("part") * (last + 1) + F.col("shard")), F.lit(1))
    deals = max(1, -(-asked.count() // QUERIES))
    index = (
        coded.select("vec_id", "v", "code", split)
        .select("vec_id", "v", "code", "s.part", F.shiftright("s.value", shift).alias("shard"))
        .withColumn("piece", F.pmod(F.xxhash64("vec_id"), pieces).cast("int"))
        .withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    )
    masks = F.array(*[F.lit(m) for m in range(last + 1) if m.bit_count() <= near])
    reach = F.array_distinct(F.transform(masks, lambda m: F.shiftright(F.col("s.value").bitwiseXOR(m), shift)))
    probes = (
        asked.withColumn("deal", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(deals)).cast("int"))
        .select("vec_id", "v", "code", "deal", split)
        .select("vec_id", "v", "code", "deal", "s.part", F.explode(reach).alias("shard"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    )

    def met(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            column = lambda f, c: f[c].to_numpy(np.int64)
            found = _nearest_in(
                int(key[0]),
                column(left, "code").view(np.uint64), column(left, "vec_id"), np.stack(left["v"].to_numpy()),
                column(right, "code").view(np.uint64), column(right, "vec_id"), np.stack(right["v"].to_numpy()),
                radius, near, k,
            )
        names = ("query_id", "vec_id", "score")
        if not found:
            return pd.DataFrame({n: [] for n in names})
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*found, strict=True), strict=True)})

    place = ["part", "shard", "piece", "deal"]
    best = index.groupBy(*place).cogroup(probes.groupBy(*place)).applyInPandas(met, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
