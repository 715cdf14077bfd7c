"""Running values over long ordered groups, without one task per group.

A shard may hold a third of all rows, so a window over the shard alone would put
them into one task. Here the order is cut into chunks: each chunk is one small
window, chunk totals are pre-aggregated, and only those totals (one row per
chunk) see a window over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "__chunk"
_CARRY = "__carry"

# Values of the leading order column per chunk. A chunk is sorted by one task, the
# chunks of a group by another: both stay small up to some 10^12 rows a group.
SPAN = 262_144


def span_chunk(column: str, span: int) -> Column:
    """An order-preserving chunk number: ``span`` consecutive values share one."""
    return F.floor(F.col(column) / F.lit(span)).cast("bigint")


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    span: int = SPAN,
) -> DataFrame:
    """Last non-null ``values`` at or before each row, per ``keys`` in ``order``.

    ``order[0]`` is a number and sets the chunks. Wrap a value in a struct if its
    own null must count.
    """
    keys, order = list(keys), list(order)
    chunked = df.withColumn(CHUNK, span_chunk(order[0], span))
    at = F.struct(*order)
    marked = chunked.withColumns({f"__v_{n}": v for n, v in values.items()})
    within = W.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)

    tails = marked.groupBy(*keys, CHUNK).agg(
        *[
            F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), at)).alias(f"__t_{n}")
            for n in values
        ]
    )
    carries = tails.select(
        *keys,
        CHUNK,
        *[F.last(f"__t_{n}", ignorenulls=True).over(before).alias(f"{_CARRY}_{n}") for n in values],
    )
    return (
        marked.withColumns(
            {f"__w_{n}": F.last(f"__v_{n}", ignorenulls=True).over(within) for n in values}
        )
        .join(carries, [*keys, CHUNK])
        .withColumns({n: F.coalesce(f"__w_{n}", f"{_CARRY}_{n}") for n in values})
        .drop(CHUNK, *[f"{p}_{n}" for n in values for p in ("__v", "__w", _CARRY)])
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    chunks: Sequence[Column],
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in ``order``.

    ``chunks`` must preserve ``order``: a later chunk holds only later rows.
    """
    keys, order = list(keys), list(order)
    parts = [f"{CHUNK}{i}" for i in range(len(chunks))]
    chunked = df.withColumns(dict(zip(parts, chunks))).withColumn("__x", value)
    before = W.partitionBy(*keys).orderBy(*parts).rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy(*keys, *parts).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    offsets = (
        chunked.groupBy(*keys, *parts)
        .agg(F.sum("__x").alias("__sum"))
        .select(*keys, *parts, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        chunked.withColumn("__in", F.sum("__x").over(within))
        .join(offsets, [*keys, *parts])
        .withColumn(name, F.col("__in") + F.col("__offset"))
        .drop("__x", "__in", "__offset", *parts)
    )


def running_number(
    df: DataFrame,
    keys: Sequence[str],
    chunks: Sequence[Column],
    order: Sequence[str],
    name: str,
) -> DataFrame:
    """``row_number`` per ``keys`` in ``order``, chunk by chunk."""
    return running_sum(df, keys, chunks, order, F.lit(1).cast("bigint"), name)
