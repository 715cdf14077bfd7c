"""Records -> current table.

The fold keeps, per key and column, the value of the highest ``seq`` that
carries the column, and the highest ``seq`` of a write and of a delete. That is
one aggregate with map-side combining: the shuffle carries at most one row per
key and map task, however often a key changes. The result does not depend on
order or repetition of the records, so a replayed batch is harmless (W11).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from rowtide.operators.running import running_number, span_chunk
from rowtide.operators.shape import DELETE, TRUNCATE

# State columns beside the key: a column's value sits in ``v_<name>``, the seq
# that wrote it in ``s_<name>``.
WRITE_SEQ, DELETE_SEQ = "write_seq", "delete_seq"


def fold_records(records: DataFrame, pk: Sequence[str], columns: Sequence[str],
                 seq: str = "seq") -> DataFrame:
    """Mergeable state, one row per key: what each column and the key last saw.

    TRUNCATE records carry no key and are left to ``last_truncate``.
    """
    pk = list(pk)
    s, op = F.col(seq), F.col("op")
    values = [c for c in columns if c not in pk]
    keyed = records.filter(op != TRUNCATE).select(
        *[F.col("row")[k].alias(k) for k in pk],
        F.when(op != DELETE, s).alias(WRITE_SEQ),
        F.when(op == DELETE, s).alias(DELETE_SEQ),
        *[F.col("row")[c].alias(f"v_{c}") for c in values],
        *[
            F.when((op != DELETE) & F.array_contains("written", c), s).alias(f"s_{c}")
            for c in values
        ],
    )
    return merge_state_rows(keyed, pk, values)


def merge_state_rows(rows: DataFrame, pk: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Merge any number of state rows per key into one; associative and idempotent."""
    # One maximum per column, of (seq, value); a column that was not written has no pair.
    # A written null has one, so absent and null differ.
    last = lambda c: F.max(
        F.when(F.col(f"s_{c}").isNotNull(), F.struct(F.col(f"s_{c}").alias("s"), F.col(f"v_{c}").alias("v")))
    )
    merged = rows.groupBy(*pk).agg(
        F.max(WRITE_SEQ).alias(WRITE_SEQ),
        F.max(DELETE_SEQ).alias(DELETE_SEQ),
        *[last(c).alias(f"__{c}") for c in values],
    )
    return merged.select(
        *pk,
        WRITE_SEQ,
        DELETE_SEQ,
        *[F.col(f"__{c}.v").alias(f"v_{c}") for c in values],
        *[F.col(f"__{c}.s").alias(f"s_{c}") for c in values],
    )


def last_truncate(records: DataFrame, seq: str = "seq") -> DataFrame:
    """One row: the highest seq of a TRUNCATE, or null."""
    return records.filter(F.col("op") == TRUNCATE).agg(F.max(seq).alias("truncate_seq"))


def literal(value, like: DataType) -> Column:
    """A seq as a literal: a number, or a tuple for a place of several numbers; null for none."""
    if isinstance(value, tuple):
        value = F.struct(*[F.lit(v).alias(f.name) for v, f in zip(value, like.fields)])
    return (value if isinstance(value, Column) else F.lit(value)).cast(like)


def _after(seq: Column, floor: Column) -> Column:
    """Whether there is a seq, and it is later than the floor, if there is one."""
    return F.coalesce(seq > floor, seq.isNotNull())


def _floor(state: DataFrame, truncate_seq) -> Column:
    """What a write must be later than: the key's delete and the last TRUNCATE; null if neither is there."""
    return F.greatest(F.col(DELETE_SEQ), literal(truncate_seq, state.schema[DELETE_SEQ].dataType))


def rows_of_state(
    state: DataFrame, pk: Sequence[str], columns: Sequence[str], truncate_seq=None, dropped: Mapping[str, object] | None = None
) -> DataFrame:
    """The living rows of a folded state, none older than the last TRUNCATE (a seq or a column).

    D6: ``dropped`` gives the place at which a column went at the source. What was written to
    it up to there is null in every row, what came later under the same name stands.
    """
    floor = _floor(state, truncate_seq)
    kind = state.schema[DELETE_SEQ].dataType

    def own(c: str) -> Column:
        at = (dropped or {}).get(c)
        beyond = _after(F.col(f"s_{c}"), floor)
        if at is not None:
            beyond = beyond & (F.col(f"s_{c}") > literal(at, kind))
        return F.when(beyond, F.col(f"v_{c}")).alias(c)

    return state.filter(_after(F.col(WRITE_SEQ), floor)).select(*[F.col(c) if c in pk else own(c) for c in columns])


def current_state(records: DataFrame, pk: Sequence[str], columns: Sequence[str],
                  seq: str = "seq", truncates: bool = False, dropped: Mapping[str, object] | None = None) -> DataFrame:
    """The table after all records.

    TRUNCATE empties it, DELETE removes a row, other records create the row if
    absent and overwrite the columns they carry. ``truncates=True`` looks for
    TRUNCATE records; their highest seq is a scalar subquery, worked out once.
    ``dropped`` has the columns that went, with their places (D6).
    """
    state = fold_records(records, pk, columns, seq)
    last = last_truncate(records, seq).scalar() if truncates else None
    return rows_of_state(state, pk, columns, last, dropped)


def soft_delete(records: DataFrame, pk: Sequence[str], columns: Sequence[str],
                seq: str = "seq", synced_at: str | None = None, truncates: bool = False) -> DataFrame:
    """Rows stay with their last values, ``deleted`` marks the removed ones.

    With ``truncates=True`` a TRUNCATE marks all rows before it. ``synced_at`` is one UTC
    time for the whole run, handed in by the caller.
    """
    state = fold_records(records, pk, columns, seq)
    floor = _floor(state, last_truncate(records, seq).scalar() if truncates else None)
    out = state.select(
        *[F.col(c) if c in pk else F.col(f"v_{c}").alias(c) for c in columns],
        (~_after(F.col(WRITE_SEQ), floor)).alias("deleted"),
    )
    if synced_at is not None:
        out = out.withColumn("synced_at", F.lit(synced_at + "Z").cast("timestamp"))
    return out


def row_id(columns: Sequence[str], bits: int = 256) -> Column:
    """A hash of all values, to tell rows of a table without primary key apart.

    Each value goes in with its length and null has a mark of its own, so no two
    different rows give the same text.
    """
    return _hash({c: F.col(c) for c in columns}, bits)


def _row_id_of(image: Column, columns: Sequence[str]) -> Column:
    return _hash({c: image[c] for c in columns}, 256)


def _hash(values: dict[str, Column], bits: int) -> Column:
    def part(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))

    joined = F.concat_ws("|", *[part(v) for v in values.values()])
    return F.md5(joined) if bits == 128 else F.sha2(joined, bits)


def distinct_rows(table: DataFrame, columns: Sequence[str], bits: int = 256) -> DataFrame:
    """Equal rows once, with their ``row_id``.

    Equal rows have equal ids, so the values themselves are the grouping: that is a
    hash aggregate with map-side combining, and only its result is hashed.
    """
    return table.select(*columns).distinct().withColumn("row_id", row_id(columns, bits))


def row_index(
    table: DataFrame, columns: Sequence[str], span: int, name: str = "row_index"
) -> DataFrame:
    """Number equal rows in the order ``shard, seq``.

    Rows with equal ``columns`` are those with equal ids; for wide tables give
    ``["row_id"]``. However often one row comes, it is numbered in pieces of
    ``span`` values of ``seq``.
    """
    return running_number(
        table, columns, [F.col("shard"), span_chunk("seq", span)], ["shard", "seq"], name
    )


def with_row_id(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A5: give both images of a table without primary key their ``row_id``.

    With ``pk=['row_id']`` a DELETE then names the row it removes, and an UPDATE
    becomes a DELETE of the old row and an UPSERT of the new one.
    """
    def keyed(side: str) -> Column:
        image = F.col(side)
        return F.when(
            image.isNotNull(),
            F.struct(_row_id_of(image, columns).alias("row_id"), *[image[c] for c in columns]),
        )

    return changes.withColumns({"before": keyed("before"), "after": keyed("after")})


#: Copies of one row that a task writes at once.
COPIES = 100_000


def signed_rows(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Image pairs of a table without key as rows that come (``n`` = 1) and go (-1).

    An update is one of each; with equal images it is none. Other columns are kept.
    """
    b, a = F.col("before"), F.col("after")
    others = [c for c in changes.columns if c not in ("before", "after")]
    row = lambda image: F.struct(*[image[c].alias(c) for c in columns])
    side = lambda image, n: F.when(image.isNotNull(), F.struct(row(image).alias("row"), F.lit(n).alias("n")))
    same = F.lit(True)
    for c in columns:
        same = same & b[c].eqNullSafe(a[c])
    moves = F.when(b.isNotNull() & a.isNotNull() & same, F.array()).otherwise(F.array_compact(F.array(side(b, -1), side(a, 1))))
    return changes.select(*others, F.inline(moves)).select(*others, "row", "n")


def current_multiset(
    signed: DataFrame, columns: Sequence[str], seq: str = "seq", truncate_seq=None, replayed: bool = True, index: str | None = None
) -> DataFrame:
    """A table without key after all its signed rows, equal rows as often as they are there.

    Counts add up, so a delete takes one of several equal rows, whichever comes first in the
    log. ``seq`` tells changes apart, over all shards: records that come again are counted
    once (W11); ``replayed=False`` spares that shuffle where none do. Rows up to
    ``truncate_seq`` are gone. A row that went more often than it came, as its beginning lies
    before the log, is not there. ``index`` names a column that numbers equal rows from 1.

    However often a row stands, it is one group with one count, combined on the map side; its
    copies are written in pieces of ``COPIES``, dealt to as many tasks.
    """
    columns = list(columns)
    if truncate_seq is not None:
        signed = signed.filter(F.col(seq) > literal(truncate_seq, signed.schema[seq].dataType))
    if replayed:
        signed = signed.select(seq, "row", "n").distinct()
    counted = signed.groupBy(*[F.col("row")[c].alias(c) for c in columns]).agg(F.sum("n").alias("__n")).filter("__n > 0")
    pieces = counted.withColumn("__from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"), F.lit(COPIES).cast("bigint"))))
    spread = pieces.repartition(*[F.col(f"`{c}`") for c in columns], "__from")
    last = F.least(F.col("__n"), F.col("__from") + COPIES - 1)
    numbered = spread.select(*columns, F.explode(F.sequence("__from", last)).alias(index or "__i"))
    return numbered if index else numbered.drop("__i")


def dropped_column(table: DataFrame, dropped: Sequence[str]) -> DataFrame:
    """A column gone at the source stays here, with null values."""
    return table.withColumns(
        {c: F.lit(None).cast(table.schema[c].dataType) for c in dropped}
    )


def merge_layouts(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows before and after a column came or went, missing columns null."""
    return older.unionByName(newer, allowMissingColumns=True)
