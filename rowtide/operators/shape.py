"""Row images -> typed change records.

A change is a row with nullable structs ``before`` and ``after``. A record is
that change with ``op``, the ``row`` it carries and ``written``, the names it
carries: a null inside ``written`` is a written null, a column outside it is
unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions import convert
from rowtide.functions import types as T
from rowtide.functions.geometry import geometry_to_geojson

UPSERT, UPDATE, DELETE, TRUNCATE = "UPSERT", "UPDATE", "DELETE", "TRUNCATE"


# --- selection ---------------------------------------------------------------

def select_objects(catalog: DataFrame, selection: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the catalog rows whose ``keys`` are flagged ``included``.

    ``keys`` names the level: ``[keyspace]``, ``[keyspace, table]``, or down to
    ``column``. What is missing from the selection is excluded.
    """
    kept = selection.filter(F.col("included")).select(*keys)
    return catalog.join(kept, list(keys), "left_semi")


def select_columns(df: DataFrame, flags: Mapping[str, bool]) -> DataFrame:
    """The columns flagged true, in table order; absent or false drops them."""
    return df.select(*[c for c in df.columns if flags.get(c, False)])


def existing_columns(requested: Sequence[str], available: Sequence[str] | None) -> list[str]:
    """Requested columns that exist, in requested order.

    ``available=None`` says the catalog could not be read: the request stands.
    """
    if available is None:
        return list(requested)
    known = set(available)
    return [c for c in requested if c in known]


def star_fallback(requested: Sequence[str], available: Sequence[str]) -> list[str]:
    """Blank names are dropped; if none is left, every column is read."""
    named = [c.strip() for c in requested if c and c.strip()]
    return named or list(available)


# --- classification and shaping ----------------------------------------------

def classify_change(before: Column, after: Column) -> Column:
    """The operation of an image pair; null when both sides are missing."""
    return (
        F.when(before.isNull() & after.isNotNull(), F.lit(UPSERT))
        .when(before.isNotNull() & after.isNotNull(), F.lit(UPDATE))
        .when(before.isNotNull(), F.lit(DELETE))
    )


def shape_changes(
    changes: DataFrame,
    pk: Sequence[str],
    columns: Sequence[str] | None = None,
    drop_noop: bool = False,
    pk_change: str = "split",
) -> DataFrame:
    """Change records of image pairs, all other columns kept.

    * UPSERT carries every selected column, nulls included (C3)
    * DELETE carries the primary key, from the before image (C4)
    * UPDATE carries the primary key and what differs, null-safe (C5); an update
      that changes nothing still gives a record unless ``drop_noop`` (C6)

    An UPDATE that moves a row to another primary key is split into a DELETE of
    the old key and an UPSERT of the new row; ``pk_change='keep'`` leaves it as
    one UPDATE of the new key, and the old row alive (A4).
    """
    if pk_change not in ("split", "keep"):
        raise ValueError(f"pk_change must be 'split' or 'keep', not {pk_change!r}")
    columns = list(columns or changes.schema["after"].dataType.fieldNames())
    pk = [k for k in pk if k in columns]
    others = [c for c in changes.columns if c not in ("before", "after")]
    b, a = F.col("before"), F.col("after")

    typed = changes.withColumn("op", classify_change(b, a)).filter(F.col("op").isNotNull())
    if pk and pk_change == "split":
        moved = F.lit(False)
        for k in pk:
            moved = moved | ~b[k].eqNullSafe(a[k])
        moved = (F.col("op") == UPDATE) & moved
        none = F.lit(None)
        # One row in, one or two out; the old key goes first.
        pair = lambda op, before, after: F.struct(
            F.lit(op).alias("op"), before.alias("before"), after.alias("after")
        )
        typed = (
            typed.withColumn(
                "__c",
                F.explode(
                    F.when(
                        moved,
                        F.array(
                            pair(DELETE, b, none.cast(changes.schema["after"].dataType)),
                            pair(UPSERT, none.cast(changes.schema["before"].dataType), a),
                        ),
                    ).otherwise(F.array(F.struct("op", b.alias("before"), a.alias("after"))))
                ),
            )
            .select(*others, "__c.*")
        )

    op = F.col("op")
    image = F.when(op == DELETE, b).otherwise(a)
    carried = {
        c: F.lit(True)
        if c in pk
        else (op == UPSERT) | ((op == UPDATE) & ~b[c].eqNullSafe(a[c]))
        for c in columns
    }
    flagged = typed.withColumn("__image", image)
    row = F.struct(
        *[F.when(carried[c], F.col("__image")[c]).alias(c) for c in columns]
    )
    # Joined from one-name arrays: that stays inside generated code, a lambda would not.
    nothing = F.array().cast("array<string>")
    written = F.concat(
        *[F.when(carried[c], F.array(F.lit(c))).otherwise(nothing) for c in columns]
    )
    records = flagged.select(*others, "op", row.alias("row"), written.alias("written"))
    if drop_noop:
        records = records.filter((op != UPDATE) | (F.size("written") > len(pk)))
    return records


def snapshot_records(snapshot: DataFrame, columns: Sequence[str], seq: int = 0) -> DataFrame:
    """Each row of a full copy is an UPSERT that carries every column."""
    columns = list(columns)
    others = [c for c in snapshot.columns if c not in columns and c != "seq"]
    return snapshot.select(
        *others,
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(UPSERT).alias("op"),
        F.struct(*columns).alias("row"),
        F.array(*[F.lit(c) for c in columns]).alias("written"),
    )


def truncate_gate(state: DataFrame) -> DataFrame:
    """The tables to truncate before any read.

    A table qualifies if it has shards and none has a position or a last key.
    Returns ``keyspace, table, truncate``.
    """
    fresh = (F.coalesce(F.col("position"), F.lit("")) == "") & F.col("last_pk").isNull()
    return state.groupBy("keyspace", "table").agg(F.bool_and(fresh).alias("truncate"))


# --- raw rows ----------------------------------------------------------------

def positional_to_named(values: Column, names: Column) -> Column:
    """Values and names of equal number as a map; anything else is an error."""
    return F.when(
        F.size(values) == F.size(names), F.map_from_arrays(names, values)
    ).when(
        values.isNotNull(),
        F.raise_error(
            F.format_string(
                "a row holds %d values where its layout names %d", F.size(values), F.size(names)
            )
        ),
    )


def plan_writers(
    catalog_rows: Sequence[Mapping],
    selected: Sequence[str],
    strict: bool = False,
    on_overflow: str = "error",
    set_as_json: bool = False,
) -> tuple[dict[str, "callable"], list[str]]:
    """A converter per selected column, and the primary key among them.

    ``catalog_rows`` are the table's rows of the catalog (bounded by the source's
    column limit), with ``column, column_type, is_pk, logical_type, precision,
    scale, label_kind, labels``. The converters together form one projection.
    """
    if not catalog_rows:
        raise ValueError("table is not in the schema")
    known = {r["column"]: r for r in catalog_rows}
    missing = [c for c in selected if c not in known]
    if missing:
        raise ValueError(f"no converter for selected columns {missing}")  # C11

    def writer(r: Mapping):
        logical, is_pk = r["logical_type"], bool(r["is_pk"])
        labels = list(r["labels"] or [])
        if r["label_kind"] == "enum":
            listed = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
            return lambda v: convert.enum_label(v, listed)
        if r["label_kind"] == "set":
            return lambda v: convert.set_labels(v, labels, set_as_json)
        source = r["column_type"].lower()
        if source.startswith("bit"):
            return convert.bits_to_long
        if source.startswith(T.GEOMETRY_PREFIXES):
            return geometry_to_geojson
        make = convert.converter(logical)
        if logical == T.DECIMAL:
            return lambda v: make(v, r["precision"], r["scale"])
        if logical in (T.NAIVE_DATE, T.NAIVE_DATETIME, T.UTC_DATETIME):
            return lambda v: make(v, is_pk=is_pk, strict=strict)
        if logical in (T.INT, T.SHORT, T.FLOAT):
            return lambda v: make(v, on_overflow=on_overflow)
        return make

    writers = {c: writer(known[c]) for c in selected}
    return writers, [c for c in selected if known[c]["is_pk"]]


def write_row(image: Column, writers: Mapping[str, "callable"]) -> Column:
    """A raw image (struct or map of bytes) as the typed struct of its writers."""
    return F.when(
        image.isNotNull(), F.struct(*[w(image[c]).alias(c) for c, w in writers.items()])
    )


def write_rows(changes: DataFrame, writers: Mapping[str, "callable"]) -> DataFrame:
    """Raw ``before`` and ``after`` arrays, laid out as ``layout``, as typed structs.

    Each row's names are looked up in its own layout, so rows of different layouts may
    stand side by side. A row of another width than its layout is an error, as is a row
    without one. The wire values become columns of their own first, so that a converter
    reads each one once.
    """
    sides = ("before", "after")
    others = [c for c in changes.columns if c not in (*sides, "layout")]
    width = F.coalesce(F.size("layout"), F.lit(-1))

    def checked(side: str) -> Column:
        return F.when(F.size(side) == width, F.col(side)).when(
            F.col(side).isNotNull(),
            F.raise_error(
                F.format_string("a row holds %d values where its layout names %d", F.size(side), width)
            ),
        )

    placed = changes.select(
        *others,
        *[checked(side).alias(side) for side in sides],
        *[F.array_position("layout", c).cast("int").alias(f"__at_{c}") for c in writers],
    )
    wire = placed.select(
        *others,
        *[F.col(side).isNotNull().alias(f"__has_{side}") for side in sides],
        *[
            F.when(F.col(f"__at_{c}") > 0, F.try_element_at(side, F.col(f"__at_{c}"))).alias(
                f"__{side}_{c}"
            )
            for side in sides
            for c in writers
        ],
    )
    typed = wire.select(
        *others,
        *[f"__has_{side}" for side in sides],
        *[
            w(F.col(f"__{side}_{c}")).alias(f"__{side}_{c}")
            for side in sides
            for c, w in writers.items()
        ],
    )
    return typed.select(
        *others,
        *[
            F.when(
                F.col(f"__has_{side}"),
                F.struct(*[F.col(f"__{side}_{c}").alias(c) for c in writers]),
            ).alias(side)
            for side in sides
        ],
    )


def check_shapes(changes: DataFrame) -> DataFrame:
    """C11: an update must have exactly one row on each side, in ``n_before``/``n_after``."""
    bad = (F.col("n_before") > 0) & (F.col("n_after") > 0) & (
        (F.col("n_before") != 1) | (F.col("n_after") != 1)
    )
    return changes.withColumn(
        "shape_error",
        F.when(
            bad,
            F.format_string(
                "an update pairs one row with one: %d before, %d after",
                F.col("n_before"),
                F.col("n_after"),
            ),
        ),
    )
