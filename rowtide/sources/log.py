"""Snapshots and change logs as DataFrames.

A log row is one stream event:

``keyspace, shard, resp_id, event_idx, event_type`` and, by type,
``table, fields`` (FIELD), ``table, row_changes`` (ROW), ``shard_gtids`` (VGTID),
``table, last_pk, completed`` (LASTPK). ``(resp_id, event_idx)`` orders a shard.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.operators.lineage import settle
from rowtide.operators.running import carry_forward


# The event types that carry meaning; all others are ignored.
FIELD, ROW, VGTID, LASTPK, COPY_COMPLETED = "FIELD", "ROW", "VGTID", "LASTPK", "COPY_COMPLETED"

ORDER = ["resp_id", "event_idx"]
#: Versions of a table's layout in a shard that rows are compared with one by one.
FEW = 64
#: Responses that are put in order together where layouts change more often.
LAYOUT_SPAN = 4096


# --- snapshots ---------------------------------------------------------------

def jdbc_snapshot(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], **options: str
) -> DataFrame:
    """One task per predicate, for instance a shard or a key range of it."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(options))


def after_key(pk: Sequence[str], last: Sequence) -> Column:
    """Strictly after ``last`` in the order of a (composite) key.

    Written as plain comparisons with a bound on the leading column, so that it
    reaches the Parquet row groups or the source database.
    """
    pk, last = list(pk), list(last)
    beyond = F.lit(False)
    equal = F.lit(True)
    for i, (column, value) in enumerate(zip(pk, last)):
        step = F.col(column) > F.lit(value)
        beyond = step if i == 0 else beyond | (equal & step)
        same = F.col(column) == F.lit(value)
        equal = same if i == 0 else equal & same
    return beyond if len(pk) == 1 else (F.col(pk[0]) >= F.lit(last[0])) & beyond


def resume_snapshot(
    snapshot: DataFrame, pk: Sequence[str], last_pk: Mapping[str, Sequence | None]
) -> DataFrame:
    """What each shard still has to copy.

    A shard with a last key continues after it, one without is copied whole.
    Shards that are not named are not read.
    """
    todo = F.lit(False)
    for i, (shard, last) in enumerate(last_pk.items()):
        mine = F.col("shard") == shard
        if last is not None:
            mine = mine & after_key(pk, last)
        todo = mine if i == 0 else todo | mine
    return snapshot.filter(todo)


def read_all_shards(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Separate per-shard inputs as one frame; all shards are read at once."""
    out = None
    for shard, frame in frames.items():
        tagged = frame.withColumn("shard", F.lit(shard))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no shards")
    return out


# --- change log --------------------------------------------------------------

def bare_name(table: Column) -> Column:
    """The text after the last dot."""
    return F.substring_index(table, ".", -1)


def match_table(events: DataFrame, table: str) -> DataFrame:
    """Events of one table, by bare name."""
    return events.filter(bare_name(F.col("table")) == table)


def change_scan(log: DataFrame, start_seq: int, stop_seq: int | None = None) -> DataFrame:
    """The log after ``start_seq`` up to ``stop_seq``; both reach the row groups."""
    part = log.filter(F.col("seq") > start_seq)
    return part if stop_seq is None else part.filter(F.col("seq") <= stop_seq)


def unnest_row_changes(events: DataFrame) -> DataFrame:
    """One row per change of a ROW event, with its place ``change_idx``."""
    others = [c for c in events.columns if c != "row_changes"]
    return (
        events.select(*others, F.posexplode("row_changes").alias("change_idx", "__c"))
        .select(*others, "change_idx", "__c.before", "__c.after")
        .filter(F.col("before").isNotNull() | F.col("after").isNotNull())
    )


def pair_images(before: Column, after: Column) -> Column:
    """Images zipped by place to the longer list, the missing side null.

    An empty pair of lists, or null for both, gives no change.
    """
    none = F.array()
    zipped = F.arrays_zip(
        F.coalesce(before, none).alias("before"), F.coalesce(after, none).alias("after")
    )
    return F.transform(zipped, lambda p: F.struct(p["before"].alias("before"), p["after"].alias("after")))


def unnest_response(batch: DataFrame) -> DataFrame:
    """A batch of arrays as single changes in the order insert, delete, update.

    ``inserts`` and ``deletes`` are arrays of images, ``updates`` an array of
    ``struct<before: array, after: array>``. One explode, no shuffle.
    """
    others = [c for c in batch.columns if c not in ("inserts", "deletes", "updates")]
    image = batch.schema["inserts"].dataType.elementType
    none = F.lit(None).cast(image)
    change = lambda rank, before, after: F.struct(
        F.lit(rank).alias("kind_rank"), before.alias("before"), after.alias("after")
    )
    listed = lambda c: F.coalesce(c, F.array().cast(f"array<{image.simpleString()}>"))
    inserts = F.transform(listed(F.col("inserts")), lambda r: change(0, none, r))
    deletes = F.transform(listed(F.col("deletes")), lambda r: change(1, r, none))
    updates = F.flatten(
        F.transform(
            F.coalesce(F.col("updates"), F.array()),
            lambda u: F.transform(
                pair_images(listed(u["before"]), listed(u["after"])),
                lambda p: change(2, p["before"], p["after"]),
            ),
        )
    )
    return batch.select(
        *others, F.posexplode(F.concat(inserts, deletes, updates)).alias("pos", "__c")
    ).select(*others, "pos", "__c.*")


def peek_latest(events: DataFrame) -> DataFrame:
    """The latest non-empty position of each keyspace and shard."""
    return (
        events.filter(F.coalesce(F.col("position"), F.lit("")) != "")
        .groupBy("keyspace", "shard")
        .agg(F.max_by("position", "seq").alias("latest"))
    )


# --- row layouts -------------------------------------------------------------

def _versions(fields: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys``, ``name`` (a struct of the list) and the places from and to which it is in force.

    Lists that repeat the one before are one version, so there are as many rows as layout
    changes. The window sees the FIELD events of one table in one shard.
    """
    at = F.struct(*ORDER)
    log = W.partitionBy(*keys).orderBy(*ORDER)
    changed = fields.withColumn("__old", F.lag("fields").over(log)).filter(~F.col("__old").eqNullSafe(F.col("fields")))
    return changed.select(
        *[F.col(k).alias(f"__{name}_{k}") for k in keys],
        F.struct("fields").alias(name),
        at.alias(f"{name}_from"),
        F.lead(at).over(log).alias(f"{name}_to"),
    )


def layout_as_of(events: DataFrame, few: int = FEW, span: int = LAYOUT_SPAN) -> DataFrame:
    """Each ROW event with ``layout``, the field list in force before it.

    A FIELD event sets the list for its exact table name and for its bare name.
    A row takes the exact name's list, else the bare name's. Where no table has over ``few``
    versions in a shard, they are broadcast as intervals of the log and the rows stay where
    they are. Else rows and lists are put in order together, ``span`` responses at a time,
    so the work is in proportion to the log however often layouts change.
    """
    named = events.filter(F.col("event_type").isin(FIELD, ROW)).withColumn(
        "__bare", bare_name(F.col("table"))
    )
    fields = settle(
        named.filter(F.col("event_type") == FIELD).select("keyspace", "shard", "table", "__bare", *ORDER, "fields")
    )
    rows = named.filter(F.col("event_type") == ROW)
    by_bare, by_exact = ["keyspace", "shard", "__bare"], ["keyspace", "shard", "table"]
    bare_versions = _versions(fields, by_bare, "__by_bare")
    # A change of an exact name's list is one of its bare name's, so no exact name has more.
    most = bare_versions.groupBy(*[f"____by_bare_{k}" for k in by_bare]).count().agg(F.max("count")).first()[0]
    if (most or 0) <= few:
        rows = _inside(rows, bare_versions, by_bare, "__by_bare")
        rows = _inside(rows, _versions(fields, by_exact, "__by_exact"), by_exact, "__by_exact")
    else:
        both = rows.unionByName(fields.withColumn("event_type", F.lit(FIELD)), allowMissingColumns=True)
        listed = F.when(F.col("event_type") == FIELD, F.struct("fields"))
        for keys, name in ((by_bare, "__by_bare"), ([*by_bare, "table"], "__by_exact")):
            both = carry_forward(both, keys, ORDER, {name: listed}, span)
        rows = both.filter(F.col("event_type") == ROW)
    exact = F.when(F.col("table") == F.col("__bare"), F.col("__by_bare.fields")).otherwise(F.col("__by_exact.fields"))
    bare = F.col("__by_bare.fields")
    return rows.withColumn("layout", F.when(F.size(exact) > 0, exact).when(F.size(bare) > 0, bare)).drop(
        "__bare", "__by_bare", "__by_exact"
    )


def _inside(rows: DataFrame, versions: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with the version (``name``) in whose interval each stands, or null."""
    at = F.struct(*ORDER)
    inside = (at > F.col(f"{name}_from")) & F.coalesce(at <= F.col(f"{name}_to"), F.lit(True))
    same = [F.col(k) == F.col(f"__{name}_{k}") for k in keys]
    return rows.join(F.broadcast(versions), reduce(lambda a, b: a & b, [*same, inside]), "left").drop(
        *[f"__{name}_{k}" for k in keys], f"{name}_from", f"{name}_to"
    )


def require_layout(rows: DataFrame) -> DataFrame:
    """C11: a row without a layout before it is an error."""
    return rows.withColumn(
        "layout",
        F.when(F.col("layout").isNotNull(), F.col("layout")).otherwise(
            F.raise_error(F.concat(F.lit("no field list before a row of table "), F.col("table")))
        ),
    )


class LayoutChanged(RuntimeError):
    """The log goes on with another field list; only a full re-copy mends the table."""


def schema_change_guard(events: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """Per table and shard, whether the layout changed inside the range read.

    A second, different field list, or one without a ``selected`` column, asks for
    a full re-copy.
    """
    text = F.to_json(F.col("fields"))
    lacks = F.lit(False)
    for column in selected or []:
        lacks = lacks | ~F.array_contains("fields", column)
    return (
        events.filter(F.col("event_type") == FIELD)
        .groupBy("keyspace", "shard", bare_name(F.col("table")).alias("table"))
        .agg(
            F.count("*").alias("versions"),
            (F.min(text) != F.max(text)).alias("changed"),
            F.bool_or(lacks).alias("lacks_column"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("changed") | F.col("lacks_column"), F.lit("RECOPY_REQUIRED")).otherwise(
                F.lit("OK")
            ),
        )
    )


def require_same_schema(events: DataFrame, selected: Sequence[str] | None = None) -> None:
    """W13 as a gate: raises before anything is written, so the state stays as it was."""
    bad = (
        schema_change_guard(events, selected)
        .filter(F.col("verdict") != "OK")
        .select("keyspace", "table")
        .limit(1)
        .collect()
    )
    if bad:
        raise LayoutChanged(
            f"layout of table {bad[0].keyspace}.{bad[0].table} changed: run a full re-copy"
        )


def layout_steps(events: DataFrame) -> DataFrame:
    """Each change of a layout: its place, the columns that came and went, and whether the others moved.

    Columns are told by name, so a renamed one is one that went and one that came. The
    window sees the FIELD events of one table in one shard.
    """
    log = W.partitionBy("keyspace", "shard", "table").orderBy(*ORDER)
    fields = events.filter(F.col("event_type") == FIELD).select(
        "keyspace", "shard", bare_name(F.col("table")).alias("table"), *ORDER, "fields"
    )
    older = fields.withColumn("older", F.lag("fields").over(log)).filter(F.col("older") != F.col("fields"))
    return older.select(
        "keyspace",
        "shard",
        "table",
        *ORDER,
        F.array_except("fields", "older").alias("added"),
        F.array_except("older", "fields").alias("dropped"),
        (F.array_intersect("older", "fields") != F.array_intersect("fields", "older")).alias("reordered"),
    )


def migration(events: DataFrame, selected: Sequence[str], pk: Sequence[str]) -> DataFrame:
    """Per table, whether its layout changes can be followed without a re-copy, and what they dropped.

    Columns may come and go. A new order of the others, a change of the primary key, a
    ``selected`` column that no layout has, or a column that both came and went (its old
    values and its new ones have no common order over shards) need a re-copy. ``dropped``
    holds each column that went with its latest place.
    """
    listed = lambda names: F.array(*[F.lit(n) for n in names]).cast("array<string>")
    steps = layout_steps(events)
    keys = ["keyspace", "table"]
    flat = lambda side: F.flatten(F.collect_list(side))
    changed = steps.groupBy(*keys).agg(
        F.bool_or("reordered").alias("reordered"), flat("added").alias("added"), flat("dropped").alias("gone")
    )
    went = (
        steps.select(*keys, F.explode("dropped").alias("column"), F.struct(*ORDER).alias("at"))
        .groupBy(*keys, "column")
        .agg(F.max("at").alias("at"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("column", "at"))).alias("dropped"))
    )
    known = (
        events.filter(F.col("event_type") == FIELD)
        .groupBy("keyspace", bare_name(F.col("table")).alias("table"))
        .agg(F.array_distinct(F.flatten(F.collect_set("fields"))).alias("known"))
    )
    none = F.array().cast("array<string>")
    added, gone = F.coalesce("added", none), F.coalesce("gone", none)
    recopy = (
        F.coalesce("reordered", F.lit(False))
        | F.arrays_overlap(added, gone)
        | F.arrays_overlap(F.concat(added, gone), listed(pk))
        | (F.size(F.array_except(listed(selected), "known")) > 0)
    )
    return (
        known.join(changed, keys, "left")
        .join(went, keys, "left")
        .select(
            *keys,
            "dropped",
            F.when(recopy, F.lit("RECOPY"))
            .when((F.size(added) > 0) | (F.size(gone) > 0), F.lit("MIGRATE"))
            .otherwise(F.lit("NONE"))
            .alias("verdict"),
        )
    )


def require_migratable(events: DataFrame, selected: Sequence[str], pk: Sequence[str]) -> dict[str, tuple[int, int]]:
    """D7 as a gate: the columns of one table that went, with their places; raises where only a re-copy helps."""
    found = {}
    for row in migration(events, selected, pk).collect():  # one table's: as many entries as columns
        if row.verdict == "RECOPY":
            raise LayoutChanged(f"layout of table {row.keyspace}.{row.table} changed beyond migration: run a full re-copy")
        for gone in row.dropped or []:
            found[gone.column] = max(found.get(gone.column, (-1, -1)), tuple(gone["at"]))
    return found


# --- lost pieces of a log ----------------------------------------------------

#: Responses are put in order in spans of so many numbers, each a set of bounded size.
SPAN = 4096


def log_islands(events: DataFrame) -> DataFrame:
    """Per keyspace and shard, the runs of response numbers without a hole (``first``, ``last``).

    For logs that number the responses of a shard one by one. The numbers of a span are
    gathered as a set, combined on the map side, so repeated events cost nothing; each span is
    cut into runs on its own, and only runs, one per span of a whole log, are joined over a
    shard. Events without a number are left out; an empty log has no runs.
    """
    place = ["keyspace", "shard"]
    spans = (
        events.filter(F.col("resp_id").isNotNull())
        .groupBy(*place, F.floor(F.col("resp_id") / SPAN).alias("span"))
        .agg(F.sort_array(F.collect_set("resp_id")).alias("ids"))
    )
    near = lambda i: F.get("ids", i)
    starts = F.filter("ids", lambda x, i: (i == 0) | (x - near(F.greatest(i - 1, F.lit(0))) > 1))
    ends = F.filter("ids", lambda x, i: F.coalesce(near(i + 1) - x > 1, F.lit(True)))
    runs = spans.select(*place, F.explode(F.arrays_zip(starts.alias("first"), ends.alias("last"))).alias("r")).select(*place, "r.*")
    order = W.partitionBy(*place).orderBy("first")
    opens = F.coalesce(F.col("first") - F.lag("last").over(order) > 1, F.lit(True))
    return (
        runs.withColumn("opens", opens.cast("bigint"))
        .withColumn("island", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .groupBy(*place, "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("island")
    )


def log_gaps(events: DataFrame) -> DataFrame:
    """Per keyspace and shard, the response numbers that are missing (``lost_from``, ``lost_to``), ends included.

    What is missing before the log's first response can't be told from the log; ``lost_upto``
    covers it.
    """
    order = W.partitionBy("keyspace", "shard").orderBy("first")
    before = log_islands(events).withColumn("before", F.lag("last").over(order))
    return before.filter(F.col("before").isNotNull()).select(
        "keyspace", "shard", (F.col("before") + 1).alias("lost_from"), (F.col("first") - 1).alias("lost_to")
    )


def lost_upto(events: DataFrame) -> DataFrame:
    """Per keyspace and shard, the highest response that is not there, as ``purged_upto``.

    From there on the log has no hole, so a cursor at or behind it goes on, and one before it
    has lost something: what ``expired_log_reset`` asks for. Responses that are only late look lost.
    """
    return log_islands(events).groupBy("keyspace", "shard").agg((F.max("first") - 1).alias("purged_upto"))
