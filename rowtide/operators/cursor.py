"""Progress through a change log.

Events are first reduced to one row per response, in parallel and with map-side
combining; everything that depends on order works on that smaller frame, chunk
by chunk (``running``), never on a whole shard in one task.

Cursor frames have ``keyspace, shard, position, last_pk``; ``last_pk`` is a
``struct<fields: array, values: array>`` or null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.lineage import settle
from rowtide.operators.running import SPAN, carry_forward, running_number, span_chunk
from rowtide.sources.log import COPY_COMPLETED, LASTPK, ROW, VGTID, bare_name

PLACE = ["keyspace", "shard"]
# A copy is checkpointed after this many rows or minutes.
CHECKPOINT_ROWS = 1000
CHECKPOINT_MINUTES = 10


def valid_last_pk(last_pk: Column) -> Column:
    """A last key without field names is an error."""
    return F.when(last_pk.isNull() | (F.size(last_pk["fields"]) > 0), last_pk).otherwise(
        F.raise_error(F.lit("copy cursor is missing the field names of its last key"))
    )


def response_cursors(events: DataFrame, table: str) -> DataFrame:
    """W1-W3 inside a response: one row per ``keyspace, shard, resp_id``.

    * ``set_position``: the last non-empty position for this keyspace and shard
    * ``set_last_pk``: a struct around the last key, so that "cleared" differs
      from "not mentioned"
    * ``copy_completed``, ``records``
    """
    kind = F.col("event_type")
    own = F.try_element_at(
        F.filter(
            "shard_gtids",
            lambda g: (g["keyspace"] == F.col("keyspace")) & (g["shard"] == F.col("shard")),
        ),
        F.lit(1),
    )
    own = F.when(kind == VGTID, own)
    listed = F.try_element_at(
        F.filter(own["table_pks"], lambda p: bare_name(p["table"]) == table), F.lit(1)
    )["last_pk"]
    mine = bare_name(F.col("table")) == table
    set_pk = F.when(own.isNotNull(), F.struct(valid_last_pk(listed).alias("last_pk"))).when(
        (kind == LASTPK) & mine,
        F.struct(
            F.when(~F.coalesce("completed", F.lit(False)), valid_last_pk(F.col("last_pk"))).alias(
                "last_pk"
            )
        ),
    )
    changes = F.size(
        F.filter("row_changes", lambda c: c["before"].isNotNull() | c["after"].isNotNull())
    )
    return (
        events.select(
            *PLACE,
            "resp_id",
            "event_idx",
            F.nullif(own["gtid"], F.lit("")).alias("__pos"),
            set_pk.alias("__pk"),
            # The end of another table's copy is not this one's.
            ((kind == COPY_COMPLETED) & (F.col("table").isNull() | mine)).alias("__done"),
            F.when((kind == ROW) & mine, changes).otherwise(0).alias("__n"),
        )
        .groupBy(*PLACE, "resp_id")
        .agg(
            F.max_by("__pos", F.when(F.col("__pos").isNotNull(), F.col("event_idx"))).alias(
                "set_position"
            ),
            F.max_by("__pk", F.when(F.col("__pk").isNotNull(), F.col("event_idx"))).alias(
                "set_last_pk"
            ),
            F.bool_or("__done").alias("copy_completed"),
            F.sum("__n").cast("bigint").alias("records"),
        )
    )


def cursor_timeline(
    events: DataFrame, table: str, start: DataFrame | None = None, span: int = SPAN
) -> DataFrame:
    """The cursor after each response, beginning from ``start``.

    The events are read once: their per-response rows are settled before the order
    is worked out on them.
    """
    filled = carry_forward(
        settle(response_cursors(events, table)),
        PLACE,
        ["resp_id"],
        {"position": F.col("set_position"), "__pk": F.col("set_last_pk")},
        span,
    )
    if start is None:
        return filled.select(
            *PLACE,
            "resp_id",
            F.coalesce("position", F.lit("")).alias("position"),
            F.col("__pk.last_pk").alias("last_pk"),
            "copy_completed",
            "records",
        )
    begin = start.select(
        *PLACE, F.col("position").alias("__p0"), F.struct("last_pk").alias("__k0")
    )
    return filled.join(F.broadcast(begin), PLACE, "left").select(
        *PLACE,
        "resp_id",
        F.coalesce("position", "__p0", F.lit("")).alias("position"),
        F.coalesce("__pk", "__k0")["last_pk"].alias("last_pk"),
        "copy_completed",
        "records",
    )


def bounded_stop(timeline: DataFrame, stops: DataFrame) -> DataFrame:
    """The response that ends the read, per keyspace and shard.

    Once a response ends at the stop position, reading goes on while the position
    stays there, and ends after the first response that ends elsewhere with no
    copy under way. A completed copy ends it too. ``end_resp`` is null where the
    log does not reach that point yet.

    No window: the first response at the stop is one aggregate per shard, the end
    another. Pass a settled timeline, it is read twice; ``stops`` is broadcast, a row per shard.
    """
    at = timeline.join(F.broadcast(stops.select(*PLACE, "stop")), PLACE)
    here = F.col("position") == F.col("stop")
    first = at.filter(here).groupBy(*PLACE).agg(F.min("resp_id").alias("__first"))
    past = (F.col("resp_id") > F.col("__first")) & ~here & F.col("last_pk").isNull()
    ends = F.coalesce(F.col("copy_completed"), F.lit(False)) | F.coalesce(past, F.lit(False))
    return (
        at.join(F.broadcast(first), PLACE, "left")
        .groupBy(*PLACE)
        .agg(F.min(F.when(ends, F.col("resp_id"))).alias("end_resp"))
    )


def bounded_read(
    events: DataFrame, table: str, stops: DataFrame, start: DataFrame | None = None,
    span: int = SPAN,
) -> tuple[DataFrame, DataFrame]:
    """The events up to the end rule, and the cursor to continue from.

    The rows of the ending response are part of the read, and its position is the
    new cursor. The events are read twice: once for their cursors, once for the
    rows, which meet the ends. Those are one row per shard and broadcast: a join by shard
    would deal the log to as many tasks as there are shards.
    """
    timeline = settle(cursor_timeline(events, table, start, span))
    ends = settle(bounded_stop(timeline, stops))
    within = F.col("end_resp").isNull() | (F.col("resp_id") <= F.col("end_resp"))
    read = events.join(F.broadcast(ends), PLACE).filter(within).drop("end_resp")
    cursors = (
        timeline.join(F.broadcast(ends), PLACE)
        .filter(within)
        .groupBy(*PLACE)
        .agg(F.max_by(F.struct("position", "last_pk", "resp_id"), "resp_id").alias("__c"))
        .select(*PLACE, "__c.position", "__c.last_pk", F.col("__c.resp_id").alias("seq"))
    )
    return read, cursors


def positions(events: DataFrame) -> DataFrame:
    """Each response's own positions, for ``peek_latest``: ``keyspace, shard, position, seq``."""
    own = F.filter(
        "shard_gtids",
        lambda g: (g["keyspace"] == F.col("keyspace")) & (g["shard"] == F.col("shard")),
    )
    return events.filter(F.col("event_type") == VGTID).select(
        *PLACE,
        F.try_element_at(own, F.lit(1))["gtid"].alias("position"),
        F.col("resp_id").alias("seq"),
    )


def skip_if_current(state: DataFrame, latest: DataFrame) -> DataFrame:
    """The cursors that have something to read.

    A cursor inside a copy always does; another only if the latest position is not
    its own.
    """
    idle = F.col("last_pk").isNull() & F.col("latest").eqNullSafe(F.col("position"))
    return state.join(latest, PLACE, "left").filter(~idle).drop("latest")


def copy_checkpoints(
    snapshot: DataFrame, pk: Sequence[str], span: int, rows: int = CHECKPOINT_ROWS
) -> DataFrame:
    """The checkpoints of a copy in key order, per shard.

    One after every ``rows`` rows and one at the end: ``checkpoint`` number, its
    ``records`` and the ``last_pk`` it stands at. ``span`` cuts the (numeric)
    leading key column into chunks, so no shard is numbered in one task.
    """
    numbered = running_number(snapshot, ["shard"], [span_chunk(pk[0], span)], list(pk), "__n")
    return (
        numbered.withColumn(
            "checkpoint", F.floor((F.col("__n") - 1) / F.lit(rows)).cast("bigint")
        )
        .groupBy("shard", "checkpoint")
        .agg(F.count("*").alias("records"), F.max(F.struct(*pk)).alias("last_pk"))
    )


def made_progress(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per cursor, whether position or last key differ."""
    old = before.select(
        "keyspace", "table", "shard",
        F.col("position").alias("__p"), F.col("last_pk").alias("__k"),
    )
    return (
        after.join(old, ["keyspace", "table", "shard"], "left")
        .withColumn(
            "progressed",
            ~(
                F.coalesce("position", F.lit("")).eqNullSafe(F.coalesce("__p", F.lit("")))
                & F.col("last_pk").eqNullSafe(F.col("__k"))
            ),
        )
        .drop("__p", "__k")
    )


def drop_replayed(records: DataFrame) -> DataFrame:
    """A failed pass starts over, so records may come twice; keep one of each."""
    return records.dropDuplicates(["keyspace", "table", "shard", "seq", "op"])


# Fixed value: the mark of a cursor whose log was removed before it was read.
EXPIRED = "BINLOG_EXPIRATION_ERROR"


def expired_log_reset(state: DataFrame, purged: DataFrame, compat: bool = False) -> DataFrame:
    """Cursors whose next log entry is gone start a full copy.

    ``purged`` gives per keyspace and shard the highest removed ``purged_upto``.
    Rows deleted while the log was lost would survive the copy, so the table is to be
    emptied first (``truncate``), and then every shard of it is copied anew.
    ``compat=True`` resets the one shard and leaves its old rows (A15).
    """
    gone = F.coalesce(
        (F.coalesce("position", F.lit("")) != "") & (F.col("seq") < F.col("purged_upto")),
        F.lit(False),
    )
    marked = state.join(purged, PLACE, "left").withColumn("__gone", gone)
    if compat:
        marked = marked.withColumn("__reset", F.col("__gone"))
    else:
        tables = marked.groupBy("keyspace", "table").agg(F.bool_or("__gone").alias("__reset"))
        marked = marked.join(tables, ["keyspace", "table"])
    return marked.withColumns(
        {
            "position": F.when(F.col("__reset"), F.lit("")).otherwise(F.col("position")),
            "last_pk": F.when(~F.col("__reset"), F.col("last_pk")),
            "seq": F.when(~F.col("__reset"), F.col("seq")),
            "error_code": F.when(F.col("__gone"), F.lit(EXPIRED)),
            "truncate": F.lit(False) if compat else F.col("__reset"),
        }
    ).drop("__gone", "__reset", "purged_upto")
