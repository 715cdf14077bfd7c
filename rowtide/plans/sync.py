"""One sync from end to end.

The log holds every response of every shard, row images as arrays of wire bytes.
A sync reads, for each selected table, from the saved cursors to the positions
that were the latest when it began, writes the records, and then the state. A run
that fails writes no state beyond the tables it finished, so the next one starts
there and gives the same records again.

Records are ordered by ``(generation, resp, event, change)``. A full copy opens a new
generation of its table: a TRUNCATE at its first place, the snapshot's rows at its next,
and the log from the positions peeked before the snapshot on. So a copy outranks all that
was applied before, and a row that is gone at the source is gone after it. A table is
copied when it has no cursor yet, when its log was removed behind its cursor, and when its
layout changed, if ``snapshots`` can give its rows; a new table without a snapshot is read
from the start of the log, and the other two cases are errors without one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowtide.operators import cursor, shape, sinks, state
from rowtide.operators.lineage import settle
from rowtide.plans import copying
from rowtide.sources import catalog as cat
from rowtide.sources import log

LAST_PK = "struct<fields: array<string>, values: array<string>>"
PLACE = "struct<generation: bigint, resp: bigint, event: bigint, change: bigint>"
LAYOUTS = "array<struct<table: string, resp_id: bigint, event_idx: int, fields: array<string>>>"
SHARD = ["keyspace", "shard"]
CURSORS = [*SHARD, "table", "position", "last_pk", "seq", "generation", "layouts"]

Snapshots = Callable[[str, str], DataFrame | None]
Events = DataFrame | Callable[[], DataFrame]
#: Behind every event of a response, before the next response.
LAST_EVENT = 1 << 62


def peek(events: DataFrame) -> DataFrame:
    """Per keyspace and shard the latest position of the log and the response that has it."""
    return settle(
        cursor.positions(events)
        .filter(F.coalesce(F.col("position"), F.lit("")) != "")
        .groupBy(*SHARD)
        .agg(F.max_by("position", "seq").alias("latest"), F.max("seq").alias("latest_seq"))
    )


def place(generation: int, *numbers) -> Column:
    """A place in the order of a table's records."""
    parts = [F.lit(generation), *[n if not isinstance(n, int) else F.lit(n) for n in numbers]]
    return F.struct(*parts).cast(PLACE)


def _begin_layouts(events: DataFrame, cursors: DataFrame) -> DataFrame:
    """The field lists in force where a read begins, as events just before it.

    They come from the cursors' own notes; only for cursors without them (of a copy, or of
    an older state) is the log looked through, and there for FIELD events alone.
    """
    noted = cursors.filter(F.col("layouts").isNotNull()).select(
        *SHARD, F.inline(F.from_json("layouts", LAYOUTS))
    )
    bare = cursors.filter(F.col("layouts").isNull()).select(*SHARD, F.col("seq").alias("__from"))
    older = (
        events.filter(F.col("event_type") == log.FIELD)
        .join(F.broadcast(bare), SHARD)
        .filter(F.col("resp_id") <= F.col("__from"))
        .groupBy(*SHARD, "table")
        .agg(F.max_by(F.struct("resp_id", "event_idx", "fields"), F.struct("resp_id", "event_idx")).alias("f"))
        .select(*SHARD, "table", "f.*")
    )
    return noted.unionByName(older).withColumn("event_type", F.lit(log.FIELD))


def _noted_layouts(fields: DataFrame) -> DataFrame:
    """Per shard, the last field list of each table name, as the next read's note."""
    last = fields.groupBy(*SHARD, "table").agg(
        F.max_by(F.struct("table", "resp_id", "event_idx", "fields"), F.struct("resp_id", "event_idx")).alias("f")
    )
    # As many entries as names that the log has for one table.
    return last.groupBy(*SHARD).agg(F.to_json(F.array_sort(F.collect_list("f"))).alias("layouts"))


def ahead_of(events: DataFrame, keyspace: str, cursors: DataFrame) -> DataFrame:
    """The events after the cursors; the least of them is a literal that reaches the files.

    The cursors, one per shard, are broadcast, so the log isn't dealt by shard.
    """
    starts = cursors.select(*SHARD, F.coalesce("seq", F.lit(-1)).alias("__from"))
    least = starts.agg(F.min("__from")).first()[0]
    mine = events.filter((F.col("keyspace") == keyspace) & (F.col("resp_id") > F.lit(-1 if least is None else least)))
    return mine.join(F.broadcast(starts), SHARD).filter(F.col("resp_id") > F.col("__from")).drop("__from")


def table_records(
    events: DataFrame,
    described: Sequence[dict],
    keyspace: str,
    table: str,
    columns: Sequence[str],
    cursors: DataFrame,
    latest: DataFrame,
    generation: int = 1,
    migrate: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame, dict[str, tuple]]:
    """The records of one table since its ``cursors``, the cursors after them, and columns that went.

    With ``migrate`` a layout may gain and lose columns on the way (D7): each row is read by
    the layout in force at its place, a column that came is null before, and one that went is
    given back with its place. Without, any change of a layout is an error.

    ``described`` are the table's catalog rows; ``cursors`` have one row per shard
    with ``position, last_pk`` (JSON text or null), ``seq``, the last response read, and
    ``layouts``; ``latest`` has the positions to stop at.
    """
    writers, pk = shape.plan_writers(described, columns, **options)
    active = settle(
        cursor.skip_if_current(cursors, latest.drop("latest_seq")).withColumn("last_pk", F.from_json("last_pk", LAST_PK))
    )
    ahead = ahead_of(events, keyspace, active)
    begin = _begin_layouts(events.filter(F.col("keyspace") == keyspace), active)
    fields = settle(
        log.match_table(
            begin.unionByName(ahead.filter(F.col("event_type") == log.FIELD), allowMissingColumns=True), table
        ).select(*SHARD, "table", "resp_id", "event_idx", "event_type", "fields")
    )
    if migrate:
        gone = log.require_migratable(fields, list(writers), pk)
    else:
        log.require_same_schema(fields, list(writers))
        gone = {}
    stops = latest.select(*SHARD, F.col("latest").alias("stop"))
    read, after = cursor.bounded_read(ahead, table, stops, active)

    rows = log.match_table(read.filter(F.col("event_type") == log.ROW), table)
    laid = log.require_layout(log.layout_as_of(rows.unionByName(fields, allowMissingColumns=True)))
    changes = log.unnest_row_changes(laid).select(
        F.lit(keyspace).alias("keyspace"),
        F.lit(table).alias("table"),
        "shard",
        place(generation, F.col("resp_id"), F.col("event_idx"), F.col("change_idx")).alias("seq"),
        "layout",
        "before",
        "after",
    )
    typed = shape.write_rows(changes, writers)
    moved = after.join(_noted_layouts(fields), SHARD, "left").select(
        *SHARD,
        F.lit(table).alias("table"),
        "position",
        F.to_json("last_pk").alias("last_pk"),
        "seq",
        F.lit(generation).cast("bigint").alias("generation"),
        "layouts",
    )
    # Shards with nothing to read keep their cursor.
    kept = cursors.join(moved.select(*SHARD), SHARD, "left_anti")
    dropped = {c: (generation, *at, 0) for c, at in gone.items()}
    return shape.shape_changes(typed, pk, list(writers)), moved.unionByName(kept.select(moved.columns)), dropped


def copied_records(
    snapshot: DataFrame,
    records: DataFrame,
    keyspace: str,
    table: str,
    columns: Sequence[str],
    generation: int,
    marks: DataFrame | None = None,
) -> DataFrame:
    """The snapshot as the first rows of a generation, typed like ``records``.

    W15: with ``marks`` (shard, latest_seq), taken before the snapshot was read, a row stands
    right behind what the log of its shard had by then: it outranks all of that, and gives way
    to whatever the log tells of it later, be it before or after the row was read. Rows without
    a shard stand at the beginning, below all of the log.
    """
    row = records.schema["row"].dataType
    typed = snapshot.select(
        F.col("shard") if "shard" in snapshot.columns else F.lit("-").alias("shard"),
        *[F.col(c).cast(row[c].dataType).alias(c) for c in columns],
    )
    at = place(generation, -1, 0, 0)
    if marks is not None:
        mark = marks.filter(F.col("keyspace") == keyspace).select("shard", F.col("latest_seq").alias("__mark"))
        typed = typed.join(F.broadcast(mark), "shard", "left")  # one row per shard
        at = F.when(F.col("__mark").isNull(), at).otherwise(place(generation, F.col("__mark"), LAST_EVENT, 0))
    copied = shape.snapshot_records(typed, columns).withColumns({"seq": at, "keyspace": F.lit(keyspace), "table": F.lit(table)})
    return copied.withColumn("row", F.col("row").cast(row)).select(records.columns)


def sync(
    events: Events,
    catalog: DataFrame,
    selection: DataFrame,
    shards: DataFrame,
    out_dir: str,
    run: str,
    state_text: str = "",
    starts_text: str | None = None,
    snapshots: Snapshots | None = None,
    purged: DataFrame | None = None,
    numbered: bool = False,
    shard_names: str = "",
    migrate: bool = False,
    former: DataFrame | None = None,
    copy_ranges: int = 1,
    **options,
) -> str:
    """Sync every selected table; returns the new state as JSON text.

    ``selection`` has ``keyspace, table, column, included``. ``snapshots(keyspace, table)``
    gives a table's rows as they are now, with its columns by name and ``shard``, or null.
    ``purged`` has ``keyspace, shard, purged_upto``, the last response that was removed. Where the
    responses of a shard are ``numbered`` one by one, it is found in the log behind the least cursor.
    ``shard_names`` is a comma list of the shards to read; empty means all. A generation is
    numbered by the milliseconds at which its sync began, so that a copy outranks all that an
    earlier sync applied, even if its state is lost.

    With ``migrate`` columns may come and go in the log without a re-copy (D7); those that went
    are listed with their places in ``out_dir/schema/<keyspace>/<table>/run=<run>``, for
    ``sinks.apply_records`` or ``apply.current_state`` to null what was written to them. ``former``
    is the catalog of the last sync: a table whose column order, primary key, or enum or set
    labels changed since is copied anew.

    With ``copy_ranges`` over 1 a table is copied in so many ranges of its primary key, and the
    log is read on after each of them, so that it is never far behind and the state is saved as
    often. A sync that dies in a copy is taken up by the next one, given the state that it left
    in ``out_dir/state/run=<run>``: only the ranges that aren't finished are read. ``events`` may
    be a function that gives the log as it is at that time, and ``snapshots`` is asked anew for
    each range.

    Records go to ``out_dir/records/<keyspace>/<table>/run=<run>``, what became of each
    cursor to ``out_dir/report/run=<run>``, how many records of each operation each table got to
    ``out_dir/counts/run=<run>`` (counted while they are written), the state to ``out_dir/state/run=<run>`` after
    each table. Tables are taken one after another, those to copy last and small ones of them
    first (D9), all shards of a table at once.
    """
    now = events if callable(events) else lambda: events
    spark, opened = catalog.sparkSession, int(time.time() * 1000)
    shards = cat.check_shards(shard_names, shards)
    chosen = selection.filter(F.col("included"))
    tables = settle(
        shape.select_objects(cat.drop_internal_tables(catalog), chosen, ["keyspace", "table", "column"])
    )
    cursors = state.merge_state(
        state.state_from_json(spark, state_text),
        tables.select("keyspace", "table").distinct(),
        shards,
        state.starting_positions(spark, starts_text),
    ).drop("start_ignored")
    state.require_state(tables.select("keyspace", "table").distinct(), cursors)
    if purged is None and numbered:
        least = cursors.agg(F.min("seq")).first()[0]
        purged = log.lost_upto(now() if least is None else now().filter(F.col("resp_id") > least))
    if purged is not None:
        cursors = cursor.expired_log_reset(cursors.drop("error_code"), purged)
    else:
        cursors = cursors.withColumn("truncate", F.lit(False))
    cursors = settle(cursors)
    fresh = {(r["keyspace"], r["table"]) for r in shape.truncate_gate(cursors).filter("truncate").collect()}
    lost = {(r["keyspace"], r["table"]) for r in cursors.filter("truncate").select("keyspace", "table").distinct().collect()}
    # Peeked once, before any snapshot is read.
    seen = now()
    latest = peek(seen)
    remade = set()
    if former is not None:
        verdicts = cat.schema_diff(former, catalog).filter(F.col("verdict") == "RECOPY").join(tables.select("keyspace", "table").distinct(), ["keyspace", "table"])
        # A new or removed table is neither.
        known = verdicts.join(former.select("keyspace", "table").distinct(), ["keyspace", "table"], "left_semi")
        remade = {(r["keyspace"], r["table"]) for r in known.collect()}
    # The catalog's own size, not the data's: one row per selected column.
    described: dict[tuple[str, str], list[dict]] = {}
    for r in cat.describe_columns(tables).orderBy("keyspace", "table", "ordinal").collect():
        described.setdefault((r["keyspace"], r["table"]), []).append(r.asDict())

    state_run, counts = run, []
    # What is only read on comes first, then the copies, small tables before large ones.
    sizes = {}
    for name in described:
        frame = snapshots(*name) if snapshots is not None and name in fresh | lost | remade else None
        if frame is not None:
            sizes[name] = frame.count()
    order = sorted(described, key=lambda name: (sizes.get(name, -1), name))
    before, done, text = cursors, cursors.drop("truncate"), state_text
    for keyspace, table in order:
        columns = described[keyspace, table]
        names = [c["column"] for c in columns]
        of_table = (F.col("keyspace") == keyspace) & (F.col("table") == table)
        own = done.filter(of_table).join(shards.select(*SHARD), SHARD, "left_semi").select(*CURSORS)
        generation = own.agg(F.max("generation")).first()[0] or 0

        def read(cursors: DataFrame, generation: int, log_now=seen, upto=latest) -> tuple[DataFrame, DataFrame, dict[str, tuple]]:
            return table_records(
                log_now, columns, keyspace, table, names, cursors, upto, generation, migrate, **options
            )

        def save(records: DataFrame, moved: DataFrame | None, run: str) -> None:
            """Records first, then the state that says so; counted as they are written."""
            nonlocal done, text
            seen_ops = Observation()
            count = lambda op: F.count_if(F.col("op") == op)
            counted = records.observe(seen_ops, *[count(op).alias(name) for op, name in sinks.COUNTS.items()])
            sinks.write_records(counted, f"{out_dir}/records/{keyspace}/{table}/run={run}", "overwrite")
            counts.append((keyspace, table, *[seen_ops.get[name] for name in sinks.COUNTS.values()]))
            if moved is not None:
                others = done.join(moved.select(*SHARD, "table"), [*SHARD, "table"], "left_anti")
                done = settle(others.unionByName(moved, allowMissingColumns=True))
                text = state.write_checkpoint(done, f"{out_dir}/state/run={state_run}")

        def begin(generation: int, upto: DataFrame = latest) -> DataFrame:
            """Cursors at the positions peeked before a copy."""
            return own.select(*SHARD, "table").join(upto, SHARD, "left").select(
                *SHARD,
                "table",
                F.coalesce("latest", F.lit("")).alias("position"),
                F.lit(None).cast("string").alias("last_pk"),
                F.col("latest_seq").alias("seq"),
                F.lit(generation).cast("bigint").alias("generation"),
                F.lit(None).cast("string").alias("layouts"),
            )

        def truncated(records: DataFrame, generation: int) -> DataFrame:
            return sinks.emit_truncate(records, (generation, -1, -1, -1), keyspace=keyspace, table=table)

        def copy(generation: int) -> tuple[DataFrame, DataFrame, dict[str, tuple]]:
            """The snapshot, and cursors at the positions peeked before it."""
            records, moved, gone = read(begin(generation), generation)  # nothing yet: the log begins where it ends
            return copied_records(snapshot, records, keyspace, table, names, generation), moved, gone

        def copy_by_range(way: copying.Copy, moved: DataFrame) -> None:
            """The ranges that are left, the log after each; begun anew if the layout changes meanwhile."""
            try:
                copy_ranges_left(way, moved)
            except log.LayoutChanged:
                way.close(spark)
                generation = max(way.generation + 1, int(time.time() * 1000))
                fresh_plan = copying.plan_copy(snapshots(keyspace, table), copies, pk, copy_ranges, generation)
                copy_ranges_left(fresh_plan, settle(begin(generation, peek(now()))))

        def copy_ranges_left(way: copying.Copy, moved: DataFrame) -> None:
            nothing = read(moved, way.generation, seen.limit(0), latest.limit(0))[0]
            # Written again where a copy is taken up, at the same place, so it does nothing then.
            save(truncated(nothing, way.generation), moved, f"copy-{way.generation}-begin")
            for i in way.left():
                marks = peek(now())
                part = way.rows(snapshots(keyspace, table), pk, i)
                save(copied_records(part, nothing, keyspace, table, names, way.generation, marks), None, f"copy-{way.generation}-{i}")
                way.finish(spark, i)
                log_now = now()
                records, moved, gone = read(moved, way.generation, log_now, peek(log_now))
                if gone:
                    sinks.write_schema_changes(
                        spark, gone, records.schema["seq"].dataType.simpleString(), f"{out_dir}/schema/{keyspace}/{table}/run={state_run}-{i}"
                    )
                moved = settle(moved)
                save(records, moved, f"{state_run}-{way.generation}-{i}")
            way.close(spark)

        opening = max(generation + 1, opened)
        snapshot = snapshots(keyspace, table) if snapshots is not None else None
        can_copy = snapshot is not None
        if (keyspace, table) in lost and not can_copy:
            raise RuntimeError(f"the log of {keyspace}.{table} was removed before it was read: a snapshot is needed")
        if (keyspace, table) in remade and not can_copy:
            raise log.LayoutChanged(f"layout of table {keyspace}.{table} changed beyond migration: run a full re-copy")
        pk = [c["column"] for c in columns if c["is_pk"]]
        copies = f"{out_dir}/copy/{keyspace}/{table}"
        under_way = copying.open_copy(spark, copies, generation) if can_copy and generation else None
        new = (keyspace, table) in fresh or (keyspace, table) in lost or (keyspace, table) in remade
        again = (keyspace, table) in lost or (keyspace, table) in remade
        if under_way is not None and not again:
            copy_by_range(under_way, own)
            continue
        if new and can_copy and copy_ranges > 1 and pk:
            copy_by_range(copying.plan_copy(snapshot, copies, pk, copy_ranges, opening), settle(begin(opening)))
            continue
        if new and can_copy:
            records, moved, dropped = copy(opening)
        else:
            try:
                records, moved, dropped = read(own, opening if new else generation)
            except log.LayoutChanged:
                if not can_copy:
                    raise
                new = True
                records, moved, dropped = copy(opening)
        if new:
            records = truncated(records, opening)
        if dropped:
            kind = records.schema["seq"].dataType.simpleString()
            sinks.write_schema_changes(spark, dropped, kind, f"{out_dir}/schema/{keyspace}/{table}/run={run}")
        save(records, moved, run)
    sinks.write_counts(spark, counts, f"{out_dir}/counts/run={run}")
    sinks.sync_outcome(before, done).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/report/run={run}")
    return text
