"""The raw log of a source as a stream.

Responses are read as they land, field lists, positions and rows of all tables in one pass.
What a batch needs of those before it is small and is kept as three tables: the field
lists of each table, the latest position of each shard, and the latest key of each copy. They
are folded with those of the batch by plain aggregates; the rows, however many a table has,
only meet the field lists, so no hot table or shard becomes one task's work.

Rows are laid out (C8) and dealt to the tables in one partitioned write, their values still
as they came. ``typed_records`` reads one table's part and turns it into records, so the log is
scanned as often for a hundred tables as for one.

Each batch writes rows, then its state; the state of the last batch that finished is the
stream's. A batch that is run again begins from the state before it and overwrites what it
wrote. A shard's files must land in the order of its log; pieces that are delivered again
change nothing but repeat their records, which fold alike (W11). Events of one response may
be spread over batches. A row without a field list before it fails its batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowtide.operators import shape, sinks
from rowtide.operators.cursor import PLACE, valid_last_pk
from rowtide.sources import log

#: Tables that a task writes side by side; of more, it sorts the rest of its rows.
OPEN_TABLES = 16
_AT = "struct<resp_id: bigint, event_idx: int>"
_KEY = "struct<fields: array<string>, values: array<string>>"
#: The state's tables: one row per version of a layout, per shard, and per shard and table.
STATE = {
    "layouts": "keyspace string, shard string, table string, resp_id bigint, event_idx int, fields array<string>",
    "keys": f"keyspace string, shard string, table string, set_at struct<resp_id: bigint, event_idx: int, nth: int>, last_pk {_KEY}",
    "shards": f"keyspace string, shard string, seq bigint, vgtid_at {_AT}, latest struct<at: {_AT}, position: string>",
}


def _own(events: DataFrame) -> Column:
    """The entry of an event's own shard in its list of positions, or null."""
    own = F.filter("shard_gtids", lambda g: (g["keyspace"] == F.col("keyspace")) & (g["shard"] == F.col("shard")))
    return F.when(F.col("event_type") == log.VGTID, F.try_element_at(own, F.lit(1)))


def next_layouts(layouts: DataFrame, events: DataFrame) -> DataFrame:
    """The versions of all field lists after ``events``; lists that repeat the one before are none."""
    came = events.filter(F.col("event_type") == log.FIELD).select(layouts.columns)
    order = W.partitionBy(*PLACE, "table").orderBy(*log.ORDER)
    older = F.lag("fields").over(order)
    return layouts.unionByName(came).withColumn("__old", older).filter(~F.col("__old").eqNullSafe(F.col("fields"))).drop("__old")


def next_shards(shards: DataFrame, events: DataFrame) -> DataFrame:
    """Per shard the last response seen, the last event that lists positions, and the last position with its place."""
    at, own = F.struct(*log.ORDER).cast(_AT), _own(events)
    position = F.nullif(own["gtid"], F.lit(""))
    came = events.select(
        *PLACE,
        F.col("resp_id").alias("seq"),
        F.when(own.isNotNull(), at).alias("vgtid_at"),
        F.when(position.isNotNull(), F.struct(at.alias("at"), position.alias("position"))).alias("latest"),
    )
    return shards.unionByName(came).groupBy(*PLACE).agg(*[F.max(c).alias(c) for c in ("seq", "vgtid_at", "latest")])


def next_keys(keys: DataFrame, events: DataFrame) -> DataFrame:
    """Per shard and table the last mention of a copy's key; a finished copy's is null."""
    own = _own(events)
    listed = events.select(*PLACE, *log.ORDER, F.posexplode(own["table_pks"]).alias("nth", "p")).select(
        *PLACE,
        log.bare_name(F.col("p.table")).alias("table"),
        F.struct(*log.ORDER, (-F.col("nth")).alias("nth")).alias("set_at"),  # of two in one list the first counts
        valid_last_pk(F.col("p.last_pk")).alias("last_pk"),
    )
    told = events.filter(F.col("event_type") == log.LASTPK).select(
        *PLACE,
        log.bare_name(F.col("table")).alias("table"),
        F.struct(*log.ORDER, F.lit(0).alias("nth")).alias("set_at"),
        F.when(~F.coalesce("completed", F.lit(False)), valid_last_pk(F.col("last_pk"))).alias("last_pk"),
    )
    return (
        keys.unionByName(listed)
        .unionByName(told)
        .groupBy(*PLACE, "table")
        .agg(F.max("set_at").alias("set_at"), F.max_by(F.struct("last_pk"), "set_at").alias("k"))
        .select(*PLACE, "table", "set_at", "k.last_pk")
    )


def cursors_of(shards: DataFrame, keys: DataFrame, table: str) -> DataFrame:
    """``keyspace, shard, position, last_pk, seq`` of one table.

    A list of positions that doesn't name the table clears its key.
    """
    mine = keys.filter(F.col("table") == table).drop("table")
    set_at = F.struct("set_at.resp_id", "set_at.event_idx")
    stands = F.col("vgtid_at").isNull() | (set_at >= F.col("vgtid_at"))
    return shards.join(mine, PLACE, "left").select(
        *PLACE,
        F.coalesce("latest.position", F.lit("")).alias("position"),
        F.when(stands, F.col("last_pk")).alias("last_pk"),
        "seq",
    )


def dealt_rows(events: DataFrame, layouts: DataFrame) -> DataFrame:
    """The row changes of all tables, each with its layout and its table's bare name."""
    rows = events.filter(F.col("event_type") == log.ROW)
    fields = layouts.withColumn("event_type", F.lit(log.FIELD))
    laid = log.require_layout(log.layout_as_of(rows.unionByName(fields, allowMissingColumns=True)))
    return log.unnest_row_changes(laid).select(
        *PLACE, log.bare_name(F.col("table")).alias("table"), *log.ORDER, "change_idx", "layout", "before", "after"
    )


def _row_schema(events: StructType) -> str:
    image = events["row_changes"].dataType.elementType["after"].dataType.simpleString()
    return (
        "shard string, resp_id bigint, event_idx int, change_idx int, layout array<string>, "
        f"before {image}, after {image}, batch bigint, keyspace string, table string"
    )


def _state(spark: SparkSession, out_dir: str, name: str, batch: int) -> DataFrame:
    if batch < 0:
        return spark.createDataFrame([], STATE[name])
    return spark.read.schema(STATE[name]).parquet(f"{out_dir}/state/{name}/batch={batch}")


def tail_raw_log(spark: SparkSession, log_dir: str, schema: StructType, out_dir: str, files_per_batch: int | None = None) -> int:
    """Deals what the log has now to its tables; returns the number of batches run."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ran: list[int] = []

    def deal(events: DataFrame, batch: int) -> None:
        session = events.sparkSession

        def move(name: str, step) -> None:
            step(_state(session, out_dir, name, batch - 1), events).coalesce(1).write.mode("overwrite").parquet(
                f"{out_dir}/state/{name}/batch={batch}"
            )

        move("layouts", next_layouts)
        rows = dealt_rows(events, _state(session, out_dir, "layouts", batch))
        with sinks.open_writers(session, OPEN_TABLES):
            rows.write.mode("overwrite").partitionBy("keyspace", "table").parquet(f"{out_dir}/rows/batch={batch}")
        move("keys", next_keys)
        move("shards", next_shards)  # the last: it says that the batch is done
        ran.append(batch)

    query = (
        reader.parquet(log_dir)
        .writeStream.foreachBatch(deal)
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def last_batch(spark: SparkSession, out_dir: str) -> int:
    """The last batch whose state is complete; -1 before the first."""
    try:
        marks = spark.read.schema("batch bigint").parquet(f"{out_dir}/state/shards")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    last = marks.agg(F.max("batch")).first()[0]  # a row per shard and batch
    return -1 if last is None else last


def stream_cursors(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The cursors of one table as the stream left them."""
    batch = last_batch(spark, out_dir)
    return cursors_of(_state(spark, out_dir, "shards", batch), _state(spark, out_dir, "keys", batch), table)


def typed_records(
    spark: SparkSession,
    out_dir: str,
    schema: StructType,
    described: Sequence[dict],
    keyspace: str,
    table: str,
    columns: Sequence[str],
    **options,
) -> DataFrame:
    """One table's records of all finished batches, from its own part of the rows.

    ``schema`` is the log's; ``described`` are the table's catalog rows. Records are ordered
    by ``seq``, a struct of response, event and change.
    """
    writers, pk = shape.plan_writers(described, columns, **options)
    rows = spark.read.schema(_row_schema(schema)).parquet(f"{out_dir}/rows")
    mine = rows.filter(
        (F.col("batch") <= last_batch(spark, out_dir)) & (F.col("keyspace") == keyspace) & (F.col("table") == table)
    )
    changes = mine.select(
        "keyspace", "table", "shard", F.struct(*log.ORDER, "change_idx").alias("seq"), "layout", "before", "after"
    )
    return shape.shape_changes(shape.write_rows(changes, writers), pk, list(writers))
