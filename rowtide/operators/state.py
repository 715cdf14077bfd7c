"""Sync state.

A state frame has one cursor per row: ``keyspace, table, shard, position,
last_pk``. Its size is the number of shards times tables, not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CURSOR = ["keyspace", "table", "shard"]
STREAM_JSON = (
    "struct<keyspaces: map<string, struct<streams: map<string, struct<shards: "
    "map<string, struct<position: string, last_pk: string, seq: bigint, error_code: string, "
    "generation: bigint, layouts: string>>>>>>>"
)


def starting_positions(spark: SparkSession, text: str | None) -> DataFrame:
    """``{keyspace: {shard: position}}`` as ``keyspace, shard, position``.

    Text that is not of this form is an error; no text means no positions.
    """
    source = spark.createDataFrame([(text or "{}",)], "text string")
    return explode_positions(source, "text")


def explode_positions(texts: DataFrame, column: str) -> DataFrame:
    """S11 over a column of such texts; other columns are kept."""
    others = [c for c in texts.columns if c != column]
    parsed = F.from_json(column, "map<string,map<string,string>>", {"mode": "FAILFAST"})
    return (
        texts.select(*others, F.explode(parsed).alias("keyspace", "__shards"))
        .select(*others, "keyspace", F.explode("__shards").alias("shard", "position"))
    )


def initial_state(tables: DataFrame, shards: DataFrame, starts: DataFrame) -> DataFrame:
    """An empty cursor, or its starting position, per table and shard of a keyspace."""
    return (
        tables.select("keyspace", "table")
        .join(shards.select("keyspace", "shard"), "keyspace")
        .join(starts.select("keyspace", "shard", "position"), ["keyspace", "shard"], "left")
        .select(
            *CURSOR,
            F.coalesce("position", F.lit("")).alias("position"),
            F.lit(None).cast("string").alias("last_pk"),
        )
    )


def merge_state(
    saved: DataFrame, tables: DataFrame, shards: DataFrame, starts: DataFrame
) -> DataFrame:
    """Saved cursors completed for the selected tables and present shards.

    A saved cursor always wins, and stays even if its shard or table is no longer
    listed. A new table begins at the starting positions; a new shard of a known
    table begins empty, whatever the starting positions say (A12), and is flagged
    ``start_ignored`` where one was given.
    """
    fresh = initial_state(tables, shards, starts)
    known = saved.select("keyspace", "table").distinct().withColumn("__known", F.lit(True))
    wanted = (
        fresh.join(known, ["keyspace", "table"], "left")
        .select(
            *CURSOR,
            F.when(F.col("__known"), F.lit("")).otherwise(F.col("position")).alias("__fresh"),
            F.coalesce(F.col("__known") & (F.col("position") != ""), F.lit(False)).alias(
                "__ignored"
            ),
        )
    )
    extra = [c for c in saved.columns if c not in (*CURSOR, "position", "last_pk")]
    kept = saved.select(*CURSOR, "position", "last_pk", *extra, F.lit(True).alias("__saved"))
    return kept.join(wanted, CURSOR, "full_outer").select(
        *CURSOR,
        F.when(F.col("__saved"), F.coalesce("position", F.lit("")))
        .otherwise(F.col("__fresh"))
        .alias("position"),
        "last_pk",
        *extra,
        (F.coalesce("__ignored", F.lit(False)) & F.col("__saved").isNull()).alias("start_ignored"),
    )


def require_state(tables: DataFrame, state: DataFrame) -> None:
    """C11: a selected table without a cursor is an error, before any read."""
    lost = tables.join(state, ["keyspace", "table"], "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"no state for stream {lost[0].keyspace}:{lost[0].table}")


def _sorted_map(key: Column, value: Column) -> Column:
    entries = F.array_sort(
        F.collect_list(F.struct(key.alias("k"), value.alias("v"))),
        lambda x, y: F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0),
    )
    return F.map_from_entries(entries)


def stream_shards(state: DataFrame) -> DataFrame:
    """The shard map of each stream, named ``keyspace:table``; a group is one table's shards."""
    optional = lambda c, ddl: (F.col(c) if c in state.columns else F.lit(None)).cast(ddl).alias(c)
    cursor = F.struct(
        F.coalesce("position", F.lit("")).alias("position"),
        F.col("last_pk").cast("string").alias("last_pk"),
        optional("seq", "bigint"),
        optional("error_code", "string"),
        optional("generation", "bigint"),
        optional("layouts", "string"),
    )
    return state.groupBy("keyspace", "table").agg(
        F.struct(_sorted_map(F.col("shard"), cursor).alias("shards")).alias("stream")
    )


def state_to_json(state: DataFrame) -> DataFrame:
    """K3: the whole state as one JSON text, keys sorted; one row, one column ``state``."""
    streams = stream_shards(state).groupBy("keyspace").agg(
        F.struct(
            _sorted_map(F.concat_ws(":", "keyspace", "table"), F.col("stream")).alias("streams")
        ).alias("ks")
    )
    return streams.agg(
        F.to_json(F.struct(_sorted_map(F.col("keyspace"), F.col("ks")).alias("keyspaces"))).alias(
            "state"
        )
    )


def state_from_json(spark: SparkSession, text: str) -> DataFrame:
    """The state frame of such a text; empty text is an empty state, bad text an error."""
    source = spark.createDataFrame([(text.strip() or '{"keyspaces":{}}',)], "text string")
    parsed = F.from_json("text", STREAM_JSON, {"mode": "FAILFAST"})
    return (
        source.select(F.explode(parsed["keyspaces"]).alias("keyspace", "__k"))
        .select("keyspace", F.explode("__k.streams").alias("__stream", "__s"))
        .select(
            "keyspace",
            # A stream is named "keyspace:table".
            F.substr("__stream", F.length("keyspace") + 2).alias("table"),
            F.explode("__s.shards").alias("shard", "__c"),
        )
        .select(*CURSOR, "__c.position", "__c.last_pk", "__c.seq", "__c.error_code", "__c.generation", "__c.layouts")
    )


def write_checkpoint(state: DataFrame, path: str) -> str:
    """K3: write the state as JSON text and return it; call it after the records are written."""
    text = state_to_json(state).first().state
    whole = state.sparkSession.range(1).coalesce(1).select(F.lit(text).alias("state"))
    whole.write.mode("overwrite").text(path)
    return text


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).collect()
    return state_from_json(spark, rows[0].value if rows else "")
