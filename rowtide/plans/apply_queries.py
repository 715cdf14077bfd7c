"""Queries of shaping and applying (C*, D*, K*, W11, W15, S7, S8)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import apply, cursor, shape, sinks
from rowtide.plans import derive as d
from rowtide.plans.registry import query
from rowtide.plans.sync import sync
from rowtide.session import shared_dir
from rowtide.sources import catalog as cat
from rowtide.sources import log
from rowtide.streaming import raw, tail

PK, COLUMNS = d.ORDERS_PK, d.ORDERS_COLUMNS


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.shape_changes(d.order_changes(spark, sf_dir), PK, COLUMNS)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


FOLD_SQL = """
, fold AS (
  SELECT k, max(seq) FILTER (WHERE op <> 'DELETE') AS w,
         coalesce(max(seq) FILTER (WHERE op = 'DELETE'), -1) AS x,
         arg_max({'v': st, 's': seq}, seq) FILTER (WHERE has_st) AS st,
         arg_max({'v': pr, 's': seq}, seq) FILTER (WHERE has_pr) AS pr
  FROM recs GROUP BY k)
"""
CURRENT_SQL = f"""WITH {d.ORDER_RECORDS_SQL} {FOLD_SQL}
SELECT k AS o_orderkey,
       CASE WHEN struct_extract(st, 's') > x THEN struct_extract(st, 'v') END AS o_orderstatus,
       CASE WHEN struct_extract(pr, 's') > x THEN struct_extract(pr, 'v') END AS o_orderpriority
FROM fold WHERE w > x"""


@query(CURRENT_SQL)
def current_state(spark, sf_dir):
    """Image pairs -> records -> table. The flagship."""
    return apply.current_state(order_records(spark, sf_dir), PK, COLUMNS)


@query(f"""WITH {d.ORDER_RECORDS_SQL} {FOLD_SQL}
SELECT k AS o_orderkey, struct_extract(st, 'v') AS o_orderstatus,
       struct_extract(pr, 'v') AS o_orderpriority, x > w AS deleted,
       TIMESTAMP '2026-01-01 00:00:00' AS synced_at
FROM fold""")
def current_state_soft_delete(spark, sf_dir):
    """D2, D3."""
    out = apply.soft_delete(
        order_records(spark, sf_dir), PK, COLUMNS, synced_at="2026-01-01 00:00:00"
    )
    return out.withColumn("synced_at", F.to_utc_timestamp("synced_at", F.current_timezone()).cast("timestamp_ntz"))


@query(f"""WITH {d.ORDER_RECORDS_SQL},
late AS (SELECT * FROM recs WHERE seq > {d.TRUNCATE_AT}),
fold AS (
  SELECT k, max(seq) FILTER (WHERE op <> 'DELETE') AS w,
         coalesce(max(seq) FILTER (WHERE op = 'DELETE'), -1) AS x,
         arg_max({{'v': st, 's': seq}}, seq) FILTER (WHERE has_st) AS st,
         arg_max({{'v': pr, 's': seq}}, seq) FILTER (WHERE has_pr) AS pr
  FROM late GROUP BY k)
SELECT k AS o_orderkey,
       CASE WHEN struct_extract(st, 's') > x THEN struct_extract(st, 'v') END AS o_orderstatus,
       CASE WHEN struct_extract(pr, 's') > x THEN struct_extract(pr, 'v') END AS o_orderpriority
FROM fold WHERE w > x""")
def current_state_truncate(spark, sf_dir):
    """A TRUNCATE in the middle of the log empties the table."""
    records = sinks.emit_truncate(
        order_records(spark, sf_dir), d.TRUNCATE_AT, keyspace="shop", table="orders"
    )
    return apply.current_state(records, PK, COLUMNS, truncates=True)


@query(f"""WITH {d.ORDER_RECORDS_SQL}
SELECT k AS o_orderkey, shard, seq, op, st AS o_orderstatus, pr AS o_orderpriority,
       'o_orderkey' || CASE WHEN has_st THEN ',o_orderstatus' ELSE '' END
                    || CASE WHEN has_pr THEN ',o_orderpriority' ELSE '' END AS written
FROM recs""")
def change_records(spark, sf_dir):
    """What each record carries."""
    return order_records(spark, sf_dir).select(
        "row.*", "shard", "seq", "op", F.array_join("written", ",").alias("written")
    )


@query("""WITH v AS (
  SELECT event_id, user_id AS old_account, user_id + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS account,
         CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS old_type, event_type
  FROM events),
p AS (SELECT * FROM v)
SELECT event_id AS seq, 'UPDATE' AS op, account, CASE WHEN event_type <> old_type THEN event_type END AS event_type,
       CASE WHEN event_type <> old_type THEN 'account,event_type' ELSE 'account' END AS written
FROM p WHERE account = old_account
UNION ALL
SELECT event_id, 'DELETE', old_account, NULL, 'account' FROM p WHERE account <> old_account
UNION ALL
SELECT event_id, 'UPSERT', account, event_type, 'account,event_type' FROM p WHERE account <> old_account""")
def moved_and_unchanged_rows(spark, sf_dir):
    """A moved key gives DELETE and UPSERT, an unchanged row a bare UPDATE."""
    i, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    image = lambda account, t: F.struct(account.alias("account"), t.alias("event_type"))
    pairs = d.read(spark, sf_dir, "events").select(
        i.alias("seq"),
        image(user, F.when(i % 3 == 0, F.lit("view")).otherwise(kind)).alias("before"),
        image(F.when(i % 5 == 0, user + 1).otherwise(user), kind).alias("after"),
    )
    return shape.shape_changes(pairs, ["account"]).select(
        "seq", "op", "row.*", F.array_join("written", ",").alias("written")
    )


@query("""SELECT user_id, struct_extract(e, 't') AS event_type, struct_extract(e, 'v') AS value,
       struct_extract(e, 'p') AS props
FROM (SELECT user_id, arg_max({'t': event_type, 'v': value, 'p': props}, event_id) AS e
      FROM events GROUP BY user_id)""")
def latest_event_per_user(spark, sf_dir):
    """D1 on a log where every record carries everything."""
    columns = ["user_id", "event_type", "value", "props"]
    events = d.read(spark, sf_dir, "events")
    records = events.select(
        F.col("event_id").alias("seq"),
        F.lit(shape.UPSERT).alias("op"),
        F.struct(*columns).alias("row"),
        F.array(*[F.lit(c) for c in columns]).alias("written"),
    )
    return apply.current_state(records, ["user_id"], columns)


@query(CURRENT_SQL)
def applied_table(spark, sf_dir):
    """K5: the log applied in two runs, the later half first, then the whole again."""
    root = _scratch(spark, "applied")
    records = order_records(spark, sf_dir)
    late = F.col("seq") >= d.NULL_AT
    for part in (records.filter(late), records.filter(~late), records):
        sinks.apply_records(part, root, PK, COLUMNS, buckets=8)
    return sinks.read_table(spark, root, PK, COLUMNS)


@query(CURRENT_SQL)
def streamed_state(spark, sf_dir):
    """The log as files, tailed as a stream, then folded."""
    root = _scratch(spark, "streamed")
    changes = d.order_changes(spark, sf_dir)
    changes.repartition(4).write.parquet(f"{root}/log")
    tail.tail_log(spark, f"{root}/log", changes.schema, f"{root}/out", PK, COLUMNS, files_per_batch=2)
    return apply.current_state(tail.streamed_records(spark, f"{root}/out"), PK, COLUMNS)


@query(f"""WITH {d.ORDER_RECORDS_SQL}
SELECT op, count(*) AS n, count(st) AS statuses, CAST(sum(k) AS BIGINT) AS keys
FROM recs WHERE op <> 'DELETE' GROUP BY op""")
def written_records(spark, sf_dir):
    """K1: records written by operation and read back without the deletes' files."""
    path = _scratch(spark, "records")
    sinks.write_records(order_records(spark, sf_dir), path)
    back = spark.read.parquet(path).filter(F.col("op") != shape.DELETE)
    return back.groupBy("op").agg(
        F.count("*").alias("n"),
        F.count("row.o_orderstatus").alias("statuses"),
        F.sum("row.o_orderkey").alias("keys"),
    )


@query(CURRENT_SQL)
def replayed_records(spark, sf_dir):
    """Records that came twice, reduced to one each and folded."""
    records = order_records(spark, sf_dir)
    twice = records.unionByName(records)
    return apply.current_state(cursor.drop_replayed(twice), PK, COLUMNS)


@query(CURRENT_SQL)
def merged_copy_and_catchup(spark, sf_dir):
    """A full copy at seq 0 and the changes that came meanwhile, folded as one."""
    orders = d.read(spark, sf_dir, "orders").select(
        F.lit("shop").alias("keyspace"),
        F.lit("orders").alias("table"),
        d.shard_of("o_custkey").alias("shard"),
        *COLUMNS,
    )
    copied = shape.snapshot_records(orders, COLUMNS)
    changed = order_records(spark, sf_dir).filter(F.col("seq") >= d.UPDATE_AT)
    both = copied.unionByName(changed, allowMissingColumns=True)
    return apply.current_state(both, PK, COLUMNS)


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard,
       'UPSERT' AS op, CAST(0 AS BIGINT) AS seq, o_orderstatus, o_totalprice, 3 AS n_written
FROM orders""")
def snapshot_scan(spark, sf_dir):
    """Each row of a full copy is an UPSERT."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    orders = d.read(spark, sf_dir, "orders").select(d.shard_of("o_custkey").alias("shard"), *columns)
    return shape.snapshot_records(orders, columns).select(
        "row.*", "shard", "op", "seq", F.size("written").alias("n_written")
    )


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_custkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard FROM orders),
mid AS (SELECT max(o_orderkey) // 2 AS m FROM o)
SELECT o_orderkey, shard, o_orderstatus FROM o, mid
WHERE (shard = '-80' AND o_orderkey > m) OR shard = '80-'""")
def resume_snapshot(spark, sf_dir):
    """One shard goes on after its last key, the other is copied whole."""
    orders = d.read(spark, sf_dir, "orders")
    middle = orders.agg(F.max("o_orderkey")).first()[0] // 2
    tagged = orders.withColumn("shard", d.shard_of("o_custkey"))
    return log.resume_snapshot(tagged, PK, {"-80": [middle], "80-": None}).select(
        "o_orderkey", "shard", "o_orderstatus"
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem,
  (SELECT max(l_orderkey) // 2 AS m FROM lineitem)
WHERE (l_orderkey, l_linenumber) > (m, 3)""")
def composite_pk_resume(spark, sf_dir):
    """S8 with two key columns: lexicographic, with a bound that reaches the scan."""
    lineitem = d.read(spark, sf_dir, "lineitem")
    middle = lineitem.agg(F.max("l_orderkey")).first()[0] // 2
    return lineitem.filter(log.after_key(["l_orderkey", "l_linenumber"], [middle, 3])).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


# --- tables without a primary key --------------------------------------------------

LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"]
LINE_ID_SQL = " || '|' || ".join(
    f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')"
    for c in LINE_COLUMNS
)


@query(f"""SELECT DISTINCT md5({LINE_ID_SQL}) AS row_id, {', '.join(LINE_COLUMNS)} FROM lineitem""")
def row_id_dedupe(spark, sf_dir):
    """Rows without a key, told apart by the hash of their values."""
    return apply.distinct_rows(d.read(spark, sf_dir, "lineitem"), LINE_COLUMNS, 128)


@query("""SELECT user_id, event_type, event_id AS seq,
       row_number() OVER (PARTITION BY user_id, event_type
                          ORDER BY CASE WHEN user_id % 2 = 0 THEN '-80' ELSE '80-' END, event_id) AS row_index
FROM events""")
def row_index(spark, sf_dir):
    """The order of updates of equal rows, numbered chunk by chunk."""
    events = d.read(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("event_id").alias("seq"), d.shard_of("user_id").alias("shard")
    )
    numbered = apply.row_index(events, ["user_id", "event_type"], span=1_000_000)
    return numbered.select("user_id", "event_type", "seq", "row_index")


@query("""WITH e AS (
  SELECT user_id, event_type, value, sum(CASE WHEN event_id % 4 = 3 THEN -1 ELSE 1 END) AS n
  FROM events GROUP BY ALL)
SELECT user_id, event_type, value FROM (
  SELECT user_id, event_type, value, unnest(generate_series(1, CAST(n AS BIGINT))) AS i FROM e WHERE n > 0)""")
def keyless_current_state(spark, sf_dir):
    """A delete in a table without key takes one of the rows that equal it."""
    columns = ["user_id", "event_type", "value"]
    image = F.struct(*columns)
    i = F.col("event_id")
    is_delete = i % 4 == 3
    none = F.lit(None).cast("struct<user_id: bigint, event_type: string, value: double>")
    changes = d.read(spark, sf_dir, "events").select(
        F.when(is_delete, i + d.DELETE_AT).otherwise(i).alias("seq"),
        F.when(is_delete, image).otherwise(none).alias("before"),
        F.when(~is_delete, image).otherwise(none).alias("after"),
    )
    return apply.current_multiset(apply.signed_rows(changes, columns), columns, replayed=False)


@query(f"""WITH {d.ORDER_IMAGES_SQL}, signed AS (
  SELECT st, pr, 1 AS n FROM images WHERE side = 'after' UNION ALL
  SELECT st, pr, -1 FROM images WHERE side = 'before'), counted AS (
  SELECT st, pr, sum(n) AS n FROM signed GROUP BY ALL)
SELECT st AS o_orderstatus, pr AS o_orderpriority, unnest(generate_series(1, CAST(n AS BIGINT))) AS row_index
FROM counted WHERE n > 0""")
def keyless_multiset(spark, sf_dir):
    """The orders log without its key, replayed in part: few distinct rows, each as often as it is there."""
    columns = COLUMNS[1:]
    changes = d.order_changes(spark, sf_dir)
    again = changes.filter(F.col("seq") % 30 == 0)
    signed = apply.signed_rows(changes.unionByName(again), columns)
    return apply.current_multiset(signed, columns, index="row_index")


@query("""SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice
FROM orders""")
def dropped_column(spark, sf_dir):
    """A dropped column keeps its place with nulls, an added one is null before."""
    orders = d.read(spark, sf_dir, "orders")
    even = F.col("o_orderkey") % 2 == 0
    older = apply.dropped_column(orders.filter(~even).select(*COLUMNS), ["o_orderpriority"])
    newer = orders.filter(even).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return apply.merge_layouts(older, newer)


# --- reports -------------------------------------------------------------------------

@query(f"""WITH {d.ORDER_RECORDS_SQL}
SELECT 'shop' AS keyspace, 'orders' AS "table", shard,
       count(*) FILTER (WHERE op = 'UPSERT') AS upserts,
       count(*) FILTER (WHERE op = 'UPDATE') AS updates,
       count(*) FILTER (WHERE op = 'DELETE') AS deletes,
       CAST(0 AS BIGINT) AS truncates, min(seq) AS first_seq, max(seq) AS last_seq
FROM recs GROUP BY shard""")
def sync_report(spark, sf_dir):
    """K4."""
    return sinks.sync_report(order_records(spark, sf_dir))


GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}" for t in GIVEN)
    + ") ORDER BY row_count, \"table\""
)
def copy_order(spark, sf_dir):
    """D9, D10."""
    return sinks.copy_order({t: d.read(spark, sf_dir, t) for t in GIVEN})


@query("""WITH n AS (
  SELECT o_orderkey, o_orderkey % 3 AS n_before, o_custkey % 3 AS n_after FROM orders)
SELECT o_orderkey, CASE WHEN n_before > 0 AND n_after > 0 AND (n_before <> 1 OR n_after <> 1)
  THEN 'an update pairs one row with one: ' || n_before || ' before, ' || n_after || ' after' END AS shape_error
FROM n""")
def uneven_updates(spark, sf_dir):
    """C11: updates whose sides don't pair up are reported in a column."""
    counted = d.read(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 3).alias("n_before"), (F.col("o_custkey") % 3).alias("n_after")
    )
    return shape.check_shapes(counted).select("o_orderkey", "shape_error")


@query("""SELECT 'none' AS "table", CAST(0 AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS filled
UNION ALL SELECT 'nulls', count(*), 0 FROM orders""")
def empty_tables(spark, sf_dir):
    """A table without rows, and one with a column that is all null, are written and read back."""
    root = _scratch(spark, "empty")
    orders = d.read(spark, sf_dir, "orders").select(*COLUMNS)
    sinks.write_table(orders.filter("o_orderkey < 0"), f"{root}/none")
    sinks.write_table(orders.withColumn("o_orderstatus", F.lit(None).cast("string")), f"{root}/nulls")
    count = lambda name: spark.read.parquet(f"{root}/{name}").agg(
        F.lit(name).alias("table"), F.count("*").alias("row_count"), F.count("o_orderstatus").alias("filled")
    )
    return count("none").unionByName(count("nulls"))


# --- whole syncs ------------------------------------------------------------------------

ORDER_TYPES = ("bigint", "varchar(1)", "varchar(20)")


def _order_source(spark: SparkSession):
    """Catalog, selection and shards of the orders table."""
    catalog = spark.createDataFrame(
        [("shop", "orders", i + 1, c, t, "" if i else "PRI") for i, (c, t) in enumerate(zip(COLUMNS, ORDER_TYPES))],
        "keyspace string, table string, ordinal int, column string, column_type string, column_key string",
    )
    selection = catalog.select("keyspace", "table", "column", F.lit(True).alias("included"))
    shards = spark.createDataFrame([("shop", "-80"), ("shop", "80-")], "keyspace string, shard string")
    return catalog, selection, shards


def _order_log(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    d.raw_order_log(spark, sf_dir).write.parquet(f"{root}/log")
    return spark.read.parquet(f"{root}/log")


@query(CURRENT_SQL)
def synced_table(spark, sf_dir):
    """Two syncs over the raw orders log, the second from the first one's state."""
    root, source = _scratch(spark, "synced"), _order_source(spark)
    events = _order_log(spark, sf_dir, root)
    state = sync(events.filter(F.col("resp_id") < d.NULL_AT), *source, root, "1")
    sync(events, *source, root, "2", state)
    records = spark.read.parquet(f"{root}/records/shop/orders")
    return apply.current_state(records, PK, COLUMNS, truncates=True)


def _orders_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as a snapshot has them at last: every third is gone, the others are new."""
    return d.read(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 != 0).select(
        "o_orderkey", F.lit("S").alias("o_orderstatus"), "o_orderpriority", d.shard_of("o_custkey").alias("shard")
    )


SNAPSHOT_SQL = "SELECT o_orderkey, 'S' AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0"


@query(SNAPSHOT_SQL)
def resynced_table(spark, sf_dir):
    """A second full sync, its state lost, over a table in use: only the snapshot is left."""
    root, source = _scratch(spark, "resynced"), _order_source(spark)
    events = _order_log(spark, sf_dir, root)
    for run, state_of in (("1", None), ("2", lambda keyspace, table: _orders_now(spark, sf_dir))):
        sync(events, *source, root, run, snapshots=state_of)
        records = spark.read.parquet(f"{root}/records/shop/orders/run={run}")
        # A bucket for about a million rows.
        sinks.apply_records(records, f"{root}/table", PK, COLUMNS, buckets=max(1, records.count() // 1_000_000))
    return sinks.read_table(spark, f"{root}/table", PK, COLUMNS)


@query(SNAPSHOT_SQL)
def expired_log_recopy(spark, sf_dir):
    """The log was removed behind the cursors, so the next sync copies the table anew."""
    root, source = _scratch(spark, "expired"), _order_source(spark)
    events = _order_log(spark, sf_dir, root)
    early = F.col("resp_id") < d.NULL_AT
    state = sync(events.filter(early), *source, root, "1")
    purged = spark.createDataFrame([("shop", "-80", 2**62)], "keyspace string, shard string, purged_upto bigint")
    sync(
        events.filter(~early), *source, root, "2", state, purged=purged,
        snapshots=lambda keyspace, table: _orders_now(spark, sf_dir),
    )
    records = spark.read.parquet(f"{root}/records/shop/orders")
    return apply.current_state(records, PK, COLUMNS, truncates=True)


@query(f"""WITH {d.ORDER_RECORDS_SQL} {FOLD_SQL}
SELECT k AS o_orderkey, struct_extract(st, 'v') AS o_orderstatus, struct_extract(pr, 'v') AS o_orderpriority,
       NOT coalesce(w > greatest(x, {d.TRUNCATE_AT}), FALSE) AS deleted
FROM fold""")
def soft_delete_truncate(spark, sf_dir):
    """A TRUNCATE marks every row before it."""
    records = sinks.emit_truncate(order_records(spark, sf_dir), d.TRUNCATE_AT, keyspace="shop", table="orders")
    return apply.soft_delete(records, PK, COLUMNS, truncates=True)


def _wire(*columns: str):
    return F.array(*[F.col(c).cast("string").cast("binary") for c in columns])


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def wide_event_records(spark, sf_dir):
    """Copy packets of up to 100,000 changes in one event."""
    root, source = _scratch(spark, "wide"), _order_source(spark)
    packets = (
        d.read(spark, sf_dir, "orders")
        .withColumn("resp_id", (F.floor(F.col("o_orderkey") / 100_000) + 1).cast("bigint"))
        .groupBy(d.shard_of("o_custkey").alias("shard"), "resp_id")
        .agg(F.collect_list(_wire(*COLUMNS)).alias("images"))
        .select(
            F.lit("shop").alias("keyspace"),
            "shard",
            "resp_id",
            F.lit(0).alias("event_idx"),
            F.lit("ROW").alias("event_type"),
            F.lit("shop.orders").alias("table"),
            F.transform(
                "images", lambda i: F.struct(F.lit(None).cast("array<binary>").alias("before"), i.alias("after"))
            ).alias("row_changes"),
        )
    )
    stream = d.raw_order_log(spark, sf_dir)
    ends = packets.select("keyspace", "shard", "resp_id").distinct().select(
        "keyspace",
        "shard",
        "resp_id",
        F.lit(1).alias("event_idx"),
        F.lit("VGTID").alias("event_type"),
        F.array(
            F.struct("keyspace", "shard", F.concat("shard", F.lit(":"), "resp_id").alias("gtid"), F.array().alias("table_pks"))
        ).cast(stream.schema["shard_gtids"].dataType).alias("shard_gtids"),
    )
    fields = stream.filter(F.col("event_type") == log.FIELD)
    events = fields.unionByName(packets, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    sync(events, *source, root, "1")
    return apply.current_state(spark.read.parquet(f"{root}/records/shop/orders"), PK, COLUMNS, truncates=True)


@query("""SELECT o_orderkey AS seq, o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def mixed_layout_rows(spark, sf_dir):
    """Two shards name their columns in different orders."""
    key = d.shard_of("o_custkey")
    turned = ["o_orderpriority", "o_orderkey", "o_orderstatus"]
    rows = d.read(spark, sf_dir, "orders").select(
        F.lit("shop").alias("keyspace"),
        key.alias("shard"),
        F.col("o_orderkey").alias("resp_id"),
        F.lit(0).alias("event_idx"),
        F.lit("ROW").alias("event_type"),
        F.lit("shop.orders").alias("table"),
        F.when(key == "-80", _wire(*COLUMNS)).otherwise(_wire(*turned)).alias("after"),
    )
    fields = rows.select("keyspace", "shard").distinct().select(
        "keyspace",
        "shard",
        F.lit(-1).cast("bigint").alias("resp_id"),
        F.lit(0).alias("event_idx"),
        F.lit("FIELD").alias("event_type"),
        F.lit("shop.orders").alias("table"),
        F.when(F.col("shard") == "-80", F.array(*map(F.lit, COLUMNS))).otherwise(F.array(*map(F.lit, turned))).alias("fields"),
    )
    laid = log.require_layout(log.layout_as_of(rows.unionByName(fields, allowMissingColumns=True)))
    changes = laid.select(F.col("resp_id").alias("seq"), "layout", F.lit(None).cast("array<binary>").alias("before"), "after")
    text = lambda v: v.cast("string")
    writers = {"o_orderkey": lambda v: text(v).cast("bigint"), "o_orderstatus": text, "o_orderpriority": text}
    return shape.write_rows(changes, writers).select("seq", "after.*")


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def evolved_table(spark, sf_dir):
    """A column that came after the first run; older rows have it null."""
    root = _scratch(spark, "evolved")
    orders = d.read(spark, sf_dir, "orders")
    first = shape.snapshot_records(orders.select("o_orderkey", "o_orderstatus"), COLUMNS[:2])
    later = shape.snapshot_records(orders.filter("o_orderkey % 2 = 0").select(*COLUMNS), COLUMNS, seq=1)
    sinks.apply_records(first, root, PK, COLUMNS[:2], buckets=4)
    sinks.apply_records(later, root, PK, COLUMNS, buckets=4)
    return sinks.read_table(spark, root, PK, COLUMNS)


# --- columns that come and go -----------------------------------------------------------

# From here on the log of the orders has another layout: the priority is gone, the clerk is there.
_MIGRATED_AT = d.NULL_AT
_NEW_COLUMNS = ["o_orderkey", "o_orderstatus", "o_clerk"]


def _migrating_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is inserted; a DDL drops the priority and adds the clerk; later every third order gets its clerk,
    every fifth is deleted, and every twentieth is inserted anew."""
    k = F.col("o_orderkey")
    wire = lambda *values: F.array(*[v.cast("string").cast("binary") for v in values])
    none = F.lit(None).cast("array<binary>")
    clerk, status, no_text = F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.col("o_orderstatus"), F.lit(None).cast("string")
    old = wire(k, status, F.col("o_orderpriority"))
    step = lambda at, before, after: F.struct(
        (F.lit(at).cast("bigint") + k * 10).alias("resp_id"), F.array(F.struct(before.alias("before"), after.alias("after"))).alias("row_changes")
    )
    last = F.when(k % 3 == 0, clerk).otherwise(no_text)
    steps = F.array(
        step(0, none, old),
        F.when(k % 3 == 0, step(_MIGRATED_AT, wire(k, status, no_text), wire(k, status, clerk))),
        F.when(k % 5 == 0, step(d.DELETE_AT, wire(k, status, last), none)),
        F.when(k % 20 == 0, step(d.REINSERT_AT, none, wire(k, F.lit("R"), F.lit("anew")))),
    )
    rows = d.read(spark, sf_dir, "orders").select(d.shard_of("o_custkey").alias("shard"), F.explode(steps).alias("c")).filter("c IS NOT NULL")
    rows = rows.select(F.lit("shop").alias("keyspace"), "shard", "c.*", F.lit("shop.orders").alias("table"))
    stream = d.raw_order_log(spark, sf_dir).limit(0)
    position = F.array(
        F.struct("keyspace", "shard", F.concat(F.lit("pos-"), F.col("resp_id").cast("string")).alias("gtid"), F.array().alias("table_pks"))
    ).cast(stream.schema["shard_gtids"].dataType)
    changes = rows.withColumns({"event_idx": F.lit(0), "event_type": F.lit("ROW")})
    ends = rows.drop("row_changes").withColumns({"event_idx": F.lit(1), "event_type": F.lit("VGTID"), "shard_gtids": position})
    shards = spark.createDataFrame([("-80",), ("80-",)], "shard string")
    layouts = [(0, COLUMNS), (_MIGRATED_AT, _NEW_COLUMNS)]
    fields = shards.select(
        F.lit("shop").alias("keyspace"),
        "shard",
        F.inline(F.array(*[F.struct(F.lit(at).cast("bigint").alias("resp_id"), F.array(*map(F.lit, names)).alias("fields")) for at, names in layouts])),
    ).withColumns({"event_idx": F.lit(-1), "event_type": F.lit("FIELD"), "table": F.lit("shop.orders")})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [stream, changes, ends, fields])


def _orders_described(spark: SparkSession, columns: list[str], *types: str):
    """Catalog and selection of the orders table with these columns."""
    catalog = spark.createDataFrame(
        [("shop", "orders", i + 1, c, t, "" if i else "PRI") for i, (c, t) in enumerate(zip(columns, types, strict=True))],
        "keyspace string, table string, ordinal int, column string, column_type string, column_key string",
    )
    return catalog, catalog.select("keyspace", "table", "column", F.lit(True).alias("included"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
       CAST(NULL AS VARCHAR) AS o_orderpriority,
       CASE WHEN o_orderkey % 20 = 0 THEN 'anew' WHEN o_orderkey % 3 = 0 THEN 'C' || o_custkey END AS o_clerk
FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 20 = 0""")
def migrated_table(spark, sf_dir):
    """A column goes and another comes in mid-log, between and within syncs; no snapshot is there to copy."""
    root = _scratch(spark, "migrated")
    _migrating_log(spark, sf_dir).write.parquet(f"{root}/log")
    events = spark.read.parquet(f"{root}/log")
    shards = _order_source(spark)[2]
    old = _orders_described(spark, COLUMNS, *ORDER_TYPES)
    new = _orders_described(spark, _NEW_COLUMNS, "bigint", "varchar(1)", "varchar(20)")
    # The first sync ends while orders are still inserted, the second begins in the old layout and crosses to the new one.
    half = d.read(spark, sf_dir, "orders").agg(F.floor(F.max("o_orderkey") / 2) * 10).first()[0]
    state = sync(events.filter(F.col("resp_id") < half), *old, shards, root, "1")
    sync(events, *new, shards, root, "2", state, migrate=True, former=old[0])
    dropped = sinks.dropped_places(spark, f"{root}/schema/shop/orders")
    columns = [*COLUMNS, "o_clerk"]
    for run, own in (("1", COLUMNS), ("2", _NEW_COLUMNS)):
        records = spark.read.parquet(f"{root}/records/shop/orders/run={run}")
        sinks.apply_records(records, f"{root}/table", PK, own, buckets=8, dropped=dropped if run == "2" else None)
    return sinks.read_table(spark, f"{root}/table", PK, columns)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 16 = 0 THEN 'back' END AS o_orderpriority
FROM orders""")
def dropped_in_place(spark, sf_dir):
    """A dropped column is null in every bucket, touched by a record or not; what is written to its name later stands."""
    root = _scratch(spark, "dropped")
    orders = d.read(spark, sf_dir, "orders")
    sinks.apply_records(shape.snapshot_records(orders.select(*COLUMNS), COLUMNS), root, PK, COLUMNS, buckets=8)
    one = orders.filter("o_orderkey = 7").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    sinks.apply_records(shape.snapshot_records(one, COLUMNS[:2], seq=1), root, PK, COLUMNS[:2], buckets=8)
    sinks.drop_columns(spark, root, {"o_orderpriority": 2})
    again = orders.filter("o_orderkey % 16 = 0").select("o_orderkey", "o_orderstatus", F.lit("back").alias("o_orderpriority"))
    sinks.apply_records(shape.snapshot_records(again, COLUMNS, seq=3), root, PK, COLUMNS, buckets=8)
    return sinks.read_table(spark, root, PK, COLUMNS)


# --- copies by key range ----------------------------------------------------------------

class _Died(RuntimeError):
    pass


@query(SNAPSHOT_SQL)
def interrupted_copy(spark, sf_dir):
    """A copy dies in its third range; the next sync goes on with that one, from the state that was left."""
    root, source = _scratch(spark, "interrupted"), _order_source(spark)
    events, asked = _order_log(spark, sf_dir, root), 0

    def rows(keyspace: str, table: str) -> DataFrame:
        nonlocal asked
        asked += 1
        if asked == 5:  # asked for its size and its keys, then for two ranges
            raise _Died("the source went away")
        return _orders_now(spark, sf_dir)

    try:
        sync(events, *source, root, "1", snapshots=rows, copy_ranges=5)
    except _Died:
        state = spark.read.text(f"{root}/state/run=1").first()[0]
    sync(events, *source, root, "2", state, snapshots=rows, copy_ranges=5)
    records = spark.read.parquet(f"{root}/records/shop/orders")
    return apply.current_state(records, PK, COLUMNS, truncates=True)


@query(CURRENT_SQL)
def interleaved_copy(spark, sf_dir):
    """The log grows between and during the ranges of a copy; rows are updated, deleted and inserted in all of them."""
    root, source = _scratch(spark, "interleaved"), _order_source(spark)
    events = _order_log(spark, sf_dir, root)
    records = order_records(spark, sf_dir)
    shards = d.read(spark, sf_dir, "orders").select("o_orderkey", d.shard_of("o_custkey").alias("shard"))
    middle = 10 * d.read(spark, sf_dir, "orders").agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    # The log's ends one after another; what a range reads lies half-way between two of them.
    times = [middle, d.UPDATE_AT, d.UPDATE_AT + middle, d.NULL_AT + middle, d.DELETE_AT, d.DELETE_AT + middle, d.REINSERT_AT + middle]
    now = 0

    def log_now() -> DataFrame:
        return events.filter(F.col("resp_id") <= (times[now] if now < len(times) else 1 << 62))

    def rows(keyspace: str, table: str) -> DataFrame:
        nonlocal now
        begin = times[min(now, len(times) - 1)]
        now += 1
        end = times[now] if now < len(times) else 1 << 62
        at = (begin + min(end, begin + middle)) // 2
        return apply.current_state(records.filter(F.col("seq") <= at), PK, COLUMNS).join(shards, "o_orderkey")

    sync(log_now, *source, root, "1", snapshots=rows, copy_ranges=4)
    state = spark.read.text(f"{root}/state/run=1").first()[0]
    sync(events, *source, root, "2", state, snapshots=rows, copy_ranges=4)
    return apply.current_state(spark.read.parquet(f"{root}/records/shop/orders"), PK, COLUMNS, truncates=True)


# --- the raw log as a stream ---------------------------------------------------------------

def _described(spark: SparkSession, table: str, columns, types) -> list[dict]:
    """A table's catalog rows, its first column the key."""
    rows = [("shop", table, i + 1, c, t, "" if i else "PRI") for i, (c, t) in enumerate(zip(columns, types))]
    catalog = spark.createDataFrame(
        rows, "keyspace string, table string, ordinal int, column string, column_type string, column_key string"
    )
    return [r.asDict() for r in cat.describe_columns(catalog).orderBy("ordinal").collect()]


def _tailed(spark: SparkSession, events: DataFrame, root: str, steps) -> None:
    """The log landing piece by piece, the stream started anew after each."""
    events.write.parquet(f"{root}/whole")
    whole = spark.read.schema(events.schema).parquet(f"{root}/whole")
    for low, high in zip([-1, *steps], [*steps, 1 << 62]):
        piece = whole.filter((F.col("resp_id") > low) & (F.col("resp_id") <= high))
        piece.write.mode("append").parquet(f"{root}/log")
        raw.tail_raw_log(spark, f"{root}/log", events.schema, f"{root}/out")


def _streamed(spark: SparkSession, schema, root: str, table: str, columns, types) -> DataFrame:
    described = _described(spark, table, columns, types)
    records = raw.typed_records(spark, f"{root}/out", schema, described, "shop", table, columns)
    return apply.current_state(records, columns[:1], columns)


@query(CURRENT_SQL)
def streamed_log(spark, sf_dir):
    """Raw responses as a stream, restarted between a field list and its rows."""
    root, events = _scratch(spark, "rawlog"), d.raw_order_log(spark, sf_dir)
    _tailed(spark, events, root, [0, d.UPDATE_AT, d.DELETE_AT])
    return _streamed(spark, events.schema, root, "orders", COLUMNS, ORDER_TYPES)


@query(f"""SELECT 'orders' AS source, o_orderkey AS id, o_orderstatus AS first, o_orderpriority AS second
FROM ({CURRENT_SQL})
UNION ALL
SELECT 'customer', c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END
FROM customer WHERE c_custkey % 5 <> 0""")
def multi_table_sync(spark, sf_dir):
    """Two tables dealt from one log in one pass, one of them with a layout that changes."""
    root, events = _scratch(spark, "manytables"), d.raw_shop_log(spark, sf_dir)
    _tailed(spark, events, root, [d.NULL_AT])
    common = ["id", "first", "second"]
    orders = _streamed(spark, events.schema, root, "orders", COLUMNS, ORDER_TYPES).select(*COLUMNS).toDF(*common)
    customers = _streamed(spark, events.schema, root, "customer", d.CUSTOMER_COLUMNS, d.CUSTOMER_TYPES)
    both = orders.withColumn("source", F.lit("orders")).unionByName(
        customers.select(*d.CUSTOMER_COLUMNS).toDF(*common).withColumn("source", F.lit("customer"))
    )
    return both.select("source", *common)
