"""Queries of log reading, cursors and state (S9-S16, W*, C7-C9, K3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.operators import cursor, shape, sinks, state
from rowtide.operators.checkpoints import response_checkpoints
from rowtide.operators.lineage import settle
from rowtide.plans import derive as d
from rowtide.plans.registry import query
from rowtide.sources import log

TABLE = "orders"


def _value_of(last_pk: str = "last_pk"):
    return F.col(last_pk)["values"][0].cast("bigint")


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT shard, resp AS resp_id, position, pk AS last_pk, done AS copy_completed, records FROM timeline""")
def cursor_timeline(spark, sf_dir):
    """The cursor after every response."""
    return cursor.cursor_timeline(d.stream_events(spark, sf_dir), TABLE).select(
        "shard", "resp_id", "position", _value_of().alias("last_pk"), "copy_completed", "records"
    )


def _bounded(spark, sf_dir):
    events = d.stream_events(spark, sf_dir)
    return cursor.bounded_read(events, TABLE, d.stream_stops(events))


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT m.shard, m.resp AS resp_id, m.idx AS event_idx, m.kind AS event_type, m.i AS seq
FROM marks m JOIN ends e ON m.shard = e.shard WHERE end_resp IS NULL OR m.resp <= end_resp""")
def change_scan_bounded(spark, sf_dir):
    """Every event up to the end rule."""
    read, _ = _bounded(spark, sf_dir)
    return read.select(
        "shard", "resp_id", F.col("event_idx").cast("bigint").alias("event_idx"), "event_type", "seq"
    )


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT shard, struct_extract(c, 'p') AS position, struct_extract(c, 'k') AS last_pk FROM (
  SELECT t.shard, arg_max({{'p': position, 'k': pk}}, resp) AS c
  FROM timeline t JOIN ends e ON t.shard = e.shard WHERE end_resp IS NULL OR resp <= end_resp
  GROUP BY t.shard)""")
def bounded_cursor(spark, sf_dir):
    """The cursor a bounded read leaves behind."""
    _, cursors = _bounded(spark, sf_dir)
    return cursors.select("shard", "position", _value_of().alias("last_pk"))


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT i AS seq, shard, kind AS event_type FROM marks
WHERE i > (SELECT max(event_id) // 3 FROM events) AND i <= (SELECT max(event_id) * 2 // 3 FROM events)""")
def change_scan(spark, sf_dir):
    """A range of the log by its sequence number."""
    events = d.stream_events(spark, sf_dir)
    last = d.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return log.change_scan(events, last // 3, last * 2 // 3).select("seq", "shard", "event_type")


def _positions(spark, sf_dir):
    own = F.element_at("shard_gtids", 2)
    return d.stream_events(spark, sf_dir).withColumn("position", own["gtid"])


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT 'shop' AS keyspace, shard, arg_max(pos, i) FILTER (WHERE pos IS NOT NULL) AS latest
FROM marks GROUP BY shard""")
def peek_latest(spark, sf_dir):
    """S10."""
    return log.peek_latest(_positions(spark, sf_dir))


SKIP_SQL = """
latest AS (
  SELECT shard, arg_max(pos, i) FILTER (WHERE pos IS NOT NULL) AS latest FROM marks GROUP BY shard),
cur AS (
  SELECT u AS tbl, shard, 'p' || CAST(max(resp) // 3 AS VARCHAR) AS position,
         CASE WHEN u % 4 = 0 THEN u END AS last_pk
  FROM marks GROUP BY u, shard)
"""


@query(f"""WITH {d.STREAM_EVENTS_SQL}, {SKIP_SQL}
SELECT tbl, c.shard, position, last_pk FROM cur c JOIN latest l ON c.shard = l.shard
WHERE last_pk IS NOT NULL OR position <> latest""")
def skip_if_current(spark, sf_dir):
    """A cursor per user; those at the latest position drop out, unless in a copy."""
    events = _positions(spark, sf_dir)
    cursors = (
        events.groupBy("keyspace", "shard", F.col("user_id").alias("tbl"))
        .agg(F.concat(F.lit("p"), F.floor(F.max("resp_id") / 3).cast("string")).alias("position"))
        .withColumn("last_pk", F.when(F.col("tbl") % 4 == 0, F.col("tbl")))
    )
    return cursor.skip_if_current(cursors, log.peek_latest(events)).select(
        "tbl", "shard", "position", "last_pk"
    )


@query("""WITH o AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard FROM orders),
n AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY o_orderkey) - 1) // 1000 AS checkpoint FROM o)
SELECT shard, CAST(checkpoint AS BIGINT) AS checkpoint, count(*) AS records, max(o_orderkey) AS last_pk
FROM n GROUP BY shard, checkpoint""")
def copy_checkpoints(spark, sf_dir):
    """Where a copy of the orders can be taken up again."""
    orders = d.read(spark, sf_dir, "orders").select(
        "o_orderkey", d.shard_of("o_custkey").alias("shard")
    )
    return cursor.copy_checkpoints(orders, ["o_orderkey"], span=1_000_000).withColumn(
        "last_pk", F.col("last_pk.o_orderkey")
    )


@query(f"""WITH RECURSIVE {d.STREAM_EVENTS_SQL},
seen AS (
  SELECT shard, resp, position, pk, records, resp * 12000 AS secs,
         row_number() OVER (PARTITION BY shard ORDER BY resp) AS n FROM timeline),
walk AS (
  SELECT shard, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS resp, CAST(0 AS BIGINT) AS c, min(secs) AS t0, FALSE AS fired,
         CAST(0 AS BIGINT) AS had
  FROM seen GROUP BY shard
  UNION ALL
  SELECT shard, n, resp, CASE WHEN fire THEN 0 ELSE c END, CASE WHEN fire THEN secs ELSE t0 END, fire, c FROM (
    SELECT s.shard, s.n, s.resp, w.c + s.records AS c, w.t0, s.secs,
           s.pk IS NOT NULL AND w.c + s.records > 0 AND (w.c + s.records >= 120 OR s.secs - w.t0 >= 48000) AS fire
    FROM walk w JOIN seen s ON s.shard = w.shard AND s.n = w.n + 1))
SELECT w.shard, w.resp AS resp_id, w.had AS records, s.position, s.pk AS last_pk
FROM walk w JOIN seen s ON w.shard = s.shard AND w.resp = s.resp WHERE fired""")
def copy_checkpoints_by_response(spark, sf_dir):
    """The exact rule, rows and time, at the ends of responses."""
    timeline = settle(cursor.cursor_timeline(d.stream_events(spark, sf_dir), TABLE))
    found = response_checkpoints(
        timeline, rows=120, at=F.col("resp_id") * 12000, minutes=800
    )
    return found.select("shard", "resp_id", "records", "position", _value_of().alias("last_pk"))


# --- rows, layouts and responses -----------------------------------------------------

LAYOUT_SQL = """
named AS (
  SELECT *, CASE WHEN tbl LIKE 'shop.%' THEN substr(tbl, 6) ELSE tbl END AS bare,
         CASE WHEN kind = 'FIELD' THEN 'id,v' || CAST((i // 1000) % 3 AS VARCHAR) END AS f
  FROM ev WHERE kind IN ('FIELD', 'ROW')),
filled AS (
  SELECT *,
    last_value(f IGNORE NULLS) OVER (PARTITION BY shard, bare ORDER BY resp, idx
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS by_bare,
    last_value(f IGNORE NULLS) OVER (PARTITION BY shard, tbl ORDER BY resp, idx
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS by_exact
  FROM named)
"""
LAYOUT_OUT = f"""WITH {d.STREAM_EVENTS_SQL}, {LAYOUT_SQL}
SELECT i AS seq, shard, CASE WHEN tbl = bare THEN by_bare ELSE coalesce(by_exact, by_bare) END AS layout
FROM filled WHERE kind = 'ROW'"""


def _layouts(spark, sf_dir):
    return log.layout_as_of(d.stream_events(spark, sf_dir)).select(
        "seq", "shard", F.array_join("layout", ",").alias("layout")
    )


@query(LAYOUT_OUT)
def layout_as_of(spark, sf_dir):
    """C8."""
    return _layouts(spark, sf_dir)


@query(LAYOUT_OUT)
def layout_carried_forward(spark, sf_dir):
    """C8 over a log whose every field list comes twice: repeats change nothing."""
    events = d.stream_events(spark, sf_dir)
    again = events.filter(F.col("event_type") == log.FIELD)
    return log.layout_as_of(events.unionByName(again)).select(
        "seq", "shard", F.array_join("layout", ",").alias("layout")
    )


@query(f"""WITH {d.STREAM_EVENTS_SQL}, {LAYOUT_SQL}
SELECT shard, bare AS "table", count(*) AS versions, min(f) <> max(f) AS changed,
       bool_or(f <> 'id,v0') AS lacks_column,
       CASE WHEN min(f) <> max(f) OR bool_or(f <> 'id,v0') THEN 'RECOPY_REQUIRED' ELSE 'OK' END AS verdict
FROM named WHERE kind = 'FIELD' GROUP BY shard, bare""")
def schema_change_guard(spark, sf_dir):
    """W13."""
    return log.schema_change_guard(d.stream_events(spark, sf_dir), ["id", "v0"]).drop("keyspace")


@query(f"""WITH {d.STREAM_EVENTS_SQL}
SELECT i AS seq, shard, kind AS event_type FROM marks WHERE i % 4 <> 2 AND kind IN ('ROW', 'FIELD')""")
def match_table(spark, sf_dir):
    """Qualified and bare names of one table."""
    events = log.match_table(d.stream_events(spark, sf_dir), TABLE)
    return events.filter(F.col("event_type").isin("ROW", "FIELD")).select("seq", "shard", "event_type")


@query(f"""WITH {d.STREAM_EVENTS_SQL},
one AS (
  SELECT i AS seq, unnest(range(0, CASE WHEN i % 11 <> 0 AND i % 5 = 0 THEN 2 ELSE 1 END)) AS change_idx,
         CASE u % 3 WHEN 0 THEN 'UPSERT' WHEN 1 THEN 'DELETE' ELSE 'UPDATE' END AS op, value
  FROM marks WHERE kind = 'ROW')
SELECT seq, CAST(change_idx AS BIGINT) AS change_idx, op, CASE WHEN op = 'DELETE' THEN NULL ELSE value END AS value FROM one""")
def unnest_row_changes(spark, sf_dir):
    """One row per change; a pair without images is dropped."""
    rows = d.stream_events(spark, sf_dir).filter(F.col("event_type") == log.ROW)
    changes = log.unnest_row_changes(rows)
    return changes.select(
        "seq",
        F.col("change_idx").cast("bigint").alias("change_idx"),
        shape.classify_change(F.col("before"), F.col("after")).alias("op"),
        F.col("after.value").alias("value"),
    )


def _turn_batches(spark, sf_dir):
    """Each turn as a batch: an insert, a delete if even, an update of uneven sides."""
    t = F.col("turn")
    image = F.struct("turn", "role", F.col("text"))
    none = F.array().cast("array<struct<turn: bigint, role: string, text: string>>")
    update = F.struct(
        F.when(t % 3 == 0, F.array(image)).otherwise(F.array(image, image)).alias("before"),
        F.when(t % 3 == 1, F.array(image)).otherwise(F.array(image, image)).alias("after"),
    )
    return d.read(spark, sf_dir, "conversations").select(
        "conv_id",
        F.col("turn").alias("resp_id"),
        F.array(image).alias("inserts"),
        F.when(t % 2 == 0, F.array(image)).otherwise(none).alias("deletes"),
        F.array(update).alias("updates"),
    )


UNNEST_SQL = """
parts AS (
  SELECT conv_id, turn, role, text, 0 AS kind_rank, 0 AS p, FALSE AS has_before, TRUE AS has_after FROM conversations
  UNION ALL SELECT conv_id, turn, role, text, 1, 0, TRUE, FALSE FROM conversations WHERE turn % 2 = 0
  UNION ALL SELECT conv_id, turn, role, text, 2, 0, TRUE, TRUE FROM conversations
  UNION ALL SELECT conv_id, turn, role, text, 2, 1, turn % 3 <> 0, turn % 3 <> 1 FROM conversations)
"""


@query(f"""WITH {UNNEST_SQL}
SELECT conv_id, turn AS resp_id,
       row_number() OVER (PARTITION BY conv_id, turn ORDER BY kind_rank, p) - 1 AS pos, kind_rank,
       CASE WHEN has_before THEN text END AS before_text, CASE WHEN has_after THEN role END AS after_role
FROM parts""")
def unnest_response(spark, sf_dir):
    """Batches as single changes, inserts first, then deletes, then updates."""
    return log.unnest_response(_turn_batches(spark, sf_dir)).select(
        "conv_id",
        "resp_id",
        F.col("pos").cast("bigint").alias("pos"),
        "kind_rank",
        F.col("before.text").alias("before_text"),
        F.col("after.role").alias("after_role"),
    )


@query(f"""WITH {UNNEST_SQL}
SELECT conv_id, turn, CAST(p AS BIGINT) AS place, has_before, has_after FROM parts WHERE kind_rank = 2""")
def pair_images(spark, sf_dir):
    """The shorter side is filled with null."""
    update = F.col("updates")[0]
    return (
        _turn_batches(spark, sf_dir)
        .select(
            "conv_id",
            F.col("resp_id").alias("turn"),
            F.posexplode(log.pair_images(update["before"], update["after"])).alias("place", "c"),
        )
        .select(
            "conv_id",
            "turn",
            F.col("place").cast("bigint").alias("place"),
            F.col("c.before").isNotNull().alias("has_before"),
            F.col("c.after").isNotNull().alias("has_after"),
        )
    )


@query("""SELECT conv_id, turn, role AS role_value, CAST(length(text) AS VARCHAR) AS size_value
FROM conversations""")
def positional_to_named(spark, sf_dir):
    """Values by position, names from the layout."""
    values = F.array(
        F.col("conv_id").cast("string"), "role", F.length("text").cast("string")
    )
    named = shape.positional_to_named(
        values, F.array(F.lit("conv_id"), F.lit("role"), F.lit("size"))
    )
    return d.read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", named["role"].alias("role_value"), named["size"].alias("size_value")
    )


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard, o_orderstatus FROM orders""")
def read_all_shards(spark, sf_dir):
    """Per-shard inputs as one frame."""
    orders = d.read(spark, sf_dir, "orders")
    even = F.col("o_custkey") % 2 == 0
    return log.read_all_shards({"-80": orders.filter(even), "80-": orders.filter(~even)}).select(
        "o_orderkey", "shard", "o_orderstatus"
    )


# --- state -----------------------------------------------------------------------------

def _starts(spark, sf_dir):
    return state.explode_positions(d.starts_text(spark, sf_dir), "text")


@query(f"""WITH {d.STATE_SQL}
SELECT t.keyspace, t.tbl AS "table", p.shard, p.position FROM tabs t JOIN starts p ON t.keyspace = p.keyspace""")
def starting_positions(spark, sf_dir):
    """Positions from their JSON texts, for every table of the keyspace."""
    return d.keyspace_tables(spark, sf_dir).join(_starts(spark, sf_dir), "keyspace")


@query(f"""WITH {d.STATE_SQL}
SELECT keyspace, tbl AS "table", shard, position, CAST(NULL AS VARCHAR) AS last_pk FROM fresh""")
def initial_state(spark, sf_dir):
    """W8."""
    return state.initial_state(
        d.keyspace_tables(spark, sf_dir), d.keyspace_shards(spark, sf_dir), _starts(spark, sf_dir)
    )


MERGE_SQL = f"""WITH {d.STATE_SQL},
known AS (SELECT DISTINCT keyspace, tbl FROM saved),
wanted AS (
  SELECT f.*, k.tbl IS NOT NULL AS known FROM fresh f
  LEFT JOIN known k ON f.keyspace = k.keyspace AND f.tbl = k.tbl),
merged AS (
  SELECT coalesce(s.keyspace, w.keyspace) AS keyspace, coalesce(s.tbl, w.tbl) AS tbl,
         coalesce(s.shard, w.shard) AS shard,
         CASE WHEN s.tbl IS NOT NULL THEN s.position WHEN w.known THEN '' ELSE w.position END AS position,
         s.last_pk, s.tbl IS NULL AND w.known AND w.position <> '' AS start_ignored
  FROM saved s FULL OUTER JOIN wanted w
    ON s.keyspace = w.keyspace AND s.tbl = w.tbl AND s.shard = w.shard)
"""


def _merged(spark, sf_dir):
    return state.merge_state(
        d.saved_state(spark, sf_dir),
        d.keyspace_tables(spark, sf_dir),
        d.keyspace_shards(spark, sf_dir),
        _starts(spark, sf_dir),
    )


@query(MERGE_SQL + 'SELECT keyspace, tbl AS "table", shard, position, last_pk, start_ignored FROM merged')
def merge_state(spark, sf_dir):
    """W9."""
    return _merged(spark, sf_dir).drop("seq")


@query(MERGE_SQL + """SELECT keyspace, tbl AS "table",
       bool_and(position = '' AND last_pk IS NULL) AS truncate FROM merged GROUP BY keyspace, tbl""")
def truncate_gate(spark, sf_dir):
    """C7."""
    return shape.truncate_gate(_merged(spark, sf_dir))


@query(MERGE_SQL + """SELECT keyspace, tbl AS "table", '{"shards":{' || string_agg('"' || shard
       || '":{"position":"' || position || '"' || coalesce(',"last_pk":"' || last_pk || '"', '') || '}', ',' ORDER BY shard)
       || '}}' AS stream FROM merged GROUP BY keyspace, tbl""")
def stream_state_json(spark, sf_dir):
    """K3: the JSON of each stream in the state."""
    return state.stream_shards(_merged(spark, sf_dir).drop("seq")).select(
        "keyspace", "table", F.to_json("stream").alias("stream")
    )


@query(MERGE_SQL + """SELECT m.keyspace, m.tbl AS "table", m.shard,
       m.position IS DISTINCT FROM coalesce(s.position, '') OR m.last_pk IS DISTINCT FROM s.last_pk AS progressed
FROM (SELECT * REPLACE (CASE WHEN shard = 's1' THEN 'moved' ELSE position END AS position) FROM merged) m
LEFT JOIN saved s ON s.keyspace = m.keyspace AND s.tbl = m.tbl AND s.shard = m.shard""")
def made_progress(spark, sf_dir):
    """Cursors that moved since the saved state."""
    moved = _merged(spark, sf_dir).withColumn(
        "position", F.when(F.col("shard") == "s1", F.lit("moved")).otherwise(F.col("position"))
    )
    return cursor.made_progress(d.saved_state(spark, sf_dir), moved).select(
        "keyspace", "table", "shard", "progressed"
    )


EXPIRED_SQL = f"""WITH {d.STATE_SQL},
purged AS (
  SELECT 'ks' || CAST(s_nationkey AS VARCHAR) AS keyspace, 's0' AS shard, max(s_suppkey) * 5 AS purged_upto
  FROM supplier GROUP BY s_nationkey),
g AS (
  SELECT s.*, coalesce(position <> '' AND seq < purged_upto, FALSE) AS gone
  FROM saved s LEFT JOIN purged p ON s.keyspace = p.keyspace AND s.shard = p.shard),
r AS (SELECT keyspace, tbl, bool_or(gone) AS reset FROM g GROUP BY keyspace, tbl)
"""


@query(EXPIRED_SQL + """SELECT g.keyspace, g.tbl AS "table", shard, CASE WHEN reset THEN '' ELSE position END AS position,
       CASE WHEN NOT reset THEN last_pk END AS last_pk, CASE WHEN NOT reset THEN seq END AS seq,
       CASE WHEN gone THEN 'BINLOG_EXPIRATION_ERROR' END AS error_code, reset AS truncate
FROM g JOIN r ON g.keyspace = r.keyspace AND g.tbl = r.tbl""")
def expired_log_reset(spark, sf_dir):
    """Cursors behind the purged part of their log start over."""
    return _expired(spark, sf_dir)


def _expired(spark, sf_dir):
    purged = (
        d.read(spark, sf_dir, "supplier")
        .groupBy(F.concat(F.lit("ks"), F.col("s_nationkey").cast("string")).alias("keyspace"))
        .agg((F.max("s_suppkey") * 5).alias("purged_upto"))
        .withColumn("shard", F.lit("s0"))
    )
    return cursor.expired_log_reset(d.saved_state(spark, sf_dir), purged)


@query(EXPIRED_SQL + """, a AS (
  SELECT g.keyspace, g.tbl, g.shard, g.position AS start_position, gone,
         CASE WHEN g.shard = 'gone' THEN 'moved' WHEN reset THEN '' ELSE g.position END AS stop_position,
         NOT reset OR g.last_pk IS NULL AS same_pk
  FROM g JOIN r ON g.keyspace = r.keyspace AND g.tbl = r.tbl)
SELECT keyspace, tbl AS "table", shard, start_position, stop_position,
       CASE WHEN gone THEN 'BINLOG_EXPIRATION_ERROR' WHEN start_position <> '' AND stop_position = '' THEN 'RESET'
            WHEN start_position <> stop_position OR NOT same_pk THEN 'PROGRESS' ELSE 'CURRENT' END AS outcome
FROM a""")
def sync_outcome(spark, sf_dir):
    """K4: what became of each saved cursor after a run that lost a part of the log."""
    moved = F.when(F.col("shard") == "gone", F.lit("moved")).otherwise(F.col("position"))
    after = _expired(spark, sf_dir).withColumn("position", moved)
    return sinks.sync_outcome(d.saved_state(spark, sf_dir), after)


# The events as three shards that number their responses one by one; stretches of each are lost.
HOLED_SQL = """
holed AS (
  SELECT DISTINCT 's' || CAST(event_id % 3 AS VARCHAR) AS shard, event_id // 3 AS id FROM events
  WHERE (event_id // 3) // 100 % 7 <> event_id % 3 + 2),
steps AS (SELECT shard, id, lag(id) OVER (PARTITION BY shard ORDER BY id) AS prev FROM holed)
"""


def _holed(spark, sf_dir):
    i = F.col("event_id")
    number = F.floor(i / 3).cast("bigint")
    whole = d.read(spark, sf_dir, "events").select(
        F.lit("shop").alias("keyspace"),
        F.concat(F.lit("s"), (i % 3).cast("string")).alias("shard"),
        number.alias("resp_id"),
        (F.floor(number / 100) % 7 != i % 3 + 2).alias("there"),
    )
    return whole.filter("there").drop("there")


@query(f"""WITH {HOLED_SQL}
SELECT shard, prev + 1 AS lost_from, id - 1 AS lost_to FROM steps WHERE id - prev > 1""")
def log_gaps(spark, sf_dir):
    """The stretches of a log that are missing, found in the log itself."""
    return log.log_gaps(_holed(spark, sf_dir)).select("shard", "lost_from", "lost_to")


@query(f"""WITH {HOLED_SQL},
ends AS (SELECT shard, max(id) - 1 AS upto FROM steps WHERE prev IS NULL OR id - prev > 1 GROUP BY shard),
top AS (SELECT max(event_id) // 3 AS n FROM events),
saved AS (
  SELECT 't' || CAST(c_custkey AS VARCHAR) AS tbl, 's' || CAST(c_custkey % 3 AS VARCHAR) AS shard,
         c_custkey * 37 % (n + 1) AS seq FROM customer, top)
SELECT tbl AS "table", saved.shard, CASE WHEN seq < upto THEN 'BINLOG_EXPIRATION_ERROR' END AS error_code,
       CASE WHEN seq >= upto THEN seq END AS seq, seq < upto AS truncate
FROM saved JOIN ends ON saved.shard = ends.shard""")
def lost_log_reset(spark, sf_dir):
    """Cursors before a missing stretch start over; nobody says what was purged."""
    top = d.read(spark, sf_dir, "events").agg(F.floor(F.max("event_id") / 3).alias("n"))
    key = F.col("c_custkey").cast("bigint")
    seq = key * 37 % (F.lit(top.first()["n"]) + 1)
    saved = d.read(spark, sf_dir, "customer").select(
        F.lit("shop").alias("keyspace"),
        F.concat(F.lit("t"), key.cast("string")).alias("table"),
        F.concat(F.lit("s"), (key % 3).cast("string")).alias("shard"),
        F.concat(F.lit("p"), seq.cast("string")).alias("position"),
        F.lit(None).cast("string").alias("last_pk"),
        seq.alias("seq"),
    )
    return cursor.expired_log_reset(saved, log.lost_upto(_holed(spark, sf_dir))).select(
        "table", "shard", "error_code", "seq", "truncate"
    )
