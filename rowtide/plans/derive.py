"""Change logs, catalogs and states derived from the given tables by Spark.

None of the tables is a change log, so each is turned into one by arithmetic on
its keys. Every derived frame grows with its table. The ``*_SQL`` texts say the
same in ANSI SQL, for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPDATE_AT, NULL_AT, DELETE_AT, REINSERT_AT = 10_000_000_000, 20_000_000_000, 30_000_000_000, 40_000_000_000
TRUNCATE_AT = 15_000_000_000

ORDERS_PK = ["o_orderkey"]
ORDERS_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shard_of(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, F.lit("-80")).otherwise(F.lit("80-"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log as image pairs: one scan, one explode, no shuffle.

    Each order is inserted; some get a new status, then a null priority, then are
    deleted, then inserted anew.
    """
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    image = lambda s, p: F.struct(
        k.alias("o_orderkey"), s.alias("o_orderstatus"), p.alias("o_orderpriority")
    )
    none = F.lit(None).cast("struct<o_orderkey: bigint, o_orderstatus: string, o_orderpriority: string>")
    status2 = F.when(k % 3 == 0, F.lit("U")).otherwise(status)
    priority2 = F.when(k % 7 != 0, priority)
    change = lambda at, before, after: F.struct(
        (F.lit(at).cast("bigint") + k * 10).alias("seq"),
        before.alias("before"),
        after.alias("after"),
    )
    steps = F.array(
        change(0, none, image(status, priority)),
        F.when(
            k % 3 == 0,
            change(UPDATE_AT, image(status, priority), image(F.lit("U"), priority)),
        ),
        F.when(
            k % 7 == 0,
            change(
                NULL_AT, image(status2, priority), image(status2, F.lit(None).cast("string"))
            ),
        ),
        F.when(k % 11 == 0, change(DELETE_AT, image(status2, priority2), none)),
        F.when(k % 22 == 0, change(REINSERT_AT, none, image(F.lit("R"), F.lit("9-RE")))),
    )
    return (
        read(spark, sf_dir, "orders")
        .select(
            F.lit("shop").alias("keyspace"),
            F.lit("orders").alias("table"),
            shard_of("o_custkey").alias("shard"),
            F.explode(steps).alias("c"),
        )
        .filter(F.col("c").isNotNull())
        .select(
            "keyspace",
            "table",
            "shard",
            "c.*",
            F.concat(F.lit("pos-"), F.col("c.seq").cast("string")).alias("position"),
        )
    )


# The same log as records: what each carries is in the has_ columns.
ORDER_RECORDS_SQL = """
base AS (
  SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr,
         CASE WHEN o_custkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard
  FROM orders),
recs AS (
  SELECT k, shard, k * 10 AS seq, 'UPSERT' AS op, st, TRUE AS has_st, pr, TRUE AS has_pr FROM base
  UNION ALL
  SELECT k, shard, 10000000000 + k * 10, 'UPDATE', 'U', TRUE, NULL, FALSE FROM base WHERE k % 3 = 0
  UNION ALL
  SELECT k, shard, 20000000000 + k * 10, 'UPDATE', NULL, FALSE, NULL, TRUE FROM base WHERE k % 7 = 0
  UNION ALL
  SELECT k, shard, 30000000000 + k * 10, 'DELETE', NULL, FALSE, NULL, FALSE FROM base WHERE k % 11 = 0
  UNION ALL
  SELECT k, shard, 40000000000 + k * 10, 'UPSERT', 'R', TRUE, '9-RE', TRUE FROM base WHERE k % 22 = 0)
"""


# The log's images: what stood before each change and what after it.
ORDER_IMAGES_SQL = """
base AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
images AS (
  SELECT 'after' AS side, st, pr FROM base
  UNION ALL SELECT 'before', st, pr FROM base WHERE k % 3 = 0
  UNION ALL SELECT 'after', 'U', pr FROM base WHERE k % 3 = 0
  UNION ALL SELECT 'before', CASE WHEN k % 3 = 0 THEN 'U' ELSE st END, pr FROM base WHERE k % 7 = 0
  UNION ALL SELECT 'after', CASE WHEN k % 3 = 0 THEN 'U' ELSE st END, NULL FROM base WHERE k % 7 = 0
  UNION ALL SELECT 'before', CASE WHEN k % 3 = 0 THEN 'U' ELSE st END, CASE WHEN k % 7 <> 0 THEN pr END FROM base WHERE k % 11 = 0
  UNION ALL SELECT 'after', 'R', '9-RE' FROM base WHERE k % 22 = 0)
"""


# --- stream events -------------------------------------------------------------

EVENTS_PER_RESPONSE = 50
LAST_PK = "struct<fields: array<string>, values: array<string>>"


def _cases(*pairs, otherwise=None) -> Column:
    chain = F.when(*pairs[0])
    for test, value in pairs[1:]:
        chain = chain.when(test, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a log of two shards: field lists, rows, positions, last keys."""
    i, user = F.col("event_id"), F.col("user_id")
    resp = F.floor(i / EVENTS_PER_RESPONSE).cast("bigint")
    kind = _cases(
        (F.col("event_type") == "signup", F.lit("FIELD")),
        (F.col("event_type") == "error", F.lit("VGTID")),
        ((F.col("event_type") == "view") & (i % 7 == 0), F.lit("LASTPK")),
        ((F.col("event_type") == "purchase") & (i % 1009 == 1000), F.lit("COPY_COMPLETED")),
        otherwise=F.lit("ROW"),
    )
    table = _cases(
        (i % 4 == 0, F.lit("shop.orders")),
        (i % 4 == 2, F.lit("shop.users")),
        otherwise=F.lit("orders"),
    )
    text_i = i.cast("string")
    fields = F.array(F.lit("id"), F.concat(F.lit("v"), (F.floor(i / 1000) % 3).cast("string")))
    image = F.struct(text_i.alias("id"), F.col("value").alias("value"))
    no_image = F.lit(None).cast("struct<id: string, value: double>")
    pair = lambda b, a: F.struct(b.alias("before"), a.alias("after"))
    both = _cases(
        (user % 3 == 0, pair(no_image, image)),
        (user % 3 == 1, pair(image, no_image)),
        otherwise=pair(image, image),
    )
    changes = _cases(
        (i % 11 == 0, F.array(both, pair(no_image, no_image))),
        (i % 5 == 0, F.array(both, both)),
        otherwise=F.array(both),
    )
    key = F.struct(F.array(F.lit("id")).alias("fields"), F.array(text_i).alias("values"))
    shard = F.when(resp % 3 == 0, F.lit("80-")).otherwise(F.lit("-80"))
    other = F.when(resp % 3 == 0, F.lit("-80")).otherwise(F.lit("80-"))
    gtid = F.when(i % 13 == 0, F.lit("")).otherwise(
        F.concat(F.lit("p"), F.floor(resp / 3).cast("string"))
    )
    table_pk = lambda name: F.array(F.struct(F.lit(name).alias("table"), key.alias("last_pk")))
    pks = _cases(
        (i % 3 == 0, table_pk("orders")),
        (i % 3 == 1, table_pk("shop.users")),
        otherwise=F.array().cast(f"array<struct<table: string, last_pk: {LAST_PK}>>"),
    )
    entry = lambda s, g, p: F.struct(
        F.lit("shop").alias("keyspace"), s.alias("shard"), g.alias("gtid"), p.alias("table_pks")
    )
    only = lambda name, value: F.when(F.col("event_type") == name, value).alias
    base = read(spark, sf_dir, "events").select(
        F.lit("shop").alias("keyspace"),
        shard.alias("shard"),
        resp.alias("resp_id"),
        (i % EVENTS_PER_RESPONSE).cast("int").alias("event_idx"),
        kind.alias("event_type"),
        table.alias("table"),
        fields.alias("fields"),
        changes.alias("row_changes"),
        F.array(entry(other, F.lit("elsewhere"), pks), entry(shard, gtid, pks)).alias("shard_gtids"),
        key.alias("last_pk"),
        (user % 2 == 0).alias("completed"),
        i.alias("seq"),
        F.col("ts"),
        "user_id",
    )
    return base.select(
        "keyspace",
        "shard",
        "resp_id",
        "event_idx",
        "event_type",
        "table",
        only("FIELD", F.col("fields"))("fields"),
        only("ROW", F.col("row_changes"))("row_changes"),
        only("VGTID", F.col("shard_gtids"))("shard_gtids"),
        only("LASTPK", F.col("last_pk"))("last_pk"),
        only("LASTPK", F.col("completed"))("completed"),
        "seq",
        "ts",
        "user_id",
    )


# pos: an explicit non-empty position; pk_set: whether the event sets the last key of
# table "orders", pk: to what (null = cleared); n: changes that count.
STREAM_EVENTS_SQL = """
ev AS (
  SELECT event_id AS i, user_id AS u, event_type AS et, value, event_id // 50 AS resp,
         event_id % 50 AS idx,
         CASE WHEN (event_id // 50) % 3 = 0 THEN '80-' ELSE '-80' END AS shard,
         CASE WHEN event_id % 4 = 0 THEN 'shop.orders' WHEN event_id % 4 = 2 THEN 'shop.users'
              ELSE 'orders' END AS tbl,
         CASE WHEN event_type = 'signup' THEN 'FIELD' WHEN event_type = 'error' THEN 'VGTID'
              WHEN event_type = 'view' AND event_id % 7 = 0 THEN 'LASTPK'
              WHEN event_type = 'purchase' AND event_id % 1009 = 1000 THEN 'COPY_COMPLETED'
              ELSE 'ROW' END AS kind
  FROM events),
marks AS (
  SELECT *,
    CASE WHEN kind = 'VGTID' AND i % 13 <> 0 THEN 'p' || CAST(resp // 3 AS VARCHAR) END AS pos,
    kind = 'VGTID' OR (kind = 'LASTPK' AND i % 4 <> 2) AS pk_set,
    CASE WHEN kind = 'VGTID' AND i % 3 = 0 THEN i
         WHEN kind = 'LASTPK' AND i % 4 <> 2 AND u % 2 <> 0 THEN i END AS pk,
    CASE WHEN kind = 'ROW' AND i % 4 <> 2
         THEN CASE WHEN i % 11 = 0 THEN 1 WHEN i % 5 = 0 THEN 2 ELSE 1 END ELSE 0 END AS n
  FROM ev),
resps AS (
  SELECT shard, resp,
    arg_max(pos, idx) FILTER (WHERE pos IS NOT NULL) AS set_pos,
    arg_max({'pk': pk}, idx) FILTER (WHERE pk_set) AS set_pk,
    bool_or(kind = 'COPY_COMPLETED') AS done,
    CAST(sum(n) AS BIGINT) AS records
  FROM marks GROUP BY shard, resp),
timeline AS (
  SELECT shard, resp, done, records,
    coalesce(last_value(set_pos IGNORE NULLS) OVER w, '') AS position,
    struct_extract(last_value(set_pk IGNORE NULLS) OVER w, 'pk') AS pk
  FROM resps
  WINDOW w AS (PARTITION BY shard ORDER BY resp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
stops AS (
  SELECT shard, 'p' || CAST((max(resp) * 4 // 5) // 3 AS VARCHAR) AS stop FROM ev GROUP BY shard),
firsts AS (
  SELECT t.shard, min(t.resp) AS first_resp
  FROM timeline t JOIN stops s ON t.shard = s.shard AND t.position = s.stop GROUP BY t.shard),
ends AS (
  SELECT t.shard, min(t.resp) FILTER (WHERE t.done OR
           (t.resp > f.first_resp AND t.position <> s.stop AND t.pk IS NULL)) AS end_resp
  FROM timeline t JOIN stops s ON t.shard = s.shard LEFT JOIN firsts f ON t.shard = f.shard
  GROUP BY t.shard)
"""


def stream_stops(events: DataFrame) -> DataFrame:
    """Per shard, the position four fifths through its log, as the stop of a read."""
    reach = F.floor(F.max("resp_id") * 4 / 5)
    return events.groupBy("keyspace", "shard").agg(
        F.concat(F.lit("p"), F.floor(reach / 3).cast("string")).alias("stop")
    )


# --- catalogs ------------------------------------------------------------------

COLUMNS_PER_TABLE = 16

# One source type text per residue of the part key; %d is the part size.
TYPE_TEXTS = (
    "int(%d)", "int unsigned", "TINYINT(1)", "tinyint(4)", "smallint", "bigint(%d)",
    "bigint unsigned", "bit(%d)", "varbinary(%d)", "binary(16)", "decimal(%d,2)",
    "DECIMAL(%d)", "decimal", "double", "float", "timestamp", "time", "datetime(3)", "year",
    "varchar(%d)", "text", "char(%d)", "enum('a%d','fern, dry','skipper''s')",
    "set('r%d','rope,knot','it''s')", "geometry", "geomcollection", "point", "multilinestring", "date",
    "json", "mediumtext", "mediumint", "mediumint unsigned", "blob", "numeric(%d,2)", "real",
    "unsigned int",
)


def type_text(key: Column, size: Column) -> Column:
    texts = F.array(*[F.lit(t) for t in TYPE_TEXTS])
    picked = F.element_at(texts, (key % len(TYPE_TEXTS)).cast("int") + 1)
    return F.replace(picked, F.lit("%d"), size.cast("string"))


TYPE_TEXT_SQL = (
    "replace(list_extract(["
    + ", ".join("'" + t.replace("'", "''") + "'" for t in TYPE_TEXTS)
    + f"], CAST(p_partkey % {len(TYPE_TEXTS)} AS INTEGER) + 1), '%d', CAST(p_size AS VARCHAR))"
)


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as catalog rows: sixteen columns a table, tables in five keyspaces.

    Some tables bear the names of maintenance tables.
    """
    k = F.col("p_partkey")
    t = F.floor(k / COLUMNS_PER_TABLE).cast("bigint")
    number = t.cast("string")
    table = _cases(
        (t % 10 == 3, F.concat(F.lit("_vt_hld_"), F.md5(number), F.lit("_20250101000000_"))),
        (t % 10 == 7, F.concat(F.lit("_"), F.md5(number), F.lit("_20250101000000_vrepl"))),
        (t % 10 == 9, F.concat(F.lit("_0a1b2c3d_4e5f_6071_"), number)),
        otherwise=F.concat(F.lit("t"), number),
    )
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("ks"), (t % 5).cast("string")).alias("keyspace"),
        table.alias("table"),
        (k % COLUMNS_PER_TABLE + 1).cast("int").alias("ordinal"),
        F.concat(F.lit("c"), k.cast("string")).alias("column"),
        type_text(k, F.col("p_size")).alias("column_type"),
        F.when(k % COLUMNS_PER_TABLE == 0, F.lit("pri")).otherwise(F.lit("")).alias("column_key"),
    )


PART_CATALOG_SQL = f"""
cat AS (
  SELECT 'ks' || CAST((p_partkey // 16) % 5 AS VARCHAR) AS keyspace,
         CASE WHEN (p_partkey // 16) % 10 = 3
                THEN '_vt_hld_' || md5(CAST(p_partkey // 16 AS VARCHAR)) || '_20250101000000_'
              WHEN (p_partkey // 16) % 10 = 7
                THEN '_' || md5(CAST(p_partkey // 16 AS VARCHAR)) || '_20250101000000_vrepl'
              WHEN (p_partkey // 16) % 10 = 9
                THEN '_0a1b2c3d_4e5f_6071_' || CAST(p_partkey // 16 AS VARCHAR)
              ELSE 't' || CAST(p_partkey // 16 AS VARCHAR) END AS tbl,
         (p_partkey // 16) % 10 IN (3, 7, 9) AS internal,
         CAST(p_partkey % 16 + 1 AS INTEGER) AS ordinal,
         'c' || CAST(p_partkey AS VARCHAR) AS col,
         {TYPE_TEXT_SQL} AS column_type,
         p_partkey % 16 = 0 AS is_pk, p_partkey AS k, p_size AS size
  FROM part)
"""


# --- names and states ------------------------------------------------------------

def shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``keyspace/shard`` name per customer; some are malformed."""
    k = F.col("c_custkey")
    text = k.cast("string")
    name = _cases(
        (k % 10 == 0, F.concat(F.lit("shop"), text)),
        (k % 10 == 1, F.concat(F.lit("shop_eu/"), text, F.lit("-"))),
        (k % 10 == 2, F.concat(F.lit("shop/a/"), text, F.lit("-"))),
        (k % 10 == 3, F.concat(F.lit("my_shop/"), text)),
        (k % 10 == 4, F.lit("")),
        (k % 10 == 5, F.concat(F.lit("store/"), text)),
        otherwise=F.concat(F.lit("shop/-"), text),
    )
    return read(spark, sf_dir, "customer").select(name.alias("name"))


SHARD_NAMES_SQL = """
names AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN 'shop' || CAST(c_custkey AS VARCHAR)
              WHEN c_custkey % 10 = 1 THEN 'shop_eu/' || CAST(c_custkey AS VARCHAR) || '-'
              WHEN c_custkey % 10 = 2 THEN 'shop/a/' || CAST(c_custkey AS VARCHAR) || '-'
              WHEN c_custkey % 10 = 3 THEN 'my_shop/' || CAST(c_custkey AS VARCHAR)
              WHEN c_custkey % 10 = 4 THEN ''
              WHEN c_custkey % 10 = 5 THEN 'store/' || CAST(c_custkey AS VARCHAR)
              ELSE 'shop/-' || CAST(c_custkey AS VARCHAR) END AS name
  FROM customer)
"""


def keyspace_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per supplier, in a keyspace per nation."""
    return read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("ks"), F.col("s_nationkey").cast("string")).alias("keyspace"),
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("table"),
    )


def keyspace_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of each nation's keyspace: one per region-sized step of its key."""
    n = F.col("n_nationkey")
    shards = F.transform(
        F.sequence(F.lit(0), n % 4), lambda s: F.concat(F.lit("s"), s.cast("string"))
    )
    return read(spark, sf_dir, "nation").select(
        F.concat(F.lit("ks"), n.cast("string")).alias("keyspace"), F.explode(shards).alias("shard")
    )


def starts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starting positions of every third nation, each as its own JSON text."""
    n = F.col("n_nationkey").cast("string")
    text = F.format_string(
        '{"ks%s":{"s0":"start/%s:1-3","s1":"start/%s:4-5"}}', n, n, n
    )
    return read(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 3 == 0).select(
        text.alias("text")
    )


def saved_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors already saved: two thirds of the suppliers, one of them on a lost shard."""
    s = F.col("s_suppkey")
    return (
        read(spark, sf_dir, "supplier")
        .filter(s % 3 != 0)
        .select(
            F.concat(F.lit("ks"), F.col("s_nationkey").cast("string")).alias("keyspace"),
            F.concat(F.lit("t"), s.cast("string")).alias("table"),
            F.explode(
                F.when(s % 3 == 1, F.array(F.lit("s0"))).otherwise(
                    F.array(F.lit("s0"), F.lit("gone"))
                )
            ).alias("shard"),
            F.when(s % 5 == 0, F.lit("")).otherwise(
                F.concat(F.lit("saved/"), s.cast("string"))
            ).alias("position"),
            F.when(s % 7 == 0, s.cast("string")).alias("last_pk"),
            (s * 10).alias("seq"),
        )
    )


STATE_SQL = """
tabs AS (SELECT 'ks' || CAST(s_nationkey AS VARCHAR) AS keyspace,
                't' || CAST(s_suppkey AS VARCHAR) AS tbl FROM supplier),
shards AS (SELECT 'ks' || CAST(n_nationkey AS VARCHAR) AS keyspace,
                  's' || CAST(unnest(range(0, n_nationkey % 4 + 1)) AS VARCHAR) AS shard FROM nation),
starts AS (
  SELECT 'ks' || CAST(n_nationkey AS VARCHAR) AS keyspace, 's0' AS shard,
         'start/' || CAST(n_nationkey AS VARCHAR) || ':1-3' AS position
  FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL
  SELECT 'ks' || CAST(n_nationkey AS VARCHAR), 's1',
         'start/' || CAST(n_nationkey AS VARCHAR) || ':4-5'
  FROM nation WHERE n_nationkey % 3 = 0),
fresh AS (
  SELECT t.keyspace, t.tbl, s.shard, coalesce(p.position, '') AS position
  FROM tabs t JOIN shards s ON t.keyspace = s.keyspace
  LEFT JOIN starts p ON p.keyspace = s.keyspace AND p.shard = s.shard),
saved AS (
  SELECT 'ks' || CAST(s_nationkey AS VARCHAR) AS keyspace, 't' || CAST(s_suppkey AS VARCHAR) AS tbl,
         unnest(CASE WHEN s_suppkey % 3 = 1 THEN ['s0'] ELSE ['s0', 'gone'] END) AS shard,
         CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'saved/' || CAST(s_suppkey AS VARCHAR) END AS position,
         CASE WHEN s_suppkey % 7 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS last_pk,
         s_suppkey * 10 AS seq
  FROM supplier WHERE s_suppkey % 3 <> 0)
"""


# --- a raw log ---------------------------------------------------------------------

def raw_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log as a source's stream gives it: wire bytes, positions, field lists.

    Each change is a response of its own, with the row and then the position.
    """
    wire = lambda side: F.when(
        F.col(side).isNotNull(),
        F.array(*[F.col(side)[c].cast("string").cast("binary") for c in ORDERS_COLUMNS]),
    )
    gtid = F.struct(
        F.lit("shop").alias("keyspace"),
        "shard",
        "position",
        F.array().cast(f"array<struct<table: string, last_pk: {LAST_PK}>>").alias("table_pks"),
    )
    event = lambda idx, kind, rows, gtids: F.struct(
        F.lit(idx).alias("event_idx"),
        F.lit(kind).alias("event_type"),
        rows.alias("row_changes"),
        gtids.alias("shard_gtids"),
    )
    no_rows = F.lit(None).cast("array<struct<before: array<binary>, after: array<binary>>>")
    no_gtids = F.lit(None).cast(
        "array<struct<keyspace: string, shard: string, gtid: string, "
        f"table_pks: array<struct<table: string, last_pk: {LAST_PK}>>>>"
    )
    pair = F.array(F.struct(wire("before").alias("before"), wire("after").alias("after")))
    positions = F.array(gtid).cast(
        "array<struct<keyspace: string, shard: string, gtid: string, "
        f"table_pks: array<struct<table: string, last_pk: {LAST_PK}>>>>"
    )
    changes = order_changes(spark, sf_dir).select(
        "keyspace",
        "shard",
        F.col("seq").alias("resp_id"),
        F.explode(F.array(event(0, "ROW", pair, no_gtids), event(1, "VGTID", no_rows, positions))).alias("e"),
    )
    nothing = {
        "fields": F.lit(None).cast("array<string>"),
        "last_pk": F.lit(None).cast(LAST_PK),
        "completed": F.lit(None).cast("boolean"),
    }
    stream = changes.select("keyspace", "shard", "resp_id", "e.*").withColumns(
        {"table": F.lit("shop.orders"), **nothing}
    )
    layouts = stream.limit(0).unionByName(
        spark.range(1).select(
            F.lit("shop").alias("keyspace"),
            F.explode(F.array(F.lit("-80"), F.lit("80-"))).alias("shard"),
            F.lit(0).cast("bigint").alias("resp_id"),
            F.lit(-1).alias("event_idx"),
            F.lit("FIELD").alias("event_type"),
            F.lit("shop.orders").alias("table"),
            F.array(*[F.lit(c) for c in ORDERS_COLUMNS]).alias("fields"),
        ),
        allowMissingColumns=True,
    )
    return stream.unionByName(layouts)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_mktsegment"]
CUSTOMER_TYPES = ("bigint", "varchar(40)", "varchar(20)")
#: Responses at which customers change and go, behind those at which they come.
CUSTOMER_MOVES, CUSTOMER_GOES = 1 << 33, 1 << 34


def raw_shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_order_log`` with a second table in the same shards: customers come, every third moves, every fifth goes.

    Their layout puts the name first before they move, and the key first from then on.
    """
    k = F.col("c_custkey")
    bytes_of = lambda name, value: value.cast("string").cast("binary").alias(name)
    wire = lambda order, **new: F.array(*[bytes_of(c, new.get(c, F.col(c))) for c in order])
    old_order, moved = ["c_name", "c_custkey", "c_mktsegment"], F.lit("MOVED")
    none = F.lit(None).cast("array<binary>")
    now = F.when(k % 3 == 0, wire(CUSTOMER_COLUMNS, c_mktsegment=moved)).otherwise(wire(CUSTOMER_COLUMNS))
    change = lambda at, before, after: F.struct(
        (k + at).alias("resp_id"), F.array(F.struct(before.alias("before"), after.alias("after"))).alias("row_changes")
    )
    changes = F.array_compact(
        F.array(
            change(0, none, wire(old_order)),
            F.when(k % 3 == 0, change(CUSTOMER_MOVES, wire(CUSTOMER_COLUMNS), now)),
            F.when(k % 5 == 0, change(CUSTOMER_GOES, now, none)),
        )
    )
    rows = read(spark, sf_dir, "customer").select(
        F.lit("shop").alias("keyspace"), shard_of("c_custkey").alias("shard"), F.explode(changes).alias("c")
    ).select("keyspace", "shard", "c.*", F.lit(10).alias("event_idx"), F.lit("ROW").alias("event_type"), F.lit("customer").alias("table"))
    lists = F.array(
        F.struct(F.lit(0).cast("bigint").alias("resp_id"), F.array(*map(F.lit, old_order)).alias("fields")),
        F.struct(F.lit(CUSTOMER_MOVES).alias("resp_id"), F.array(*map(F.lit, CUSTOMER_COLUMNS)).alias("fields")),
    )
    fields = spark.range(1).select(
        F.lit("shop").alias("keyspace"), F.explode(F.array(F.lit("-80"), F.lit("80-"))).alias("shard"), lists.alias("l")
    ).select("keyspace", "shard", F.inline("l")).withColumns(
        {"event_idx": F.lit(-1), "event_type": F.lit("FIELD"), "table": F.lit("customer")}
    )
    return raw_order_log(spark, sf_dir).unionByName(rows, allowMissingColumns=True).unionByName(fields, allowMissingColumns=True)
