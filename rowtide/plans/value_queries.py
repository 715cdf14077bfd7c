"""Queries of the value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions import convert as v
from rowtide.functions import types as T
from rowtide.functions.geometry import geometry_to_geojson as to_geojson
from rowtide.operators import shape
from rowtide.plans import derive as d
from rowtide.plans.registry import query
from rowtide.sources import catalog


def _raw(text: Column) -> Column:
    """A value as the bytes of the wire."""
    return text.cast("string").cast("binary")


@query("""SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS as_int, o_orderkey * 1000000007 AS as_long,
       o_orderkey % 2 = 1 AS as_bool, o_totalprice AS as_double,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS as_decimal,
       CAST(o_totalprice AS FLOAT) AS as_float,
       CAST(o_orderdate AS DATE) AS as_date, o_orderdate AS as_datetime,
       CAST(o_orderkey % 100 AS SMALLINT) AS as_short, o_orderpriority AS as_string,
       hex(encode(o_orderstatus)) AS as_binary,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey END AS as_null
FROM orders""")
def convert_scalars(spark, sf_dir):
    """Columns to wire bytes and back."""
    k, price, date = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    day = F.date_format(date, "yyyy-MM-dd")
    return d.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        v.to_int(_raw(F.col("o_custkey"))).alias("as_int"),
        v.to_long(_raw(k * 1000000007)).alias("as_long"),
        v.to_boolean(_raw(k % 2)).alias("as_bool"),
        v.to_double(_raw(price)).alias("as_double"),
        v.to_decimal(_raw(price.cast("decimal(12,2)")), 12, 2).cast("string").alias("as_decimal"),
        v.to_float(_raw(price)).alias("as_float"),
        v.to_date(_raw(day), strict=True).alias("as_date"),
        v.to_timestamp_ntz(_raw(F.concat(day, F.lit(" 00:00:00"))), strict=True).alias("as_datetime"),
        v.to_short(_raw(k % 100)).alias("as_short"),
        v.to_string(_raw(F.col("o_orderpriority"))).alias("as_string"),
        F.hex(v.to_binary(_raw(F.col("o_orderstatus")))).alias("as_binary"),
        v.to_long(F.when(k % 4 != 0, _raw(k))).alias("as_null"),
    )


@query("SELECT event_id, epoch_us(ts) AS utc_micros, ts AS as_datetime FROM events")
def convert_times(spark, sf_dir):
    """Microseconds are kept, UTC is independent of the session's zone."""
    text = _raw(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return d.read(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(v.to_timestamp_utc(text)).alias("utc_micros"),
        v.to_timestamp_ntz(text).alias("as_datetime"),
    )


@query("""WITH o AS (SELECT o_orderkey, o_orderdate, o_orderkey % 5 IN (3, 4) AS good FROM orders)
SELECT o_orderkey, CASE WHEN good THEN CAST(o_orderdate AS DATE) END AS plain_date,
       CASE WHEN good THEN CAST(o_orderdate AS DATE) ELSE DATE '1970-01-01' END AS key_date,
       CASE WHEN good THEN o_orderdate END AS plain_time,
       CASE WHEN good THEN o_orderdate ELSE TIMESTAMP '1970-01-01 00:00:00' END AS key_time,
       CASE WHEN good THEN epoch_us(o_orderdate) END AS plain_utc,
       CASE WHEN good THEN epoch_us(o_orderdate) ELSE 0 END AS key_utc
FROM o""")
def unparsable_default(spark, sf_dir):
    """Bad dates and times give null, or the epoch in a primary key."""
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    bad = F.when(k % 5 == 0, F.lit("0000-00-00")).when(k % 5 == 1, F.lit("2004-13-45")).when(
        k % 5 == 2, F.lit("2004-12")
    )
    date = _raw(F.coalesce(bad, day))
    time = _raw(F.coalesce(bad, F.concat(day, F.lit(" 00:00:00"))))
    return d.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        v.to_date(date).alias("plain_date"),
        v.to_date(date, is_pk=True).alias("key_date"),
        v.to_timestamp_ntz(time).alias("plain_time"),
        v.to_timestamp_ntz(time, is_pk=True).alias("key_time"),
        F.unix_micros(v.to_timestamp_utc(time)).alias("plain_utc"),
        F.unix_micros(v.to_timestamp_utc(time, is_pk=True)).alias("key_utc"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_orderkey AS wide, CAST(l_linenumber AS BIGINT) AS narrow,
       CAST(9223372036854775807 AS BIGINT) - l_partkey AS widest FROM lineitem""")
def bits_to_long(spark, sf_dir):
    """V5: one to eight big-endian bytes."""
    return d.read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        v.bits_to_long(F.unhex(F.lpad(F.hex("l_orderkey"), 10, "0"))).alias("wide"),
        v.bits_to_long(F.unhex(F.lpad(F.hex("l_linenumber"), 2, "0"))).alias("narrow"),
        v.bits_to_long(
            F.unhex(F.lpad(F.hex(F.lit(2**63 - 1) - F.col("l_partkey")), 16, "0"))
        ).alias("widest"),
    )


@query("SELECT doc_id, text AS cleaned FROM documents")
def clean_utf8(spark, sf_dir):
    """Whole texts, in Latin-1 where that loses nothing, else in UTF-8."""
    text = F.col("text")
    latin = F.when(text.rlike(r"^[\x00-\xff]*$"), F.encode(text, "ISO-8859-1")).otherwise(
        text.cast("binary")
    )
    return d.read(spark, sf_dir, "documents").select("doc_id", v.clean_utf8(latin).alias("cleaned"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN props END AS json FROM events")
def json_values(spark, sf_dir):
    """Empty text is null."""
    props = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props"))
    return d.read(spark, sf_dir, "events").select("event_id", v.to_json(_raw(props)).alias("json"))


# The labels that the order priorities and the set masks stand for.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RIGHTS = ["read", "write", "delete", "admin", "owner"]


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '99' ELSE
  CASE CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
    WHEN 1 THEN '1-URGENT' WHEN 2 THEN '2-HIGH' WHEN 3 THEN '3-MEDIUM' WHEN 4 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END
  END AS priority FROM orders""")
def enum_labels(spark, sf_dir):
    """Zero, an unknown index, an index, the label itself."""
    k, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    index = F.substr(priority, F.lit(1), F.lit(1))
    wire = (
        F.when(k % 4 == 0, F.lit("0"))
        .when(k % 4 == 1, F.lit("99"))
        .when(k % 4 == 2, index)
        .otherwise(F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), index.cast("int")))
    )
    labels = F.array(*[F.lit(p) for p in PRIORITIES])
    return d.read(spark, sf_dir, "orders").select(
        "o_orderkey", v.enum_label(_raw(wire), labels).alias("priority")
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'read,admin' ELSE concat_ws(',',
  CASE WHEN o_orderkey % 32 & 1 > 0 THEN 'read' END, CASE WHEN o_orderkey % 32 & 2 > 0 THEN 'write' END,
  CASE WHEN o_orderkey % 32 & 4 > 0 THEN 'delete' END, CASE WHEN o_orderkey % 32 & 8 > 0 THEN 'admin' END,
  CASE WHEN o_orderkey % 32 & 16 > 0 THEN 'owner' END) END AS rights FROM orders""")
def set_labels(spark, sf_dir):
    """Masks and plain text."""
    k = F.col("o_orderkey")
    wire = F.when(k % 7 == 0, F.lit("read,admin")).otherwise((k % 32).cast("string"))
    return d.read(spark, sf_dir, "orders").select(
        "o_orderkey", v.set_labels(_raw(wire), RIGHTS).alias("rights")
    )


# --- geometry -------------------------------------------------------------------------------

def _half_hex(n: Column) -> Column:
    """The big-endian bytes, in hex, of n/2 as a double; n is a whole number below 2^52."""
    top = F.length(F.bin(n)) - 1
    fraction = F.call_function("shiftleft", n - F.call_function("shiftleft", F.lit(1).cast("bigint"), top), 52 - top)
    bits = F.call_function("shiftleft", (top + 1022).cast("bigint"), F.lit(52)) + fraction
    return F.when(n == 0, F.lit("0" * 16)).otherwise(F.lpad(F.hex(bits), 16, "0"))


def _shape(code: int, *parts: Column) -> Column:
    return F.concat(F.lit(f"00{code:08x}"), *parts)


def _count(n: int) -> Column:
    return F.lit(f"{n:08x}")


NUMBER_SQL = "CAST({0} // 2 AS VARCHAR) || CASE WHEN {0} % 2 = 1 THEN '.5' ELSE '' END"
X_SQL, Y_SQL = NUMBER_SQL.format("l_partkey"), NUMBER_SQL.format("l_suppkey")


@query(f"""WITH p AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber % 4 AS kind,
         '[' || {X_SQL} || ',' || {Y_SQL} || ']' AS a, '[' || {Y_SQL} || ',' || {X_SQL} || ']' AS b
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, CASE kind
  WHEN 0 THEN '{{"type":"Point","coordinates":' || a || '}}'
  WHEN 1 THEN '{{"type":"LineString","coordinates":[' || a || ',' || b || ']}}'
  WHEN 2 THEN '{{"type":"Polygon","coordinates":[[' || a || ',' || b || ',[0,0],' || a || ']]}}'
  ELSE '{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":' || b
    || '}},{{"type":"MultiPoint","coordinates":[' || a || ',' || b || ']}}]}}' END AS geojson
FROM p""")
def geometry_to_geojson(spark, sf_dir):
    """Shapes built from the line items, as the source stores them."""
    x, y = _half_hex(F.col("l_partkey")), _half_hex(F.col("l_suppkey"))
    a, b, zero = F.concat(x, y), F.concat(y, x), F.lit("0" * 32)
    kind = F.col("l_linenumber") % 4
    wkb = (
        F.when(kind == 0, _shape(1, a))
        .when(kind == 1, _shape(2, _count(2), a, b))
        .when(kind == 2, _shape(3, _count(1), _count(4), a, b, zero, a))
        .otherwise(
            _shape(
                7, _count(2), _shape(1, b), _shape(4, _count(2), _shape(1, a), _shape(1, b))
            )
        )
    )
    stored = F.unhex(F.concat(F.lit("0" * 8), wkb))
    return d.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", to_geojson(stored).alias("geojson")
    )


# --- a whole table ----------------------------------------------------------------------------

# The orders table as the source would describe it.
ORDERS_CATALOG = [
    ("o_orderkey", "bigint", "PRI"),
    ("o_custkey", "int unsigned", ""),
    ("o_orderstatus", "enum('F','O','P')", ""),
    ("o_totalprice", "decimal(12,2)", ""),
    ("o_orderdate", "datetime", ""),
    ("o_orderpriority", "varchar(20)", ""),
]


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice,
       CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS o_orderdate FROM orders""")
def typed_rows(spark, sf_dir):
    """A raw image per row through the converters its catalog asks for."""
    columns = [
        ("shop", "orders", i + 1, name, kind, key) for i, (name, kind, key) in enumerate(ORDERS_CATALOG)
    ]
    described = catalog.describe_columns(
        spark.createDataFrame(
            columns,
            "keyspace string, table string, ordinal int, column string, column_type string, column_key string",
        )
    )
    rows = [r.asDict() for r in described.collect()]
    selected = [c for c, _, _ in ORDERS_CATALOG if c != "o_orderpriority"]
    writers, _ = shape.plan_writers(rows, selected)
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    index = F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), status)
    time = F.when(k % 9 == 0, F.lit("0000-00-00 00:00:00")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    wire = d.read(spark, sf_dir, "orders").select(
        _raw(k).alias("o_orderkey"),
        _raw(F.col("o_custkey")).alias("o_custkey"),
        # Half the rows as a copy gives them, half as the change log does.
        _raw(F.when(k % 2 == 0, status).otherwise(index.cast("string"))).alias("o_orderstatus"),
        _raw(F.col("o_totalprice").cast("decimal(12,2)")).alias("o_totalprice"),
        _raw(time).alias("o_orderdate"),
    )
    typed = wire.select(*[write(F.col(c)).alias(c) for c, write in writers.items()])
    return typed.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
