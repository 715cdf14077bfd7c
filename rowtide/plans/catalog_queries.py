"""Queries of the catalog, selection and type mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions import types as T
from rowtide.operators import shape
from rowtide.plans import derive as d
from rowtide.plans.registry import query
from rowtide.sources import catalog


@query(f"""WITH {d.SHARD_NAMES_SQL}
SELECT CASE WHEN name LIKE 'shop/%' THEN substr(name, 6) ELSE name END AS keyspace
FROM names WHERE contains(name, 'shop')""")
def list_keyspaces(spark, sf_dir):
    """S1."""
    return catalog.list_keyspaces(d.shard_names(spark, sf_dir), "shop")


@query(f"""WITH {d.SHARD_NAMES_SQL}
SELECT substr(name, 6) AS shard FROM names WHERE name LIKE 'shop/%'""")
def list_shards(spark, sf_dir):
    """S2."""
    return catalog.list_shards(d.shard_names(spark, sf_dir), "shop")


@query(f"""WITH {d.PART_CATALOG_SQL} SELECT DISTINCT tbl AS "table" FROM cat WHERE keyspace = 'ks2'""")
def list_tables(spark, sf_dir):
    """S3."""
    return catalog.list_tables(d.part_catalog(spark, sf_dir), "ks2")


@query(f"""WITH {d.PART_CATALOG_SQL} SELECT keyspace, tbl AS "table", col AS "column" FROM cat WHERE NOT internal""")
def drop_internal_tables(spark, sf_dir):
    """P5."""
    return catalog.drop_internal_tables(d.part_catalog(spark, sf_dir)).select(
        "keyspace", "table", "column"
    )


LOGICAL_SQL = """
typed AS (
  SELECT *, CASE WHEN t = 'tinyint(1)' THEN 'BOOLEAN' WHEN t LIKE 'tinyint%' THEN 'INT'
    WHEN t LIKE 'bit%' THEN 'LONG' WHEN t LIKE 'varbinary%' OR t LIKE 'binary%' THEN 'BINARY'
    WHEN t LIKE 'int%' AND t LIKE '%unsigned%' THEN 'LONG'
    WHEN t LIKE 'int%' OR t LIKE 'smallint%' THEN 'INT'
    WHEN t LIKE 'bigint%' AND t LIKE '%unsigned%' THEN 'DECIMAL' WHEN t LIKE 'bigint%' THEN 'LONG'
    WHEN t LIKE 'decimal%' THEN 'DECIMAL' WHEN t LIKE 'double%' OR t LIKE 'float%' THEN 'DOUBLE'
    WHEN t LIKE 'timestamp%' THEN 'UTC_DATETIME' WHEN t LIKE 'time%' THEN 'STRING'
    WHEN t LIKE 'datetime%' THEN 'NAIVE_DATETIME' WHEN t LIKE 'year%' THEN 'INT'
    WHEN t LIKE 'varchar%' OR t LIKE 'text%' OR t LIKE 'enum%' OR t LIKE 'char%' THEN 'STRING'
    WHEN t LIKE 'set%' OR t LIKE 'geom%' OR t LIKE 'multi%' OR t LIKE 'po%' OR t LIKE 'line%' THEN 'JSON'
    WHEN t = 'date' THEN 'NAIVE_DATE' WHEN t = 'json' THEN 'JSON' WHEN t = 'mediumint' THEN 'INT'
    WHEN t LIKE '%blob' THEN 'BINARY' ELSE 'STRING' END AS logical_type
  FROM (SELECT *, lower(column_type) AS t FROM cat)),
params AS (
  SELECT *,
    CASE WHEN t = 'bigint unsigned' THEN 20 WHEN logical_type = 'DECIMAL'
         THEN coalesce(TRY_CAST(nullif(regexp_extract(t, '([0-9]+)', 1), '') AS INTEGER), 10) END AS precision,
    CASE WHEN logical_type = 'DECIMAL'
         THEN coalesce(TRY_CAST(nullif(regexp_extract(t, '[0-9]+,([0-9]+)', 1), '') AS INTEGER), 0) END AS scale
  FROM typed)
"""


@query(f"""WITH {d.PART_CATALOG_SQL}, {LOGICAL_SQL}
SELECT k AS p_partkey, column_type, logical_type FROM typed""")
def map_types(spark, sf_dir):
    """T1."""
    return d.read(spark, sf_dir, "part").select(
        "p_partkey", d.type_text(F.col("p_partkey"), F.col("p_size")).alias("column_type")
    ).withColumn("logical_type", T.map_type(F.col("column_type")))


@query(f"""WITH {d.PART_CATALOG_SQL}, {LOGICAL_SQL}
SELECT k AS p_partkey, precision, scale FROM params WHERE logical_type = 'DECIMAL'""")
def decimal_params(spark, sf_dir):
    """T4."""
    text = d.type_text(F.col("p_partkey"), F.col("p_size"))
    precision, scale = T.decimal_params(text)
    return (
        d.read(spark, sf_dir, "part")
        .filter(T.map_type(text) == T.DECIMAL)
        .select("p_partkey", precision.alias("precision"), scale.alias("scale"))
    )


@query(f"""WITH {d.PART_CATALOG_SQL}
SELECT k AS p_partkey, CASE WHEN column_type LIKE 'enum%' THEN 'enum' ELSE 'set' END AS label_kind,
       array_to_string(list_transform(regexp_extract_all(column_type, '''((?:[^'']|'''')*)''', 1),
         lambda x: replace(x, '''''', '''')), '|') AS labels
FROM cat WHERE column_type LIKE 'enum%' OR column_type LIKE 'set%'""")
def parse_labels(spark, sf_dir):
    """T2, T3."""
    text = d.type_text(F.col("p_partkey"), F.col("p_size"))
    return (
        d.read(spark, sf_dir, "part")
        .select("p_partkey", T.label_kind(text).alias("label_kind"), T.parse_labels(text).alias("l"))
        .filter(F.col("label_kind").isNotNull())
        .select("p_partkey", "label_kind", F.array_join("l", "|").alias("labels"))
    )


@query(f"""WITH {d.PART_CATALOG_SQL}, {LOGICAL_SQL}
SELECT keyspace, tbl AS "table", col AS "column", is_pk, logical_type, precision, scale,
       CASE WHEN logical_type = 'DECIMAL' AND precision <= 38 THEN 'decimal(' || precision || ',' || scale || ')'
            WHEN logical_type IN ('BOOLEAN', 'INT', 'DOUBLE', 'BINARY') THEN lower(logical_type)
            WHEN logical_type = 'LONG' THEN 'bigint' WHEN logical_type = 'NAIVE_DATE' THEN 'date'
            WHEN logical_type = 'NAIVE_DATETIME' THEN 'timestamp_ntz'
            WHEN logical_type = 'UTC_DATETIME' THEN 'timestamp' ELSE 'string' END AS spark_type
FROM params""")
def describe_columns(spark, sf_dir):
    """S4, T1, T4, T5."""
    return catalog.describe_columns(d.part_catalog(spark, sf_dir)).select(
        "keyspace", "table", "column", "is_pk", "logical_type", "precision", "scale", "spark_type"
    )


@query(f"""WITH {d.PART_CATALOG_SQL}, {LOGICAL_SQL}
SELECT keyspace, tbl AS "table", count(*) AS n_columns,
       string_agg(col || ':' || logical_type || CASE WHEN is_pk THEN '*' ELSE '' END, ',' ORDER BY ordinal) AS columns
FROM typed WHERE NOT internal GROUP BY keyspace, tbl""")
def build_schema(spark, sf_dir):
    """S5."""
    text = lambda c: F.concat(
        c["column"], F.lit(":"), c["logical_type"], F.when(c["is_pk"], F.lit("*")).otherwise(F.lit(""))
    )
    return catalog.build_schema(d.part_catalog(spark, sf_dir)).select(
        "keyspace",
        "table",
        F.size("columns").cast("bigint").alias("n_columns"),
        F.array_join(F.transform("columns", text), ",").alias("columns"),
    )


@query(f"""WITH {d.PART_CATALOG_SQL}
SELECT keyspace, tbl AS "table",
       coalesce(string_agg(CASE WHEN column_type LIKE 'enum%' THEN col || ':enum:3'
                                WHEN column_type LIKE 'set%' THEN col || ':set:3' END, ',' ORDER BY ordinal), '') AS labelled
FROM cat WHERE NOT internal GROUP BY keyspace, tbl""")
def build_update_schema(spark, sf_dir):
    """The schema with the labels of its enum and set columns."""
    labelled = F.filter("columns", lambda c: c["label_kind"].isNotNull())
    text = lambda c: F.concat_ws(":", c["column"], c["label_kind"], F.size(c["labels"]).cast("string"))
    return catalog.build_schema(d.part_catalog(spark, sf_dir), with_labels=True).select(
        "keyspace", "table", F.array_join(F.transform(labelled, text), ",").alias("labelled")
    )


@query(f"""WITH {d.PART_CATALOG_SQL},
picked AS (SELECT DISTINCT keyspace, tbl FROM cat WHERE k // 16 % 3 = 1)
SELECT c.keyspace, c.tbl AS "table", c.col AS "column" FROM cat c
WHERE keyspace <> 'ks4' AND EXISTS (SELECT 1 FROM picked p WHERE p.keyspace = c.keyspace AND p.tbl = c.tbl)""")
def select_objects(spark, sf_dir):
    """Included keyspaces, then included tables."""
    cat = d.part_catalog(spark, sf_dir)
    key = F.substr(F.col("column"), F.lit(2)).cast("bigint")
    tables = cat.groupBy("keyspace", "table").agg(
        F.bool_or(F.floor(key / d.COLUMNS_PER_TABLE) % 3 == 1).alias("included")
    )
    keyspaces = tables.groupBy("keyspace").agg((F.col("keyspace") != "ks4").alias("included"))
    kept = shape.select_objects(cat, keyspaces, ["keyspace"])
    return shape.select_objects(kept, tables, ["keyspace", "table"]).select(
        "keyspace", "table", "column"
    )


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def select_columns(spark, sf_dir):
    """Absent and false flags drop a column."""
    flags = {"o_orderstatus": True, "o_orderkey": True, "o_totalprice": False}
    return shape.select_columns(d.read(spark, sf_dir, "orders"), flags)


@query("SELECT o_orderpriority, o_orderkey FROM orders")
def existing_columns(spark, sf_dir):
    """What does not exist is dropped from the request."""
    orders = d.read(spark, sf_dir, "orders")
    return orders.select(
        *shape.existing_columns(["o_orderpriority", "o_removed", "o_orderkey"], orders.columns)
    )


@query("SELECT * FROM nation, region WHERE n_regionkey = r_regionkey")
def star_fallback(spark, sf_dir):
    """A request of blank names reads every column."""
    both = d.read(spark, sf_dir, "nation").join(
        d.read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return both.select(*shape.star_fallback(["", " "], both.columns))


@query("""SELECT o_orderkey, '-80' AS shard FROM orders WHERE o_custkey % 2 = 0""")
def shard_filter(spark, sf_dir):
    """Only the configured shards are read."""
    orders = d.read(spark, sf_dir, "orders").select(
        "o_orderkey", d.shard_of("o_custkey").alias("shard")
    )
    chosen = catalog.check_shards(" -80 ,", orders.select("shard").distinct())
    return orders.join(chosen, "shard", "left_semi").select("o_orderkey", "shard")


# --- layouts over time -------------------------------------------------------------------

def _newer(spark, sf_dir):
    """The part catalog later: columns dropped, added, reordered, keys and labels changed."""
    k = F.substr(F.col("column"), F.lit(2)).cast("bigint")
    t = F.floor(k / d.COLUMNS_PER_TABLE)
    cat = d.part_catalog(spark, sf_dir)
    kept = cat.filter(~((t % 4 == 1) & (k % 16 == 9)))
    changed = kept.withColumns(
        {
            "ordinal": F.when(t % 6 == 5, F.lit(17) - F.col("ordinal")).otherwise(F.col("ordinal")),
            "column_key": F.when((t % 7 == 6) & (k % 16 == 1), F.lit("PRI")).otherwise(
                F.col("column_key")
            ),
            "column_type": F.when(
                (t % 5 == 2) & F.col("column_type").startswith("enum"), F.lit("enum('new')")
            ).otherwise(F.col("column_type")),
        }
    )
    added = cat.filter((t % 4 == 2) & (k % 16 == 0)).withColumns(
        {
            "ordinal": F.lit(17),
            "column": F.concat("column", F.lit("_new")),
            "column_type": F.lit("int"),
            "column_key": F.lit(""),
        }
    )
    return changed.unionByName(added)


@query(f"""WITH {d.PART_CATALOG_SQL},
newer AS (
  SELECT keyspace, tbl, CASE WHEN k // 16 % 6 = 5 THEN 17 - ordinal ELSE ordinal END AS ordinal, col,
         CASE WHEN k // 16 % 5 = 2 AND column_type LIKE 'enum%' THEN 'enum(''new'')' ELSE column_type END AS column_type,
         is_pk OR (k // 16 % 7 = 6 AND k % 16 = 1) AS is_pk
  FROM cat WHERE NOT (k // 16 % 4 = 1 AND k % 16 = 9)
  UNION ALL
  SELECT keyspace, tbl, 17, col || '_new', 'int', FALSE FROM cat WHERE k // 16 % 4 = 2 AND k % 16 = 0),
j AS (
  SELECT coalesce(o.keyspace, n.keyspace) AS keyspace, coalesce(o.tbl, n.tbl) AS tbl,
         o.ordinal AS oo, n.ordinal AS no, coalesce(o.col, n.col) AS col,
         coalesce(o.is_pk, FALSE) <> coalesce(n.is_pk, FALSE) AS pk_diff,
         o.col IS NOT NULL AND n.col IS NOT NULL AND
           CASE WHEN o.column_type LIKE 'enum%' OR o.column_type LIKE 'set%' THEN o.column_type END
             IS DISTINCT FROM
           CASE WHEN n.column_type LIKE 'enum%' OR n.column_type LIKE 'set%' THEN n.column_type END AS label_diff
  FROM cat o FULL OUTER JOIN newer n ON o.keyspace = n.keyspace AND o.tbl = n.tbl AND o.col = n.col),
g AS (
  SELECT keyspace, tbl, count(*) FILTER (WHERE oo IS NULL) AS added, count(*) FILTER (WHERE no IS NULL) AS dropped,
         coalesce(string_agg(col, ',' ORDER BY oo) FILTER (WHERE oo IS NOT NULL AND no IS NOT NULL) <>
           string_agg(col, ',' ORDER BY no) FILTER (WHERE oo IS NOT NULL AND no IS NOT NULL), FALSE) AS reordered,
         bool_or(pk_diff) AS pk_changed, bool_or(label_diff) AS labels_changed
  FROM j GROUP BY keyspace, tbl)
SELECT keyspace, tbl AS "table", added, dropped, reordered, pk_changed, labels_changed,
       CASE WHEN reordered OR pk_changed OR labels_changed THEN 'RECOPY'
            WHEN added > 0 OR dropped > 0 THEN 'MIGRATE' ELSE 'NONE' END AS verdict
FROM g""")
def schema_diff(spark, sf_dir):
    """Migrate or copy anew."""
    return catalog.schema_diff(d.part_catalog(spark, sf_dir), _newer(spark, sf_dir))
