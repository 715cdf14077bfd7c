"""Source catalog as DataFrames.

A catalog row is one column: ``keyspace, table, ordinal, column, column_type,
column_key``. It comes from Parquet or, over JDBC, from the source itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions import types as T

# Names of the source's own maintenance tables, matched anywhere.
INTERNAL_TABLES = (
    r"_[0-9a-zA-Z]{8}_[0-9a-zA-Z]{4}_[0-9a-zA-Z]{4}_.*|_vt_.*",
    r"\b_(\w+|\d+)_\d+_vrepl\b",
)

CATALOG_SQL = (
    "(select table_schema as `keyspace`, table_name as `table`, ordinal_position as `ordinal`, "
    "column_name as `column`, column_type as `column_type`, column_key as `column_key` "
    "from information_schema.columns) as c"
)


def jdbc_catalog(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """The live catalog; credentials, driver and routing are JDBC options."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=CATALOG_SQL, **options).load()
    )


def list_keyspaces(names: DataFrame, database: str) -> DataFrame:
    """Names that contain ``database`` anywhere, without a leading ``database/``."""
    prefix = database + "/"
    name = F.col("name")
    return names.filter(name.contains(database)).select(
        F.when(name.startswith(prefix), F.substr(name, F.lit(len(prefix) + 1)))
        .otherwise(name)
        .alias("keyspace")
    )


def list_shards(names: DataFrame, keyspace: str) -> DataFrame:
    """Shards of exactly ``keyspace`` from ``keyspace/shard`` names."""
    parts = F.split("name", "/", 2)
    return names.filter((F.size(parts) == 2) & (parts[0] == keyspace)).select(
        parts[1].alias("shard")
    )


def list_tables(catalog: DataFrame, keyspace: str) -> DataFrame:
    """S3."""
    return catalog.filter(F.col("keyspace") == keyspace).select("table").distinct()


def is_internal(name: Column) -> Column:
    return name.rlike(INTERNAL_TABLES[0]) | name.rlike(INTERNAL_TABLES[1])


def drop_internal_tables(catalog: DataFrame) -> DataFrame:
    """P5."""
    return catalog.filter(~is_internal(F.col("table")))


def describe_columns(
    catalog: DataFrame, tinyint1_as_bool: bool = True, compat: bool = False
) -> DataFrame:
    """S4 with T1-T5: every column with its key flag, logical and Spark type, labels."""
    precision, scale = T.decimal_params(F.col("column_type"))
    return (
        catalog.withColumns(
            {
                "is_pk": F.upper("column_key") == "PRI",
                "logical_type": T.map_type(F.col("column_type"), tinyint1_as_bool, compat),
                "label_kind": T.label_kind(F.col("column_type")),
                "labels": T.parse_labels(F.col("column_type")),
            }
        )
        .withColumns(
            {
                n: F.when(F.col("logical_type") == T.DECIMAL, v)
                for n, v in (("precision", precision), ("scale", scale))
            }
        )
        .withColumn(
            "spark_type", T.spark_ddl(F.col("logical_type"), F.col("precision"), F.col("scale"))
        )
    )


def build_schema(
    catalog: DataFrame,
    tinyint1_as_bool: bool = True,
    compat: bool = False,
    with_labels: bool = False,
) -> DataFrame:
    """One row per table with its columns in catalog order.

    A group is one table, so its size is the source's column limit per table.
    ``with_labels`` adds the enum and set labels an update needs (S6).
    """
    fields = ["ordinal", "column", "logical_type", "is_pk", "precision", "scale", "spark_type"]
    if with_labels:
        fields += ["label_kind", "labels"]
    described = describe_columns(drop_internal_tables(catalog), tinyint1_as_bool, compat)
    return described.groupBy("keyspace", "table").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("columns")
    )


def check_shards(configured: str, shards: DataFrame) -> DataFrame:
    """The shards named in a comma list; one that does not exist is an error.

    Names are trimmed once, for the check and for use (A7). An empty list keeps all.
    """
    named = [s.strip() for s in configured.split(",") if s.strip()]
    if not named:
        return shards
    wanted = shards.sparkSession.createDataFrame([(s,) for s in named], "shard string")
    unknown = wanted.join(shards, "shard", "left_anti").limit(1).collect()
    if unknown:
        raise ValueError(f"no such shard: {unknown[0].shard}")
    return shards.join(wanted, "shard", "left_semi")


def schema_diff(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Per table, what changed and whether it can be migrated.

    An added or dropped column is migrated. Another order of the surviving
    columns, another primary key, or other enum or set labels need a new copy.
    """
    keys = ["keyspace", "table", "column"]
    described = {
        side: describe_columns(frame).select(
            *keys,
            F.col("ordinal").alias(f"{side}_ordinal"),
            F.coalesce("is_pk", F.lit(False)).alias(f"{side}_pk"),
            F.when(F.col("label_kind").isNotNull(), F.col("column_type")).alias(f"{side}_labels"),
        )
        for side, frame in (("old", older), ("new", newer))
    }
    both = described["old"].join(described["new"], keys, "full_outer")
    in_old, in_new = F.col("old_ordinal").isNotNull(), F.col("new_ordinal").isNotNull()
    stays = in_old & in_new
    # Surviving columns keep their order iff sorting by either ordinal gives one sequence.
    by = lambda o: F.array_sort(F.collect_list(F.when(stays, F.struct(o, "column"))))
    names = lambda pairs: F.transform(F.col(pairs), lambda p: p["column"])
    tables = both.groupBy("keyspace", "table").agg(
        F.count_if(in_new & ~in_old).alias("added"),
        F.count_if(in_old & ~in_new).alias("dropped"),
        F.bool_or(
            F.coalesce(F.col("old_pk"), F.lit(False)) != F.coalesce(F.col("new_pk"), F.lit(False))
        ).alias("pk_changed"),
        F.bool_or(stays & ~F.col("old_labels").eqNullSafe(F.col("new_labels"))).alias(
            "labels_changed"
        ),
        by("old_ordinal").alias("__old"),
        by("new_ordinal").alias("__new"),
    )
    reordered = names("__old") != names("__new")
    recopy = reordered | F.col("pk_changed") | F.col("labels_changed")
    return tables.select(
        "keyspace",
        "table",
        "added",
        "dropped",
        reordered.alias("reordered"),
        "pk_changed",
        "labels_changed",
        F.when(recopy, F.lit("RECOPY"))
        .when((F.col("added") > 0) | (F.col("dropped") > 0), F.lit("MIGRATE"))
        .otherwise(F.lit("NONE"))
        .alias("verdict"),
    )
