"""Records and tables out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import apply
from rowtide.operators.lineage import settle
from rowtide.operators.shape import DELETE, TRUNCATE, UPDATE, UPSERT


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """K1: records by operation; a reader of one operation skips the others' files."""
    with open_writers(records.sparkSession, len(COUNTS)):
        records.write.mode(mode).partitionBy("op").parquet(path)


@contextmanager
def open_writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Partitioned writes inside keep that many files open at once, so rows of so few partitions aren't sorted first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def emit_truncate(records: DataFrame, seq, **place: str) -> DataFrame:
    """K2: ``records`` with a TRUNCATE at ``seq``: no row, nothing written.

    It empties what is older, so it must be later than all that was applied before: a
    sync gives it the first place of a new generation.
    """
    one = records.sparkSession.range(1)
    truncate = one.select(
        *[F.lit(v).alias(k) for k, v in place.items()],
        apply.literal(seq, records.schema["seq"].dataType).alias("seq"),
        F.lit(TRUNCATE).alias("op"),
        F.array().cast("array<string>").alias("written"),
    )
    return records.unionByName(truncate, allowMissingColumns=True)


#: Operations and the names of their counts.
COUNTS = {UPSERT: "upserts", UPDATE: "updates", DELETE: "deletes", TRUNCATE: "truncates"}


def write_counts(spark: SparkSession, counts: Sequence[tuple], path: str) -> None:
    """K4: records by operation of each table, added up over what one sync wrote of it."""
    names = list(COUNTS.values())
    rows = spark.createDataFrame(list(counts), "keyspace string, table string, " + ", ".join(f"{n} bigint" for n in names))
    added = rows.groupBy("keyspace", "table").agg(*[F.sum(n).alias(n) for n in names])
    added.coalesce(1).write.mode("overwrite").parquet(path)


def sync_report(records: DataFrame) -> DataFrame:
    """K4: counts by operation and the range of ``seq`` per keyspace, table and shard."""
    count = lambda op: F.count_if(F.col("op") == op)
    return records.groupBy("keyspace", "table", "shard").agg(
        count(UPSERT).alias("upserts"),
        count(UPDATE).alias("updates"),
        count(DELETE).alias("deletes"),
        count(TRUNCATE).alias("truncates"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


def sync_outcome(before: DataFrame, after: DataFrame) -> DataFrame:
    """K4: where each cursor began and stands, and what became of it.

    An error keeps its code here (A16); RESET is a cursor put back to the start,
    PROGRESS one that moved, CURRENT one that had nothing to read.
    """
    key = ["keyspace", "table", "shard"]
    old = before.select(
        *key, F.col("position").alias("start_position"), F.col("last_pk").alias("__pk")
    )
    error = F.col("error_code") if "error_code" in after.columns else F.lit(None).cast("string")
    start, stop = (F.coalesce(c, F.lit("")) for c in ("start_position", "position"))
    moved = (start != stop) | ~F.col("last_pk").eqNullSafe(F.col("__pk"))
    return after.join(old, key, "left").select(
        *key,
        start.alias("start_position"),
        stop.alias("stop_position"),
        F.when(error.isNotNull(), error)
        .when((start != "") & (stop == ""), F.lit("RESET"))
        .when(moved, F.lit("PROGRESS"))
        .otherwise(F.lit("CURRENT"))
        .alias("outcome"),
    )


def copy_order(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The tables by row count, small ones first; an empty table counts 0."""
    counts = None
    for name, frame in tables.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return counts.select("table", "row_count").orderBy("row_count", "table")


def write_schema_changes(spark: SparkSession, dropped: Mapping[str, tuple], kind: str, path: str) -> None:
    """The columns that a run found dropped, with their places."""
    rows = [(c, s) for c, s in sorted(dropped.items())]
    spark.createDataFrame(rows, f"column string, seq {kind}").coalesce(1).write.mode("overwrite").parquet(path)


def dropped_places(spark: SparkSession, path: str) -> dict[str, tuple]:
    """The latest place of each column that any run under ``path`` found dropped; as many entries as columns."""
    found = read_if_there(spark, path)
    if found is None:
        return {}
    return {r["column"]: tuple(r["seq"]) for r in found.groupBy("column").agg(F.max("seq").alias("seq")).collect()}


def write_table(table: DataFrame, path: str) -> None:
    """A table without rows, or with columns that are all null, is still written."""
    table.write.mode("overwrite").parquet(path)


# --- the applied table ---------------------------------------------------------
#
# root/data/version=V/bucket=B   state rows of the keys hashed to B, as of run V
# root/manifest/version=V        after run V: the version of each bucket, the last TRUNCATE,
#                                the place at which each dropped column went
#
# The highest manifest counts. Data is written first, the manifest last and in one
# file: a run that dies in between leaves no trace, and running it again gives the
# same rows. Only the buckets that a run's keys fall into are read and rewritten.

#: Rows of the state that a task merges.
TASK_ROWS = 200_000


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """What is at a path, or null if nothing is."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _current(spark: SparkSession, root: str) -> tuple[dict[int, int], int, int | tuple | None, dict[str, int | tuple]]:
    """(bucket -> version, last version, last truncate seq, dropped column -> seq); as many entries as buckets."""
    versions = read_if_there(spark, f"{root}/manifest")
    if versions is None:
        return {}, 0, None, {}
    last = versions.agg(F.max("version")).first()[0]
    rows = spark.read.parquet(f"{root}/manifest/version={last}").collect()
    dropped = rows[0]["dropped"] if "dropped" in rows[0] else None
    return (
        {r.bucket: r.bucket_version for r in rows if r.bucket is not None},
        last,
        rows[0].truncate_seq,
        {d["column"]: d["seq"] for d in dropped or []},
    )


def _write_manifest(spark, root: str, version: int, where: dict[int, int], truncate_seq, dropped: dict, kind: str) -> None:
    gone = [(c, s) for c, s in sorted(dropped.items())]
    entries = [(b, v, truncate_seq, gone) for b, v in where.items()] or [(None, None, truncate_seq, gone)]
    schema = f"bucket int, bucket_version int, truncate_seq {kind}, dropped array<struct<column: string, seq: {kind}>>"
    spark.createDataFrame(entries, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")


def _latest_drops(older: Mapping, newer: Mapping | None) -> dict:
    """The later place of each dropped column."""
    out = dict(older)
    for column, seq in (newer or {}).items():
        out[column] = max(out.get(column, seq), seq)
    return out


def drop_columns(spark: SparkSession, root: str, dropped: Mapping[str, int | tuple]) -> int:
    """What was written to these columns up to their places becomes null; returns the new version.

    Only a manifest is written, no bucket: a reader applies the places to all of them alike.
    """
    where, last, truncated, before = _current(spark, root)
    kind = spark.read.parquet(f"{root}/manifest/version={last}").schema["truncate_seq"].dataType.simpleString()
    _write_manifest(spark, root, last + 1, where, truncated, _latest_drops(before, dropped), kind)
    return last + 1


def _bucket(pk: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*pk), F.lit(buckets)).cast("int")


def apply_records(
    records: DataFrame,
    root: str,
    pk: Sequence[str],
    columns: Sequence[str],
    buckets: int,
    dropped: Mapping[str, int | tuple] | None = None,
) -> int:
    """K5: fold records into the table at ``root``; returns the new version.

    ``buckets`` is fixed for a table: what a run rewrites is whole buckets. One may be larger
    than a task can hold; it is merged in pieces of about ``TASK_ROWS`` keys.
    Deleted keys keep a tombstone, so an older record that comes late changes
    nothing. ``columns`` are those that the records may carry; columns of earlier runs stay
    as they are, in every bucket, until they are named in ``dropped`` with the place at which
    they went (D6).
    """
    spark = records.sparkSession
    pk = list(pk)
    values = [c for c in columns if c not in pk]
    where, last, truncated, gone = _current(spark, root)
    version = last + 1

    # The keys of the records are worked out once; the look for a TRUNCATE decodes no rows.
    delta = settle(
        apply.fold_records(records, pk, columns).withColumn("bucket", _bucket(pk, buckets))
    )
    # At most ``buckets`` numbers.
    touched = sorted(r.bucket for r in delta.select("bucket").distinct().collect())
    emptied = apply.last_truncate(records).first().truncate_seq
    if not touched and emptied is None and not dropped:
        return last

    if touched:
        both = delta
        old = [f"{root}/data/version={where[b]}/bucket={b}" for b in touched if b in where]
        if old:
            before = spark.read.option("mergeSchema", True).parquet(*old)
            # Columns that came since are null in older rows; those that are no longer listed stay.
            both = both.unionByName(
                before.withColumn("bucket", _bucket(pk, buckets)), allowMissingColumns=True
            )
            values += [c[2:] for c in before.columns if c.startswith("v_") and c[2:] not in values]
        # Each side has one row per key, so a bucket is as even as the hash, and large ones are
        # merged in pieces. Both are a subset of the grouping, so the merge needs no further shuffle.
        pieces = -(-both.count() // (len(touched) * TASK_ROWS)) or 1
        piece = F.pmod(F.xxhash64(F.lit("piece"), *pk), F.lit(pieces)).cast("int")
        dealt = both.withColumn("piece", piece).repartition(len(touched) * pieces, "bucket", "piece")
        merged = apply.merge_state_rows(dealt, ["bucket", "piece", *pk], values).drop("piece")
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/version={version}")

    where.update(dict.fromkeys(touched, version))
    seen = [t for t in (truncated, emptied) if t is not None]
    truncate_seq = max(seen, default=None)
    kind = records.schema["seq"].dataType.simpleString()
    _write_manifest(spark, root, version, where, truncate_seq, _latest_drops(gone, dropped), kind)
    return version


def read_table(
    spark: SparkSession, root: str, pk: Sequence[str], columns: Sequence[str]
) -> DataFrame | None:
    """The living rows of an applied table, or null if nothing was applied yet."""
    where, _, truncated, gone = _current(spark, root)
    if not where:
        return None
    paths = [f"{root}/data/version={v}/bucket={b}" for b, v in sorted(where.items())]
    state = spark.read.option("mergeSchema", True).parquet(*paths)
    return apply.rows_of_state(state, list(pk), columns, truncated, gone)
