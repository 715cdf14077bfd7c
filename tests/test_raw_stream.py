"""The raw log as a stream gives what the batch gives, wherever it stops."""

import pytest
from pyspark.sql import functions as F

from rowtide.operators import cursor
from rowtide.plans import derive as d
from rowtide.streaming import raw

SF = "/root/testdata/sf0.001"


def rows_of(frame, *columns):
    return sorted(map(str, frame.select(*columns).collect()))


def test_cursors_fold_over_any_cut(spark):
    """Batches may end inside a response; what is delivered again changes nothing."""
    events = d.stream_events(spark, SF).cache()
    top = events.agg(F.max("seq")).first()[0]
    cuts = [0, top // 7, top // 3, top // 2 + 3, top + 1]
    shards, keys = (spark.createDataFrame([], raw.STATE[n]) for n in ("shards", "keys"))
    for low, high in zip(cuts, cuts[1:]):
        part = events.filter((F.col("seq") >= low - 40) & (F.col("seq") < high))
        shards, keys = raw.next_shards(shards, part), raw.next_keys(keys, part)
        shards = spark.createDataFrame(shards.collect(), raw.STATE["shards"])
        keys = spark.createDataFrame(keys.collect(), raw.STATE["keys"])
    for table in ("orders", "users"):
        timeline = cursor.cursor_timeline(events, table)
        want = timeline.groupBy("keyspace", "shard").agg(F.max_by(F.struct("position", "last_pk", F.col("resp_id").alias("seq")), "resp_id").alias("c"))
        got = raw.cursors_of(shards, keys, table)
        names = ["keyspace", "shard", "position", "last_pk", "seq"]
        assert rows_of(got, *names) == rows_of(want.select("keyspace", "shard", "c.*"), *names)


def test_versions_of_layouts(spark):
    names = "keyspace string, shard string, table string, resp_id bigint, event_idx int, fields array<string>, event_type string"
    event = lambda at, *fields: ("k", "-", "t", at, 0, list(fields), "FIELD")
    log = [event(1, "a"), event(2, "a"), event(5, "a", "b"), event(7, "a"), ("k", "-", "u", 9, 0, ["a"], "FIELD")]
    state = spark.createDataFrame([], raw.STATE["layouts"])
    for part in (log[:2], log[1:4], log[2:], log[:1]):
        state = raw.next_layouts(state, spark.createDataFrame(part, names))
    assert [(r.table, r.resp_id, r.fields) for r in state.orderBy("table", "resp_id").collect()] == [
        ("t", 1, ["a"]), ("t", 5, ["a", "b"]), ("t", 7, ["a"]), ("u", 9, ["a"])
    ]


def test_stream_stops_and_goes_on(spark, tmp_path):
    """A restart between a field list and its rows; an idle run; a piece delivered twice; rows without a field list."""
    events = d.raw_shop_log(spark, SF).cache()
    landed, out = str(tmp_path / "log"), str(tmp_path / "out")
    low, high = events.filter("resp_id <= 0"), events.filter("resp_id > 0 AND resp_id < 200")
    low.coalesce(1).write.parquet(landed)
    assert raw.last_batch(spark, out) == -1
    assert raw.tail_raw_log(spark, landed, events.schema, out) == 1
    high.coalesce(1).write.mode("append").parquet(landed)
    assert raw.tail_raw_log(spark, landed, events.schema, out) == 1
    assert raw.tail_raw_log(spark, landed, events.schema, out) == 0
    assert raw.last_batch(spark, out) == 1
    dealt = spark.read.schema(raw._row_schema(events.schema)).parquet(f"{out}/rows")
    per_table = events.filter("resp_id < 200 AND event_type = 'ROW'").groupBy("table").count()
    want = {t.table.split(".")[-1]: t["count"] for t in per_table.collect()}
    assert {r.table: r["count"] for r in dealt.groupBy("table").count().collect()} == want and len(want) == 2
    seen = rows_of(raw.stream_cursors(spark, out, "orders"), "shard", "position", "seq")
    high.coalesce(1).write.mode("append").parquet(landed)
    assert raw.tail_raw_log(spark, landed, events.schema, out) == 1
    assert rows_of(raw.stream_cursors(spark, out, "orders"), "shard", "position", "seq") == seen
    stray = high.filter("event_type = 'ROW'").limit(1).withColumn("table", F.lit("unknown"))
    stray.write.mode("append").parquet(landed)
    with pytest.raises(Exception, match="no field list"):
        raw.tail_raw_log(spark, landed, events.schema, out)
    assert raw.last_batch(spark, out) == 2


def test_scans_do_not_grow_with_tables(spark, tmp_path):
    """One scan of the log deals the rows of all tables; a table's records read its own part only."""
    events = d.raw_shop_log(spark, SF)
    events.write.parquet(str(tmp_path / "log"))
    whole = spark.read.parquet(str(tmp_path / "log"))
    raw.next_layouts(spark.createDataFrame([], raw.STATE["layouts"]), whole).write.parquet(str(tmp_path / "layouts"))
    rows = raw.dealt_rows(whole, spark.read.parquet(str(tmp_path / "layouts")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_changes#") and sum("Relation" in x and "row_changes" in x for x in plan.splitlines()) == 1
