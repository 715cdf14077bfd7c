"""The stream gives what the batch gives, wherever it stops."""

from pyspark.sql import functions as F

from rowtide.operators import apply, shape, sinks
from rowtide.plans import derive as d
from rowtide.streaming import tail

SF = "/root/testdata/sf0.001"
PK, COLUMNS = d.ORDERS_PK, d.ORDERS_COLUMNS


def table_of(records):
    return {tuple(r) for r in apply.current_state(records, PK, COLUMNS).collect()}


def test_stream_equals_batch_at_every_stop(spark, tmp_path):
    changes = d.order_changes(spark, SF)
    root, log = str(tmp_path / "out"), tmp_path / "log"
    steps = [0, d.UPDATE_AT, d.NULL_AT, d.DELETE_AT, d.REINSERT_AT, 10 * d.REINSERT_AT]
    applied = str(tmp_path / "table")

    def fold(records, _):
        sinks.apply_records(records, applied, PK, COLUMNS, buckets=4)

    for low, high in zip(steps, steps[1:]):
        part = changes.filter((F.col("seq") >= low) & (F.col("seq") < high))
        part.coalesce(2).write.mode("append").parquet(str(log))
        ran = tail.tail_log(spark, str(log), changes.schema, root, PK, files_per_batch=1, on_batch=fold)
        assert ran >= 1
        want = table_of(shape.shape_changes(changes.filter(F.col("seq") < high), PK))
        assert table_of(tail.streamed_records(spark, root)) == want
        assert {tuple(r) for r in sinks.read_table(spark, applied, PK, COLUMNS).collect()} == want
        latest = tail.streamed_cursors(spark, root).agg(F.max("seq")).first()[0]
        assert latest == part.agg(F.max("seq")).first()[0]
        # Nothing new: no batch, no records.
        before = tail.streamed_records(spark, root).count()
        assert tail.tail_log(spark, str(log), changes.schema, root, PK, on_batch=fold) == 0
        assert tail.streamed_records(spark, root).count() == before


def test_repeated_batch_is_written_once(spark, tmp_path):
    changes = d.order_changes(spark, SF)
    root, log = str(tmp_path / "out"), str(tmp_path / "log")
    changes.coalesce(1).write.parquet(log)
    failing = {"left": 1}

    def break_once(records, _):
        if failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            tail.tail_log(spark, log, changes.schema, root, PK, on_batch=break_once)
        except Exception as e:
            assert "lost" in str(e)
    records = tail.streamed_records(spark, root)
    assert records.count() == shape.shape_changes(changes, PK).count()
    assert table_of(records) == table_of(shape.shape_changes(changes, PK))
