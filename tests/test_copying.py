"""Copies by key range: ranges of any key, a copy taken up again, and the log between the ranges."""

import datetime
import decimal
import os

import pytest
from pyspark.sql import functions as F

from rowtide.plans import copying
from rowtide.plans.sync import sync
from tests.test_sync import expected, setting, snapshot_of, started, table, written  # noqa: F401


def test_ranges_of_a_composite_key(spark, tmp_path):
    base = datetime.date(2020, 1, 1)
    rows = [(chr(97 + i % 5) * (i % 3 + 1), decimal.Decimal(i % 7) / 4, base + datetime.timedelta(i), bytes([i % 256]), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "a string, b decimal(9,2), c date, d binary, v int").repartition(4)
    pk = ["a", "b", "c", "d"]
    way = copying.plan_copy(frame, str(tmp_path / "copy"), pk, 6, 3)
    parts = [[r.v for r in way.rows(frame, pk, i).collect()] for i in way.left()]
    assert len(parts) == 6 and sorted(v for p in parts for v in p) == list(range(900))
    assert max(map(len, parts)) < 2 * 900 / 6
    # What is finished is known to whoever opens the copy next, and a closed copy is not opened.
    way.finish(spark, 0)
    way.finish(spark, 4)
    again = copying.open_copy(spark, str(tmp_path / "copy"), 3)
    assert again.ends == way.ends and again.left() == [1, 2, 3, 5]
    assert copying.open_copy(spark, str(tmp_path / "copy"), 4) is None
    way.close(spark)
    assert copying.open_copy(spark, str(tmp_path / "copy"), 3) is None


@pytest.mark.parametrize("n", [0, 1, 2])
def test_fewer_rows_than_ranges(spark, tmp_path, n):
    frame = spark.range(n)
    way = copying.plan_copy(frame, str(tmp_path / "copy"), ["id"], 5, 1)
    assert sorted(r.id for i in way.left() for r in way.rows(frame, ["id"], i).collect()) == list(range(n))
    assert copying.open_copy(spark, str(tmp_path / "copy"), 1).ends == way.ends


def test_bounds_reach_the_files(spark, tmp_path):
    spark.range(1000).select("id", (F.col("id") % 3).alias("k")).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    way = copying.plan_copy(frame, str(tmp_path / "copy"), ["id", "k"], 4, 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = way.rows(frame, ["id", "k"], 1)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan


def test_a_copy_that_died_goes_on(spark, setting, tmp_path):  # noqa: F811
    source, out = started(*range(1, 25)), str(tmp_path / "out")
    asked, dies = [], [True]

    def rows(keyspace, name):
        asked.append(1)
        if dies[0] and len(asked) == 5:
            raise RuntimeError("gone")
        return snapshot_of(spark, source)(keyspace, name)

    events = lambda: source.frame(spark)
    with pytest.raises(RuntimeError, match="gone"):
        sync(events, *setting, out, "1", snapshots=rows, copy_ranges=4)
    text = spark.read.text(f"{out}/state/run=1").first()[0]
    copied = lambda: {f for f in os.listdir(f"{out}/records/shop/items") if f.startswith("run=copy-") and not f.endswith("begin")}
    first = copied()
    assert len(first) == 2
    kept = {f: os.stat(f"{out}/records/shop/items/{f}/_SUCCESS").st_mtime_ns for f in first}
    # Meanwhile rows of copied and of uncopied ranges change.
    source.change(1, None)
    source.change(24, None)
    source.change(2, {**source.rows[2], "qty": 77})
    source.change(23, {**source.rows[23], "kind": "b"})
    source.change(99, {"id": 99, "kind": None, "qty": None, "flag": False})
    dies[0], before = False, len(asked)
    text = sync(events, *setting, out, "2", text, snapshots=rows, copy_ranges=4)
    assert len(asked) - before == 3  # whether it can be copied, and the two ranges that were left
    assert table(spark, out) == expected(source) and len(copied()) == 4
    assert kept == {f: os.stat(f"{out}/records/shop/items/{f}/_SUCCESS").st_mtime_ns for f in first}
    # It is complete: the next sync reads the log alone.
    source.change(3, None)
    sync(events, *setting, out, "3", text, snapshots=rows, copy_ranges=4)
    assert table(spark, out) == expected(source) and len(copied()) == 4
    counts = spark.read.parquet(f"{out}/counts/run=3").collect()
    assert [(r.upserts, r.updates, r.deletes, r.truncates) for r in counts] == [(0, 0, 1, 0)]


def test_the_log_wins_over_rows_read_before_it(spark, setting, tmp_path):  # noqa: F811
    """Between the mark and the read of a range, and between the read and the next mark, every kind of change happens."""
    source, out = started(*range(1, 13)), str(tmp_path / "out")

    def rows(keyspace, name):
        n = len(source.log)
        for key in (2, 5, 8, 11):  # before the read: it has the later value already
            if key in source.rows:
                source.change(key, {**source.rows[key], "qty": n})
        shot = snapshot_of(spark, source)(keyspace, name)
        for key in (1, 6, 12, 9):  # after it: the log alone knows
            if key in source.rows and n % 2:
                source.change(key, None)
            else:
                source.change(key, {"id": key, "kind": "b", "qty": n, "flag": True})
        return shot

    sync(lambda: source.frame(spark), *setting, out, "1", snapshots=rows, copy_ranges=3)
    assert table(spark, out) == expected(source)


def test_a_layout_that_changes_in_a_copy_begins_it_anew(spark, setting, tmp_path):  # noqa: F811
    source, out = started(*range(1, 9)), str(tmp_path / "out")
    asked = []

    def rows(keyspace, name):
        asked.append(1)
        if len(asked) == 4:
            source.fields.insert(1, "extra")
            for shard in ("-80", "80-"):
                source.response(shard, fields=True)
            source.change(1, None)
        return snapshot_of(spark, source)(keyspace, name)

    sync(lambda: source.frame(spark), *setting, out, "1", snapshots=rows, copy_ranges=3)
    assert table(spark, out) == expected(source)
