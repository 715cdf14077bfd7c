"""Columns that come and go: in the log, in a sync, in an applied table."""

import os

import pytest
from pyspark.sql import functions as F

from rowtide.operators import apply, shape, sinks
from rowtide.plans.sync import sync
from rowtide.sources import log
from tests.test_sync import CATALOG, Source, setting, snapshot_of, started  # noqa: F401


def fields(spark, *layouts):
    """(shard, resp, names) as FIELD events of one table."""
    rows = [("shop", s, r, 0, "FIELD", "shop.items", list(names)) for s, r, names in layouts]
    return spark.createDataFrame(
        rows, "keyspace string, shard string, resp_id bigint, event_idx int, event_type string, table string, fields array<string>"
    )


@pytest.mark.parametrize(
    "layouts, verdict, dropped",
    [
        ([("a", 1, "ik"), ("a", 5, "ik")], "NONE", {}),
        ([("a", 1, "ik"), ("a", 5, "ikq")], "MIGRATE", {}),
        ([("a", 1, "ixk"), ("a", 5, "ik"), ("b", 1, "ixk"), ("b", 9, "ik")], "MIGRATE", {"x": (9, 0)}),
        ([("a", 1, "ixk"), ("a", 5, "ikq")], "MIGRATE", {"x": (5, 0)}),
        ([("a", 1, "ikx"), ("a", 5, "ixk")], "RECOPY", {"": ()}),  # another order
        ([("a", 1, "k"), ("a", 5, "ik")], "RECOPY", {"": ()}),  # the key came
        ([("a", 1, "ikx"), ("a", 5, "ik"), ("a", 9, "ikx")], "RECOPY", {"": ()}),  # one went and came
        ([("a", 1, "i")], "RECOPY", {"": ()}),  # a selected column that no layout has
    ],
)
def test_verdicts(spark, layouts, verdict, dropped):
    frame = fields(spark, *layouts)
    assert [r.verdict for r in log.migration(frame, ["i", "k"], ["i"]).collect()] == [verdict]
    if verdict == "RECOPY":
        with pytest.raises(log.LayoutChanged, match="full re-copy"):
            log.require_migratable(frame, ["i", "k"], ["i"])
    else:
        assert log.require_migratable(frame, ["i", "k"], ["i"]) == dropped


def test_no_layouts(spark):
    assert log.require_migratable(fields(spark).limit(0), ["i"], ["i"]) == {}


def of(spark, *columns):
    described = {c: (t, k) for _, table, _, c, t, k in CATALOG if table == "items"} | {"extra": ("varchar(9)", "")}
    rows = [("shop", "items", i + 1, c, *described[c]) for i, c in enumerate(columns)]
    catalog = spark.createDataFrame(rows, "keyspace string, table string, ordinal int, column string, column_type string, column_key string")
    return catalog, catalog.select("keyspace", "table", "column", F.lit(True).alias("included"))


class Wider(Source):
    """A source whose rows have another column, too."""

    def image(self, row):
        out = super().image(row)
        return [bytearray(b"new") if f == "extra" and row.get("extra") else v for f, v in zip(self.fields, out)]


def test_a_sync_migrates(spark, setting, tmp_path):  # noqa: F811
    shards, out = setting[2], str(tmp_path / "out")
    source = Wider()
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    for key in (1, 2, 3, 4):
        source.change(key, {"id": key, "kind": "a", "qty": key, "flag": True})
    old = of(spark, "id", "kind", "qty", "flag")
    text = sync(source.frame(spark), *old, shards, out, "0")
    source.change(6, {"id": 6, "kind": "b", "qty": 6, "flag": True})  # still in the old layout
    source.fields = ["id", "kind", "flag", "extra"]
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    source.change(1, {"id": 1, "kind": "b", "qty": None, "flag": True, "extra": True})
    source.change(2, None)
    source.change(5, {"id": 5, "kind": "a", "qty": None, "flag": False, "extra": True})
    new = of(spark, "id", "kind", "flag", "extra")
    with pytest.raises(RuntimeError, match="full re-copy"):
        sync(source.frame(spark), *new, shards, out, "x", text)
    text = sync(source.frame(spark), *new, shards, out, "1", text, migrate=True, former=old[0])
    dropped = sinks.dropped_places(spark, f"{out}/schema/shop/items")
    assert set(dropped) == {"qty"}
    records = spark.read.option("mergeSchema", True).parquet(f"{out}/records/shop/items")
    columns = ["id", "kind", "qty", "flag", "extra"]
    got = apply.current_state(records, ["id"], columns, truncates=True, dropped=dropped).collect()
    assert {r.id: (r.kind, r.qty, r.extra) for r in got} == {
        1: ("b", None, "new"), 3: ("a", None, None), 4: ("a", None, None), 5: ("a", None, "new"), 6: ("b", None, None),
    }
    # Another order of the columns, or other labels, are copied anew.
    source.fields = ["id", "flag", "kind", "extra"]
    source.response("-80", fields=True)
    source.change(3, None)
    turned = of(spark, "id", "flag", "kind", "extra")
    with pytest.raises(log.LayoutChanged):
        sync(source.frame(spark), *turned, shards, out, "2", text, migrate=True, former=new[0])
    shot = snapshot_of(spark, source)
    wide = lambda k, t: shot(k, t).withColumn("extra", F.lit("copied"))
    sync(source.frame(spark), *turned, shards, out, "2", text, migrate=True, former=new[0], snapshots=wide)
    records = spark.read.option("mergeSchema", True).parquet(f"{out}/records/shop/items")
    got = apply.current_state(records, ["id"], ["id", "kind", "extra"], truncates=True).collect()
    assert {r.id: r.extra for r in got} == dict.fromkeys([1, 4, 5, 6], "copied")


def test_dropping_a_column_writes_no_bucket(spark, tmp_path):
    root, columns = str(tmp_path / "t"), ["id", "v", "w"]
    rows = spark.createDataFrame([(i, f"v{i}", f"w{i}") for i in range(20)], "id int, v string, w string")
    sinks.apply_records(shape.snapshot_records(rows, columns), root, ["id"], columns, 4)
    # A record without the column leaves it alone, in its own bucket, too.
    one = shape.snapshot_records(rows.filter("id = 3").select("id", F.lit("new").alias("v")), ["id", "v"], seq=1)
    sinks.apply_records(one, root, ["id"], ["id", "v"], 4)
    got = {r.id: (r.v, r.w) for r in sinks.read_table(spark, root, ["id"], columns).collect()}
    assert got == {i: (f"v{i}" if i != 3 else "new", f"w{i}") for i in range(20)}
    before = sorted(os.listdir(f"{root}/data"))
    assert sinks.drop_columns(spark, root, {"w": 5}) == 3
    assert sorted(os.listdir(f"{root}/data")) == before
    assert {r.w for r in sinks.read_table(spark, root, ["id"], columns).collect()} == {None}
    # An earlier place changes nothing; a later value stands; an older one that comes late does not.
    sinks.drop_columns(spark, root, {"w": 2})
    for seq, key in ((4, 1), (6, 2)):
        sinks.apply_records(shape.snapshot_records(rows.filter(f"id = {key}"), columns, seq=seq), root, ["id"], columns, 4)
    assert {r.id for r in sinks.read_table(spark, root, ["id"], columns).filter("w IS NOT NULL").collect()} == {2}
