"""Whole syncs over a growing log: cycles, idle runs, resume, schema change."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import apply, cursor
from rowtide.plans.sync import ahead_of, sync
from rowtide.session import shared_dir

KEY = "struct<fields: array<string>, values: array<string>>"
IMAGE = "array<binary>"
EVENTS = (
    "keyspace string, shard string, resp_id bigint, event_idx int, event_type string, table string, "
    f"fields array<string>, row_changes array<struct<before: {IMAGE}, after: {IMAGE}>>, "
    "shard_gtids array<struct<keyspace: string, shard: string, gtid: string, "
    f"table_pks: array<struct<table: string, last_pk: {KEY}>>>>, last_pk {KEY}, completed boolean"
)
COLUMNS = ["id", "kind", "qty", "flag"]
CATALOG = [("shop", "items", i + 1, c, t, k) for i, (c, t, k) in enumerate(
    [("id", "bigint", "PRI"), ("kind", "enum('a','b')", ""), ("qty", "int", ""), ("flag", "tinyint(1)", "")])] + [
    ("shop", "_vt_hld_x", 1, "id", "bigint", "PRI"), ("shop", "skipped", 1, "id", "bigint", "PRI")]


class Source:
    """Two shards that log what happens to them."""

    def __init__(self):
        self.log, self.rows, self.resp, self.fields = [], {}, {"-80": 0, "80-": 0}, list(COLUMNS)

    def image(self, row):
        kind = {"a": "1", "b": "2", None: None}[row["kind"]]
        values = {"id": str(row["id"]), "kind": kind, "qty": None if row["qty"] is None else str(row["qty"]), "flag": str(int(row["flag"]))}
        return [None if values.get(f) is None else bytearray(values[f].encode()) for f in self.fields]

    def response(self, shard, *pairs, fields=False):
        self.resp[shard] += 1
        resp, out = self.resp[shard], []
        if fields:
            out.append(("FIELD", "shop.items", list(self.fields), None, None))
        for pair in pairs:
            out.append(("ROW", "shop.items", None, [pair], None))
        out.append(("VGTID", None, None, None, [("shop", shard, f"{shard}:{resp}", [])]))
        for i, (kind, table, f, rows, gtids) in enumerate(out):
            self.log.append(("shop", shard, resp, i, kind, table, f, rows, gtids, None, None))

    def change(self, key, row):
        shard = "-80" if key % 2 else "80-"
        before = self.rows.get(key)
        self.response(shard, (before and self.image(before), row and self.image(row)))
        if row:
            self.rows[key] = row
        else:
            self.rows.pop(key)

    def frame(self, spark):
        return spark.createDataFrame(self.log, EVENTS)


@pytest.fixture(scope="module")
def setting(spark):
    catalog = spark.createDataFrame(
        CATALOG, "keyspace string, table string, ordinal int, column string, column_type string, column_key string")
    selection = spark.createDataFrame(
        [(k, t, c, t != "skipped") for k, t, _, c, _, _ in CATALOG],
        "keyspace string, table string, column string, included boolean")
    shards = spark.createDataFrame([("shop", "-80"), ("shop", "80-")], "keyspace string, shard string")
    return catalog, selection, shards


def written(spark, out):
    return spark.read.parquet(f"{out}/records/shop/items")


def table(spark, out):
    got = apply.current_state(written(spark, out), ["id"], COLUMNS, truncates=True).collect()
    return {r.id: (r.kind, r.qty, r.flag) for r in got}


def expected(source):
    return {k: (r["kind"], r["qty"], r["flag"]) for k, r in source.rows.items()}


def test_cycles(spark, setting, tmp_path):
    rng, source, out, text = random.Random(4), Source(), str(tmp_path / "out"), ""
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    new = lambda k: {"id": k, "kind": rng.choice(["a", "b", None]), "qty": rng.choice([None, 1, 7]), "flag": rng.random() < 0.5}
    for cycle in range(3):
        for key in range(cycle * 8, cycle * 8 + 24):
            source.change(key, new(key))
        for key in list(source.rows):
            if key % 4 == cycle:
                source.change(key, {**source.rows[key], "qty": cycle})
            elif key % 9 == cycle:
                source.change(key, None)
        text = sync(source.frame(spark), *setting, out, f"{cycle}", text)
        assert table(spark, out) == expected(source)
        counts = {r.op: r["count"] for r in written(spark, out).filter(F.col("run") == cycle).groupBy("op").count().collect()}
        assert counts.get("TRUNCATE", 0) == (1 if cycle == 0 else 0)
    shards = json.loads(text)["keyspaces"]["shop"]["streams"]
    assert set(shards) == {"shop:items"}
    assert {s: c["position"] for s, c in shards["shop:items"]["shards"].items()} == {
        s: f"{s}:{n}" for s, n in source.resp.items()}
    # Nothing new: no records, the same state.
    before = written(spark, out).count()
    again = sync(source.frame(spark), *setting, out, "idle", text)
    assert again == text and written(spark, out).count() == before


def test_schema_change_fails_without_a_trace(spark, setting, tmp_path):
    source, out = Source(), str(tmp_path / "out")
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    source.change(1, {"id": 1, "kind": "a", "qty": 1, "flag": True})
    text = sync(source.frame(spark), *setting, out, "0")
    source.fields.insert(1, "extra")
    source.response("-80", fields=True)
    source.change(3, {"id": 3, "kind": "a", "qty": 1, "flag": True})
    with pytest.raises(RuntimeError, match="full re-copy"):
        sync(source.frame(spark), *setting, out, "1", text)
    assert {r.run for r in written(spark, out).select("run").distinct().collect()} == {0}


def snapshot_of(spark, source):
    """The source's rows as they are now, as a snapshot gives them."""
    rows = [(f"{'-80' if k % 2 else '80-'}", k, r["kind"], r["qty"], r["flag"]) for k, r in source.rows.items()]
    frame = spark.createDataFrame(rows, "shard string, id bigint, kind string, qty int, flag boolean")
    return lambda keyspace, table: frame


def started(*rows):
    source = Source()
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    for key in rows:
        source.change(key, {"id": key, "kind": "a", "qty": 1, "flag": True})
    return source


def test_layout_change_is_copied_anew(spark, setting, tmp_path):
    source, out = started(1, 2), str(tmp_path / "out")
    text = sync(source.frame(spark), *setting, out, "0")
    source.fields.insert(1, "extra")
    source.response("-80", fields=True)
    source.change(3, {"id": 3, "kind": "b", "qty": 2, "flag": False})
    source.change(1, None)
    text = sync(source.frame(spark), *setting, out, "1", text, snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source) and 1 not in table(spark, out)
    # From there on the log goes on with the new layout.
    source.change(5, {"id": 5, "kind": "a", "qty": 5, "flag": True})
    source.change(3, None)
    sync(source.frame(spark), *setting, out, "2", text)
    assert table(spark, out) == expected(source)


def test_new_table_from_a_snapshot(spark, setting, tmp_path):
    source, out = started(1, 2, 3), str(tmp_path / "out")
    source.log = [e for e in source.log if e[2] > 1]  # the log is younger than the table
    for shard in ("-80", "80-"):
        source.response(shard, fields=True)
    text = sync(source.frame(spark), *setting, out, "0", snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source)
    source.change(2, None)
    sync(source.frame(spark), *setting, out, "1", text, snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source)


def test_a_copy_mends_what_a_delete_left(spark, setting, tmp_path):
    source, out = started(1, 2), str(tmp_path / "out")
    gone = source.rows[1]
    source.change(1, None)
    sync(source.frame(spark), *setting, out, "0")
    source.rows[1] = gone  # the log was wrong: the row is there
    sync(source.frame(spark), *setting, out, "1", snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source)


def test_removed_log(spark, setting, tmp_path):
    source, out = started(1, 2), str(tmp_path / "out")
    text = sync(source.frame(spark), *setting, out, "0")
    source.change(1, None)
    source.change(2, {"id": 2, "kind": "b", "qty": 9, "flag": False})
    source.log = [e for e in source.log if not (e[1] == "-80" and e[2] > 1 and e[3] == 0)]
    purged = spark.createDataFrame([("shop", "-80", 99)], "keyspace string, shard string, purged_upto bigint")
    with pytest.raises(RuntimeError, match="a snapshot is needed"):
        sync(source.frame(spark), *setting, out, "1", text, purged=purged)
    sync(source.frame(spark), *setting, out, "1", text, purged=purged, snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source)


def test_lost_responses_are_found_by_their_numbers(spark, setting, tmp_path):
    source, out = started(1, 2), str(tmp_path / "out")
    text = sync(source.frame(spark), *setting, out, "0", numbered=True)
    source.change(2, {"id": 2, "kind": "b", "qty": 9, "flag": False})
    text = sync(source.frame(spark), *setting, out, "1", text, numbered=True)  # nothing is missing
    assert table(spark, out) == expected(source)
    source.change(1, None)
    hole = source.resp["-80"]
    source.change(3, {"id": 3, "kind": "a", "qty": 1, "flag": True})
    source.log = [e for e in source.log if (e[1], e[2]) != ("-80", hole)]
    with pytest.raises(RuntimeError, match="a snapshot is needed"):
        sync(source.frame(spark), *setting, out, "2", text, numbered=True)
    sync(source.frame(spark), *setting, out, "2", text, numbered=True, snapshots=snapshot_of(spark, source))
    assert table(spark, out) == expected(source)


def test_report_and_chosen_shards(spark, setting, tmp_path):
    source, out = started(1, 2), str(tmp_path / "out")
    text = sync(source.frame(spark), *setting, out, "0", shard_names="80-")
    assert set(table(spark, out)) == {2}
    report = {r.shard: r.outcome for r in spark.read.parquet(f"{out}/report/run=0").collect()}
    assert report == {"80-": "PROGRESS"}
    sync(source.frame(spark), *setting, out, "1", text, shard_names="80-")
    assert {r.outcome for r in spark.read.parquet(f"{out}/report/run=1").collect()} == {"CURRENT"}
    with pytest.raises(ValueError, match="no such shard"):
        sync(source.frame(spark), *setting, out, "2", text, shard_names="c0-")


def test_the_least_cursor_reaches_the_files(spark, setting, tmp_path):
    source = started(1, 2, 3)
    source.frame(spark).write.parquet(str(tmp_path / "log"))
    events = spark.read.parquet(str(tmp_path / "log"))
    cursors = spark.createDataFrame([("shop", "-80", 2), ("shop", "80-", 1)], "keyspace string, shard string, seq bigint")
    plan = ahead_of(events, "shop", cursors)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(resp_id,1)" in plan and "EqualTo(keyspace,shop)" in plan


def test_the_end_of_another_copy(spark):
    pos = lambda r: [("shop", "-", f"p{r}", [])]
    events = [("shop", "-", r, 0, "ROW", "shop.items", None, [(None, [bytearray(b"1")])], None, None, None) for r in (1, 3, 5)]
    events += [("shop", "-", r, 1, "VGTID", None, None, None, pos(r), None, None) for r in (1, 3, 5)]
    events += [("shop", "-", 3, 2, "COPY_COMPLETED", "shop.other", None, None, None, None, None)]
    stops = spark.createDataFrame([("shop", "-", "p5")], "keyspace string, shard string, stop string")
    read, _ = cursor.bounded_read(spark.createDataFrame(events, EVENTS), "items", stops)
    assert sorted(r.resp_id for r in read.filter("event_type = 'ROW'").collect()) == [1, 3, 5]


def test_without_a_shared_folder_a_cluster_is_refused(monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "a"

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)
