"""Shaping and folding."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import apply, cursor, shape, sinks
from rowtide.plans import apply_queries as queries

IMAGE = "struct<id: bigint, name: string, qty: int>"
CHANGES = f"keyspace string, table string, shard string, seq bigint, before {IMAGE}, after {IMAGE}"
COLUMNS = ["id", "name", "qty"]


def changes(spark, *pairs):
    rows = [("shop", "t", "-", i, b, a) for i, (b, a) in enumerate(pairs)]
    return spark.createDataFrame(rows, CHANGES)


def shaped(frame, **options):
    got = shape.shape_changes(frame, ["id"], **options).orderBy("seq", "op").collect()
    return [(r.op, tuple(r.row), r.written) for r in got]


def test_insert_carries_nulls(spark):
    assert shaped(changes(spark, (None, (1, None, 2)))) == [("UPSERT", (1, None, 2), COLUMNS)]


def test_delete_carries_the_key_of_the_before_image(spark):
    assert shaped(changes(spark, ((1, "a", 2), None))) == [("DELETE", (1, None, None), ["id"])]
    assert shaped(changes(spark, ((None, None, None), None))) == [("DELETE", (None, None, None), ["id"])]


@pytest.mark.parametrize(
    "before, after, row, written",
    [
        ((1, "a", 2), (1, "b", 2), (1, "b", None), ["id", "name"]),
        ((1, "a", 2), (1, None, 2), (1, None, None), ["id", "name"]),
        ((1, None, 2), (1, "b", 3), (1, "b", 3), COLUMNS),
        ((1, None, None), (1, None, None), (1, None, None), ["id"]),
        ((1, "", 0), (1, None, 0), (1, None, None), ["id", "name"]),
    ],
)
def test_update_carries_what_differs(spark, before, after, row, written):
    assert shaped(changes(spark, (before, after))) == [("UPDATE", row, written)]


def test_noop_and_empty_pairs(spark):
    same = ((1, "a", 2), (1, "a", 2))
    assert shaped(changes(spark, same)) == [("UPDATE", (1, None, None), ["id"])]
    assert shaped(changes(spark, same), drop_noop=True) == []
    assert shaped(changes(spark, (None, None))) == []


def test_moved_key(spark):
    moved = changes(spark, ((1, "a", 2), (9, "a", 2)))
    assert shaped(moved) == [
        ("DELETE", (1, None, None), ["id"]), ("UPSERT", (9, "a", 2), COLUMNS)]
    assert shaped(moved, pk_change="keep") == [("UPDATE", (9, None, None), ["id"])]
    with pytest.raises(ValueError):
        shape.shape_changes(moved, ["id"], pk_change="other")


def test_selected_columns_only(spark):
    frame = changes(spark, ((1, "a", 2), (1, "b", 3)))
    assert shaped(frame, columns=["id", "qty"]) == [("UPDATE", (1, 3), ["id", "qty"])]


def model(records, columns, pk="id"):
    """The table after all records, row by row."""
    rows = {}
    for op, row, written in records:
        if op == "TRUNCATE":
            rows.clear()
        elif op == "DELETE":
            rows.pop(row[pk], None)
        else:
            rows.setdefault(row[pk], dict.fromkeys(columns)).update({c: row[c] for c in written})
    return {tuple(r[c] for c in columns) for r in rows.values()}


def random_log(n, seed, truncates=True):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        # A third of all records hits one key.
        key = 0 if rng.random() < 0.33 else rng.randrange(40)
        row = {"id": key, "name": rng.choice([None, "x", "y"]), "qty": rng.choice([None, 1, 2])}
        op = rng.choices(["UPSERT", "UPDATE", "DELETE", "TRUNCATE"], [4, 5, 2, 0.05 if truncates else 0])[0]
        written = {
            "UPSERT": COLUMNS, "DELETE": ["id"], "TRUNCATE": [],
            "UPDATE": ["id"] + [c for c in ("name", "qty") if rng.random() < 0.5],
        }[op]
        out.append((op, row, written))
    return out


def record_frame(spark, log, first=0):
    rows = [
        ("shop", "t", "-", first + i, op, None if op == "TRUNCATE" else tuple(row[c] if c in written else None for c in COLUMNS), written)
        for i, (op, row, written) in enumerate(log)
    ]
    return spark.createDataFrame(
        rows,
        f"keyspace string, table string, shard string, seq bigint, op string, row {IMAGE}, written array<string>",
    )


def as_set(frame):
    rows = [tuple(r) for r in frame.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_is_the_model_at_every_cut(spark, seed):
    log = random_log(1000, seed)
    for cut in (1, 37, 250, 600, 1000):
        records = record_frame(spark, log[:cut]).orderBy(F.rand(3))
        assert as_set(apply.current_state(records, ["id"], COLUMNS, truncates=True)) == model(log[:cut], COLUMNS)


def test_soft_delete(spark):
    log = [("UPSERT", dict(id=1, name="a", qty=1), COLUMNS), ("UPSERT", dict(id=2, name="b", qty=2), COLUMNS),
           ("DELETE", dict(id=1), ["id"])]
    got = apply.soft_delete(record_frame(spark, log), ["id"], COLUMNS).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", 1, True), (2, "b", 2, False)]


def test_apply_in_any_order(spark, tmp_path):
    log = random_log(600, 5)
    parts = [record_frame(spark, log[i : i + 200], i) for i in (0, 200, 400)]
    root = str(tmp_path / "t")
    assert sinks.read_table(spark, root, ["id"], COLUMNS) is None
    # Late, early, repeated.
    for version, i in enumerate((2, 0, 1, 0), start=1):
        assert sinks.apply_records(parts[i], root, ["id"], COLUMNS, buckets=4) == version
    assert as_set(sinks.read_table(spark, root, ["id"], COLUMNS)) == model(log, COLUMNS)
    # Nothing to apply writes no version.
    assert sinks.apply_records(parts[0].filter("false"), root, ["id"], COLUMNS, buckets=4) == 4


def test_apply_rewrites_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    log = [("UPSERT", dict(id=i, name="a", qty=1), COLUMNS) for i in range(50)]
    sinks.apply_records(record_frame(spark, log), root, ["id"], COLUMNS, buckets=8)
    sinks.apply_records(
        record_frame(spark, [("UPDATE", dict(id=7, name="b"), ["id", "name"])], 100), root, ["id"], COLUMNS, 8)
    assert len(list((tmp_path / "t/data/version=1").glob("bucket=*"))) > 1
    assert len(list((tmp_path / "t/data/version=2").glob("bucket=*"))) == 1
    assert (7, "b", 1) in as_set(sinks.read_table(spark, root, ["id"], COLUMNS))


def test_apply_failed_before_the_manifest(spark, tmp_path):
    root = str(tmp_path / "t")
    one = record_frame(spark, [("UPSERT", dict(id=1, name="a", qty=1), COLUMNS)])
    two = record_frame(spark, [("UPSERT", dict(id=1, name="b", qty=1), COLUMNS)], 1)
    sinks.apply_records(one, root, ["id"], COLUMNS, 2)
    sinks.apply_records(two, root, ["id"], COLUMNS, 2)
    (tmp_path / "t/manifest/version=2").rename(tmp_path / "lost")
    assert as_set(sinks.read_table(spark, root, ["id"], COLUMNS)) == {(1, "a", 1)}
    assert sinks.apply_records(two, root, ["id"], COLUMNS, 2) == 2
    assert as_set(sinks.read_table(spark, root, ["id"], COLUMNS)) == {(1, "b", 1)}


def test_truncate_before_a_copy(spark):
    old = record_frame(spark, [("UPSERT", dict(id=1, name="a", qty=1), COLUMNS)])
    copy = sinks.emit_truncate(
        record_frame(spark, [("UPSERT", dict(id=2, name="b", qty=2), COLUMNS)], 10), seq=5,
        keyspace="shop", table="t")
    truncate = copy.filter("op = 'TRUNCATE'").first()
    assert truncate.row is None and truncate.written == []
    both = old.unionByName(copy)
    assert as_set(apply.current_state(both, ["id"], COLUMNS, truncates=True)) == {(2, "b", 2)}


def test_empty_table_is_written(spark, tmp_path):
    empty = apply.current_state(record_frame(spark, []), ["id"], COLUMNS)
    sinks.write_table(empty, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == COLUMNS and back.count() == 0


def test_row_ids_tell_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("~", "c"), ("1:a", "c"), ("a|1:b", "c"), ("a", "c")]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(apply.row_id(["x", "y"])).distinct().count() == len(rows)


def test_keyless_table(spark):
    frame = changes(
        spark, (None, (1, "a", 1)), (None, (1, "a", 1)), (None, (2, "b", 1)), ((2, "b", 1), (2, "c", 1)),
        ((1, "a", 1), None), (None, (3, "d", None)))
    keyed = apply.with_row_id(frame, COLUMNS)
    records = shape.shape_changes(keyed, ["row_id"])
    assert as_set(apply.current_state(records, ["row_id"], ["row_id", *COLUMNS])) == {(2, "c", 1), (3, "d", None)}


def test_replayed_records(spark):
    records = record_frame(spark, random_log(50, 9, truncates=False))
    assert cursor.drop_replayed(records.unionByName(records)).count() == 50


def test_report(spark):
    records = record_frame(spark, random_log(200, 3))
    r = sinks.sync_report(records).first()
    assert r.upserts + r.updates + r.deletes + r.truncates == 200 and (r.first_seq, r.last_seq) == (0, 199)


def test_uneven_update(spark):
    frame = spark.createDataFrame([(1, 1), (2, 1), (0, 3)], "n_before int, n_after int")
    got = [r.shape_error for r in shape.check_shapes(frame).collect()]
    assert got[0] is None and "2 before, 1 after" in got[1] and got[2] is None


def test_flagship_numbers(spark):
    """The acceptance numbers of the orders log at this scale."""
    table = queries.current_state(spark, "/root/testdata/sf0.01")
    r = table.agg(
        F.count("*").alias("n"),
        F.count("o_orderpriority").alias("p"),
        F.count_if(F.col("o_orderstatus") == "U").alias("u"),
        F.count_if(F.col("o_orderstatus") == "R").alias("r"),
        F.sum("o_orderkey").alias("k"),
    ).first()
    assert tuple(r) == (14318, 12370, 4545, 682, 107376136)


def test_apply_a_truncate(spark, tmp_path):
    root = str(tmp_path / "t")
    up = lambda i, seq: record_frame(spark, [("UPSERT", dict(id=i, name="a", qty=1), COLUMNS)], seq)
    only = record_frame(spark, [("TRUNCATE", None, [])], 5)
    sinks.apply_records(up(1, 1), root, ["id"], COLUMNS, 4)
    assert sinks.apply_records(only, root, ["id"], COLUMNS, 4) == 2
    assert as_set(sinks.read_table(spark, root, ["id"], COLUMNS)) == set()
    sinks.apply_records(up(2, 6), root, ["id"], COLUMNS, 4)
    sinks.apply_records(up(3, 2), root, ["id"], COLUMNS, 4)  # late, from before the TRUNCATE
    assert as_set(sinks.read_table(spark, root, ["id"], COLUMNS)) == {(2, "a", 1)}


# --- tables without a key as multisets ----------------------------------------------------------

def _signed(spark, *pairs):
    kind = "struct<a: string, b: int>"
    changes = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], f"seq int, before {kind}, after {kind}")
    return apply.signed_rows(changes, ["a", "b"])


def _rows(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def test_a_delete_takes_one_of_equal_rows(spark):
    x, y, none = ("x", 1), ("y", None), (None, None)
    signed = _signed(spark, (None, x), (None, x), (x, None), (None, y), (y, y), (y, x), (None, none), (None, none), (None, y))
    assert _rows(apply.current_multiset(signed, ["a", "b"])) == [("x", 1), ("x", 1), ("y", None), (None, None), (None, None)]
    numbered = apply.current_multiset(signed, ["a", "b"], index="i")
    assert _rows(numbered.filter("a = 'x'")) == [("x", 1, 1), ("x", 1, 2)]
    # The same records again change nothing; after a TRUNCATE only what came later is there.
    assert _rows(apply.current_multiset(signed.union(signed), ["a", "b"])) == _rows(apply.current_multiset(signed, ["a", "b"]))
    assert _rows(apply.current_multiset(signed, ["a", "b"], truncate_seq=6)) == [("y", None), (None, None)]


def test_a_row_older_than_the_log(spark):
    x = ("x", 1)
    assert _rows(apply.current_multiset(_signed(spark, (x, None), (x, None), (None, x)), ["a", "b"])) == []


def test_a_row_in_many_copies_is_written_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(apply, "COPIES", 7)
    signed = _signed(spark, *[(None, ("x", 1))] * 30)
    assert _rows(apply.current_multiset(signed, ["a", "b"], index="i")) == sorted([("x", 1, i + 1) for i in range(30)], key=repr)


def test_a_large_bucket_is_merged_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_ROWS", 100)
    rows = spark.range(1000).selectExpr("id", "'a' as v")
    sinks.apply_records(shape.snapshot_records(rows, ["id", "v"]), str(tmp_path), ["id"], ["id", "v"], buckets=1)
    sinks.apply_records(shape.snapshot_records(rows.selectExpr("id", "'b' as v"), ["id", "v"], seq=1), str(tmp_path), ["id"], ["id", "v"], buckets=1)
    assert len(list(tmp_path.glob("data/version=2/bucket=0/*.parquet"))) > 5
    got = sinks.read_table(spark, str(tmp_path), ["id"], ["id", "v"])
    assert sorted(tuple(r) for r in got.collect()) == [(i, "b") for i in range(1000)]


def test_records_are_written_unsorted(spark, tmp_path):
    """Operations are few, so a task writes all of them side by side and holds no rows back to sort them."""
    seen, name = [], "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with sinks.open_writers(spark, 4):
        seen.append(spark.conf.get(name))
    assert seen == ["4"] and spark.conf.get(name) == before
    records = shape.snapshot_records(spark.range(10).selectExpr("id", "'a' as v"), ["id", "v"])
    sinks.write_records(records, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 10 and spark.conf.get(name) == before
