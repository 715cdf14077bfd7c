"""Logs, cursors and state."""

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowtide.operators import cursor, shape, state
from rowtide.operators.checkpoints import response_checkpoints
from rowtide.operators.running import carry_forward, running_number, span_chunk
from rowtide.sources import log

KEY = "struct<fields: array<string>, values: array<string>>"
IMAGE = "struct<id: bigint>"
EVENTS = (
    "keyspace string, shard string, resp_id bigint, event_idx int, event_type string, table string, "
    f"fields array<string>, row_changes array<struct<before: {IMAGE}, after: {IMAGE}>>, "
    "shard_gtids array<struct<keyspace: string, shard: string, gtid: string, "
    f"table_pks: array<struct<table: string, last_pk: {KEY}>>>>, last_pk {KEY}, completed boolean"
)


def event(shard, resp, idx, kind, **more):
    names = ["table", "fields", "row_changes", "shard_gtids", "last_pk", "completed"]
    return ("shop", shard, resp, idx, kind, *[more.get(n) for n in names])


def key(v):
    return (["id"], [str(v)])


def vgtid(shard, resp, idx, gtid, pk=None, table="t", keyspace="shop"):
    pks = [] if pk is None else [(table, key(pk))]
    return event(shard, resp, idx, "VGTID", shard_gtids=[(keyspace, shard, gtid, pks)])


def rows(shard, resp, idx, *pairs, table="t"):
    return event(shard, resp, idx, "ROW", table=table, row_changes=list(pairs))


def timeline_of(spark, events, table="t", start=None, span=2):
    frame = spark.createDataFrame(events, EVENTS)
    got = cursor.cursor_timeline(frame, table, start, span).orderBy("shard", "resp_id").collect()
    return [(r.resp_id, r.position, r.last_pk and r.last_pk["values"][0], r.copy_completed, r.records) for r in got]


def test_copy_then_catch_up(spark):
    ins = lambda i: (None, (i,))
    events = [
        event("-", 1, 0, "FIELD", table="t", fields=["id"]),
        rows("-", 1, 1, ins(1), ins(2)),
        vgtid("-", 1, 2, "COPY", pk=2),
        event("-", 2, 0, "COPY_COMPLETED"),
        vgtid("-", 2, 1, "AFTER"),
        vgtid("-", 3, 0, "LATER"),
    ]
    assert timeline_of(spark, events)[:2] == [(1, "COPY", "2", False, 2), (2, "AFTER", None, True, 0)]
    stops = spark.createDataFrame([("shop", "-", "NEVER")], "keyspace string, shard string, stop string")
    read, cursors = cursor.bounded_read(spark.createDataFrame(events, EVENTS), "t", stops)
    assert {r.resp_id for r in read.collect()} == {1, 2}
    assert [(r.position, r.last_pk) for r in cursors.collect()] == [("AFTER", None)]


def test_what_moves_a_cursor(spark):
    events = [
        vgtid("-", 1, 0, "a", pk=5),
        vgtid("-", 2, 0, "", pk=6),                       # empty position: kept; key replaced
        vgtid("-", 3, 0, "elsewhere", keyspace="other"),  # another keyspace: nothing
        event("-", 4, 0, "LASTPK", table="shop.t", last_pk=key(7), completed=False),
        event("-", 5, 0, "LASTPK", table="u", completed=True),  # another table: nothing
        event("-", 6, 0, "LASTPK", table="t", completed=True),
        vgtid("-", 7, 0, "b", pk=8, table="shop.t"),
        vgtid("-", 8, 0, "c", pk=9, table="u"),           # table not listed: key cleared
        event("-", 9, 0, "OTHER"),
    ]
    assert [x[:3] for x in timeline_of(spark, events)] == [
        (1, "a", "5"), (2, "a", "6"), (3, "a", "6"), (4, "a", "7"), (5, "a", "7"), (6, "a", None),
        (7, "b", "8"), (8, "c", None), (9, "c", None)]


def test_start_cursor(spark):
    start = spark.createDataFrame(
        [("shop", "-", "saved", key(3))], f"keyspace string, shard string, position string, last_pk {KEY}")
    events = [event("-", 1, 0, "OTHER"), vgtid("-", 2, 0, "", pk=None), vgtid("-", 3, 0, "n")]
    assert [x[:3] for x in timeline_of(spark, events, start=start)] == [
        (1, "saved", "3"), (2, "saved", None), (3, "n", None)]


def test_last_key_without_fields(spark):
    events = [event("-", 1, 0, "LASTPK", table="t", last_pk=([], ["1"]), completed=False)]
    with pytest.raises(PySparkException, match="missing the field names"):
        timeline_of(spark, events)


def test_stop_rule_by_position(spark):
    """Ten positions of three responses; rows come with each third one."""
    events, resp = [], 0
    for position in range(10):
        for part in range(3):
            events.append(vgtid("-", resp, 9, f"p{position}"))
            if part == 2:
                events.append(rows("-", resp, 0, (None, (1,)), (None, (2,)), ((3,), None), ((4,), None)))
            resp += 1
    frame = spark.createDataFrame(events, EVENTS)
    stops = spark.createDataFrame([("shop", "-", "p8")], "keyspace string, shard string, stop string")
    read, cursors = cursor.bounded_read(frame, "t", stops, span=4)
    assert read.agg(F.max("resp_id")).first()[0] == 27
    ops = log.unnest_row_changes(read.filter("event_type = 'ROW'")).select(
        shape.classify_change(F.col("before"), F.col("after")).alias("op"))
    assert {r.op: r["count"] for r in ops.groupBy("op").count().collect()} == {"UPSERT": 18, "DELETE": 18}
    assert cursors.first().position == "p9"


def walk(events, shard, table, stop, ckpt_rows=None):
    """The rules, one response after another, as the stream reader lives them."""
    bare = lambda t: t.split(".")[-1]
    position, pk, watch, out, since, ckpts, ended = "", None, False, [], 0, [], None
    by_resp = {}
    for e in events:
        if e[1] == shard:
            by_resp.setdefault(e[2], []).append(e)
    for resp in sorted(by_resp):
        done = False
        for e in sorted(by_resp[resp], key=lambda e: e[3]):
            kind, tab, changes, gtids, last, completed = e[4], e[5], e[7], e[8], e[9], e[10]
            if kind == "VGTID":
                for ks, sh, gtid, pks in gtids:
                    if (ks, sh) == ("shop", shard):
                        position = gtid or position
                        pk = next((k for t, k in pks if bare(t) == table), None)
                        break
            elif kind == "LASTPK" and bare(tab) == table:
                pk = None if completed else last
            elif kind == "COPY_COMPLETED":
                done = True
            elif kind == "ROW" and bare(tab) == table:
                since += sum(b is not None or a is not None for b, a in changes)
        out.append((resp, position, pk and pk[1][0]))
        watch = watch or position == stop
        if ckpt_rows and pk is not None and since >= ckpt_rows:
            ckpts.append((resp, since))
            since = 0
        if ended is None and (done or (watch and pk is None and position != stop)):
            ended = resp
    return out, ckpts, ended


def random_events(seed, responses=60):
    rng = random.Random(seed)
    out = []
    for shard, share in (("-80", 1.0), ("80-", 0.4)):
        for resp in range(responses):
            if rng.random() > share:
                continue
            for idx in range(rng.randrange(0, 6)):
                kind = rng.choices(["VGTID", "LASTPK", "ROW", "OTHER", "COPY_COMPLETED"], [5, 2, 5, 1, 0.15])[0]
                table = rng.choice(["t", "shop.t", "u"])
                if kind == "VGTID":
                    pks = [(rng.choice(["t", "shop.t", "u"]), key(rng.randrange(99)))] if rng.random() < 0.6 else []
                    gtid = rng.choice(["", f"p{resp // 4}"])
                    out.append(event(shard, resp, idx, kind, shard_gtids=[
                        ("other", shard, "no", []), ("shop", shard, gtid, pks), ("shop", shard, "late", [])]))
                elif kind == "LASTPK":
                    out.append(event(shard, resp, idx, kind, table=table, last_pk=key(rng.randrange(99)),
                                     completed=rng.random() < 0.4))
                elif kind == "ROW":
                    pairs = [rng.choice([(None, (1,)), ((1,), None), ((1,), (1,)), (None, None)])
                             for _ in range(rng.randrange(1, 5))]
                    out.append(rows(shard, resp, idx, *pairs, table=table))
                else:
                    out.append(event(shard, resp, idx, kind))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_cursors_against_the_walk(spark, seed):
    events = random_events(seed)
    frame = spark.createDataFrame(events, EVENTS)
    timeline = cursor.cursor_timeline(frame, "t", span=7).cache()
    stops = spark.createDataFrame(
        [("shop", s, "p9") for s in ("-80", "80-")], "keyspace string, shard string, stop string")
    ends = {r.shard: r.end_resp for r in cursor.bounded_stop(timeline, stops).collect()}
    found = {}
    for r in response_checkpoints(timeline, span=5, rows=6).collect():
        found.setdefault(r.shard, []).append((r.resp_id, r.records))
    for shard in ("-80", "80-"):
        want, ckpts, ended = walk(events, shard, "t", "p9", 6)
        got = [(r.resp_id, r.position, r.last_pk and r.last_pk["values"][0])
               for r in timeline.filter(F.col("shard") == shard).orderBy("resp_id").collect()]
        assert got == want
        assert ends.get(shard) == ended
        assert sorted(found.get(shard, [])) == ckpts
    timeline.unpersist()


def test_checkpoints_by_time(spark):
    rng = random.Random(7)
    data, at = [], 0
    for resp in range(300):
        at += rng.randrange(0, 40)
        data.append(("shop", "-", resp, "p", key(resp) if rng.random() < 0.8 else None, rng.randrange(0, 5), at))
    frame = spark.createDataFrame(
        data, f"keyspace string, shard string, resp_id bigint, position string, last_pk {KEY}, records bigint, at bigint")
    got = sorted((r.resp_id, r.records) for r in
                 response_checkpoints(frame, span=11, rows=20, at=F.col("at"), minutes=2).collect())
    want, since, last = [], 0, data[0][6]
    for _, _, resp, _, pk, n, t in data:
        since += n
        if pk and since > 0 and (since >= 20 or t - last >= 120):
            want.append((resp, since))
            since, last = 0, t
    assert got == want and len(want) > 20


# --- running values ------------------------------------------------------------------------

@pytest.mark.parametrize("span", [1, 3, 1000])
def test_running_against_the_loop(spark, span):
    rng = random.Random(span)
    data = [(("hot" if rng.random() < 0.6 else "cold"), i * rng.choice([1, 1, 5]), rng.choice([None, None, i])) for i in range(200)]
    data = list({(k, o): (k, o, v) for k, o, v in data}.values())
    frame = spark.createDataFrame(data, "k string, o bigint, v int")
    filled = {(r.k, r.o): r.f for r in carry_forward(frame, ["k"], ["o"], {"f": F.col("v")}, span).collect()}
    numbered = {(r.k, r.o): r.n for r in
                running_number(frame, ["k"], [span_chunk("o", span)], ["o"], "n").collect()}
    for group in ("hot", "cold"):
        last = None
        for n, (k, o, v) in enumerate(sorted(r for r in data if r[0] == group), start=1):
            last = v if v is not None else last
            assert filled[k, o] == last and numbered[k, o] == n


# --- layouts ---------------------------------------------------------------------------------

def test_layouts_by_exact_and_bare_name(spark):
    field = lambda resp, idx, table, *f: event("-", resp, idx, "FIELD", table=table, fields=list(f))
    pair = (None, (1,))
    events = [
        field(1, 0, "shop.t", "a"), rows("-", 1, 1, pair, table="shop.t"), rows("-", 1, 2, pair, table="t"),
        field(2, 0, "t", "a", "b"), rows("-", 2, 1, pair, table="t"),
        rows("-", 2, 2, pair, table="shop.t"),            # the exact name's list is still the old one
        rows("-", 2, 3, pair, table="x.t"),               # no exact list: the bare name's
        field(3, 0, "shop.t"), rows("-", 3, 1, pair, table="shop.t"),  # empty list: none
        rows("-", 4, 0, pair, table="u"),
    ]
    frame = spark.createDataFrame(events, EVENTS)
    for twice in (frame, frame.unionByName(frame.filter("event_type = 'FIELD'"))):
        got = log.layout_as_of(twice).orderBy("resp_id", "event_idx").collect()
        assert [(r.resp_id, r.event_idx, r.layout) for r in got] == [
            (1, 1, ["a"]), (1, 2, ["a"]), (2, 1, ["a", "b"]), (2, 2, ["a"]), (2, 3, ["a", "b"]),
            (3, 1, None), (4, 0, None)]
    with pytest.raises(PySparkException, match="no field list before a row of table"):
        log.require_layout(log.layout_as_of(frame)).select("layout").collect()


def test_schema_change_fails_before_any_write(spark):
    field = lambda resp, *f: event("-", resp, 0, "FIELD", table="shop.t", fields=list(f))
    same = spark.createDataFrame([field(1, "id", "a"), field(2, "id", "a")], EVENTS)
    log.require_same_schema(same, ["id", "a"])
    with pytest.raises(RuntimeError, match="full re-copy"):
        log.require_same_schema(same, ["id", "gone"])
    changed = spark.createDataFrame([field(1, "id", "a"), field(2, "id", "mid", "a")], EVENTS)
    with pytest.raises(RuntimeError, match="shop.t"):
        log.require_same_schema(changed)


def test_positional_width(spark):
    frame = spark.createDataFrame([(["1", "x"], ["id", "name"])], "v array<string>, n array<string>")
    assert frame.select(shape.positional_to_named(F.col("v"), F.col("n")).alias("m")).first().m == {"id": "1", "name": "x"}
    short = spark.createDataFrame([(["1"], ["id", "name"])], "v array<string>, n array<string>")
    with pytest.raises(PySparkException, match="a row holds 1 values where its layout names 2"):
        short.select(shape.positional_to_named(F.col("v"), F.col("n"))).collect()


def test_write_rows_by_layout(spark):
    ab, ba, a = ["id", "name"], ["name", "id"], ["id"]
    b = lambda *v: [None if x is None else bytearray(x.encode()) for x in v]
    data = [(1, ab, b("1", "x"), None), (2, ba, None, b("y", "2")), (3, a, b("3"), b("4")), (4, ab, b("5", None), b("6", "z"))]
    frame = spark.createDataFrame(data, "seq int, layout array<string>, before array<binary>, after array<binary>")
    writers = {"id": lambda v: v.cast("string").cast("int"), "name": lambda v: v.cast("string")}
    got = shape.write_rows(frame, writers).orderBy("seq").collect()
    assert [(r.before and tuple(r.before), r.after and tuple(r.after)) for r in got] == [
        ((1, "x"), None), (None, (2, "y")), ((3, None), (4, None)), ((5, None), (6, "z"))]
    lost = spark.createDataFrame([(1, None, b("1"), None)], frame.schema)
    with pytest.raises(PySparkException, match="names -1"):
        shape.write_rows(lost, writers).collect()
    bad = spark.createDataFrame([(1, ab, b("1"), None)], frame.schema)
    with pytest.raises(PySparkException, match="a row holds 1 values where its layout names 2"):
        shape.write_rows(bad, writers).collect()


# --- scans -----------------------------------------------------------------------------------

def test_resume_after_composite_key(spark):
    data = [(s, a, b) for s in ("-80", "80-", "x") for a in range(4) for b in range(4)]
    frame = spark.createDataFrame(data, "shard string, a int, b int")
    got = {tuple(r) for r in log.resume_snapshot(frame, ["a", "b"], {"-80": [1, 2], "80-": None}).collect()}
    assert got == {r for r in data if (r[0] == "-80" and r[1:] > (1, 2)) or r[0] == "80-"}


def test_resume_reaches_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = lines.filter(log.after_key(["l_orderkey", "l_linenumber"], [700, 3]))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_orderkey,700)" in plan


def test_peek_and_skip(spark):
    events = spark.createDataFrame(
        [("shop", "-", "a", 1), ("shop", "-", "b", 2), ("shop", "-", "", 3), ("shop", "x", "z", 1), ("my", "-", "q", 9)],
        "keyspace string, shard string, position string, seq bigint")
    latest = log.peek_latest(events)
    assert {(r.keyspace, r.shard, r.latest) for r in latest.collect()} == {
        ("shop", "-", "b"), ("shop", "x", "z"), ("my", "-", "q")}
    cursors = spark.createDataFrame(
        [("shop", "-", "b", None), ("shop", "x", "z", "5"), ("my", "-", "p", None), ("no", "-", "p", None)],
        "keyspace string, shard string, position string, last_pk string")
    assert {r.keyspace + r.shard for r in cursor.skip_if_current(cursors, latest).collect()} == {"shopx", "my-", "no-"}


# --- state -----------------------------------------------------------------------------------

STATE = "keyspace string, table string, shard string, position string, last_pk string"


def frames(spark):
    tables = spark.createDataFrame([("ks", "old"), ("ks", "new")], "keyspace string, table string")
    shards = spark.createDataFrame([("ks", "-80"), ("ks", "80-")], "keyspace string, shard string")
    starts = state.starting_positions(spark, '{"ks": {"-80": "s1", "80-": "s2"}, "other": {"-": "x"}}')
    return tables, shards, starts


def test_starting_positions(spark):
    assert state.starting_positions(spark, None).count() == 0
    with pytest.raises((PySparkException, Py4JJavaError)):
        state.starting_positions(spark, '{"ks": ').collect()


def test_merge_state(spark):
    saved = spark.createDataFrame(
        [("ks", "old", "-80", "p", None), ("ks", "old", "gone", "g", None), ("ks", "excluded", "-", "e", "1")], STATE)
    got = {(r.table, r.shard): (r.position, r.last_pk, r.start_ignored)
           for r in state.merge_state(saved, *frames(spark)).collect()}
    assert got == {
        ("old", "-80"): ("p", None, False), ("old", "gone"): ("g", None, False),
        ("old", "80-"): ("", None, True),           # known table, new shard: starts are ignored
        ("new", "-80"): ("s1", None, False), ("new", "80-"): ("s2", None, False),
        ("excluded", "-"): ("e", "1", False),
    }


def test_truncate_gate(spark):
    cursors = spark.createDataFrame(
        [("ks", "fresh", "-80", "", None), ("ks", "fresh", "80-", None, None), ("ks", "begun", "-80", "", "7"),
         ("ks", "begun", "80-", "", None), ("ks", "read", "-", "p", None)], STATE)
    got = {r.table: r.truncate for r in shape.truncate_gate(cursors).collect()}
    assert got == {"fresh": True, "begun": False, "read": False}


def test_state_text(spark, tmp_path):
    cursors = spark.createDataFrame(
        [("ks", "a:b", "80-", "p2", None), ("ks", "a:b", "-80", "p1", "7"), ("z", "t", "-", "", None)], STATE)
    text = state.state_to_json(cursors).first().state
    assert json.loads(text) == {"keyspaces": {
        "ks": {"streams": {"ks:a:b": {"shards": {"-80": {"position": "p1", "last_pk": "7"}, "80-": {"position": "p2"}}}}},
        "z": {"streams": {"z:t": {"shards": {"-": {"position": ""}}}}}}}
    path = str(tmp_path / "state")
    state.write_checkpoint(cursors, path)
    back = state.read_checkpoint(spark, path)
    assert {tuple(r)[:5] for r in back.collect()} == {tuple(r) for r in cursors.collect()}
    assert state.state_from_json(spark, "").count() == 0
    with pytest.raises((PySparkException, Py4JJavaError)):
        state.state_from_json(spark, "{name: value").collect()


def test_missing_state(spark):
    tables, shards, starts = frames(spark)
    fresh = state.initial_state(tables, shards, starts)
    state.require_state(tables, fresh)
    with pytest.raises(ValueError, match="no state for stream ks:new"):
        state.require_state(tables, fresh.filter("table = 'old'"))


def test_expired_log(spark):
    cursors = spark.createDataFrame(
        [("ks", "t", "-80", "p", "1", 5), ("ks", "t", "80-", "p", None, 50), ("ks", "u", "-80", "", "3", None)],
        STATE + ", seq bigint")
    purged = spark.createDataFrame([("ks", "-80", 10), ("ks", "80-", 10)], "keyspace string, shard string, purged_upto bigint")
    got = {(r.table, r.shard): (r.position, r.last_pk, r.error_code, r.truncate)
           for r in cursor.expired_log_reset(cursors, purged).collect()}
    # The table is emptied, so its other shard is copied anew as well.
    assert got == {("t", "-80"): ("", None, "BINLOG_EXPIRATION_ERROR", True),
                   ("t", "80-"): ("", None, None, True), ("u", "-80"): ("", "3", None, False)}
    one = {(r.table, r.shard): (r.position, r.truncate)
           for r in cursor.expired_log_reset(cursors, purged, compat=True).collect()}
    assert one == {("t", "-80"): ("", False), ("t", "80-"): ("p", False), ("u", "-80"): ("", False)}


def test_made_progress(spark):
    before = spark.createDataFrame([("k", "t", "a", "p", None), ("k", "t", "b", "p", "1"), ("k", "t", "c", "", None)], STATE)
    after = spark.createDataFrame(
        [("k", "t", "a", "q", None), ("k", "t", "b", "p", None), ("k", "t", "c", "", None), ("k", "t", "d", "p", None)], STATE)
    got = {r.shard: r.progressed for r in cursor.made_progress(before, after).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": True}


def _numbered(spark, *ids, shard="-80"):
    return spark.createDataFrame([("shop", shard, i) for i in ids], "keyspace string, shard string, resp_id bigint")


def _gaps(frame):
    return sorted((r.shard, r.lost_from, r.lost_to) for r in log.log_gaps(frame).collect())


def test_log_gaps_edges(spark):
    span = log.SPAN
    assert _gaps(_numbered(spark)) == []
    assert _gaps(_numbered(spark, None, 5)) == []
    assert _gaps(_numbered(spark, 3, 3, 4, None, 5)) == []
    assert _gaps(_numbered(spark, *range(span - 2, span + 3))) == []  # across the border of spans
    assert _gaps(_numbered(spark, span - 1, span + 1)) == [("-80", span, span)]
    assert _gaps(_numbered(spark, 1, 5 * span)) == [("-80", 2, 5 * span - 1)]
    both = _numbered(spark, 1, 2, 3).union(_numbered(spark, 1, 3, shard="80-"))
    assert _gaps(both) == [("80-", 2, 2)]


def test_log_gaps_against_a_set(spark):
    dice = random.Random(5)
    ids = [i for i in range(3 * log.SPAN) if dice.random() > 0.01 and not 4000 < i < 4300]
    want, there = [], set(ids)
    for i in range(min(ids), max(ids)):
        if i not in there:
            if want and want[-1][1] == i - 1:
                want[-1] = (want[-1][0], i)
            else:
                want.append((i, i))
    frame = _numbered(spark, *dice.sample(ids, len(ids)), *ids[:50])
    assert [(a, b) for _, a, b in _gaps(frame)] == want


def test_lost_upto_resets_the_cursors_before_it(spark):
    frame = _numbered(spark, 4, 5, 6, 9, 10)
    state_rows = [("shop", f"t{s}", "-80", f"p{s}", None, s) for s in (3, 7, 8, 10)]
    saved = spark.createDataFrame(state_rows, "keyspace string, table string, shard string, position string, last_pk string, seq bigint")
    upto = log.lost_upto(frame)
    assert [r.purged_upto for r in upto.collect()] == [8]
    got = cursor.expired_log_reset(saved, upto).filter("error_code is not null")
    assert sorted(r["table"] for r in got.collect()) == ["t3", "t7"]


def test_layouts_that_change_often(spark):
    """Rows are put in order with their field lists: no row is compared with every version of its table."""
    rng, events = random.Random(8), []
    for r in range(200):
        name = rng.choice(["t", "a.t", "b.t"])
        kind = rng.choice(["FIELD", "ROW", "ROW"])
        events.append(event("-", r, 0, kind, table=name, fields=[f"c{rng.randrange(3)}"] if kind == "FIELD" else None))
    frame = spark.createDataFrame(events, EVENTS)
    told = lambda **options: sorted((r.resp_id, r.layout) for r in log.layout_as_of(frame, **options).collect())
    assert told(few=0, span=7) == told(few=1000)
    often = spark.createDataFrame(
        [event("-", r, i, k, table="t", fields=[f"c{r}"] if k == "FIELD" else None) for r in range(100) for i, k in enumerate(["FIELD", "ROW"])], EVENTS
    )
    laid = log.layout_as_of(often)
    assert "__by_bare_from" not in laid._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.resp_id, r.layout) for r in laid.collect()) == [(r, [f"c{r}"]) for r in range(100)]


def test_a_read_is_not_dealt_by_shard(spark):
    events = spark.createDataFrame([rows("-", 1, 0, (None, (1,))), vgtid("-", 1, 1, "p1"), vgtid("-", 2, 0, "p2")], EVENTS)
    stops = spark.createDataFrame([("shop", "-", "p1")], "keyspace string, shard string, stop string")
    read, cursors = cursor.bounded_read(events, "t", stops)
    for frame in (read, cursors):
        assert "SortMergeJoin" not in frame._jdf.queryExecution().executedPlan().toString()
    assert [r.position for r in cursors.collect()] == ["p2"]
