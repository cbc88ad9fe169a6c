"""Streams over several micro-batches: equal to their batch twins, with bounded state and bounded reads."""

import datetime as dt
import json
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandline.session import scratch_dir
from strandline.streaming import streams as st
from strandline.streaming import tables

T0 = dt.datetime(2024, 1, 1)


def _ev(i, hours, key, status):
    return (i, T0 + dt.timedelta(hours=hours), key, status)


EVENTS = [
    _ev(1, 0, "A", "PENDING"), _ev(2, 2, "A", "SUCCESS"),                            # finished in time
    _ev(3, 1, "B", "PENDING"), _ev(4, 12, "B", "FAILURE"),                           # finished late -> stale
    _ev(5, 3, "C", "PENDING"), _ev(6, 4, "C", "STARTED"),                            # never finished -> stale
    _ev(7, 0.5, "D", "SUCCESS"), _ev(8, 5, "D", "PENDING"), _ev(9, 6, "D", "SUCCESS"),  # terminal before start ignored
    _ev(10, 20, "E", "PENDING"),                                                     # deadline after the end
    _ev(11, 22, "F", "PENDING"), _ev(12, 23, "F", "PENDING"), _ev(13, 40, "Z", "STARTED"),
]


def _land_in_order(df, path, n_files):
    """Small files in order of time, one micro-batch each."""
    rows = sorted(df.collect(), key=lambda r: r["ts"])
    size = -(-len(rows) // n_files)
    for at in range(0, len(rows), size):
        df.sparkSession.createDataFrame(rows[at:at + size], df.schema).coalesce(1).write.mode("append").parquet(path)


SCHEMA = "event_id long, ts timestamp, analysis_id string, status string"


def _stale(spark, path, delay="0 seconds", files=1):
    """(rows of the verdicts, state rows after the last micro-batch)."""
    out, counts = scratch_dir(spark, "stale-out"), []
    q = (st.stale_stream(st.read_stream(spark, path, SCHEMA, files), "8 hours", delay).writeStream
         .option("checkpointLocation", scratch_dir(spark, "stale-ckpt")).foreachBatch(st.batch_table_sink(out))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    counts = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    return st.read_batches(spark, out).collect(), counts


def _runs(rows, verdict="stale"):
    return sorted((r.analysis_id, r.started_at) for r in rows if r.verdict == verdict)


def test_stale_stream_equals_batch_twin(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    twin = sorted((r.analysis_id, r.started_at) for r in st.stale_batch(df, "8 hours").collect())
    assert [k for k, _ in twin] == ["B", "C", "E", "F"]
    src = scratch_dir(spark, "stale-src")
    _land_in_order(df, src, 4)
    assert _runs(_stale(spark, src)[0]) == twin


def test_a_key_may_run_again_after_its_verdict(spark):
    rows = [_ev(1, 0, "A", "PENDING"), _ev(2, 9, "A", "SUCCESS"), _ev(3, 10, "A", "PENDING"), _ev(4, 11, "A", "PENDING"),
            _ev(5, 12, "A", "SUCCESS"), _ev(6, 13, "A", "PENDING"), _ev(7, 30, "Z", "STARTED"), _ev(8, 13, "B", "PENDING"),
            _ev(9, 21, "B", "FAILURE")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = [("A", T0), ("A", T0 + dt.timedelta(hours=13))]
    assert sorted((r.analysis_id, r.started_at) for r in st.stale_batch(df, "8 hours").collect()) == want
    src = scratch_dir(spark, "stale-again-src")
    _land_in_order(df, src, 5)
    assert _runs(_stale(spark, src)[0]) == want


def test_finished_keys_leave_no_state_and_late_events_are_told(spark):
    rows = [_ev(i, i % 5, f"k{i}", "PENDING") for i in range(20)] + [_ev(100 + i, 6, f"k{i}", "SUCCESS") for i in range(0, 20, 2)]
    src = scratch_dir(spark, "stale-state-src")
    for part in (rows, [_ev(200, 40, "end", "STARTED")], [_ev(201, 1, "k1", "SUCCESS"), _ev(202, 39, "new", "SUCCESS")],
                 [_ev(203, 60, "end", "STARTED")]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out, counts = _stale(spark, src, "2 hours")
    assert _runs(out) == sorted((f"k{i}", T0 + dt.timedelta(hours=i % 5)) for i in range(1, 20, 2))
    assert [(r.analysis_id, r.event_id, r.ts) for r in out if r.verdict == "late"] == [("k1", 201, T0 + dt.timedelta(hours=1))]
    assert max(counts) > 20 and counts[-1] <= 2  # only what the watermark has not passed: the last event of "end"


class _Value:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


def test_keys_of_a_bucket_are_judged_together():
    """Against a loop over all events; keys of a bucket share two values and one timer."""
    r, wait, delay, values, timers = random.Random(5), 8_000, 2_000, {}, set()

    def put(timer):
        assert timer not in timers
        timers.add(timer)

    handle = SimpleNamespace(getValueState=lambda name, schema: values.setdefault(name, _Value()), registerTimer=put, deleteTimer=timers.remove)
    bucket = st._Runs("k", wait)
    bucket.init(handle)
    events = [(r.choice(["a", "b", "c", None, *"defgh"]), r.randrange(200) * 500, i, r.choice(["PENDING", "PENDING", "SUCCESS", "STARTED", None]))
              for i in range(600)]
    said, now, seen, taken, late = [], 0, 0, [], []
    for batch in range(8):
        part = [e for e in events if e[1] // 12_500 == batch or (e[2] % 50 == batch and e[1] // 12_500 < batch)]
        time = SimpleNamespace(getCurrentWatermarkInMs=lambda: now // 1000)
        late += [(e[0], e[2]) for e in part if e[1] < now]
        taken += [e for e in part if e[1] >= now]
        frame = pd.DataFrame(part, columns=["key", "us", "event_id", "status"])
        calls = [bucket.handleInputRows((0,), iter([frame[:9], frame[9:]]), time)]
        for call in calls:
            said += list(call)
        seen = max([seen, *(e[1] for e in part)])
        for _ in range(2 if batch == 7 else 1):  # after the batch the watermark moves, and what is due comes
            now = max(now, (seen - delay) // 1000 * 1000)
            for timer in [t for t in timers if t <= now // 1000]:
                said += list(bucket.handleExpiredTimer((0,), time, SimpleNamespace(getExpiryTimeInMs=lambda t=timer: t)))
                timers.discard(timer)
        assert len(timers) <= 1 and bool(timers) == any(v.exists() for v in values.values())
    want = []
    for key in {e[0] for e in taken}:
        run = None
        for _, us, _, status in sorted((e for e in taken if e[0] == key and e[1] <= now), key=lambda e: e[1:3]):
            if run is not None and us > run + wait:
                want.append((str(key), run))
                run = None
            run = None if status in ("SUCCESS", "FAILURE") else us if run is None and status == "PENDING" else run
        want += [(str(key), run)] if run is not None and run + wait < now else []
    rows = [x for frame in said for x in frame.itertuples()]
    name = lambda x: "None" if pd.isna(x.k) else x.k
    assert sorted((name(x), x.started_at.value // 1000) for x in rows if x.verdict == "stale") == sorted(want) and len(want) > 30
    assert sorted((name(x), x.event_id) for x in rows if x.verdict == "late") == sorted((str(k), i) for k, i in late) and late


def test_stale_events_are_grouped_by_bucket(spark):
    events = spark.createDataFrame(EVENTS, SCHEMA)
    src = st.land(events, scratch_dir(spark, "stale-plan-src"))
    plan = st.stale_stream(st.read_stream(spark, src, SCHEMA), "8 hours", "0 seconds", buckets=3)._jdf.queryExecution().analyzed().toString()
    assert "AS bucket" in plan and "TransformWithStateInPySpark" in plan


def test_latest_status_and_advance_batch(spark):
    df = spark.createDataFrame([(1, T0, "A", "PENDING", "PENDING"), (2, T0 + dt.timedelta(hours=1), "A", "SUCCESS",
                                                                      "REVOKED"),
                                (3, T0 + dt.timedelta(hours=2), "A", "STARTED", "SUCCESS"),
                                (4, T0, "B", "PENDING", "RECEIVED")],
                               "event_id long, ts timestamp, analysis_id string, status string, state string")
    latest = {r.analysis_id: r.status for r in st.latest_status(df).collect()}
    assert latest == {"A": "STARTED", "B": "PENDING"}
    marker = {r.analysis_id: r.marker for r in st.advance(df).collect()}
    assert marker == {"A": "SUCCESS", "B": "STARTED"}
    assert [r.event_id for r in st.unknown_polls(df).collect()] == [2]


def test_harvest_replay_is_idempotent(spark):
    rows = [(i, T0 + dt.timedelta(hours=i), f"A{i % 3}", "SUCCESS" if i % 2 else "STARTED", f'{{"k": {i}}}')
            for i in range(12)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, analysis_id string, state string, payload string")
    src = scratch_dir(spark, "harvest-src")
    _land_in_order(df, src, 3)
    results, status = scratch_dir(spark, "h-results"), scratch_dir(spark, "h-status")
    for _ in range(2):  # the second run replays every batch from a fresh checkpoint
        ckpt = scratch_dir(spark, "h-ckpt")
        st.run_available(st.read_stream(spark, src, df.schema, 1), ckpt, st.harvest_sink(results, status))
    got = sorted(r.event_id for r in st.read_batches(spark, results).collect())
    assert got == [i for i in range(12) if i % 2]
    assert st.read_batches(spark, status).where(F.col("status") != "SUCCESS").count() == 0


def test_stale_stream_takes_unordered_files(spark):
    df = spark.createDataFrame(EVENTS[::-1], SCHEMA).repartition(5)
    src = st.land(df, scratch_dir(spark, "stale-any-src"))
    assert [k for k, _ in _runs(_stale(spark, src, files=100)[0])] == ["B", "C", "E", "F"]


def test_an_id_dropped_again_is_a_new_request(spark):
    def parse(df):
        return df.select(F.lit("sequencing_id").alias("kind"), F.col("key").alias("id"))

    src, out, ckpt = (scratch_dir(spark, f"inbox-{x}") for x in ("src", "out", "ckpt"))
    for keys, want in ((["a", "a", "b"], ["a", "b"]), (["a"], ["a", "a", "b"])):
        df = spark.createDataFrame([(k,) for k in keys], "key string")
        st.land(df, src)
        table = st.inbox_stream(spark, src, df.schema, parse, out, ckpt)
        assert sorted(r["id"] for r in table.collect()) == want
        assert st.inbox_stream(spark, src, df.schema, parse, out, ckpt).count() == len(want)


def test_family_mode_on_a_stream_equals_the_batch(spark):
    members = spark.createDataFrame([("a1", "f1"), ("a2", "f1"), ("a3", "f2"), ("a4", None), ("a5", None), ("a6", "f3")],
                                    "analysis_id string, family_id string")
    status = spark.createDataFrame([("a2", "FAILURE"), ("a4", "SUCCESS")], "analysis_id string, status string")
    results = spark.createDataFrame([("a6",)], "analysis_id string")
    want = {"a1": False, "a2": False, "a3": True, "a4": False, "a5": True, "a6": False}
    batch = st.submittable(members, status, results, family="family_id")
    assert {r["analysis_id"]: r["allowed"] for r in batch.collect()} == want
    src, out = st.land(members, scratch_dir(spark, "family-src")), scratch_dir(spark, "family-out")
    stream = st.submittable(st.read_stream(spark, src, members.schema), status, results, family="family_id", members=members)
    st.run_available(stream, scratch_dir(spark, "family-ckpt"), st.batch_table_sink(out))
    assert {r["analysis_id"]: r["allowed"] for r in st.read_batches(spark, out).collect()} == want


def test_gate_over_many_batches(spark):
    tracked = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("c", "3"), ("a", "1")], "analysis_id string, external_id string")
    t = st.land(tracked, scratch_dir(spark, "tracked"))
    s, out, ckpt = (scratch_dir(spark, f"gate-{x}") for x in ("src", "out", "ckpt"))
    schema = "external_id string, processing_status string"
    steps = [([("1", "READY"), ("3", "WAIT")], {"a": (2, 1), "b": (1, 0), "c": (1, 0)}),
             ([("2", "READY"), ("9", "READY"), ("1", "READY")], {"a": (2, 2), "b": (1, 0), "c": (1, 0)}),
             ([("3", "READY"), ("2", "READY")], {"a": (2, 2), "b": (1, 1), "c": (1, 1)}),
             ([("8", "READY")], {"a": (2, 2), "b": (1, 1), "c": (1, 1)})]
    for rows, want in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(s)
        changes = st.gate_changes(st.read_stream(spark, t, tracked.schema), st.read_stream(spark, s, schema))
        st.run_available(changes, ckpt, st.gate_sink(spark, out, every=2))
        now = {r["analysis_id"]: (r["tracked_count"], r["ready_count"]) for r in st.gate_state(spark, out).collect()}
        assert now == want
        assert all(r["done"] == (r["tracked_count"] == r["ready_count"]) for r in st.gate_state(spark, out).collect())
    assert tables.BatchTable(spark, out).bases()


def test_snapshots_read_the_last_base_and_what_came_after(spark):
    path = scratch_dir(spark, "snapshot")
    sink, table = st.snapshot_sink(spark, path, ["k"], every=3), tables.BatchTable(spark, path, tables.newest(["k"]), 3)
    with pytest.raises(FileNotFoundError):
        table.read()
    held = {}
    for b in range(12):
        rows = [(f"k{i}", b * 10 + i) for i in range(b % 4, 6)]
        held |= dict(rows)
        sink(spark.createDataFrame(rows, "k string, n long"), b)
        if b in (5, 7):  # a replayed batch replaces what it wrote
            sink(spark.createDataFrame(rows, "k string, n long"), b)
        assert {r["k"]: r["n"] for r in st.latest_snapshot(spark, path, ["k"]).collect()} == held
        assert len(table._parts()[1]) <= 4 and len(table.bases()) <= 2
    assert len(table.batches()) <= 7  # compacted folders go
    # a base without its marker, as a lost driver leaves it, does not count
    spark.createDataFrame([("k0", -1, 99)], "k string, n long, batch_id long").write.parquet(f"{path}/_base/upto=99")
    table._fs.delete(table._at(f"{path}/_base/upto=99/_SUCCESS"), False)
    assert {r["k"]: r["n"] for r in st.latest_snapshot(spark, path, ["k"]).collect()} == held
