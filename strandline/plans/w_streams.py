"""Witnesses for the status streams.

Each witness lands the bounded input as slices, each some parquet files, runs the stream
with ``trigger(availableNow=True)`` through a foreachBatch sink over several micro-batches (one a
slice), and returns the sink table; the oracle is the batch semantics in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.operators import catalog as cat
from strandline.plans.registry import witness
from strandline.plans.w_catalog import _INBOX, inbox_keys
from strandline.session import cut_lineage, scratch_dir
from strandline.streaming import streams as st

EVENTS = ("ev AS (SELECT event_id, ts, 'SRA' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(7, length(CAST(user_id AS VARCHAR))) AS INT), '0') AS analysis_id, "
          "CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'STARTED' WHEN 'click' THEN 'STARTED' "
          "WHEN 'purchase' THEN 'SUCCESS' ELSE 'FAILURE' END AS status, "
          "'boot-' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 3 AS VARCHAR) AS boot_id, "
          "CASE WHEN event_type = 'signup' THEN 'PENDING' WHEN event_type = 'view' THEN 'RECEIVED' "
          "WHEN event_type = 'click' THEN 'STARTED' WHEN event_type = 'purchase' THEN 'SUCCESS' "
          "WHEN value > 50 THEN 'FAILURE' ELSE 'REVOKED' END AS state, props AS payload FROM events)")


def _events(v):
    e = v.events
    return v.status_events.join(e.select("event_id", "event_type", "value", "props"), "event_id").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "analysis_id", "status", "boot_id",
        st.poll_state(F.col("event_type"), F.col("value")).alias("state"), F.col("props").alias("payload"))


#: Micro-batches of a witness, files of a slice (at least, and rows of a file from which there are more), and batches
#: between two compactions.
SLICES, FILES, FILE_ROWS, COMPACT_EVERY = 4, 2, 250_000, 2


def _sliced(v, df, by: Column, n: int, name: str) -> tuple[str, int]:
    """Land ``df`` as ``n`` slices by the number ``by``, one after the other; the folder and the files of a slice. The rows
    are made once, and larger slices have more files, so that as many tasks write and read them."""
    path, rows = scratch_dir(v.spark, f"{name}-src"), cut_lineage(df.withColumn("_slice", by))
    files = max(FILES, -(-rows.count() // (n * FILE_ROWS)))
    for i in range(n):
        rows.where(F.col("_slice") == i).drop("_slice").repartition(files).write.mode("append").parquet(path)
    return path, files


def _stream(v, df, name: str, by: Column | None = None):
    """Land ``df`` in slices, by default by a hash of all columns, so in no order of time; open it as a stream that
    takes one slice a micro-batch."""
    by = F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)) if by is None else by
    path, files = _sliced(v, df, by, SLICES, name)
    return st.read_stream(v.spark, path, df.schema, files)


def _run(v, stream_df, name: str, mode: str = "append"):
    out = scratch_dir(v.spark, f"{name}-out")
    ckpt = scratch_dir(v.spark, f"{name}-ckpt")
    sink = st.snapshot_sink(v.spark, out, ["analysis_id"], COMPACT_EVERY) if mode == "update" else st.batch_table_sink(out)
    st.run_available(stream_df, ckpt, sink, mode)
    return out


@witness("str_inbox", f"""
WITH k AS (SELECT {_INBOX} AS object_key FROM orders),
n AS (SELECT substr(object_key, 10) AS name FROM k WHERE starts_with(object_key, '.etl-run/')),
t AS (SELECT CASE WHEN ends_with(name, '.txt') OR ends_with(name, '.sequencing_id') THEN 'sequencing_id'
                  WHEN ends_with(name, '.batch_id') THEN 'batch_id' END AS kind,
             regexp_replace(name, '\\.(txt|sequencing_id|batch_id)$', '') AS id FROM n)
SELECT DISTINCT kind, id FROM t WHERE kind IS NOT NULL AND length(id) > 0
""")
def _(v):
    keys = inbox_keys(v)
    src = st.land(keys, scratch_dir(v.spark, "inbox-src"))
    return st.inbox_stream(v.spark, src, keys.schema, cat.pending_ids, scratch_dir(v.spark, "inbox-out"),
                           scratch_dir(v.spark, "inbox-ckpt")).select("kind", "id")


LATEST = ("QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY ts DESC, event_id DESC) = 1")


@witness("str_latest", f"""
WITH {EVENTS}
SELECT analysis_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM ev {LATEST}
""")
def _(v):
    s = _stream(v, _events(v), "latest")
    out = _run(v, st.latest_status(s), "latest", "update")
    snap = st.latest_snapshot(v.spark, out, ["analysis_id"])
    return snap.select("analysis_id", "status", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@witness("str_advance", f"""
WITH {EVENTS},
t AS (SELECT analysis_id, state AS first_terminal FROM ev WHERE state IN ('SUCCESS', 'FAILURE')
      QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY ts, event_id) = 1),
p AS (SELECT analysis_id, bool_or(state IN ('PENDING', 'STARTED', 'RECEIVED')) AS prog FROM ev GROUP BY analysis_id)
SELECT p.analysis_id, coalesce(t.first_terminal, CASE WHEN prog THEN 'STARTED' ELSE 'PENDING' END) AS marker
FROM p LEFT JOIN t USING (analysis_id)
""")
def _(v):
    s = _stream(v, _events(v), "advance")
    out = _run(v, st.advance(s), "advance", "update")
    return st.latest_snapshot(v.spark, out, ["analysis_id"]).select("analysis_id", "marker")


STATUS = f"sts AS (SELECT analysis_id, status FROM ev {LATEST})"


def _latest(v):
    """The status table, written once: a stream joins it in every micro-batch."""
    return cut_lineage(st.latest_status(_events(v)))


@witness("str_submittable", f"""
WITH {EVENTS}, {STATUS}, req AS (SELECT DISTINCT analysis_id FROM clinical)
SELECT req.analysis_id, sts.status IS NULL OR sts.status = 'FAILURE' AS allowed,
       CASE WHEN sts.status IS NULL THEN 'no_status' WHEN sts.status = 'FAILURE' THEN 'retry_failed'
            WHEN sts.status = 'SUCCESS' THEN 'done' ELSE 'in_progress' END AS reason
FROM req LEFT JOIN sts USING (analysis_id)
""")
def _(v):
    req = _stream(v, v.clinical.select("analysis_id").distinct(), "requests")
    out = _run(v, st.submittable(req, _latest(v)), "submittable")
    return st.read_batches(v.spark, out).select("analysis_id", "allowed", "reason")


RESULTS = "res AS (SELECT DISTINCT analysis_id FROM ev WHERE status = 'SUCCESS' AND CAST(json_extract_string(payload, '$.k') AS INT) > 50)"


def _results(v):
    e = _events(v)
    return e.where((F.col("status") == "SUCCESS") & (F.get_json_object("payload", "$.k").cast("int") > 50)).select(
        "analysis_id").distinct()


@witness("str_recover", f"""
WITH {EVENTS}, {RESULTS}
SELECT event_id, analysis_id,
       CASE WHEN status IN ('PENDING', 'STARTED') AND analysis_id IN (SELECT analysis_id FROM res) THEN 'SUCCESS'
            ELSE status END AS status
FROM ev
""")
def _(v):
    s = _stream(v, _events(v), "recover")
    out = _run(v, st.recover(s, cut_lineage(_results(v))), "recover")
    return st.read_batches(v.spark, out).select("event_id", "analysis_id", "status")


@witness("str_orphans", f"""
WITH {EVENTS},
sb AS (SELECT analysis_id, boot_id AS sbid FROM ev QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY ts, event_id) = 1),
bad AS (SELECT ev.* FROM ev JOIN sb USING (analysis_id) WHERE length(boot_id) > 0 AND length(sbid) > 0 AND boot_id <> sbid)
SELECT analysis_id, event_id, 'FAILURE' AS status FROM bad
QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY ts, event_id) = 1
""")
def _(v):
    e = _events(v)
    s = _stream(v, e, "orphans")
    out = _run(v, st.orphans(s, cut_lineage(st.submit_boot_ids(e))), "orphans", "update")
    return st.latest_snapshot(v.spark, out, ["analysis_id"]).select("analysis_id", "event_id", "status")


@witness("str_gate", f"""
WITH {EVENTS},
tr AS (SELECT DISTINCT analysis_id, 'F' || CAST(event_id AS VARCHAR) AS external_id FROM ev WHERE state IN ('PENDING', 'RECEIVED')),
ready AS (SELECT DISTINCT 'F' || CAST(event_id AS VARCHAR) AS external_id FROM ev
          WHERE state IN ('PENDING', 'RECEIVED', 'STARTED') AND event_id % 3 <> 0)
SELECT tr.analysis_id, count(*) AS tracked_count, count(ready.external_id) AS ready_count,
       count(*) = count(ready.external_id) AS done
FROM tr LEFT JOIN ready USING (external_id) GROUP BY tr.analysis_id
""")
def _(v):
    e = _events(v)
    ext = F.concat(F.lit("F"), F.col("event_id").cast("string")).alias("external_id")
    tracked = e.where(F.col("state").isin("PENDING", "RECEIVED")).select("analysis_id", ext)
    statuses = e.where(F.col("state").isin("PENDING", "RECEIVED", "STARTED")).select(
        ext, F.when(F.col("event_id") % 3 != 0, "READY").otherwise("PROCESSING").alias("processing_status"))
    # half of the groups is tracked from the start, the others from the third micro-batch on
    t = _stream(v, tracked, "tracked", F.pmod(F.xxhash64("analysis_id"), F.lit(2)) * 2)
    out = scratch_dir(v.spark, "gate-out")
    st.run_available(st.gate_changes(t, _stream(v, statuses, "gate")), scratch_dir(v.spark, "gate-ckpt"),
                     st.gate_sink(v.spark, out, every=COMPACT_EVERY))
    return st.gate_state(v.spark, out)


TIMEOUT = "8 hours"


DELAY = "2 hours"


@witness("str_stale", f"""
WITH RECURSIVE {EVENTS},
mark AS (SELECT max(ts) - INTERVAL 2 HOUR AS now FROM ev WHERE event_id % 97 <> 0),
late AS (SELECT event_id, analysis_id, ts FROM ev, mark WHERE event_id % 97 = 0 AND ts < now),
n AS (SELECT analysis_id, ts, status, row_number() OVER (PARTITION BY analysis_id ORDER BY ts, event_id) AS i
      FROM ev ANTI JOIN late USING (event_id)),
r AS (SELECT analysis_id, 0::BIGINT AS i, NULL::TIMESTAMP AS started, NULL::TIMESTAMP AS stale FROM ev GROUP BY analysis_id
      UNION ALL
      SELECT n.analysis_id, n.i,
             CASE WHEN r.started IS NOT NULL AND n.ts <= r.started + INTERVAL 8 HOUR
                  THEN CASE WHEN n.status IN ('SUCCESS', 'FAILURE') THEN NULL ELSE r.started END
                  WHEN n.status = 'PENDING' THEN n.ts END,
             CASE WHEN n.ts > r.started + INTERVAL 8 HOUR THEN r.started END
      FROM r JOIN n ON n.analysis_id = r.analysis_id AND n.i = r.i + 1),
o AS (SELECT analysis_id, started FROM (SELECT analysis_id, started, i, max(i) OVER (PARTITION BY analysis_id) AS last FROM r)
      WHERE i = last AND started IS NOT NULL),
v AS (SELECT analysis_id, stale AS started FROM r WHERE stale IS NOT NULL UNION ALL SELECT * FROM o)
SELECT analysis_id, 'stale' AS verdict, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at, NULL::BIGINT AS event_id
FROM v, (SELECT greatest(now, (SELECT max(ts) - INTERVAL 2 HOUR FROM ev)) AS now FROM mark) WHERE started + INTERVAL 8 HOUR < now
UNION ALL SELECT analysis_id, 'late', NULL, event_id FROM late
""")
def _(v):
    # written once: the quarters are looked for in it before it is sliced
    e = cut_lineage(_events(v).select("event_id", "ts", "analysis_id", "status"))
    # slices in order of time, then one with events of all times
    straggler = F.col("event_id") % 97 == 0
    quarter = e.agg(F.percentile_approx("ts", [0.25, 0.5, 0.75]).alias("q")).select("q").scalar()
    order = sum(((F.col("ts") > F.get(quarter, F.lit(i))).cast("int") for i in range(3)), F.lit(0))
    src, files = _sliced(v, e, F.when(straggler, F.lit(4)).otherwise(order), 5, "stale")
    out = _run(v, st.stale_stream(st.read_stream(v.spark, src, e.schema, files), TIMEOUT, DELAY), "stale")
    return st.read_batches(v.spark, out).select(
        "analysis_id", "verdict", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started_at"), "event_id")


@witness("str_harvest", f"""
WITH {EVENTS}
SELECT analysis_id, event_id, CAST(json_extract_string(payload, '$.k') AS INT) AS k FROM ev WHERE state = 'SUCCESS'
""")
def _(v):
    s = _stream(v, _events(v), "harvest")
    results = scratch_dir(v.spark, "harvest-results")
    status = scratch_dir(v.spark, "harvest-status")
    ckpt = scratch_dir(v.spark, "harvest-ckpt")
    st.run_available(s, ckpt, st.harvest_sink(results, status))
    r = st.read_batches(v.spark, results)
    return r.select("analysis_id", "event_id", F.get_json_object("payload", "$.k").cast("int").alias("k"))
