"""Status tracking as Structured Streaming jobs.

The reference polls object-store markers and service APIs on a timer; here the
status and inbox notifications are streams. Every operator has a batch twin
that computes the same table from a bounded input, so a stream run with
``trigger(availableNow=True)`` can be checked against it.

Sinks are written per micro-batch with ``foreachBatch`` into folders keyed by
the batch id, so a replayed batch (after a failure) overwrites exactly what it
wrote before: idempotent, exactly-once tables without a transactional format.
Tables of current states are compacted (see ``tables``), so reading one does not
depend on how many batches ever ran.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strandline.streaming.tables import EVERY, BatchTable, newest, summed

# Fixed values of the status state machine.
PENDING, STARTED, SUCCESS, FAILURE = "PENDING", "STARTED", "SUCCESS", "FAILURE"
IN_PROGRESS_POLLS = ["PENDING", "STARTED", "RECEIVED"]
TERMINAL = [SUCCESS, FAILURE]
IN_PROGRESS = [PENDING, STARTED]


# --- sources and sinks -----------------------------------------------------

def land(df: DataFrame, path: str) -> str:
    """Write a bounded table as the files of a stream, with the partitions it has."""
    df.write.mode("append").parquet(path)
    return path


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A file stream; how many files a micro-batch takes is left to the source unless the caller says it."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def run_available(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
                  mode: str = "append") -> None:
    """Process everything available now through ``sink`` (foreachBatch) and stop."""
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()


def batch_table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Append-mode sink: each batch lands in ``path/batch_id=<id>`` (overwrite,
    so a replayed batch replaces its own output)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def snapshot_sink(spark: SparkSession, path: str, key: Sequence[str], every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """Update-mode sink of the current row of each key, compacted every so many batches."""
    return BatchTable(spark, path, newest(key), every).write


def latest_snapshot(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Rows of the most recent batch that touched each key (update mode): the last base and the batches after it."""
    return BatchTable(spark, path, newest(key)).read().drop("batch_id")


# --- operators (each works on a stream or on a bounded DataFrame) ----------

def inbox_ids(keys: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Ids asked for by one listing of the inbox (or one micro-batch of its notifications), each (kind, id) once."""
    return parse(keys).dropDuplicates(["kind", "id"])


def inbox_sink(path: str, parse: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: the ids of each micro-batch. The source gives every dropped file once, so an id dropped again
    later is a new request; nothing is remembered from batch to batch."""
    write = batch_table_sink(path)
    return lambda batch, batch_id: write(inbox_ids(batch, parse), batch_id)


def inbox_stream(spark: SparkSession, path: str, schema, parse: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Take what has come to the inbox since the last call; returns the table of all requests (batch_id, kind, id)."""
    run_available(read_stream(spark, path, schema, files_per_trigger), checkpoint, inbox_sink(out, parse))
    return read_batches(spark, out)


def latest_status(events: DataFrame, key: str = "analysis_id") -> DataFrame:
    """Current status per key: the status of its latest event (by ts, id)."""
    return events.groupBy(key).agg(F.max(F.struct("ts", "event_id", "status")).alias("_l")).select(
        key, F.col("_l.status").alias("status"), F.col("_l.ts").alias("ts"))


def poll_state(event_type: Column, value: Column) -> Column:
    """Service state reported by a poll (the status stream's raw signal)."""
    return (F.when(event_type == "signup", "PENDING").when(event_type == "view", "RECEIVED")
            .when(event_type == "click", "STARTED").when(event_type == "purchase", "SUCCESS")
            .when(value > 50, "FAILURE").otherwise("REVOKED"))


def advance(polls: DataFrame, key: str = "analysis_id") -> DataFrame:
    """Marker per key after its polls: the first terminal poll (SUCCESS /
    FAILURE) decides; otherwise STARTED if any in-progress poll
    (PENDING/STARTED/RECEIVED), else PENDING. Unknown states change nothing."""
    terminal = F.col("state").isin(TERMINAL)
    agg = polls.groupBy(key).agg(
        F.min(F.when(terminal, F.struct("ts", "event_id", "state"))).alias("_t"),
        F.bool_or(F.col("state").isin(IN_PROGRESS_POLLS)).alias("_p"))
    marker = F.coalesce(F.col("_t.state"), F.when(F.col("_p"), F.lit(STARTED)).otherwise(F.lit(PENDING)))
    return agg.select(key, marker.alias("marker"))


def unknown_polls(polls: DataFrame) -> DataFrame:
    """Audit rows: polls with a state the state machine does not know."""
    return polls.where(~F.col("state").isin(TERMINAL + IN_PROGRESS_POLLS))


def submittable(requests: DataFrame, status: DataFrame, results: DataFrame | None = None,
                key: str = "analysis_id", family: str | None = None, members: DataFrame | None = None) -> DataFrame:
    """Whether each request may be submitted: allowed with no status or a
    FAILURE; refused when SUCCESS or in progress. With ``family``, any result
    or any status inside the family blocks every member; a request without a family stands for itself. ``members``
    is the table of families (key, family), by default the requests; a stream of requests must name it.
    ``status`` and ``results`` are tables, so requests may be a stream in both modes."""
    if family is None:
        j = requests.join(status.select(key, "status"), key, "left")
        allowed = F.col("status").isNull() | (F.col("status") == FAILURE)
        reason = (F.when(F.col("status").isNull(), "no_status").when(F.col("status") == FAILURE, "retry_failed")
                  .when(F.col("status") == SUCCESS, "done").otherwise("in_progress"))
        return j.select(key, allowed.alias("allowed"), reason.alias("reason"))
    if members is None and requests.isStreaming:
        raise ValueError("a stream of requests needs the table of family members")
    group = F.coalesce(F.col(family).cast("string"), F.concat(F.lit("\0"), F.col(key))).alias("_group")
    seen = status.where("status IS NOT NULL").select(key)
    if results is not None:
        seen = seen.unionByName(results.select(key))
    blocked = (requests if members is None else members).select(key, family).join(seen, key, "left_semi") \
        .select(group).distinct().withColumn("_blocked", F.lit(True))
    return requests.select(key, family, group).join(blocked, "_group", "left").select(
        key, family, F.col("_blocked").isNull().alias("allowed"))


def recover(status: DataFrame, results: DataFrame, key: str = "analysis_id") -> DataFrame:
    """PENDING / STARTED markers whose result already exists become SUCCESS."""
    r = results.select(key).distinct().withColumn("_has", F.lit(True))
    j = status.join(r, key, "left")
    fixed = F.when(F.col("status").isin(IN_PROGRESS) & F.coalesce(F.col("_has"), F.lit(False)),
                   F.lit(SUCCESS)).otherwise(F.col("status"))
    return j.withColumn("status", fixed).drop("_has")


def orphans(polls: DataFrame, submitted: DataFrame, key: str = "analysis_id") -> DataFrame:
    """First poll per key whose service boot id differs from the one seen at
    submission (both non-empty): the task was orphaned -> FAILURE."""
    s = submitted.select(key, F.col("boot_id").alias("submit_boot_id"))
    j = polls.join(s, key)
    bad = j.where((F.length("boot_id") > 0) & (F.length("submit_boot_id") > 0)
                  & (F.col("boot_id") != F.col("submit_boot_id")))
    first = bad.groupBy(key).agg(F.min(F.struct("ts", "event_id")).alias("_f"))
    return first.select(key, F.col("_f.event_id").alias("event_id"), F.lit(FAILURE).alias("status"))


def submit_boot_ids(events: DataFrame, key: str = "analysis_id") -> DataFrame:
    """Boot id at submission: the one of each key's earliest event."""
    return events.groupBy(key).agg(F.min(F.struct("ts", "event_id", "boot_id")).alias("_s")).select(
        key, F.col("_s.boot_id").alias("boot_id"))


def completion_gate(tracked: DataFrame, statuses: DataFrame, group: str = "analysis_id",
                    id_col: str = "external_id") -> tuple[DataFrame, DataFrame]:
    """(per group: tracked and ready counts, done flag; statuses for ids that
    are not tracked). ``statuses``: (external_id, processing_status)."""
    ready = statuses.where(F.col("processing_status") == "READY").select(id_col).distinct()
    t = tracked.select(group, id_col).distinct().join(ready.withColumn("_ready", F.lit(True)), id_col, "left")
    gate = t.groupBy(group).agg(F.count("*").alias("tracked_count"),
                                F.count(F.when(F.col("_ready"), 1)).alias("ready_count")).withColumn(
        "done", F.col("tracked_count") == F.col("ready_count"))
    unexpected = ready.join(tracked.select(id_col), id_col, "left_anti")
    return gate, unexpected


def gate_changes(tracked: DataFrame, statuses: DataFrame, group: str = "analysis_id", id_col: str = "external_id") -> DataFrame:
    """(group, tracked, ready): 1 for each id that begins to be tracked and each that becomes READY, of two streams.
    ``tracked`` is fed once; what is kept of it is the join's keyed state, so a micro-batch looks up its own ids only,
    however many came before. Ids may be READY before they are tracked; those never tracked count nowhere."""
    ids = tracked.select(F.col(group).alias("_group"), F.col(id_col).alias("_id")).dropDuplicates(["_group", "_id"])
    ready = statuses.where(F.col("processing_status") == "READY").select(F.col(id_col).alias("_ready")).dropDuplicates(["_ready"])
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    begun = ids.select(F.col("_group").alias(group), one.alias("tracked"), none.alias("ready"))
    done = ids.join(ready, F.col("_id") == F.col("_ready")).select(F.col("_group").alias(group), none.alias("tracked"), one.alias("ready"))
    return begun.unionByName(done)


def gate_table(spark: SparkSession, path: str, group: str = "analysis_id", every: int = EVERY) -> BatchTable:
    return BatchTable(spark, path, summed([group]), every)


def gate_sink(spark: SparkSession, path: str, group: str = "analysis_id", every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for ``gate_changes``: the batch's changes summed by group, into a compacted table."""
    table = gate_table(spark, path, group, every)
    return lambda batch, batch_id: table.write(batch.groupBy(group).agg(F.sum("tracked").alias("tracked"), F.sum("ready").alias("ready")), batch_id)


def gate_state(spark: SparkSession, path: str, group: str = "analysis_id") -> DataFrame:
    """(group, tracked_count, ready_count, done) now."""
    t = gate_table(spark, path, group).read()
    return t.select(group, F.col("tracked").alias("tracked_count"), F.col("ready").alias("ready_count"),
                    (F.col("tracked") == F.col("ready")).alias("done"))


# --- stale detection --------------------------------------------------------

STALE, LATE = "stale", "late"
_MICROS = 1_000_000


def stale_batch(events: DataFrame, timeout: str, now: Column | None = None, key: str = "analysis_id") -> DataFrame:
    """Batch twin: (key, started_at) of runs that were not finished within ``timeout`` (judged at ``now``, default the
    latest event). A PENDING opens a run if none is open; SUCCESS or FAILURE within the time closes it; else it ends,
    stale, at its deadline, and a later PENDING opens the next run."""
    now_col = now if now is not None else events.agg(F.max("ts").alias("m")).select("m").scalar()
    wait = F.expr(f"INTERVAL {timeout}")
    runs = events.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "status"))).alias("es"))
    none = F.lit(None).cast("timestamp")
    state = F.struct(none.alias("started"), F.array().cast("array<timestamp>").alias("stale"))

    def step(acc: Column, e: Column) -> Column:
        over = F.coalesce(e["ts"] > acc["started"] + wait, F.lit(False))
        still = F.when(over, none).otherwise(acc["started"])
        started = (F.when(still.isNull(), F.when(e["status"] == PENDING, e["ts"]))
                   .when(e["status"].isin(TERMINAL), none).otherwise(still))
        return F.struct(started.alias("started"), F.when(over, F.concat(acc["stale"], F.array(acc["started"])))
                        .otherwise(acc["stale"]).alias("stale"))

    end = runs.select(key, F.aggregate("es", state, step).alias("r")).select(key, F.when(
        F.col("r.started") + wait < now_col, F.concat("r.stale", F.array("r.started"))).otherwise(F.col("r.stale")).alias("s"))
    return end.select(key, F.explode("s").alias("started_at"))


#: Buckets that share out the keys of ``stale_stream``, and what a row of a bucket's state is: an event of no matter, one that
#: opens a run, one that ends it, the start of an open run. Events without an id come last among those of a time.
STALE_BUCKETS = 256
_OTHER, _OPENS, _ENDS, _OPEN_RUN = range(4)
_NO_ID = np.iinfo(np.int64).max


_HELD = pa.schema([("key", pa.string()), ("us", pa.int64()), ("event_id", pa.int64()), ("kind", pa.int8())])


class _Runs(StatefulProcessor):
    """State of a bucket of keys: events that the watermark has not passed, and starts of open runs, each as an Arrow stream, and
    one timer for the first time at which any of them changes. Events are taken in order of their time once the watermark has
    passed them, so the verdicts do not depend on how batches are cut. A key without either has no row, a bucket without rows
    no state."""

    def __init__(self, key: str, wait: int):
        self.key, self.wait = key, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.runs = handle.getValueState("waiting", "rows binary"), handle.getValueState("runs", "rows binary")

    def _said(self, verdict: str, keys: list, started: list, us: list, event_id: list) -> pd.DataFrame:
        def when(values: list) -> pd.Series:
            return pd.to_datetime(pd.Series(values, dtype="Int64"), unit="us")
        none = [None] * len(keys)
        return pd.DataFrame({self.key: pd.Series(keys, dtype=object), "verdict": verdict, "started_at": when(started or none),
                             "event_id": pd.Series(event_id or none, dtype="Int64"), "ts": when(us or none)})

    def _judge(self, now: int, rows: pd.DataFrame, timer: int | None) -> Iterator[pd.DataFrame]:
        """Take the events up to ``now`` out of ``rows`` (key, us, event_id, kind) and keep the rest; yields stale runs."""
        code, names = pd.factorize(rows["key"], use_na_sentinel=False)
        kind = rows["kind"].to_numpy()
        order = np.lexsort((rows["event_id"].to_numpy(), rows["us"].to_numpy(), kind != _OPEN_RUN, code))
        rows, code, kind = rows.iloc[order], code[order], kind[order]
        at = np.flatnonzero((rows["us"].to_numpy() <= now) | (kind == _OPEN_RUN))
        ends_of = np.flatnonzero(np.diff(code[at], append=-1)) + 1 if len(at) else []
        us, first = rows["us"].to_numpy()[at].tolist(), kind[at].tolist()

        def following(what: int) -> list[int]:
            """For each place the next row of a kind from there on."""
            here = np.append(np.where(kind[at] == what, np.arange(len(at)), len(at)), [len(at)] * 2)
            return np.minimum.accumulate(here[::-1])[::-1].tolist()

        opens, ends, stale, running, lo = following(_OPENS), following(_ENDS), [], [], 0
        for hi in map(int, ends_of):
            run = lo if first[lo] == _OPEN_RUN else opens[lo]
            while run < hi:  # a turn for each run, not for each event
                deadline = us[run] + self.wait
                end = bisect.bisect_right(us, deadline, run + 1, hi)
                if ends[run + 1] < end:
                    run = opens[ends[run + 1] + 1]
                elif deadline < now:
                    stale.append(run)
                    run = opens[end]
                else:
                    running.append(run)
                    break
            lo = hi
        if stale:
            yield self._said(STALE, names[code[at[stale]]].tolist(), [us[i] for i in stale], [], [])
        left, runs = rows[(rows["us"].to_numpy() > now) & (kind != _OPEN_RUN)], rows.iloc[at[running]].assign(kind=np.int8(_OPEN_RUN))
        due = self._due(left, runs)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is not None and timer != due:
            self.handle.registerTimer(due)
        self._keep(self.waiting, left)
        self._keep(self.runs, runs)

    def _due(self, waiting: pd.DataFrame, runs: pd.DataFrame) -> int | None:
        """The time, in milliseconds, at which the first of them changes."""
        first = [int(x.min()) + more for x, more in ((waiting["us"], 0), (runs["us"], self.wait)) if len(x)]
        return min(first) // 1000 + 1 if first else None

    @staticmethod
    def _keep(state, rows: pd.DataFrame) -> None:
        if not len(rows):
            state.clear()
            return
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _HELD, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
            stream.write_table(pa.Table.from_pandas(rows, schema=_HELD, preserve_index=False))
        state.update((out.getvalue().to_pybytes(),))

    def _kept(self) -> tuple[pd.DataFrame, int | None]:
        """The rows that are held, and the timer that is set."""
        waiting, runs = ((pa.ipc.open_stream(bytes(x.get()[0])).read_all() if x.exists() else _HELD.empty_table()).to_pandas()
                         for x in (self.waiting, self.runs))
        return pd.concat([waiting, runs]), self._due(waiting, runs)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - names are Spark's
        now = timerValues.getCurrentWatermarkInMs() * 1000
        come = pd.concat(list(rows))
        late = come[come["us"] < now]
        if len(late):
            yield self._said(LATE, late["key"].tolist(), [], late["us"].tolist(), late["event_id"].tolist())
        come = come[come["us"] >= now]
        kind = np.where(come["status"] == PENDING, _OPENS, np.where(come["status"].isin(TERMINAL), _ENDS, _OTHER))
        come = pd.DataFrame({"key": come["key"].to_numpy(), "us": come["us"].to_numpy().astype(np.int64),
                             "event_id": come["event_id"].fillna(_NO_ID).to_numpy().astype(np.int64), "kind": kind.astype(np.int8)})
        kept, timer = self._kept()
        yield from self._judge(now, pd.concat([kept, come]) if len(kept) else come, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        kept, timer = self._kept()
        # Spark itself takes away the timer that has come
        timer = None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer
        yield from self._judge(timerValues.getCurrentWatermarkInMs() * 1000, kept, timer)

    def close(self) -> None:
        pass


def stale_stream(events: DataFrame, timeout: str, delay: str, key: str = "analysis_id", buckets: int = STALE_BUCKETS) -> DataFrame:
    """(key, verdict, started_at, event_id, ts): ``stale`` rows are the runs of ``stale_batch``, reported when the
    watermark passes their deadline; ``late`` rows are events that came more than ``delay`` after a later one and
    therefore did not count. Timers are event-time timers; a key without open run or waiting events holds no state.
    Keys are dealt over ``buckets`` by a hash, and a bucket's keys are judged together; a stream keeps the number it began with.
    Sets the session's state store to RocksDB, which keyed states with timers need."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    wait = int(pd.Timedelta(timeout).total_seconds() * _MICROS)
    # the time goes in as a number, so that Spark hands late events to the processor instead of dropping them
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
    timed = events.withWatermark("ts", delay).select(bucket, F.col(key).cast("string").alias("key"), F.unix_micros("ts").alias("us"),
                                                     "event_id", "status")
    return timed.groupBy("bucket").transformWithStateInPandas(
        _Runs(key, wait), f"{key} string, verdict string, started_at timestamp, event_id long, ts timestamp", "append", "eventtime")


# --- harvest ----------------------------------------------------------------

def harvest_sink(results_path: str, status_path: str, key: str = "analysis_id",
                 payload: str = "payload") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: write results FIRST, then the SUCCESS markers, both
    keyed by the batch id (a replay rewrites the same folders). A SUCCESS poll
    without a payload, or with an empty one, fails the batch before anything is written."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        done = batch.where(F.col("state") == SUCCESS)
        checked = done.withColumn(payload, F.coalesce(F.nullif(F.trim(payload), F.lit("")), F.raise_error(
            F.concat(F.lit("no result came with the finished analysis "), F.col(key)))))
        checked.select(key, "event_id", payload).write.mode("overwrite").parquet(
            f"{results_path}/batch_id={batch_id}")
        (done.select(key, "event_id", F.lit(SUCCESS).alias("status"))
         .write.mode("overwrite").parquet(f"{status_path}/batch_id={batch_id}"))
    return sink


# SURVEY §2.J names
stale = stale_stream
harvest = harvest_sink
