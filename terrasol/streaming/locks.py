"""K2 as a stream: locks in keyed state, with event-time timers per document.

Events wait in state until the watermark has passed them, then they are folded in
order of time by the rule of :mod:`terrasol.operators.locks`; a timer per waiting
event and per held lock wakes a document up, so a lock expires without any further
event.  The batch twin is :func:`terrasol.operators.locks.lock_life_cycle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from terrasol.operators.locks import TIMEOUT, TIMEOUT_US, Lock, advance, expire, from_micros, micros
from terrasol.sources.tables import stream_source
from terrasol.streaming.claims import event_time
from terrasol.streaming.ingest import work_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "k long, u long, us long, action string, id long, outcome string"


class LockProcessor(StatefulProcessor):
    """One document: its lock and the events that the watermark has not passed."""

    def init(self, handle):
        self.handle = handle
        self.lock = handle.getValueState("lock", "holder long, at long, validated boolean")
        self.waiting = handle.getListState("waiting", "us long, id long, u long, action string")

    def handleInputRows(self, key, rows, timerValues):
        new = [(r.us, r.id, r.u, r.action) for r in rows if r.u is not None and r.us is not None]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(min(n[0] for n in new) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(w) for w in self.waiting.get())
        lock = Lock(*self.lock.get()) if self.lock.exists() else Lock()
        out = []

        def ran_out(gone):
            if gone:
                out.append(Row(k=key[0], u=gone[1], us=gone[0], action=TIMEOUT, id=None, outcome="expired"))

        ready = [w for w in waiting if w[0] <= passed]
        for us, i, u, action in ready:
            lock, gone = expire(lock, us)
            ran_out(gone)
            lock, outcome = advance(lock, us, u, action)
            out.append(Row(k=key[0], u=u, us=us, action=action, id=i, outcome=outcome))
        lock, gone = expire(lock, passed)
        ran_out(gone)
        left = waiting[len(ready):]
        if ready:
            self.waiting.put(left) if left else self.waiting.clear()
        self.lock.update(tuple(lock))
        if left:
            self.handle.registerTimer(left[0][0] // 1000)
        if lock.holder is not None:
            self.handle.registerTimer(-(-(lock.at + TIMEOUT_US) // 1000))
        return iter(out)

    def close(self):
        pass


def lock_stream(events: DataFrame, key: str = "doc_id", user: str = "user_id", ts: str = "ts", action: str = "action",
                event_id: str = "event_id", watermark: str = "2 hours") -> DataFrame:
    """Streaming twin of ``lock_life_cycle`` (columns ``k, u, us, action, id, outcome``; ids are longs)."""
    dtype = dict(events.dtypes)[ts]
    timed = events.select(F.col(key).cast("long").alias("k"), F.col(user).cast("long").alias("u"), micros(ts, dtype).alias("us"), F.col(action).alias("action"),
                          F.col(event_id).cast("long").alias("id"), (event_time(ts) if dtype == "timestamp_ntz" else F.col(ts)).alias("_et"))
    return timed.withWatermark("_et", watermark).groupBy("k").transformWithState(
        statefulProcessor=LockProcessor(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


def run_locks(spark: SparkSession, source_dir: str, glob: str, select_expr: list[str], ts: str = "ts",
              watermark: str = "2 hours", max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the lock stream over the files once (available-now) to its end; returns the outcomes.

    The end of the input is an event without document long after all others: it moves
    the watermark past every event and every lock.
    """
    path, options = stream_source(spark, source_dir, glob)
    given = spark.read.options(**options).parquet(path)
    dtype = dict(given.dtypes)[ts]
    tail, out, ckpt = (work_dir(spark, n) for n in ("locks-tail", "locks-out", "locks-ckpt"))
    given.limit(0).write.parquet(tail)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)

    def run() -> None:
        def read(path, options):
            reader = spark.readStream.schema(given.schema).options(**options)
            return (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader).parquet(path)

        events = read(path, options).unionByName(read(tail, {"pathGlobFilter": "*.parquet"})).selectExpr(*select_expr)
        (lock_stream(events, watermark=watermark).writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)   # keyed state with timers needs it
    try:
        run()
        last = given.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema.fields if f.name != ts]
        end = last.select((F.col(ts) + F.expr("INTERVAL 3650 DAYS")).cast(given.schema[ts].dataType).alias(ts), *others)
        end.select(*given.columns).write.mode("append").parquet(tail)
        run()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    done = spark.read.schema(OUTPUT).parquet(out).where("k is not null")
    return done.select(F.col("k").alias("doc_id"), F.col("u").alias("user_id"), from_micros("us", dtype).alias("ts"), F.col("id").alias("event_id"), "action", "outcome")
