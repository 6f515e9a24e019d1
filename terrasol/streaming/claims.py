"""K2: document claim sessions over a claim-event stream.

Events (doc, user, ts) arrive on a stream; a claim refreshed within 60 minutes
continues, a gap of 60 minutes or more starts a new claim.  ``session_window``
with a watermark keeps bounded state: a session is emitted (append mode) once
the watermark has passed its end, late events beyond the watermark are
dropped.  The batch twin is :func:`terrasol.operators.annotate.claim_sessions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasol.operators.annotate import CLAIM_GAP
from terrasol.sources.tables import stream_source
from terrasol.streaming.ingest import work_dir


def event_time(ts: str) -> F.Column:
    """Instant of a timestamp column; a wall-clock (NTZ) value is read as UTC so the
    result does not depend on the session time zone."""
    return F.expr(f"make_timestamp(year({ts}), month({ts}), day({ts}), hour({ts}), minute({ts}), "
                  f"date_part('SECOND', {ts}), 'UTC')")


def claim_sessions_stream(events: DataFrame, key: str = "doc_id", user: str = "user_id", ts: str = "ts",
                          watermark: str = "2 hours", gap: str = CLAIM_GAP) -> DataFrame:
    """Streaming aggregation: closed claim sessions per (document, user)."""
    timed = events.withColumn("_et", event_time(ts) if dict(events.dtypes)[ts] == "timestamp_ntz" else F.col(ts))
    w = F.session_window(F.col("_et"), gap)
    return (timed.withWatermark("_et", watermark)
                  .groupBy(F.col(key), F.col(user), w.alias("w"))
                  .agg(F.min(ts).alias("claim_start"), F.max(ts).alias("last_refresh"),
                       F.count("*").alias("n_events")))


def run_claims(spark: SparkSession, source_dir: str, glob: str, select_expr: list[str],
               watermark: str = "2 hours", ts: str = "ts", flush: bool = True) -> DataFrame:
    """Run the claim stream over the files once (available-now) into Parquet and
    return the sessions.

    ``flush`` ends the input: a last event long after all others moves the
    watermark past every open session, so those are emitted too; the event itself
    opens a session that no watermark reaches."""
    path, options = stream_source(spark, source_dir, glob)
    given = spark.read.options(**options).parquet(path)
    tail, out, ckpt = (work_dir(spark, n) for n in ("claims-tail", "claims-out", "claims-ckpt"))
    given.limit(0).write.parquet(tail)

    def run() -> None:
        read = lambda path, options: spark.readStream.schema(given.schema).options(**options).parquet(path)
        events = read(path, options).unionByName(read(tail, {"pathGlobFilter": "*.parquet"})).selectExpr(*select_expr)
        q = (claim_sessions_stream(events, watermark=watermark).drop("w")
             .writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    if flush:
        last = given.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema.fields if f.name != ts]
        end = last.select((F.col(ts) + F.expr("INTERVAL 3650 DAYS")).cast(given.schema[ts].dataType).alias(ts), *others)
        end.select(*given.columns).write.mode("append").parquet(tail)
        run()
    return spark.read.parquet(out)
