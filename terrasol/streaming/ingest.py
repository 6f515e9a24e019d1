"""K1: incremental ingest as a Structured Streaming job.

New document files are picked up by the file source, cleaned and measured,
and every micro-batch is upserted by key into a table of versioned snapshots
(``foreachBatch``; only the buckets that the batch touches are written, once, and a
manifest is swapped last).  Rows that cannot be taken go to a side table with the
reason.  Re-running processes only files that arrived since the last run (the source
offsets live in the stream checkpoint), which is the "skip what is already there /
resume" behaviour of the batch scripts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasol.functions.measure import document_measures
from terrasol.functions.text import clean_text
from terrasol.session import checkpoint_dir
from terrasol.sources.snapshots import RejectTable, SnapshotTable
from terrasol.sources.tables import stream_source


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/terrasol-{name}-{uuid.uuid4().hex}"


#: The micro-batch that brought a row: the last of the order columns, so that of rows alike in the others the later arrival is newer.
ARRIVAL = "_batch"
#: Column that says why a row cannot be taken (null: it can).
REASON = "_reason"


def upsert_batch(target: str, key: str, buckets: int = 64, order: tuple[str, ...] = (), rejects: str | None = None):
    """foreachBatch body: per key the newest row by ``order``, stored or arriving, is kept.

    Without order columns a row of a later batch replaces that of an earlier one.  With
    ``rejects``, rows with a ``_reason`` go to that table instead.  A replayed batch id
    changes nothing, and a failure at any point leaves the table as it was."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, good = batch.sparkSession, batch.persist()   # read several times (sinks, touched buckets, merge), measured once
        try:
            if rejects:
                RejectTable(spark, rejects).put(batch.where(F.col(REASON).isNotNull()), batch_id)
                good = batch.where(F.col(REASON).isNull()).drop(REASON)
            stored = SnapshotTable(spark, target, key, buckets, (*order, ARRIVAL))
            stored.merge(good.withColumn(ARRIVAL, F.lit(batch_id).cast("long")), batch_id)
        finally:
            batch.unpersist()
    return run


def stored_rows(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The table that ``upsert_batch`` keeps at ``target``."""
    return SnapshotTable(spark, target, key).read().drop(ARRIVAL)


def ingest_documents(spark: SparkSession, source_dir: str, glob: str, body_expr: str | None = None,
                     key: str = "doc_id", max_files_per_trigger: int | None = None, partitions: int | None = None,
                     buckets: int = 64, target: str | None = None, checkpoint: str | None = None,
                     order: tuple[str, ...] = (), rejects: str | None = None) -> DataFrame:
    """Stream the documents under ``source_dir`` (files, or folders of files, matching ``glob``) to a
    measured table, available-now trigger; returns the target table.

    ``order`` names columns of the documents that tell which row of a key is newer; they
    are stored with the measures.  A caller that names ``target`` and ``checkpoint``
    resumes: the next call with the same two folders reads only files that arrived
    since.  With ``rejects``, rows without a key or without any text after cleaning are
    written to that side table (``RejectTable``) instead of the target."""
    path, options = stream_source(spark, source_dir, glob)
    schema = spark.read.options(**options).parquet(path).schema
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(path)
    body = F.expr(body_expr) if body_expr else F.col("text")
    # hash-partition each micro-batch by key: spreads the regex work of a few
    # large files over the cluster and co-locates the upsert keys
    n = partitions or spark.sparkContext.defaultParallelism
    cleaned = stream.select(key, *order, clean_text(body).alias("pdf_text")).repartition(n, key)
    blank = F.trim(F.coalesce("pdf_text", F.lit(""))) == ""
    reason = [F.when(F.col(key).isNull(), "no key").when(blank, "no text").alias(REASON)] if rejects else []
    measured = document_measures(cleaned, "pdf_text").select(key, *order, F.length("pdf_text").alias("n_chars_clean"),
                                                             "land_surface_ha", "power_mwc", *reason)
    target = target or work_dir(spark, "ingest-target")
    q = (measured.writeStream.foreachBatch(upsert_batch(target, key, buckets, order, rejects))
         .option("checkpointLocation", checkpoint or work_dir(spark, "ingest-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stored_rows(spark, target, key)
