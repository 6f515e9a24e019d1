"""Keyed tables as versioned snapshots, changed by atomic upserts.

A table is a folder of immutable versions and manifests::

    <path>/data/v00000003/_bucket=17/part-...   rows whose key falls into bucket 17
    <path>/manifest/00000003                    JSON: which version holds each bucket

A merge writes the touched buckets once, into a new version, then a manifest that
names them under a temporary name, and renames it last.  Readers go by the newest
manifest, so they see the table before a merge or after it, never in between, and a
merge that fails anywhere leaves only files that no manifest names.  A manifest holds
the id of the batch it took in: a replayed batch is not merged twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Manifests (and the versions they name) kept for readers that are still at work.
KEEP = 2
BUCKET = "_bucket"


class SnapshotTable:
    """Rows by key; of rows with one key the newest by the order columns is stored."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, order: tuple[str, ...] = ()):
        self.spark, self.path, self.key, self.buckets, self.order = spark, path.rstrip("/"), key, buckets, order

    # -- files ------------------------------------------------------------------
    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._hadoop(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        """Numbers of the stored manifests, oldest first."""
        return [int(n) for n in self._names(f"{self.path}/manifest") if n.isdigit()]

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest manifest (or one by number): ``batch, buckets, schema``; None before the first merge."""
        found = self.versions()
        if not found:
            return None
        n = found[-1] if version is None else version
        p, fs = self._hadoop(f"{self.path}/manifest/{n:08d}")
        stream = fs.open(p)
        try:
            raw = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return json.loads(raw)

    def _swap(self, version: int, manifest: dict) -> None:
        """Publish a manifest: written under another name, then renamed."""
        p, fs = self._hadoop(f"{self.path}/manifest/{version:08d}")
        tmp, _ = self._hadoop(f"{self.path}/manifest/.{version:08d}-{uuid.uuid4().hex}")
        stream = fs.create(tmp, True)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        if not fs.rename(tmp, p):
            raise RuntimeError(f"version {version} of {self.path} was published by another writer")

    # -- rows -------------------------------------------------------------------
    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        wanted = {int(b): v for b, v in manifest["buckets"].items() if buckets is None or int(b) in buckets}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/v{v:08d}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All stored rows of the newest version (or of a kept older one)."""
        manifest = self.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"no version of {self.path} is published")
        return self._rows(manifest)

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per key (null is a key as well): the greatest by the order columns, ties by all columns."""
        cols = sorted(rows.columns)
        row = F.max_by(F.struct(*rows.columns), F.struct(*self.order, *cols)).alias("_row")
        return rows.groupBy(F.col(self.key).alias("_key")).agg(row).select("_row.*")

    def merge(self, batch: DataFrame, batch_id: int | None = None) -> bool:
        """Upsert a batch; False if this batch id was taken in before (nothing is written).

        The stored rows of the touched buckets and the batch go through one
        aggregation by key, so an older row never replaces a newer one, whichever
        arrives last, and a hot key is reduced before the shuffle.  An empty batch
        publishes its id only.
        """
        versions = self.versions()
        manifest = self.manifest() or {"batch": None, "buckets": {}, "schema": batch.schema.jsonValue()}
        if batch_id is not None and manifest["batch"] is not None and batch_id <= manifest["batch"]:
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets))
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]   # at most `buckets` numbers
        version = (versions[-1] if versions else 0) + 1
        data = f"{self.path}/data/v{version:08d}"
        if touched:
            stored = self._rows(manifest, touched)
            rows = self.newest(stored.unionByName(batch.select(*stored.columns))).withColumn(BUCKET, bucket)
            rows.repartitionByRange(BUCKET, self.key).write.mode("overwrite").partitionBy(BUCKET).parquet(data)
        buckets = manifest["buckets"] | {str(b): version for b in touched}
        self._swap(version, {"batch": manifest["batch"] if batch_id is None else batch_id, "buckets": buckets, "schema": manifest["schema"]})
        self._clean()
        return True

    def _clean(self) -> None:
        """Delete manifests but the last ``KEEP`` and the versions that no kept manifest names."""
        versions = self.versions()
        named = {f"v{v:08d}" for n in versions[-KEEP:] for v in self.manifest(n)["buckets"].values()}
        for n in versions[:-KEEP]:
            p, fs = self._hadoop(f"{self.path}/manifest/{n:08d}")
            fs.delete(p, False)
        for name in self._names(f"{self.path}/data"):
            if name not in named:
                p, fs = self._hadoop(f"{self.path}/data/{name}")
                fs.delete(p, True)


class RejectTable:
    """Rows that a job could not take, with the reason, once per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, rejects: DataFrame, batch_id: int) -> None:
        """Store a batch's rejects; a replayed batch replaces its own."""
        rejects.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
