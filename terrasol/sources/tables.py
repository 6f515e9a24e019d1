"""Driver table access: one parquet file per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy row-local work over the cluster.

    A scan yields one partition per file split; a small or unsplittable file
    (one parquet row group) gives a single task.  When the scan has fewer
    partitions than the cluster's parallelism we round-robin repartition the
    *already projected* rows; on large inputs the scan is split finely and this
    is a no-op (no extra shuffle).
    """
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(target) if n < target else df


def stream_source(spark: SparkSession, source_dir: str, glob: str) -> tuple[str, dict[str, str]]:
    """Path and reader options of the files ``glob`` under ``source_dir``.

    A table may be one file or a folder of files: ``pathGlobFilter`` is matched against
    the files' own names and would leave out all files of a folder, so a folder that
    matches is read as such.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{source_dir.rstrip('/')}/{glob}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    if any(s.isDirectory() for s in found or ()):
        return path.toString(), {}
    return source_dir, {"pathGlobFilter": glob}
