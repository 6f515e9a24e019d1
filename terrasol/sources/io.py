"""Scans and sinks.

Everything writes to / reads from paths the caller names; helper folders are
created under the shared ``spark.checkpoint.dir`` (never a machine-local
temporary folder on a cluster).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrasol.session import checkpoint_dir

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    # keep blanks inside names as they are (the gazetteer strips them itself)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | str, bad_records: bool = False) -> DataFrame:
    """CSV with header and an explicit schema, so codes such as ``2A`` stay strings.
    With ``bad_records`` malformed lines are kept in ``_corrupt_record`` (S13)."""
    r = spark.read.options(**CSV_OPTIONS)
    if bad_records:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        schema = StructType(list(schema.fields)).add("_corrupt_record", "string")
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, no index column."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_layers(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Every Parquet file of a folder, with the file stem as ``filename`` (S4);
    ``pattern`` filters file names (glob, e.g. ``artif_*``)."""
    r = spark.read
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    df = r.parquet(path)
    name = F.col("_metadata.file_name")
    return df.withColumn("filename", F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1))


def write_layers(df: DataFrame, path: str, partition_by: str) -> None:
    """Idempotent layer load: re-running replaces the partitions it writes
    instead of appending duplicates (dynamic partition overwrite) (S4 S9)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_by).parquet(path))


def write_runs(df: DataFrame, path: str, partition_cols=("model_id", "run_ts")) -> None:
    """Per-model, per-run Parquet output folders."""
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Evaluation report as (valid) JSON lines."""
    df.write.mode("overwrite").json(path)


def save_table(df: DataFrame, name: str, if_exists: str = "error") -> None:
    """CTAS modes: ``error`` (CREATE), ``ignore`` (IF NOT EXISTS), ``overwrite`` (OR REPLACE)."""
    modes = {"error": "errorifexists", "ignore": "ignore", "overwrite": "overwrite"}
    df.write.mode(modes[if_exists]).saveAsTable(name)


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of work whose key has no finished row (J7): a stopped run goes on where it was."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def file_inventory(spark: SparkSession, path: str, glob: str = "*.{pdf,PDF}") -> DataFrame:
    """Name / size / modification time of the files of a folder (S5); contents
    are not decoded (text arrives as a column)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), F.col("length").alias("size"),
                        "modificationTime")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared checkpoint folder and read back: what follows may read
    them many times, and a lost executor does not compute them anew."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/terrasol-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_rejects(df: DataFrame, path: str, reason: str = "_reason") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason and rows with one, each written to a table of its own under ``path`` and read back.

    The rows are computed once: one write, partitioned by whether there is a reason."""
    flag = "_rejected"
    while flag in df.columns:
        flag += "_"
    df.withColumn(flag, F.col(reason).isNotNull()).write.mode("overwrite").partitionBy(flag).parquet(path)
    both = df.sparkSession.read.schema(df.withColumn(flag, F.lit(True)).schema).parquet(path)
    return both.where(~F.col(flag)).drop(flag, reason), both.where(F.col(flag)).drop(flag)
