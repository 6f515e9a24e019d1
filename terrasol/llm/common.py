"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasol.session import checkpoint_dir

#: A word: any run without the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that travel to Python at a time: texts are long, and the default of 10,000 rows fills a worker and the buffers before it.
ARROW_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches of this session to at most ``ARROW_ROWS`` rows (results do not depend on it)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


class Scratch:
    """Tables written once under the shared checkpoint folder.

    Writing cuts the lineage: a table survives lost executors and is never
    computed twice.  ``drop`` deletes a table that later steps do not read; what
    a result still reads is deleted when Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        small_batches(spark)
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._end)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _end(self) -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            self.drop("")

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(col="doc_id"):
    """crc32 of the id's decimal text (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def bitmap(keys: DataFrame, *cols: str, bits: int = 24) -> DataFrame:
    """``_slot, _bits``: which hashes of the key columns occur, as 2^``bits`` bits in at most 2^(``bits`` - 6) rows.

    Its size is bounded whatever the keys hold, so it may be broadcast.
    """
    h = F.pmod(F.xxhash64(*cols), F.lit(1 << bits))
    slots = keys.select(F.shiftright(h, 6).alias("_slot"), (h % 64).cast("int").alias("_bit"))
    return slots.groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def marked(rows: DataFrame, found: DataFrame, *cols: str, bits: int = 24) -> DataFrame:
    """All rows with ``_maybe``: False if the key columns are certainly not among those of a ``bitmap``.

    An exact join afterwards has to move only the rows that may have a partner.
    """
    h = F.pmod(F.xxhash64(*cols), F.lit(1 << bits))
    out = rows.withColumn("_slot", F.shiftright(h, 6)).withColumn("_bit", (h % 64).cast("int")).join(F.broadcast(found), "_slot", "left")
    return out.withColumn("_maybe", F.coalesce(F.expr("shiftrightunsigned(_bits, _bit) & 1L"), F.lit(0)) == 1).drop("_slot", "_bit", "_bits")


def release() -> None:
    """Give memory that an ended iterator held back to the system: Python workers wait for their next task with what they keep."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(run):
    """The function of an Arrow iterator, releasing memory when the iterator ends."""
    @functools.wraps(run)
    def wrapped(it):
        yield from run(it)
        release()
    return wrapped


def running(steps: Column, group: int = 512) -> Column:
    """Sums of all elements before each one; two levels keep a long array's work far below its square."""
    add = lambda a, x: a + x
    zero = F.lit(0)
    starts = F.sequence(zero, F.floor(F.size(steps) / group).cast("int"))
    groups = F.transform(starts, lambda j: F.aggregate(F.slice(steps, j * group + 1, F.lit(group)), zero, add))
    offsets = F.transform(starts, lambda j: F.aggregate(F.slice(groups, F.lit(1), j), zero, add))
    return F.transform(steps, lambda x, i: F.get(offsets, F.floor(i / group).cast("int")) + F.aggregate(
        F.slice(steps, F.floor(i / group).cast("int") * group + 1, i % group), zero, add))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, nulls as the empty text."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


class WordIds(dict):
    """Memo word -> 64-bit hash; holds at most ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        import xxhash
        self._hash, self._limit = xxhash.xxh3_64_intdigest, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        h = self[word] = self._hash(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (vectorised, wraps on overflow)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(docs: DataFrame) -> tuple[int, int]:
    """(rows, code points of text) of a documents table."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("c")).first()
    return r.n, r.c


def batches(it: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded row count."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
