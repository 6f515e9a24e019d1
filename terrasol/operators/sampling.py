"""Stratified train/test split (W3) without a window over a whole stratum.

Rows are ordered inside their stratum by a seeded md5 of the key; the test set
is the first ``ceil(fraction * n)`` rows of each stratum.  Instead of ranking
the whole stratum (one task per stratum, unbounded under skew), a 20-bit
prefix of the hash bins every row; per-(stratum, bin) counts are aggregated
map-side, a cumulative sum over at most 2^20 bins per stratum finds the bin
holding the cut, and only rows of that single bin are ranked exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_BINS_HEX = 5  # 20-bit prefix → about a million bins per stratum


def stratified_split(df: DataFrame, key: str, stratum: str, fraction: float = 0.2,
                     seed: str = "42") -> DataFrame:
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    rows = df.withColumn("_h", h).withColumn("_bin", F.conv(F.substring("_h", 1, N_BINS_HEX), 16, 10).cast("int"))
    counts = rows.groupBy(stratum, "_bin").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(stratum).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = (counts.withColumn("_cum", F.sum("_n").over(w))
                   .withColumn("_total", F.sum("_n").over(Window.partitionBy(stratum)))
                   .withColumn("_k", F.ceil(F.col("_total") * F.lit(fraction)).cast("long")))
    # bins entirely inside the test set, the one bin crossing the cut, the rest.
    plan = sized.select(stratum, "_bin", (F.col("_cum") - F.col("_n")).alias("_before"), "_cum", "_k")
    tagged = rows.join(plan, [stratum, "_bin"])
    boundary = (F.col("_before") < F.col("_k")) & (F.col("_cum") > F.col("_k"))
    inside = tagged.where(boundary)
    rank = F.row_number().over(Window.partitionBy(stratum, "_bin").orderBy("_h", key))
    ranked = inside.withColumn("_is_test", (F.col("_before") + rank) <= F.col("_k"))
    simple = tagged.where(~boundary).withColumn("_is_test", F.col("_cum") <= F.col("_k"))
    out = simple.unionByName(ranked)
    return out.withColumn("split", F.when(F.col("_is_test"), "test").otherwise("train")).drop(
        "_h", "_bin", "_before", "_cum", "_k", "_is_test")
