"""Table profile (A4, ``SUMMARIZE``): one aggregation pass, then long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def profile(df: DataFrame, columns: list[str] | None = None, exact_distinct: bool = False,
            quantiles: bool = False, accuracy: int = 10000) -> DataFrame:
    """Per column of any type: type, min and max, distinct count, avg, sample std,
    count, null %, and optionally approximate q25/q50/q75.

    Numeric columns fill ``min, max`` (and avg, std, quantiles), all others
    ``min_text, max_text``.  All statistics of all columns come from a single
    ``agg`` (one scan, partial aggregation); distinct counts are approximate like
    those of ``SUMMARIZE``.  ``exact_distinct`` shuffles the distinct (column,
    value) pairs instead and is meant for bounded tables."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or list(kinds)
    numeric = {c: isinstance(kinds[c], NumericType) for c in cols}
    none = {"double": F.lit(None).cast("double"), "string": F.lit(None).cast("string")}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double") if numeric[c] else F.col(f"`{c}`").cast("string")
        distinct = F.lit(None).cast("long") if exact_distinct else F.approx_count_distinct(x)
        aggs += [F.min(x).alias(f"{i}__min"), F.max(x).alias(f"{i}__max"), distinct.alias(f"{i}__nd"),
                 F.count(x).alias(f"{i}__cnt"), F.count("*").alias(f"{i}__rows")]
        if numeric[c]:
            aggs += [F.avg(x).alias(f"{i}__avg"), F.stddev_samp(x).alias(f"{i}__std")]
            if quantiles:
                aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{i}__q"))
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        at = lambda name, kind, i=i, c=c: F.col(f"{i}__{name}") if numeric[c] == (kind == "double") else none[kind]
        fields = [F.lit(c).alias("column_name"), F.lit(kinds[c].simpleString()).alias("column_type"),
                  at("min", "double").alias("min"), at("max", "double").alias("max"),
                  at("min", "string").alias("min_text"), at("max", "string").alias("max_text"),
                  F.col(f"{i}__nd").alias("n_distinct"), (F.col(f"{i}__avg") if numeric[c] else none["double"]).alias("avg"),
                  (F.col(f"{i}__std") if numeric[c] else none["double"]).alias("std"), F.col(f"{i}__cnt").alias("count"),
                  (F.lit(100.0) * (F.col(f"{i}__rows") - F.col(f"{i}__cnt")) / F.col(f"{i}__rows")).alias("null_percentage")]
        if quantiles:
            fields += [(F.col(f"{i}__q")[k] if numeric[c] else none["double"]).alias(n) for k, n in enumerate(("q25", "q50", "q75"))]
        rows.append(F.struct(*fields))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if exact_distinct:
        # all columns in one shuffle: stack (column, value) pairs, de-duplicate them
        # (map-side first), count per column
        value = lambda c: (F.col(f"`{c}`").cast("double") if numeric[c] else F.col(f"`{c}`")).cast("string")
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), value(c).alias("v")) for c in cols])).alias("s"))
        nd = (stacked.select("s.*").where(F.col("v").isNotNull()).distinct()
                     .groupBy("column_name").agg(F.count("*").alias("_nd")))
        out = (out.join(nd, "column_name", "left")
                  .withColumn("n_distinct", F.coalesce(F.col("_nd"), F.lit(0)).cast("long")).drop("_nd")
                  .select(*[c for c in out.columns]))
    return out


#: Sizes of the sketches: 2^HLL_K registers (standard error about 1.04 / sqrt of that), KLL_K (rank error about 1.33 % at 200).
HLL_K, KLL_K = 14, 400
#: Bounds that the read-out of a merged profile keeps: relative error of a distinct count, rank error of a quantile.
DISTINCT_ERROR, RANK_ERROR = 0.04, 0.02


def sketch(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with everything that a profile needs and that merges (A4).

    Counts, least and greatest value, sum and sum of squares, an HLL sketch of the
    values and, for numeric columns, a KLL sketch: a few kilobytes per column, whatever
    the table holds, made by partial aggregation in one scan.  Increments are sketched
    apart, stored, and merged later without reading any of their rows again.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or list(kinds)
    numeric = {c: isinstance(kinds[c], NumericType) for c in cols}
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(cols):
        x, text = F.col(f"`{c}`").cast("double"), F.col(f"`{c}`").cast("string")
        aggs += [F.count(text).alias(f"{i}__count"), F.min(text).alias(f"{i}__min_text"), F.max(text).alias(f"{i}__max_text"),
                 F.hll_sketch_agg(text, HLL_K).alias(f"{i}__hll")]
        if numeric[c]:
            aggs += [F.min(x).alias(f"{i}__min"), F.max(x).alias(f"{i}__max"), F.sum(x).alias(f"{i}__sum"), F.sum(x * x).alias(f"{i}__squares"),
                     F.kll_sketch_agg_double(x, KLL_K).alias(f"{i}__kll")]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        at = lambda name, kind, i=i, c=c: (F.col(f"{i}__{name}") if numeric[c] else F.lit(None)).cast(kind).alias(name)
        text = lambda name, i=i, c=c: (F.lit(None) if numeric[c] else F.col(f"{i}__{name}")).cast("string").alias(name)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c].simpleString()).alias("column_type"), F.col("rows"), F.col(f"{i}__count").alias("count"),
                             text("min_text"), text("max_text"), F.col(f"{i}__hll").alias("hll"), at("min", "double"), at("max", "double"), at("sum", "double"),
                             at("squares", "double"), at("kll", "binary")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Sketch rows of any number of increments as one row per column."""
    return sketches.groupBy("column_name", "column_type").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_union_agg("hll").alias("hll"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares"),
        F.kll_merge_agg_double("kll").alias("kll"))


def read_sketches(merged: DataFrame) -> DataFrame:
    """The profile of sketch rows: the columns of ``profile`` with quartiles and approximate distinct counts.

    A distinct count is within ``DISTINCT_ERROR`` and a quartile's rank within
    ``RANK_ERROR`` (about four standard errors of the sketches' sizes).
    """
    n, empty = F.col("count"), F.col("count") == 0
    spread_ = (F.col("squares") - F.col("sum") * F.col("sum") / n) / (n - 1)
    quantile = lambda q: F.when(F.col("min").isNotNull(), F.kll_sketch_get_quantile_double("kll", F.lit(q)))
    return merged.select(
        "column_name", "column_type", "min", "max", "min_text", "max_text", F.when(empty, 0).otherwise(F.hll_sketch_estimate("hll")).cast("long").alias("n_distinct"),
        F.when(~empty, F.col("sum") / n).alias("avg"), F.when(n > 1, F.sqrt(F.greatest(spread_, F.lit(0.0)))).alias("std"), "count",
        (F.lit(100.0) * (F.col("rows") - n) / F.col("rows")).alias("null_percentage"), *(quantile(q).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)))
