"""Multi-label evaluation.

Predictions arrive wide: ``{label}`` truth 0/1 and ``{label}_score`` columns.
The report is computed with two aggregations only: one global pass over
exploded (row, label) cells for per-label counts and one for the per-row
``samples`` average; everything after that is a handful of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label keys and their human names.
LABELS = {
    "surfaces_artificialisees": "Surfaces artificialisées",
    "surfaces_naturelles": "Surfaces naturelles",
    "surfaces_agricoles": "Surfaces agricoles",
    "surfaces_forestieres": "Surfaces forestières",
}
THRESHOLD_STEP = 0.05
N_THRESHOLDS = 20
DEFAULT_THRESHOLD = 0.5


def div0(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def check_score_columns(df: DataFrame, labels=LABELS) -> None:
    """Schema contract (P11): every truth and score column must exist."""
    missing = [c for k in labels for c in (k, k + "_score") if c not in df.columns]
    if missing:
        raise ValueError(f"missing prediction columns: {missing}")


def binarise(score: Column, threshold) -> Column:
    """Strictly greater than threshold; null score → 0."""
    return F.coalesce(score > threshold, F.lit(False)).cast("int")


def multi_hot_array(land_types: Column, labels=LABELS) -> list[Column]:
    """Truth columns from an array of label names by membership (P12, array form)."""
    return [F.coalesce(F.array_contains(land_types, name), F.lit(False)).cast("int").alias(key) for key, name in labels.items()]


def multi_hot(land_type: Column, labels=LABELS) -> list[Column]:
    """Truth columns from a ``land_type`` string by substring test."""
    return [land_type.contains(name).cast("int").alias(key) for key, name in labels.items()]


def _cells(df: DataFrame, labels, threshold) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.col(k).cast("int").alias("y"),
                                         binarise(F.col(k + "_score"), threshold).alias("p"))
                                for k in labels]))
    return df.select(cells.alias("c")).select("c.*")


def label_counts(df: DataFrame, labels=LABELS, threshold=DEFAULT_THRESHOLD) -> DataFrame:
    """tp/fp/fn/tn per label (A10)."""
    y, p = F.col("y"), F.col("p")
    return _cells(df, labels, threshold).groupBy("label").agg(
        F.sum((y * p)).cast("long").alias("tp"), F.sum(((1 - y) * p)).cast("long").alias("fp"),
        F.sum((y * (1 - p))).cast("long").alias("fn"), F.sum(((1 - y) * (1 - p))).cast("long").alias("tn"))


def classification_report(df: DataFrame, labels=LABELS, threshold=DEFAULT_THRESHOLD, by: tuple[str, ...] = ()) -> DataFrame:
    """Per-label and micro/macro/weighted/samples precision, recall, f1, support (A11),
    for each group of the ``by`` columns (none: one report).

    One aggregation over the input computes every count (tp/fp/fn per label and
    the per-row samples ratios); the eight report rows are then derived from that
    single row by projection, so the predictions are scanned once."""
    keys = list(labels)
    y = {k: F.col(k).cast("int") for k in keys}
    p = {k: binarise(F.col(k + "_score"), threshold) for k in keys}
    inter = reduce(lambda a, b: a + b, [y[k] * p[k] for k in keys])
    nt = reduce(lambda a, b: a + b, [y[k] for k in keys])
    npred = reduce(lambda a, b: a + b, [p[k] for k in keys])
    aggs = []
    for i, k in enumerate(keys):
        aggs += [F.sum(y[k] * p[k]).cast("long").alias(f"tp{i}"), F.sum((1 - y[k]) * p[k]).cast("long").alias(f"fp{i}"),
                 F.sum(y[k] * (1 - p[k])).cast("long").alias(f"fn{i}")]
    aggs += [F.avg(div0(inter, npred)).alias("sp"), F.avg(div0(inter, nt)).alias("sr"),
             F.avg(div0(2 * inter, nt + npred)).alias("sf"), F.sum(nt).cast("long").alias("st")]
    one = df.groupBy(*by).agg(*aggs)

    def prf(tp, fp, fn):
        return div0(tp, tp + fp), div0(tp, tp + fn), div0(2 * tp, 2 * tp + fp + fn)

    per = [prf(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}")) for i in range(len(keys))]
    sup = [F.col(f"tp{i}") + F.col(f"fn{i}") for i in range(len(keys))]
    total_sup = reduce(lambda a, b: a + b, sup)
    tp, fp, fn = (reduce(lambda a, b: a + b, [F.col(f"{c}{i}") for i in range(len(keys))]) for c in ("tp", "fp", "fn"))
    n = float(len(keys))

    def row(name, pr, rc, f1, support):
        return F.struct(F.lit(name).alias("label"), pr.alias("precision"), rc.alias("recall"), f1.alias("f1"),
                        support.cast("long").alias("support"))

    rows = [row(k, *per[i], sup[i]) for i, k in enumerate(keys)]
    rows.append(row("micro avg", *prf(tp, fp, fn), total_sup))
    rows.append(row("macro avg", *[reduce(lambda a, b: a + b, [m[j] for m in per]) / n for j in range(3)], total_sup))
    rows.append(row("weighted avg", *[div0(reduce(lambda a, b: a + b, [m[j] * sup[i] for i, m in enumerate(per)]),
                                           total_sup) for j in range(3)], total_sup))
    rows.append(row("samples avg", F.col("sp"), F.col("sr"), F.col("sf"), F.col("st")))
    return one.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def best_threshold(df: DataFrame, labels=LABELS) -> DataFrame:
    """Micro-F1 threshold sweep over t = i * 0.05, i = 0..19 in one pass.

    Each (row, label) cell is binned by how many candidate thresholds its score
    strictly exceeds (0..20, null → 0); TP and predicted-positive counts per bin
    are summed once (partial aggregation, at most 21 groups) and the counts at
    threshold i are the sums over bins > i.  First strict improvement wins, so
    ties go to the lowest threshold; 0.5 is kept when no F1 is positive.
    """
    cells = F.explode(F.array(*[F.struct(F.col(k).cast("int").alias("y"), F.col(k + "_score").alias("s"))
                                for k in labels]))
    s = F.col("s")
    exceeded = F.size(F.filter(F.sequence(F.lit(0), F.lit(N_THRESHOLDS - 1)),
                               lambda i: F.coalesce(s > i * F.lit(THRESHOLD_STEP), F.lit(False))))
    per_bin = (df.select(cells.alias("c")).select("c.*")
                 .groupBy(exceeded.alias("b"))
                 .agg(F.sum("y").cast("long").alias("pos"), F.count("*").cast("long").alias("n")))
    spark = df.sparkSession
    # each of the at most 21 bin rows is expanded to the 20 candidate thresholds
    sweep = (per_bin.select("*", F.explode(F.sequence(F.lit(0), F.lit(N_THRESHOLDS - 1))).alias("i"))
             .groupBy("i").agg(
                 F.sum(F.when(F.col("b") > F.col("i"), F.col("pos")).otherwise(0)).alias("tp"),
                 F.sum(F.when(F.col("b") > F.col("i"), F.col("n") - F.col("pos")).otherwise(0)).alias("fp"),
                 F.sum("pos").alias("P")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")
    f1 = sweep.select("i", div0(2 * tp, 2 * tp + fp + fn).alias("f1"))
    # the default row (0.5, F1 0) only wins when no threshold has a positive F1
    cands = (f1.where(F.col("f1") > 0)
               .select((F.col("i") * F.lit(THRESHOLD_STEP)).alias("threshold"), F.col("f1").alias("best_f1"), "i")
               .unionByName(spark.range(1).select(F.lit(DEFAULT_THRESHOLD).alias("threshold"),
                                                  F.lit(0.0).alias("best_f1"), F.lit(None).cast("int").alias("i"))))
    return (cands.orderBy(F.col("best_f1").desc(), F.col("i").asc_nulls_last()).limit(1)
                 .select("threshold", "best_f1"))


def timing_stats(df: DataFrame, c: str = "prediction_time") -> DataFrame:
    """sum / mean / sample std of prediction times."""
    return df.agg(F.sum(c).alias("total"), F.avg(c).alias("avg"), F.stddev_samp(c).alias("std"))


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(arr, F.array_max(arr)) - 1


def accuracy(df: DataFrame, logits: str, label: str) -> DataFrame:
    """Share of rows whose argmax equals the label."""
    return df.agg(F.avg((argmax(F.col(logits)) == F.col(label)).cast("double")).alias("accuracy"))
