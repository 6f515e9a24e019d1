"""Annotation table operators (S11 W4 F13-F15 O3 A15-A18 X30 N3 K2 batch twin).

The annotation table is keyed by ``pdf_name`` and carries the model's original
predictions (``map<label, struct<score, pred>>``), the human validation
(``map<label, boolean>``, who, when) and a claim lock (who, when).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasol.operators.evaluate import LABELS, div0

LOCK_TIMEOUT_MINUTES = 60
CLEANUP_TIMEOUT_MINUTES = 30
# 60 minutes minus one microsecond: a gap of exactly 60 minutes opens a new claim.
CLAIM_GAP_US = 3_599_999_999
CLAIM_GAP = f"{CLAIM_GAP_US} microseconds"

PREDICTION_FIELDS = ["pdf_text", "pdf_text_raw", "contexts", "explanation", "prediction_time",
                     "original_predictions"]
VALIDATION_FIELDS = ["is_validated", "validated_by", "validated_at", "validated_predictions",
                     "locked_by", "locked_at"]


def pack_predictions(labels=LABELS) -> Column:
    """Wide ``{label}_score`` / ``{label}_pred`` columns → map<label, struct<score, pred>>."""
    kv = []
    for k in labels:
        kv += [F.lit(k), F.struct(F.col(k + "_score").cast("double").alias("score"),
                                  F.col(k + "_pred").cast("boolean").alias("pred"))]
    return F.create_map(*kv)


def dedupe_last(batch: DataFrame, key: str, order: str) -> DataFrame:
    """Last row per key by ``order`` (W4), as a partial aggregation: hot keys are
    reduced map-side before the shuffle instead of being sorted in one task."""
    others = [c for c in batch.columns if c not in (key, order)]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order))
    return batch.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def upsert(existing: DataFrame, batch: DataFrame, key: str = "pdf_name", order: str = "_ord") -> DataFrame:
    """Upsert keyed on ``key`` (S11): NULs stripped from text, last batch row wins,
    prediction fields replaced, validation and lock fields preserved; ``action``
    tells created / updated / unchanged."""
    new = dedupe_last(batch, key, order)
    for c in ("pdf_text", "pdf_text_raw", "explanation"):
        if c in new.columns:
            new = new.withColumn(c, F.replace(F.col(c), F.lit("\x00"), F.lit("")))
    pred_cols = [c for c in new.columns if c != key]
    n = new.select(key, *[F.col(c).alias("_n_" + c) for c in pred_cols], F.lit(True).alias("_in_new"))
    joined = existing.withColumn("_in_old", F.lit(True)).join(n, key, "full_outer")
    out_cols = [F.col(key)]
    for c in existing.columns:
        if c == key:
            continue
        if c in pred_cols:
            out_cols.append(F.when(F.col("_in_new"), F.col("_n_" + c)).otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    for c in pred_cols:
        if c not in existing.columns:
            out_cols.append(F.col("_n_" + c).alias(c))
    action = (F.when(F.col("_in_old").isNull(), "created")
               .when(F.col("_in_new").isNull(), "unchanged").otherwise("updated"))
    return joined.select(*out_cols, action.alias("action"))


def progress(ann: DataFrame, user: str | None = None) -> DataFrame:
    """total, validated, completion % and per-user contribution %."""
    v = F.coalesce(F.col("is_validated"), F.lit(False))
    mine = v & (F.col("validated_by") == F.lit(user)) if user is not None else F.lit(False)
    agg = ann.agg(F.count("*").alias("total_docs"), F.count_if(v).alias("validated_docs"),
                  F.count_if(mine).alias("user_validated_docs"))
    return agg.select("total_docs", "validated_docs",
                      (div0(F.col("validated_docs"), F.col("total_docs")) * 100).alias("overall_completion"),
                      "user_validated_docs",
                      (div0(F.col("user_validated_docs"), F.col("validated_docs")) * 100).alias("user_contribution"))


def user_contributions(ann: DataFrame) -> DataFrame:
    """Every validator's share of the validated documents (A15, all users at once)."""
    v = ann.where(F.col("is_validated"))
    per = v.groupBy("validated_by").agg(F.count("*").alias("n_validated"))
    # validators grow with the users: the grand total is one broadcast row
    total = v.agg(F.count("*").alias("_total"))
    return per.join(F.broadcast(total)).select(
        "validated_by", "n_validated", (div0(F.col("n_validated"), F.col("_total")) * 100).alias("contribution_pct"))


def leaderboard(ann: DataFrame) -> DataFrame:
    """Validated documents per user, most first."""
    return (ann.where(F.col("is_validated")).groupBy("validated_by")
               .agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), F.col("validated_by")))


def human_vs_model(ann: DataFrame, labels=LABELS) -> DataFrame:
    """Wide truth/score frame for the report: truth = validated map, prediction =
    original ``pred`` (as score 1/0 so the 0.5 threshold reproduces it) (A18)."""
    v = ann.where(F.col("is_validated"))
    cols = []
    for k in labels:
        cols.append(F.coalesce(F.col("validated_predictions")[k], F.lit(False)).cast("int").alias(k))
        cols.append(F.col("original_predictions")[k]["pred"].cast("double").alias(k + "_score"))
    return v.select(*cols)


def _summary(keys: Column) -> Column:
    return F.when(F.size(keys) > 0, F.concat(F.size(keys).cast("string"), F.lit(" labels: "),
                                              F.array_join(keys, ", "))).otherwise(F.lit("No labels selected"))


def validated_summary(ann: DataFrame) -> Column:
    """"n labels: a, b" / "No labels selected" / "Not validated" (X30, N3)."""
    keys = F.map_keys(F.map_filter(F.col("validated_predictions"), lambda k, x: x))
    return F.when(~F.coalesce(F.col("is_validated"), F.lit(False)), F.lit("Not validated")).otherwise(_summary(keys))


def original_summary(ann: DataFrame) -> Column:
    keys = F.map_keys(F.map_filter(F.col("original_predictions"), lambda k, x: F.coalesce(x["pred"], F.lit(False))))
    return _summary(keys)


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def stale_locks(ann: DataFrame, as_of, minutes: int = CLEANUP_TIMEOUT_MINUTES) -> DataFrame:
    """Locks taken at or before ``as_of - minutes`` (F14, cleanup command)."""
    limit = _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return ann.where(F.col("locked_by").isNotNull() & (F.col("locked_at") <= limit))


def lock_states(ann: DataFrame, as_of, stale: int = CLEANUP_TIMEOUT_MINUTES, expiry: int = LOCK_TIMEOUT_MINUTES) -> DataFrame:
    """One row per lock and state that holds at ``as_of``: ``stale`` (F14, cleanup) and ``expired`` (F14, expiry), in one pass."""
    old = lambda minutes: F.col("locked_by").isNotNull() & (F.col("locked_at") <= _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    kinds = F.array(F.when(old(stale), F.lit("stale")),
                    F.when(old(expiry) & ~F.coalesce(F.col("is_validated"), F.lit(False)), F.lit("expired")))
    return ann.select("*", F.explode(F.array_compact(kinds)).alias("kind"))


def release_expired(ann: DataFrame, as_of, minutes: int = LOCK_TIMEOUT_MINUTES) -> DataFrame:
    """Clear locks held for ``>= minutes`` on unvalidated documents (F14, expiry)."""
    limit = _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    expired = ~F.coalesce(F.col("is_validated"), F.lit(False)) & (F.col("locked_at") <= limit)
    return (ann.withColumn("locked_by", F.when(expired, F.lit(None)).otherwise(F.col("locked_by")))
               .withColumn("locked_at", F.when(expired, F.lit(None)).otherwise(F.col("locked_at"))))


def claimable(ann: DataFrame) -> DataFrame:
    """Not validated and not locked."""
    return ann.where(~F.coalesce(F.col("is_validated"), F.lit(False)) & F.col("locked_by").isNull())


def next_claimable(ann: DataFrame, seed: str = "42", key: str = "pdf_name") -> DataFrame:
    """One pseudo-random claimable document, repeatable by seed (O3): top-1 by md5."""
    return claimable(ann).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))).limit(1)


def claim_sessions(events: DataFrame, key: str = "doc_id", user: str = "user_id", ts: str = "ts",
                   gap_us: int = CLAIM_GAP_US, bucket: str = "day") -> DataFrame:
    """Claim life-cycle as sessions per (document, user) (K2 batch twin): a claim
    refreshed within 60 minutes continues, a gap of 60 minutes or more starts a
    new claim.

    Two phases so a (document, user) pair holding a large share of all events is
    never sessionized by one task: (1) sessions inside each (key, user, time
    bucket) in parallel; (2) the partial sessions — far fewer rows — are
    stitched with a dynamic-gap ``session_window`` whose window spans
    ``[start, last + gap)``, which merges two partial sessions exactly when the
    event gap across the bucket boundary is below the claim gap."""
    b = F.date_trunc(bucket, F.col(ts))
    gap = f"{int(gap_us)} microseconds"
    part = (events.groupBy(key, user, b.alias("_bucket"), F.session_window(F.col(ts), gap).alias("_w"))
                  .agg(F.min(ts).alias("_s"), F.max(ts).alias("_l"), F.count("*").alias("_n")))
    dyn = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, CAST((timestampdiff(MICROSECOND, _s, _l) + {int(gap_us)}) "
                 f"/ 1000000.0 AS DECIMAL(18, 6)))")
    return (part.groupBy(key, user, F.session_window(F.col("_s"), dyn).alias("w"))
                .agg(F.min("_s").alias("claim_start"), F.max("_l").alias("last_refresh"),
                     F.sum("_n").alias("n_events"))
                .drop("w"))


def validated_between(ann: DataFrame, first, last, at: str = "validated_at") -> DataFrame:
    """Admin facet (F13): documents validated from ``first`` to before ``last``."""
    return ann.where(F.coalesce(F.col("is_validated"), F.lit(False)) & (F.col(at) >= _ts(first)) & (F.col(at) < _ts(last)))


def search(ann: DataFrame, term: str, validated: bool | None = None) -> DataFrame:
    """Admin facets (F13): optional validation filter and a case-insensitive
    search in ``pdf_name`` or any context."""
    t = term.lower()
    hit = F.lower(F.col("pdf_name")).contains(t) | F.exists(F.col("contexts"), lambda c: F.lower(c).contains(t))
    out = ann.where(hit)
    if validated is not None:
        out = out.where(F.coalesce(F.col("is_validated"), F.lit(False)) == F.lit(validated))
    return out
