import datetime as dt

from pyspark.sql import functions as F

from terrasol.operators import annotate


def test_upsert_preserves_validation_and_last_wins(spark):
    existing = spark.createDataFrame(
        [("a", "old a", True, "alice"), ("b", "old b", False, None)],
        "pdf_name string, explanation string, is_validated boolean, validated_by string")
    batch = spark.createDataFrame(
        [("a", 1, "new a1\x00"), ("a", 2, "new a2"), ("c", 1, "new c")],
        "pdf_name string, _ord int, explanation string")
    got = {r.pdf_name: (r.explanation, r.is_validated, r.validated_by, r.action)
           for r in annotate.upsert(existing, batch).collect()}
    assert got == {"a": ("new a2", True, "alice", "updated"), "b": ("old b", False, None, "unchanged"),
                   "c": ("new c", None, None, "created")}


def test_lock_expiry_boundaries(spark):
    as_of = dt.datetime(2024, 1, 1, 12, 0, 0)
    ann = spark.createDataFrame([
        ("exact", False, "u", as_of - dt.timedelta(minutes=60)),
        ("held", False, "u", as_of - dt.timedelta(minutes=60) + dt.timedelta(microseconds=1)),
        ("validated", True, "u", as_of - dt.timedelta(hours=3)),
        ("free", False, None, None),
    ], "pdf_name string, is_validated boolean, locked_by string, locked_at timestamp_ntz")
    as_of_col = F.lit(as_of).cast("timestamp_ntz")
    rel = {r.pdf_name: r.locked_by for r in annotate.release_expired(ann, as_of_col).collect()}
    assert rel == {"exact": None, "held": "u", "validated": "u", "free": None}
    claim = {r.pdf_name for r in annotate.claimable(annotate.release_expired(ann, as_of_col)).collect()}
    assert claim == {"exact", "free"}


def test_claim_sessions_gap_boundary(spark):
    t0 = dt.datetime(2024, 1, 1, 8, 0, 0)
    ev = spark.createDataFrame([
        (1, 1, t0), (1, 1, t0 + dt.timedelta(minutes=60)),                                   # exactly 60 → new claim
        (2, 1, t0), (2, 1, t0 + dt.timedelta(minutes=60) - dt.timedelta(microseconds=1)),    # refresh
        (2, 2, t0),
    ], "doc_id long, user_id long, ts timestamp_ntz")
    got = sorted((r.doc_id, r.user_id, r.n_events) for r in annotate.claim_sessions(ev).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 2), (2, 2, 1)]


def test_progress_and_summaries(spark):
    ann = spark.createDataFrame([
        ("a", True, "u1", {"surfaces_naturelles": True, "surfaces_agricoles": True},
         {"surfaces_naturelles": {"score": 0.9, "pred": True}}),
        ("b", True, "u2", {"surfaces_naturelles": False}, {"surfaces_naturelles": {"score": 0.1, "pred": False}}),
        ("c", False, None, None, {"surfaces_naturelles": {"score": 0.7, "pred": True}}),
    ], "pdf_name string, is_validated boolean, validated_by string, validated_predictions map<string,boolean>, "
       "original_predictions map<string,struct<score:double,pred:boolean>>")
    p = annotate.progress(ann, "u1").collect()[0]
    assert (p.total_docs, p.validated_docs, p.user_validated_docs) == (3, 2, 1)
    assert abs(p.overall_completion - 200 / 3) < 1e-9 and p.user_contribution == 50.0
    s = {r.pdf_name: (r.v, r.o) for r in ann.select(
        "pdf_name", annotate.validated_summary(ann).alias("v"), annotate.original_summary(ann).alias("o")).collect()}
    assert s["a"] == ("2 labels: surfaces_naturelles, surfaces_agricoles", "1 labels: surfaces_naturelles")
    assert s["b"] == ("No labels selected", "No labels selected")
    assert s["c"][0] == "Not validated"
    empty = annotate.progress(ann.where("false")).collect()[0]
    assert empty.overall_completion == 0.0 and empty.user_contribution == 0.0


def test_claim_sessions_stitched_across_buckets(spark):
    d = dt.datetime(2024, 1, 1, 23, 30, 0)
    ev = spark.createDataFrame([
        (1, 1, d), (1, 1, d + dt.timedelta(minutes=40)), (1, 1, d + dt.timedelta(minutes=80)),   # one claim over midnight
        (2, 1, d), (2, 1, d + dt.timedelta(minutes=60)),                                          # exactly 60: two claims
    ], "doc_id long, user_id long, ts timestamp_ntz")
    got = sorted((r.doc_id, r.n_events, r.claim_start, r.last_refresh) for r in annotate.claim_sessions(ev).collect())
    assert got == [(1, 3, d, d + dt.timedelta(minutes=80)), (2, 1, d, d), (2, 1, d + dt.timedelta(minutes=60),
                                                                           d + dt.timedelta(minutes=60))]


def test_two_phase_sessions_equal_single_phase(spark):
    import random
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 3, 1, 0, 0, 0)
    rows, t = [], t0
    for _ in range(600):                          # hot key: one (doc, user) over several days
        t += dt.timedelta(minutes=rnd.choice([5, 30, 59, 60, 61, 180]), microseconds=rnd.choice([0, 1, -1]))
        rows.append((1, 1, t))
    rows += [(2, rnd.randint(1, 3), t0 + dt.timedelta(minutes=rnd.randint(0, 5000))) for _ in range(200)]
    ev = spark.createDataFrame(rows, "doc_id long, user_id long, ts timestamp_ntz")
    direct = (ev.groupBy("doc_id", "user_id", F.session_window("ts", annotate.CLAIM_GAP))
                .agg(F.min("ts").alias("s"), F.max("ts").alias("l"), F.count("*").alias("n")))
    a = sorted((r.doc_id, r.user_id, r.s, r.l, r.n) for r in direct.collect())
    b = sorted((r.doc_id, r.user_id, r.claim_start, r.last_refresh, r.n_events)
               for r in annotate.claim_sessions(ev).collect())
    assert a == b and len(a) > 50
