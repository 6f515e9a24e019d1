import itertools

import numpy as np
from pyspark.sql import functions as F

from terrasol.operators import evaluate as ev

K = list(ev.LABELS)


def _df(spark, truth, scores):
    rows = [tuple(int(x) for x in t) + tuple(None if s is None else float(s) for s in sc)
            for t, sc in zip(truth, scores)]
    schema = ", ".join([f"{k} int" for k in K] + [f"{k}_score double" for k in K])
    df = spark.createDataFrame(rows, schema)
    return df.select(*[c for k in K for c in (k, k + "_score")])


def _brute(truth, pred):
    y, p = np.array(truth), np.array(pred)
    d = lambda a, b: 0.0 if b == 0 else a / b
    out = {}
    tps = (y * p).sum(0); fps = ((1 - y) * p).sum(0); fns = (y * (1 - p)).sum(0)
    for i, k in enumerate(K):
        out[k] = (d(tps[i], tps[i] + fps[i]), d(tps[i], tps[i] + fns[i]), d(2 * tps[i], 2 * tps[i] + fps[i] + fns[i]))
    tp, fp, fn = tps.sum(), fps.sum(), fns.sum()
    out["micro avg"] = (d(tp, tp + fp), d(tp, tp + fn), d(2 * tp, 2 * tp + fp + fn))
    per = np.array([out[k] for k in K]); sup = tps + fns
    out["macro avg"] = tuple(per.mean(0))
    out["weighted avg"] = tuple((per * sup[:, None]).sum(0) / sup.sum()) if sup.sum() else (0.0, 0.0, 0.0)
    rows = [(d((a * b).sum(), b.sum()), d((a * b).sum(), a.sum()), d(2 * (a * b).sum(), a.sum() + b.sum()))
            for a, b in zip(y, p)]
    out["samples avg"] = tuple(np.mean(rows, axis=0))
    return out


def test_report_matches_formulas(spark):
    rng = np.random.default_rng(7)
    truth = rng.integers(0, 2, (40, 4)).tolist() + [[0, 0, 0, 0]]
    scores = rng.random((41, 4)).round(2).tolist()
    scores[3][0] = None          # null score → not predicted
    scores[4][1] = 0.5           # exactly at the threshold → not predicted (strict)
    for r in scores:             # last label never predicted → zero division → 0
        r[3] = 0.1
    pred = [[int(s is not None and s > 0.5) for s in r] for r in scores]
    want = _brute(truth, pred)
    got = {r.label: (r.precision, r.recall, r.f1) for r in ev.classification_report(_df(spark, truth, scores)).collect()}
    for k, v in want.items():
        assert np.allclose(got[k], v), k


def test_threshold_ties_lowest_wins_and_default(spark):
    truth = [[1, 0, 0, 0], [0, 1, 0, 0]]
    scores = [[0.9, 0.1, 0.0, 0.0], [0.1, 0.9, 0.0, 0.0]]
    r = ev.best_threshold(_df(spark, truth, scores)).collect()[0]
    # every t in [0.1, 0.85] gives F1 = 1; the lowest candidate wins
    assert abs(r.threshold - 0.1) < 1e-12 and r.best_f1 == 1.0
    zero = ev.best_threshold(_df(spark, [[0, 0, 0, 0]], [[None, None, None, None]])).collect()[0]
    assert zero.threshold == 0.5 and zero.best_f1 == 0.0


def test_timing_single_row_std_null(spark):
    df = spark.createDataFrame([(1.5,)], "prediction_time double")
    r = ev.timing_stats(df).collect()[0]
    assert r.total == 1.5 and r.avg == 1.5 and r.std is None


def test_argmax_accuracy(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9], 1), ([2.0, 1.0, 0.0], 1)], "l array<double>, y int")
    assert ev.accuracy(df, "l", "y").collect()[0].accuracy == 0.5


def test_threshold_sweep_against_loop(spark):
    rng = np.random.default_rng(21)
    truth = rng.integers(0, 2, (60, 4)).tolist()
    scores = (rng.integers(0, 20, (60, 4)) * 0.05).round(2).tolist()      # many scores exactly on a threshold
    y = np.array(truth)
    best, thr = 0.0, 0.5
    for t in np.arange(0, 1, 0.05):                                        # the original loop
        p = (np.array(scores) > t).astype(int)
        tp, fp, fn = (y * p).sum(), ((1 - y) * p).sum(), (y * (1 - p)).sum()
        f1 = 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)
        if f1 > best:
            best, thr = f1, t
    r = ev.best_threshold(_df(spark, truth, scores)).collect()[0]
    assert abs(r.threshold - thr) < 1e-12 and abs(r.best_f1 - best) < 1e-12
