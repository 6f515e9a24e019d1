import zlib

import numpy as np

from terrasol.llm import quality
from terrasol.llm.queries import op8_quality
from llm_data import SF, docs, empty, odd  # noqa: F401


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    y = np.array(labels)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r.doc_id: r for r in op8_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for d, r in got.items())
    held = [x for x in labels if got[x.doc_id].held_out]
    assert auc([got[x.doc_id].score for x in held], [x.quality for x in held]) > 0.97
    assert np.mean([got[x.doc_id].predicted == x.quality for x in held]) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", __import__("pyspark").sql.functions.expr(
        "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end"))
    assert (quality.train(docs, labels) == quality.train(docs, flipped)).all()


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (7, 1), (7, 1), (9, 0), (99, 1)], "doc_id long, quality int")
    w = quality.train(odd, labels)
    got = quality.score(odd, w).collect()
    assert len(got) == odd.count() and all(0 < r.score < 1 for r in got)
    assert quality.score(empty, w).collect() == []
    none = quality.train(empty, labels.where("false"))
    assert not none.any() and {r.score for r in quality.score(odd, none).collect()} == {0.5}


def test_features_are_shares_of_hashed_ngrams():
    f = quality.Features()
    assert len(f("")) == 0 and len(f("one")) == 2 and len(f("a b c")) == 3 + 2 + 3 + 2 + 1
    assert sorted(f("Der der")) != sorted(f("Der die"))
    assert (f("a b a b") == quality.Features()("a b a b")).all()


def test_scores_equal_a_direct_computation(spark, docs):  # noqa: F811
    import math
    import re
    import xxhash
    import numpy as np
    from terrasol.llm import quality
    rng = np.random.default_rng(1)
    weights = rng.normal(0, 1, (1 << 10) + 1)

    def mixed(x):
        m = (1 << 64) - 1
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & m
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & m
        return x ^ x >> 31

    def direct(text):
        m, h = (1 << 64) - 1, xxhash.xxh3_64_intdigest
        words, shapes = [], []
        for w in re.findall(r"\w+|[^\w\s]+", text):
            shape = w[:2] if not w[0].isalnum() else "9" if w.isdigit() else "u" if len(w) > 1 and w.isupper() else "t" if w[0].isupper() else "l"
            words.append(h(w.lower().encode()))
            shapes.append(h(b"\0" + shape.encode()) ^ (0x5555 if len(words) > 1 and words[-1] == words[-2] else 0))
        grams = [*words, *(a * 3 + b & m for a, b in zip(words, words[1:])), *shapes, *(a * 5 + b & m for a, b in zip(shapes, shapes[1:])),
                 *(a * 7 + b * 11 + c & m for a, b, c in zip(shapes, shapes[1:], shapes[2:]))]
        values = [float(np.float32(weights[mixed(g) & 1023])) for g in grams]
        z = float(np.float32(weights[-1])) + (sum(values) * quality.SCALE / len(grams) if grams else 0.0)
        return 1 / (1 + math.exp(-min(max(z, -35.0), 35.0)))

    got = {r.doc_id: r.score for r in quality.score(docs, weights, 10).collect()}
    for r in docs.collect():
        assert math.isclose(got[r.doc_id], direct(r.text or ""), rel_tol=1e-9, abs_tol=1e-12)
