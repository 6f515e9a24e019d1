import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from terrasol.llm import lm_score
from terrasol.llm.common import id_crc
from terrasol.llm.queries import op1_lm_score
from llm_data import SF, docs, empty, odd, words  # noqa: F401


def reference(rows, train, order=2, weights=(lm_score.K, lm_score.A)):
    """Scores by direct recursion over counted n-grams."""
    count, seqs = Counter(), []
    for doc, text in rows:
        seq = [" ", *words(text), "\n"]
        seqs.append(seq)
        if train(doc):
            count[(" ",)] += 1
            for i in range(1, len(seq)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        count[tuple(seq[i - k + 1:i + 1])] += 1
    tokens = sum(c for g, c in count.items() if len(g) == 1 and g != (" ",))
    types = sum(1 for g in count if len(g) == 1 and g != (" ",))

    def p(h, w):
        if not h:
            return (count[(w,)] + 1) / (tokens + types + 1)
        b = weights[0] + weights[1] * count[h]
        return (count[h + (w,)] + b * p(h[1:], w)) / (count[h] + b)

    out = []
    for (doc, _), seq in zip(rows, seqs):
        score = sum(math.log10(p(tuple(seq[max(0, i - order + 1):i]), seq[i])) for i in range(1, len(seq)))
        base = sum(math.log10((count[(w,)] + 1) / (tokens + types + 1)) for w in seq[1:])
        out.append((doc, len(seq) - 1, sum(count[(w,)] > 0 for w in seq[1:]), tokens, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key)):
        assert a[:4] == b[:4]
        assert math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_bigram_scores_equal_direct_recursion(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = lm_score.score_texts(docs, id_crc() % 7 != 2).collect()
    same(got, reference(rows, lambda d: zlib.crc32(str(d).encode()) % 7 != 2))


def test_many_blocks_lanes_and_orders_agree(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for order in (1, 2, 3):
        got = lm_score.score_texts(odd, F.col("doc_id") % 3 != 0, order=order, block_chars=500).collect()
        same(got, reference(rows, lambda d: d is not None and d % 3 != 0, order))


def test_probabilities_sum_to_one(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.limit(30).collect()]
    g = lm_score.Grams([(t or "").encode() for _, t in rows], 2)
    count = {k: __import__("numpy").bincount(g.of[k][g.of[k] >= 0], minlength=len(g.key[k])) for k in (1, 2)}
    start = g.of[1][g.first[0]]
    total = [c for i, c in enumerate(count[1]) if i != start]
    a = lm_score.Automaton(g, count, int(sum(total)), len(total), 2)
    word = g.seq[g.at[1]][[i for i in range(len(count[1])) if i != start]]
    import numpy as np
    word = np.append(word, np.uint64(12345))  # and the unknown word
    for state in range(0, len(g.key[1]), 37):
        p = a.step(np.ones(len(word), np.int64), np.full(len(word), state), word)
        assert math.isclose((10 ** p).sum(), 1, rel_tol=1e-9)


def test_empty_and_untrained(spark, empty, odd):
    assert lm_score.score_texts(empty, F.lit(True)).collect() == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same(lm_score.score_texts(odd, F.lit(False)).collect(), reference(rows, lambda d: False))


def test_query_scores_trigrams_with_a_falling_weight(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    count, seqs = Counter(), {}
    for doc, text in rows:
        seq = seqs[doc] = [" ", *words(text), "\n"]
        if not held(doc):
            count.update(tuple(seq[i:i + k]) for k in (1, 2, 3) for i in range(len(seq) - k + 1))
    single = [g for g in count if len(g) == 1 and g != (" ",)]
    n = sum(count[g] for g in single) + len(single) + 1

    def p(h, w):
        if not h:
            return (count[(w,)] + 1) / n
        b = 3 + 6 * count[h] ** 0.8
        return (count[h + (w,)] + b * p(h[1:], w)) / (count[h] + b)

    for r in op1_lm_score(spark, SF).collect():
        seq = seqs[r.doc_id]
        want = sum(math.log10(p(tuple(seq[max(0, i - 2):i]), seq[i])) for i in range(1, len(seq)))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        assert r.held_out == held(r.doc_id) and math.isclose(r.base_score, sum(math.log10(p((), w)) for w in seq[1:]), rel_tol=1e-9)


def test_weight_of_the_shorter_context_falls():
    share = lambda c: lm_score.mass(c, lm_score.FALLING) / (c + lm_score.mass(c, lm_score.FALLING))
    assert share(10) > share(1000) > share(100_000) and share(10.0 ** 9) < 0.1
