from collections import defaultdict

import numpy as np

from terrasol.llm import mixing
from terrasol.llm.queries import op3_mix
from llm_data import SF, docs, empty, odd, words  # noqa: F401


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Iterated resharing, as stated: cap, share the excess by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        part = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if part[s] >= cap * sizes[s]}
        if not above:
            target.update(part)
            break
        target.update({s: cap * sizes[s] for s in above})
        open_ -= above
    return target


def check(got, rows):
    sizes, taken, biggest, of = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for d, s, t in rows:
        sizes[s] += len(words(t))
        biggest[s] = max(biggest[s], len(words(t)))
        of[d] = s
    target = expected_targets(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, len(words(t))) for d, _, t in rows)
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= biggest[s] + 1e-6
    return taken, target


def test_query_meets_targets_and_reruns_agree(spark, docs):
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    got = op3_mix(spark, SF).collect()
    taken, target = check(got, rows)
    assert abs(sum(taken.values()) - sum(target.values())) < 0.02 * sum(target.values())
    assert sorted(map(tuple, got)) == sorted(map(tuple, op3_mix(spark, SF).collect()))


def test_hot_source_in_many_chunks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", " ".join("w" * int(rng.integers(1, 60)))) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, chunk=40).collect()
    taken, target = check(got, rows)
    for s in target:  # balanced chunks leave little to chance
        assert abs(taken[s] - target[s]) <= 60
    # the second total: copies per source stay near their expected number
    n, copies = defaultdict(int), defaultdict(int)
    for r in got:
        n[r.source] += 1
        copies[r.source] += r.copies
    for r in {(r.source, r.target / r.source_size) for r in got}:
        assert abs(copies[r[0]] - n[r[0]] * r[1]) <= 2


def test_odd_rows(spark, odd, empty):
    assert mixing.mix(empty).collect() == []
    rows = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    assert len(mixing.mix(odd).collect()) == len(rows)
    check([r for r in mixing.mix(odd).collect()], rows)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(6)
    size = rng.integers(0, 500, 400).astype(float)
    p = rng.random(400)
    x = np.column_stack([np.ones(400), size])
    q = mixing.fly(p, x, 1)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    assert np.allclose(q @ x, p @ x)
    mean = np.mean([mixing.land(mixing.fly(p[:9], x[:9], s), size[:9], s) for s in range(4000)], axis=0)
    assert np.abs(mean - p[:9]).max() < 0.05  # inclusion probabilities are kept
