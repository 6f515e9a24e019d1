import math
import random
from collections import defaultdict

import numpy as np

from terrasol.llm import near_dedup
from terrasol.llm.common import WordIds
from terrasol.llm.queries import op10_near_dedup
from llm_data import SF, docs, empty, odd, words  # noqa: F401


def shingle_set(text):
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute_force(rows):
    """doc_id -> (set size, least reachable id) from all pairs that share a shingle."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for d, s in sets.items():
        for h in s:
            by[h].append(d)
    for a, b in {(a, b) for ds in by.values() for a in ds for b in ds if a < b}:
        n = len(sets[a] & sets[b])
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def check(got, rows):
    want = brute_force(rows)
    assert len(got) == len(rows)
    for r in got:
        n, c = want[r.doc_id]
        assert (r.n_shingles, r.component_id, r.kept) == (n, c, c == r.doc_id), r


def test_query_equals_brute_force(spark, docs):
    check(op10_near_dedup(spark, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_large_group_of_near_copies(spark, monkeypatch):
    """Copies of copies: many pairs just below and above the threshold, dealt over several tasks and rounds."""
    monkeypatch.setattr(near_dedup, "PIVOTS", 8)
    monkeypatch.setattr(near_dedup, "MEMBERS", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = [base]
    for _ in range(150):
        t = list(rng.choice(texts[-40:]))
        for _ in range(rng.choice((1, 1, 2, 3))):
            t[rng.randrange(len(t))] = f"x{rng.random()}"
        texts.append(t)
    texts += [[f"s{i}{j}" for j in range(rng.randrange(1, 12))] for i in range(30)]
    texts += [rng.choice(texts) for _ in range(30)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(near_dedup.near_duplicates(df).collect(), rows)


def test_odd_rows(spark, odd, empty):
    assert near_dedup.near_duplicates(empty).collect() == []
    got = near_dedup.near_duplicates(odd).collect()
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert len(got) == odd.count()
    assert by[1] == (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True)
    assert by[4] == (1, 4, True) and by[5] == (1, 4, False) and by[6] == (1, 4, False)
    assert by[7] == (15, 7, True) and by[8] == (15, 7, False)  # 14 of 16 shingles in common
    assert [r.kept for r in got if r.doc_id == 10] == [True, True]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def alike(rng, n, true):
    """Two sets of n elements each with at least the given Jaccard similarity (and as little more as they allow)."""
    both = max(1, math.ceil(2 * n * true / (1 + true)))
    rest = max(0, n - both)
    x = rng.integers(0, 2**64, both + 2 * rest, np.uint64)
    return np.unique(x[:both + rest]), np.unique(np.concatenate([x[:both], x[both + rest:]]))


def test_estimates_follow_the_true_similarity():
    rng = np.random.default_rng(1)
    for true in (0.5, 0.75, 0.9):
        errors = []
        for _ in range(60):
            a, b = alike(rng, 2000, true)
            est = near_dedup.estimate(near_dedup.registers(a), near_dedup.registers(b), np.array(len(a)), np.array(len(b)))
            errors.append(float(est) - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_bands_find_linkable_pairs_of_every_size_and_few_others():
    rng = np.random.default_rng(2)
    keys = lambda s: set(near_dedup.band_keys(near_dedup.sketches(s)).tolist())
    for n in (4, 8, 16, 24, 30, 33, 36, 40, 43, 60, 150, 1000):
        met = [bool(keys(a) & keys(b)) for a, b in (alike(rng, n, 0.76) for _ in range(150))]
        assert sum(met) >= 149, n
        far = [bool(keys(a) & keys(b)) for a, b in (alike(rng, max(n, 30), 0.06) for _ in range(100))]
        assert sum(far) <= 5, n
    small = np.unique(rng.integers(0, 2**64, 32, np.uint64))
    large = np.concatenate([small, rng.integers(0, 2**64, 10, np.uint64)])
    assert keys(small) & keys(np.unique(large))  # one on each side of the limit


def test_intersections_in_small_slices():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(20)]
    got = near_dedup.intersections(sets[:7], sets[7:], most=50)
    assert (got == [[len(np.intersect1d(p, m)) for p in sets[:7]] for m in sets[7:]]).all()


def test_shingles_of_short_texts():
    ids = WordIds()
    assert len(near_dedup.shingles(b" \n", ids)) == 0
    assert len(near_dedup.shingles(b"a b c d", ids)) == 1 == len(near_dedup.shingles(b"a b c d e", ids))
    assert near_dedup.shingles(b"a B", ids) == near_dedup.shingles(b"A  b", ids)
    assert near_dedup.shingles(b"a b", ids) != near_dedup.shingles(b"b a", ids)


A = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at "
B = "some other words that have nothing in common with what stands in any of the remaining rows"


def test_one_id_on_different_texts(spark):
    rows = [(3, A + "night"), (7, A + "noon"), (7, B), (8, B + " here"), (5, "x y"), (5, "z"), (4, A + "x"), (1, ""), (1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == sorted([(3, 15, 3, True), (7, 15, 3, False), (7, 13, 7, True), (8, 14, 7, False), (5, 1, 5, True), (5, 1, 5, True),
                          (4, 15, 3, False), (1, 0, 1, True), (1, 0, 1, True)])
    same = spark.createDataFrame([(7, A + "night"), (7, A + "noon")], "doc_id long, text string")
    assert sorted((r.component_id, r.kept) for r in near_dedup.near_duplicates(same).collect()) == [(7, False), (7, True)]
